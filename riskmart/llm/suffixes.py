"""Suffix-array dedup: bytes covered by a string of `LENGTH` bytes that also starts earlier.

Only suffixes whose first LENGTH bytes occur twice matter, so most are ruled out before any text moves:

1. Each window of LENGTH bytes has an anchor, its gram of least hash. Equal windows have equal anchors, so suffixes are
   compared only under the same anchor. Neighbouring suffixes that share an anchor form a run (about 35 of them), and
   travel as one row. Rows are first combined within each batch: a run with the content of an earlier one is a repeat.
2. Under an anchor, runs of equal content are repeats of the first one. Only where contents differ, the first run of each
   content goes on, with its text.
3. Sampled splitters range-partition the suffixes of these runs by anchor; each bucket sorts its suffixes by multikey
   quicksort (eight bytes a step, ties only go on) and compares neighbours. A splitter never parts equal anchors, so equal
   suffixes never lie on both sides of a boundary; a group that runs over from one batch into the next is carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.tables import stored
from riskmart.llm.words import CHUNK, NO_ID, _tables, buffers, mix, numbered, parts, pieces

#: Bytes of a string that counts as repeated.
LENGTH = 100
#: Bytes of an anchor gram.
GRAM = 32
#: Different runs under one anchor that are compared as runs; beyond that each suffix travels by itself.
MOST_RUNS = 5_000
#: Suffixes sorted at once.
MOST_SUFFIXES = 200_000


def prefix_hash(data: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _tables()[0][: len(data)], out=total[1:])
    return total


def substring_hashes(total: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return mix((total[stop] - total[start]) * _tables()[1][start] + (stop - start).astype(np.uint64))


def segments(data: np.ndarray, ptr: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(bytes, pointer, text numbers, offset) of stretches below CHUNK bytes; a longer text is cut so that each window lies in one stretch."""
    if ptr[-1] <= CHUNK - 1:
        yield data, ptr, np.arange(len(ptr) - 1), 0
        return
    for k in range(len(ptr) - 1):
        for at in range(ptr[k], max(ptr[k] + 1, ptr[k + 1] - LENGTH + 1), CHUNK - LENGTH):
            stop = min(ptr[k + 1], at + CHUNK - 1)
            yield data[at:stop], np.array([0, stop - at]), np.array([k]), int(at - ptr[k])


def runs(data: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, stop, anchor, content) of each run of windows with one anchor: bytes start to stop of the text."""
    out = [[] for _ in range(5)]
    for raw, cut, texts, offset in segments(data, ptr):
        if len(raw) < LENGTH:
            continue
        total = prefix_hash(raw)
        at = np.arange(len(raw) - GRAM + 1)
        gram = substring_hashes(total, at, at + GRAM)
        places = np.uint64(CHUNK - 1)
        least = (gram & ~places) | at.astype(np.uint64)
        width = 1
        while 2 * width <= LENGTH - GRAM + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = LENGTH - GRAM + 1 - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        anchor = (least & places).astype(np.int64)  # of the window that starts here
        owner = np.repeat(np.arange(len(texts)), np.diff(cut))[: len(anchor)]
        whole = np.arange(len(anchor)) + LENGTH <= cut[owner + 1]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | ~whole[:-1]
        begin = np.flatnonzero(new & whole)
        follow = np.searchsorted(np.flatnonzero(new), begin, "right")
        end = np.append(np.flatnonzero(new), len(anchor))[follow]
        valid = np.concatenate([[0], np.cumsum(whole)])
        stop = begin + (valid[end] - valid[begin]) - 1 + LENGTH
        base = cut[owner[begin]]
        for column, values in zip(out, (texts[owner[begin]], begin - base + offset, stop - base + offset, gram[anchor[begin]], substring_hashes(total, begin, stop)), strict=True):
            column.append(values)
    kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
    return tuple(np.concatenate(c).astype(k) if c else np.zeros(0, k) for c, k in zip(out, kinds, strict=True))


RUN = "anchor long, content long, key long, copy int, start long, stop long, seen boolean"


def _found_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of the batch; all but the first of equal runs come out as seen, joined where they touch."""
    for batch in batches:
        columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        row = 0
        for part in pieces(batch, "text", CHUNK - 1):
            found = runs(*buffers(part.column("text")))
            columns[0].append(found[0] + row)
            for column, values in zip(columns[1:], found[1:], strict=True):
                column.append(values)
            row += part.num_rows
        if not columns[0]:
            continue
        text, start, stop, anchor, content = (np.concatenate(c) for c in columns)
        key, copy = batch.column("key").to_numpy()[text], batch.column("copy").to_numpy()[text]
        order = np.lexsort((start, copy, key, content, anchor))
        a, c = anchor[order], content[order]
        again = np.zeros(len(order), bool)
        again[1:] = (a[1:] == a[:-1]) & (c[1:] == c[:-1])
        first, later = order[~again], order[again]
        yield _run_batch(anchor[first], content[first], key[first], copy[first], start[first], stop[first], False)
        later = later[np.lexsort((start[later], text[later]))]
        if len(later):
            new = np.ones(len(later), bool)
            new[1:] = (text[later][1:] != text[later][:-1]) | (start[later][1:] > stop[later][:-1])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(later)) - 1  # stops ascend within a text
            yield _run_batch(mix(key[later[head]].view(np.uint64)), content[later[head]], key[later[head]], copy[later[head]], start[later[head]], stop[later[tail]], True)


def _run_batch(anchor, content, key, copy, start, stop, seen) -> pa.RecordBatch:
    columns = [anchor.view(np.int64), content.view(np.int64), key, copy.astype(np.int32), start, stop, np.full(len(key), seen)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "content", "key", "copy", "start", "stop", "seen"])


#: What becomes of a run: its bytes are repeated, its suffixes must be compared, or compared one by one.
SEEN, COMPARE, SINGLY = 0, 1, 2


def _classed(most_runs: int):
    names = ["anchor", "key", "copy", "start", "stop", "state"]

    def emit(rows: dict[str, np.ndarray], state: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[n]) for n in names[:-1]] + [pa.array(np.full(len(rows["key"]), state, np.int32))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor, content, key, copy, start."""
        last: tuple[int, int] | None = None
        held: list[dict[str, np.ndarray]] = []  # first runs of the anchor that is not yet over
        single = False  # that anchor has too many different runs to hold

        def size() -> int:
            return sum(len(h["key"]) for h in held)

        for batch in batches:
            rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("anchor", "content", "key", "copy", "start", "stop", "seen")}
            done = rows["seen"]
            if done.any():
                yield emit({n: v[done] for n, v in rows.items()}, SEEN)
                rows = {n: v[~done] for n, v in rows.items()}
            if not len(rows["key"]):
                continue
            a, c = rows["anchor"], rows["content"]
            new_anchor, new = np.ones(len(a), bool), np.ones(len(a), bool)
            new_anchor[1:] = a[1:] != a[:-1]
            new[1:] = new_anchor[1:] | (c[1:] != c[:-1])
            if last:
                new_anchor[0] = a[0] != last[0]
                new[0] = new_anchor[0] or c[0] != last[1]
            last = (a[-1], c[-1])
            if (~new).any():
                yield emit({n: v[~new] for n, v in rows.items()}, SEEN)
            tops = np.append(np.flatnonzero(new_anchor), len(a))
            if tops[0] > 0 and new[: tops[0]].any():  # goes on with the held anchor
                more = {n: v[: tops[0]][new[: tops[0]]] for n, v in rows.items()}
                if single:
                    yield emit(more, SINGLY)
                else:
                    held.append(more)
            if len(tops) > 1:  # the held anchor is over, and all but the last of this batch
                if not single and size() > 1:
                    yield from (emit(h, COMPARE) for h in held)
                group = np.cumsum(new_anchor)[tops[0] :]
                group = group - group[0]
                firsts = new[tops[0] :]
                count = np.bincount(group[firsts])
                inner = firsts & (count[group] > 1) & (group < len(count) - 1)
                if inner.any():
                    yield emit({n: v[tops[0] :][inner] for n, v in rows.items()}, COMPARE)
                single = False
                held = [{n: v[tops[-2] :][new[tops[-2] :]] for n, v in rows.items()}]
            if not single and size() > most_runs:
                yield from (emit(h, SINGLY) for h in held)
                held, single = [], True
        if not single and size() > 1:
            yield from (emit(h, COMPARE) for h in held)

    return run


def _with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """anchor, key, copy, start, bytes of each run to compare; a suffix that travels singly is keyed by its own hash."""
    names = ["anchor", "key", "copy", "start", "bytes"]
    for batch in batches:
        for part in pieces(batch, "text"):
            raw, ptr = buffers(part.column("text"))
            listed = part.column("runs")
            rows = listed.flatten()
            own = np.repeat(np.arange(part.num_rows), np.diff(listed.offsets.to_numpy()))
            start, stop, anchor, state = (rows.field(n).to_numpy() for n in ("start", "stop", "anchor", "state"))
            key, copy = part.column("key").to_numpy(), part.column("copy").to_numpy()
            whole = state == COMPARE
            n = stop[~whole] - start[~whole] - LENGTH + 1
            alone_own = np.repeat(own[~whole], n)
            alone = np.repeat(start[~whole] - np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64), n) + np.arange(n.sum())
            begin = np.concatenate([ptr[own[whole]] + start[whole], ptr[alone_own] + alone])
            size = np.concatenate([stop[whole] - start[whole], np.full(len(alone), LENGTH)])
            owner = np.concatenate([own[whole], alone_own])
            for low in range(0, len(begin), 50_000):
                b, s, o = begin[low : low + 50_000], size[low : low + 50_000], owner[low : low + 50_000]
                offsets = np.concatenate([[0], np.cumsum(s)])
                at = np.repeat(b - offsets[:-1], s) + np.arange(offsets[-1])
                content = raw[at] if len(at) else raw[:0]
                keys = anchor[whole][low : low + 50_000]
                if len(keys) < len(b):
                    singles = np.array([int.from_bytes(hashlib.blake2b(content[x : x + LENGTH].tobytes(), digest_size=8).digest(), "little", signed=True) for x in offsets[len(keys) : -1]], np.int64)
                    keys = np.concatenate([keys, singles])
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(b), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(content.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(key[o]), pa.array(copy[o]), pa.array(b - ptr[o]), binary.cast(pa.binary())], names)


def multikey_classes(rows: np.ndarray) -> np.ndarray:
    """The class of each row of bytes among equal rows: sorted by eight bytes at a time, where only ties go on."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8")
    label = np.zeros(n, np.int64)
    open_rows = np.arange(n)
    for k in range(words.shape[1]):
        if not len(open_rows):
            break
        word = words[open_rows, k].astype(np.uint64)
        order = np.lexsort((word, label[open_rows]))
        at = open_rows[order]
        new = np.ones(len(at), bool)
        new[1:] = (label[at][1:] != label[at][:-1]) | (word[order][1:] != word[order][:-1])
        head = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
        label[at] = head + 1 + n * k  # any name that is the class's own
        count = np.diff(np.append(np.flatnonzero(new), len(at)))
        open_rows = at[np.repeat(count, count) > 1]
        alone = at[np.repeat(count, count) == 1]
        label[alone] = -1 - alone
    return label


def repeated_suffixes(content: list[bytes], key: np.ndarray, copy: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, offset in it) of the suffixes whose first LENGTH bytes also start earlier, by key, copy and start."""
    n = np.array([len(c) - LENGTH + 1 for c in content])
    ptr = np.concatenate([[0], np.cumsum([len(c) for c in content])])
    run = np.repeat(np.arange(len(n)), n)
    inner = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    raw = np.frombuffer(b"".join(content), np.uint8)
    label = multikey_classes(np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[ptr[run] + inner])
    order = np.lexsort((start[run] + inner, copy[run], key[run], label))
    again = np.zeros(len(order), bool)
    again[1:] = label[order][1:] == label[order][:-1]
    later = np.sort(order[again])
    return run[later], inner[later]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, copy, start, stop of the bytes of repeated suffixes. Rows come sorted by anchor, key, copy, start."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        content = rows.column("bytes").to_pylist()
        key, copy, start = (rows.column(n).to_numpy() for n in ("key", "copy", "start"))
        run, inner = repeated_suffixes(content, key, copy, start)
        new = np.ones(len(run), bool)
        new[1:] = (run[1:] != run[:-1]) | (inner[1:] != inner[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(run)) - 1 if len(run) else head
        columns = [key[run[head]], copy[run[head]], start[run[head]] + inner[head], start[run[head]] + inner[tail] + LENGTH]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "copy", "start", "stop"])

    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        anchor = rest.column("anchor").to_numpy()
        tops = np.append(np.flatnonzero(np.append([True], anchor[1:] != anchor[:-1])), len(anchor))
        sizes = pc.binary_length(rest.column("bytes")).to_numpy() - LENGTH + 1
        total = np.concatenate([[0], np.cumsum(sizes)])
        low = 0
        while low < len(tops) - 2:  # all groups but the last, which may go on
            high = max(low + 1, int(np.searchsorted(total[tops], total[tops[low]] + MOST_SUFFIXES, "right")) - 1)
            high = min(high, len(tops) - 2)
            yield solve(rest.slice(tops[low], tops[high] - tops[low]))
            low = high
        rest = rest.slice(tops[-2])
        if rest.num_rows > 2 * MOST_RUNS and (sizes[tops[-2] :] == 1).all():  # equal single suffixes: only the first must stay
            yield solve(rest)
            rest = rest.slice(0, 1)
    if rest is not None and rest.num_rows:
        yield solve(rest)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string, starts array<long>, stops array<long>"
NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _cut(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                raw, ptr = buffers(part.column("text"))
                listed = part.column("spans")
                rows = listed.flatten()
                start, stop = rows.field("start").to_numpy(), rows.field("stop").to_numpy()
                at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(listed), 0).to_numpy())])
                out = []
                for k, key in enumerate(part.column("key").to_pylist()):
                    text = raw[ptr[k] : ptr[k + 1]]
                    order = np.argsort(start[at[k] : at[k + 1]], kind="stable")
                    s, e = start[at[k] : at[k + 1]][order], np.maximum.accumulate(stop[at[k] : at[k + 1]][order])
                    head = np.flatnonzero(np.append([True], s[1:] > e[:-1])) if len(s) else np.zeros(0, np.int64)
                    heads, tails = s[head], e[np.append(head[1:], len(s))[: len(head)] - 1]
                    edges = np.concatenate([[0], np.stack([heads, tails], 1).ravel(), [len(text)]]).astype(np.int64)
                    kept = b"".join(text[edges[i] : edges[i + 1]].tobytes() for i in range(0, len(edges), 2))
                    digest = hashlib.sha256(kept).hexdigest()
                    doc_id = None if key == NO_ID else key
                    out.append((doc_id, len(text), len(text) - len(kept), len(heads), kept if keep_text else None, digest, heads.tolist(), tails.tolist()))
                kinds = [pa.int64()] * 4 + [pa.binary(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], NAMES)

    return run


def remove_repeats(docs: DataFrame, keep_text: bool = True, most_runs: int = MOST_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left; NULL unless keep_text), kept_sha256, starts, stops.

    Each byte covered by LENGTH equal bytes that also start earlier (smaller doc_id, or the same document and an earlier
    start) goes; starts and stops are the byte spans removed. Kept bytes may end within a character, so they are binary.
    NULL and empty texts have nothing to remove. A NULL doc_id comes before all others; rows that repeat an id count in
    the order of their texts. One row comes out for each row of docs; an empty table gives an empty one.
    """
    n = parts(docs.sparkSession)
    rows = numbered(docs)
    found = rows.mapInArrow(_found_runs, RUN)
    dealt = found.repartition(n, "anchor").sortWithinPartitions("anchor", "content", "key", "copy", "start")
    classed = stored(dealt.mapInArrow(_classed(most_runs), "anchor long, key long, copy int, start long, stop long, state int"))
    open_runs = classed.filter(F.col("state") != SEEN).groupBy("key", "copy").agg(F.collect_list(F.struct("start", "stop", "anchor", "state")).alias("runs"))
    carried = rows.join(open_runs, ["key", "copy"]).select("key", "copy", "text", "runs").mapInArrow(_with_text, "anchor long, key long, copy int, start long, bytes binary")
    bucket = carried.repartitionByRange(n, "anchor").sortWithinPartitions("anchor", "key", "copy", "start")
    compared = bucket.mapInArrow(_compared, "key long, copy int, start long, stop long")
    seen = classed.filter(F.col("state") == SEEN).select("key", "copy", "start", "stop")
    spans = seen.unionByName(compared).groupBy("key", "copy").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return rows.join(spans, ["key", "copy"], "left").select("key", "text", "spans").mapInArrow(_cut(keep_text), RESULT)
