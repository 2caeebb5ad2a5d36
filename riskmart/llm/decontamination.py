"""Benchmark decontamination: q-gram lemma filtering over diagonal bands, then banded alignment.

Texts are compared as UTF-8 bytes with A-Z as a-z and each space or control space as one space. An item of m bytes has an
edit budget of floor(rate * m). If it occurs in a document with e edits or fewer, then at least m + 1 - q * (e + 1) of its
q-grams occur there on diagonals that lie within e of each other. Bands of twice e + 1 diagonals that overlap by half
contain any such run of diagonals, so counting per band loses nothing; regions with enough are verified by alignment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.words import LOWER, SPACES, buffers, pieces, plain

#: Bytes of a gram. Shorter items say too little to be found in a text and match nothing.
Q = 12
#: Edits allowed for each byte of an item.
RATE = 0.05
#: Bytes of items that are broadcast at once; a larger benchmark goes through the documents block by block.
BLOCK_BYTES = 4_000_000
FILTER_BITS = 21


def normal(data: np.ndarray) -> np.ndarray:
    data = LOWER[data]
    data[SPACES[data]] = 32
    return data


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of the Q bytes at each position."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8").ravel()
    n = len(data) - Q + 1
    return (eight[:n] * np.uint64(0x9E3779B97F4A7C15)) ^ ((eight[Q - 8 : Q - 8 + n] + np.uint64(0x7F4A7C15)) * np.uint64(0xD6E8FEB86659FD93))


def slot(gram: np.ndarray) -> np.ndarray:
    return ((gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - FILTER_BITS)


class Index:
    """The grams of a block of items, for lookups by position."""

    def __init__(self, items: list[tuple[int | None, bytes]], rate: float) -> None:
        self.ids = [i for i, _ in items]
        self.texts = [normal(np.frombuffer(t, np.uint8)) for _, t in items]
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        # the lemma needs one shared gram at least, so the budget of a short item is lower
        self.budget = np.minimum(np.floor(rate * self.sizes), (self.sizes // Q) - 1).astype(np.int64)
        self.need = self.sizes + 1 - Q * (self.budget + 1)
        all_grams = [grams(t) for t in self.texts]
        gram = np.concatenate(all_grams) if all_grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(items)), [len(g) for g in all_grams])
        place = np.concatenate([np.arange(len(g)) for g in all_grams]) if all_grams else np.zeros(0, np.int64)
        order = np.argsort(gram, kind="stable")
        self.gram, first, self.count = np.unique(gram[order], return_index=True, return_counts=True)
        self.first, self.item, self.place = first, item[order], place[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[slot(self.gram)] = True

    def hits(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, position in the data, position in the item) of all shared grams."""
        gram = grams(data)
        at = np.flatnonzero(self.filter[slot(gram)])
        if not len(at) or not len(self.gram):
            none = np.zeros(0, np.int64)
            return none, none, none
        found = np.searchsorted(self.gram, gram[at])
        found[found == len(self.gram)] = 0
        true = self.gram[found] == gram[at]
        at, found = at[true], found[true]
        n = self.count[found]
        source = np.repeat(self.first[found] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return self.item[source], np.repeat(at, n), self.place[source]


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """Fewest edits of an occurrence of the item in the text that starts on a diagonal from low to high: (edits, start, end).

    Only diagonals within the budget of those are filled. None if there is no occurrence within the budget.
    """
    left, right = low - budget, high + budget
    diagonals = np.arange(left, right + 1)
    far = len(item) + len(text) + 1
    cost = np.where((diagonals >= 0) & (diagonals <= len(text)), 0, far)  # an occurrence may start anywhere
    start = diagonals.copy()
    padded = np.concatenate([text, np.zeros(1, np.uint8)])
    steps = np.arange(len(diagonals))
    for row in range(1, len(item) + 1):
        column = diagonals + row  # bytes of the text used so far
        inside = (column >= 1) & (column <= len(text))
        same = padded[np.clip(column - 1, 0, len(text))] == item[row - 1]
        match = np.where(inside, cost + ~same, far)
        skip = np.append(cost[1:] + 1, far)  # a byte of the item is missing
        better = skip < match
        now = np.where(better, skip, match)
        begin = np.where(better, np.append(start[1:], 0), start)
        now = np.where((column >= 0) & (column <= len(text)), now, far)
        run = np.minimum.accumulate(now - steps)  # bytes of the text that the item lacks
        source = np.maximum.accumulate(np.where(now - steps == run, steps, 0))
        cost, start = np.minimum(run + steps, far), begin[source]
        if cost.min() > budget:
            return None
    column = diagonals + len(item)
    best = int(np.lexsort((start, cost))[0])
    return (int(cost[best]), int(start[best]), int(column[best])) if cost[best] <= budget else None


def regions(index: Index, item: np.ndarray, doc: np.ndarray, diagonal: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, lowest, highest diagonal) of the bands that share enough grams; touching bands are joined."""
    width = index.budget[item] + 1
    band = diagonal // width
    keys = np.concatenate([np.stack([doc, item, b], 1) for b in (band, band - 1)])
    order = np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(keys)))
    keys = keys[at][count >= index.need[keys[at, 1]]]
    k = 0
    while k < len(keys):
        d, i, b = keys[k]
        last = b
        while k + 1 < len(keys) and keys[k + 1][0] == d and keys[k + 1][1] == i and keys[k + 1][2] <= last + 1:
            k += 1
            last = keys[k][2]
        w = int(index.budget[i]) + 1
        yield int(d), int(i), int(b) * w, int(last + 2) * w - 1
        k += 1


def occurrences(index: Index, data: np.ndarray, ptr: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of each occurrence within its budget, as byte offsets in the text."""
    item, at, place = index.hits(data)
    doc = np.searchsorted(ptr, at, "right") - 1
    whole = at + Q <= ptr[doc + 1]
    item, at, place, doc = item[whole], at[whole], place[whole], doc[whole]
    diagonal = at - place - ptr[doc]
    for d, i, low, high in regions(index, item, doc, diagonal):
        text, budget, own = data[ptr[d] : ptr[d + 1]], int(index.budget[i]), index.texts[i]
        begin, stop = max(0, low - budget), min(len(text), high + len(own) + budget)
        window, wanted = text[begin:stop].tobytes(), own.tobytes()
        found = window.find(wanted)
        if found >= 0:  # the alignment without edits
            while found >= 0:
                yield d, i, begin + found, begin + found + len(own), 0
                found = window.find(wanted, found + len(own))
            continue
        if got := align(own, text[begin:stop], low - begin, high - begin, budget):
            yield d, i, begin + got[1], begin + got[2], got[0]


def _blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in blocks of bounded size, one of them on the driver at a time; equal items are one, a NULL item_id stays NULL."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    block, size = [], 0
    for item, text in rows.filter(F.octet_length("text") >= Q).dropDuplicates().orderBy("item_id", "text").toLocalIterator():
        raw = text.encode()
        if size + len(raw) > most and block:
            yield block
            block, size = [], 0
        block.append((item, raw))
        size += len(raw)
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, start, end (code points of the text, end exclusive), edits (bytes): each occurrence of an item.

    NULL, empty and short items (under Q bytes) match nothing, nor do NULL and empty texts. An item that occurs more than
    once in touching bands with edits is reported once, by its best occurrence. Repeated rows are reported as often as
    they come; a NULL doc_id stays NULL. Documents are neither shuffled nor joined.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, start long, end long, edits long"
    result = None
    for block in _blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast((block, rate))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value)
            for batch in batches:
                for part in pieces(batch, "text"):
                    raw, ptr = buffers(part.column("text"))
                    rows = []
                    ids = part.column("doc_id").to_pylist()
                    for d, i, start, end, edits in occurrences(index, normal(raw), ptr):
                        text = raw[ptr[d] : ptr[d + 1]]
                        points = np.cumsum((text[:end] & 0xC0) != 0x80)
                        rows.append((ids[d], index.ids[i], int(points[start - 1]) if start else 0, int(points[end - 1]), edits))
                    if rows:
                        columns = list(zip(*rows, strict=True))
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "start", "end", "edits"])

        found = plain(docs, "doc_id", "text").mapInArrow(run, schema)
        result = found if result is None else result.unionByName(found)
    return spark.createDataFrame([], T._parse_datatype_string(schema)) if result is None else result


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, whose text holds no item of the benchmark."""
    kept = docs
    for block in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast((block, rate))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value)
            for batch in batches:
                for part in pieces(batch, "text"):
                    raw, ptr = buffers(part.column("text"))
                    clean = np.ones(part.num_rows, bool)
                    clean[[d for d, *_ in occurrences(index, normal(raw), ptr)]] = False
                    yield part.filter(pa.array(clean))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
