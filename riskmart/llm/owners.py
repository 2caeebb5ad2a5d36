"""Exact duplicates: full byte strings meet in Patricia tries, whose terminal nodes know the owner of each string.

Each task first collapses its own copies in a trie, so a text leaves a task once, however often it occurs there.
These strings are dealt out by length and content hash and inserted into the tries of the partitions; strings are equal
only when they end in the same terminal node, the hash merely brings them together. A trie above its share of memory
writes its largest subtree to a file, which is read into a trie of its own afterwards.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.words import LOWER, buffers, pieces
from riskmart.session import work_dir

#: Bytes of a trie (labels and payloads) above which a subtree is written to a file.
MOST_BYTES = 96 << 20
#: What a node and a row of payload take besides their bytes.
NODE_BYTES, ROW_BYTES = 320, 96
#: A text is hot from this share of all bytes (so there are few) and from as many rows as it gets salts.
HOT_SHARE, SALTS = 10_000, 32
#: Rows and bytes of a batch that leaves a task.
BATCH_ROWS, BATCH_BYTES = 4_096, 4 << 20


class Node:
    """An edge label and what follows it; spill is the file that takes the rest of all strings that reach the node."""

    __slots__ = ("label", "kids", "payload", "spill")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.kids: dict[int, Node] = {}
        self.payload: Any = None
        self.spill: Any = None


def _shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b[at:]."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """Byte strings with a payload each; equal strings merge their payloads.

    `merge(old, new)` returns the payload of both. Memory is bounded: see MOST_BYTES.
    """

    def __init__(self, merge: Callable[[Any, Any], Any], most: int = MOST_BYTES) -> None:
        self.root, self.merge, self.most = Node(b""), merge, most
        self.bytes: dict[int, int] = {}  # below each kid of the root, what is held in memory
        self.total = 0

    def insert(self, key: bytes, payload: Any, weight: int = ROW_BYTES) -> None:
        node, at, end, first, grown = self.root, 0, len(key), key[0] if key else -1, weight
        while node.spill is None and at < end:
            kid = node.kids.get(key[at])
            if kid is None:
                kid = node.kids[key[at]] = Node(key[at:])
                grown += end - at + NODE_BYTES
            elif not key.startswith(kid.label, at):
                n = _shared(kid.label, key, at)
                middle = Node(kid.label[:n])
                kid.label = kid.label[n:]
                middle.kids[kid.label[0]] = kid
                kid = node.kids[key[at]] = middle
                grown += NODE_BYTES
            node, at = kid, at + len(kid.label)
        if node.spill is not None:
            pickle.dump((key[at:], payload, weight), node.spill)
            return
        node.payload = payload if node.payload is None else self.merge(node.payload, payload)
        self.bytes[first] = self.bytes.get(first, 0) + grown
        self.total += grown
        if self.total > self.most:
            self._spill()

    def _spill(self) -> None:
        """Write the heaviest subtree below the root to a file; a single string stays."""
        large = [first for first, kid in self.root.kids.items() if kid.kids]
        if not large:
            return
        first = max(large, key=self.bytes.__getitem__)
        top = self.root.kids[first]
        file = tempfile.TemporaryFile()
        for rest, payload in self._walk(top, b""):
            pickle.dump((rest, payload, ROW_BYTES), file)
        top.kids, top.payload, top.spill = {}, None, file
        self.total -= self.bytes.pop(first)

    def _walk(self, top: Node, prefix: bytes) -> Iterator[tuple[bytes, Any]]:
        """The strings below a node, without its label, and their payloads; subtrees in files come as tries of their own."""
        stack = [(top, prefix)]
        while stack:
            node, text = stack.pop()
            if node.spill is not None:
                yield from self._reread(node, text)
            elif node.payload is not None:
                yield text, node.payload
            stack.extend((kid, text + kid.label) for kid in node.kids.values())

    def _reread(self, node: Node, prefix: bytes) -> Iterator[tuple[bytes, Any]]:
        inner = Trie(self.merge, self.most)
        node.spill.seek(0)
        while True:
            try:
                rest, payload, weight = pickle.load(node.spill)
            except EOFError:
                break
            inner.insert(rest, payload, weight)
        node.spill.close()
        for rest, payload in inner.strings():
            yield prefix + rest, payload

    def strings(self) -> Iterator[tuple[bytes, Any]]:
        """Every string once, with its payload. The trie is used up."""
        return self._walk(self.root, b"")


LOCAL = "ids array<long>, n long, least long, greatest long, n_bytes long, hash long, text_sha256 string, text binary"
OWNED = "name long, lead long, holder long, least long, greatest long, n long, n_bytes long, hash long, text binary"


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    total = 0
    for row in rows:
        held.append(row)
        total += size(row)
        if len(held) >= BATCH_ROWS or total >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _schema(text: str) -> pa.Schema:
    kinds = {"array<long>": pa.list_(pa.int64()), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in text.split(", "))])


def _of(pick: Callable, *values: int | None) -> int | None:
    known = [v for v in values if v is not None]
    return pick(known) if known else None


def collapse(hash_mask: int = -1, most: int = MOST_BYTES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per text of a task: its ids, their least and greatest, length, hash, digest, and the normalised bytes.

    When the trie is full its rows leave and it starts anew: the text then leaves the task more than once.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        def leave(trie: Trie) -> Iterator[tuple]:
            for text, ids in trie.strings():
                mark = (xxhash.xxh64_intdigest(text) & hash_mask & (1 << 64) - 1) - (1 << 63)
                yield ids, len(ids), _of(min, *ids), _of(max, *ids), len(text), mark, hashlib.sha256(text).hexdigest(), text

        def both(a: list, b: list) -> list:
            a.extend(b)
            return a

        trie = Trie(both, 1 << 62)
        for batch in batches:
            for part in pieces(batch, "text"):
                data, ptr = buffers(part.column("text"))
                lowered = LOWER[data].tobytes()
                for k, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    trie.insert(lowered[ptr[k] : ptr[k + 1]], [doc_id])
                    if trie.total > most:
                        yield from leave(trie)
                        trie = Trie(both, 1 << 62)
        yield from leave(trie)

    return lambda batches: _batches(rows(batches), _schema(LOCAL), lambda r: len(r[-1]) + 8 * len(r[0]) + 128)


def own(keep_text: bool, most: int = MOST_BYTES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows (name, holder, least, greatest, n, n_bytes, hash, text): each name with what its whole text holds.

    `lead` is one name of the text, `holder` the least name that has the greatest id; the text goes with the lead if it
    is kept.
    """

    def both(a: list, b: list) -> list:
        names, holder, least, greatest, n, *mark = a
        if (b[3] is not None, b[3] or 0, -b[1]) > (greatest is not None, greatest or 0, -holder):
            holder = b[1]
        names.extend(b[0])
        return [names, holder, _of(min, least, b[2]), _of(max, greatest, b[3]), n + b[4], *mark]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = Trie(both, most)
        for batch in batches:
            for part in pieces(batch, "text"):
                columns = [part.column(c).to_pylist() for c in ("name", "holder", "least", "greatest", "n", "n_bytes", "hash")]
                data, ptr = buffers(part.column("text"))
                whole = data.tobytes()
                for k, (name, *rest) in enumerate(zip(*columns, strict=True)):
                    trie.insert(whole[ptr[k] : ptr[k + 1]], [[name], *rest])
        for text, (names, holder, least, greatest, n, n_bytes, mark) in trie.strings():
            lead = min(names)
            for name in names:
                yield name, lead, holder, least, greatest, n, n_bytes, mark, text if keep_text and name == lead else None

    return lambda batches: _batches(rows(batches), _schema(OWNED), lambda r: len(r[-1] or b"") + 72)


def _kept(rows: DataFrame) -> DataFrame:
    """Written to the shared folder and read again, compressed well: the strings are most of it."""
    path = work_dir(rows.sparkSession, "owners")
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def owners(docs: DataFrame, keep: str = "largest", hash_mask: int = -1, most: int = MOST_BYTES, hot_share: int = HOT_SHARE) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row: groups of rows whose texts are equal but for A-Z and a-z.

    The row of the largest (or smallest) doc_id of a group stays. A NULL text counts as an empty one. A row without id
    stays only where its whole group has none; of rows that repeat the staying id one stays, so each group keeps
    exactly one row. Other columns take no part; an empty table gives an empty result. `hash_mask` weakens the hash
    that deals out the strings, which changes no result.

    A text with a large share of the bytes is salted and merged in a second step. Shuffled are each task's distinct
    texts once; only names and numbers go back to the documents.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be 'largest' or 'smallest'")
    sign = 1 if keep == "largest" else -1
    rows = docs.select((F.col("`doc_id`").cast("long") * sign).alias("doc_id"), F.col("`text`").cast("string").alias("text"))
    local = _kept(rows.mapInArrow(collapse(hash_mask, most), LOCAL).withColumn("name", F.monotonically_increasing_id()))
    key = ["n_bytes", "hash"]
    whole = local.agg(F.sum(F.col("n_bytes") + 1)).scalar()
    size = F.sum(F.col("n_bytes") + 1)
    hot = local.groupBy(*key).agg(size.alias("bytes"), F.count("*").alias("rows")).filter((F.col("rows") >= SALTS) & (F.col("bytes") * hot_share >= whole))
    hot = _kept(hot.select(*key, F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod("name", F.lit(SALTS)) + 1).otherwise(F.lit(0)).alias("salt")
    # At most hot_share keys can have their share of the bytes each.
    dealt = local.join(F.broadcast(hot), key, "left").select("name", F.col("name").alias("holder"), "least", "greatest", "n", *key, "text", salt)
    cold = dealt.filter("salt = 0").repartition(*key).mapInArrow(own(False, most), OWNED).select("name", "holder", "greatest", "n")
    found = cold
    if not hot.isEmpty():
        first = _kept(dealt.filter("salt > 0").repartition(*key, "salt").mapInArrow(own(True, most), OWNED))
        merged = first.filter("name = lead").repartition(*key).mapInArrow(own(False, most), OWNED)
        final = merged.select(F.col("name").alias("lead"), "holder", "greatest", "n")
        found = cold.unionByName(first.select("name", "lead").join(final, "lead").drop("lead"))
    met = local.select("name", "ids", "text_sha256").join(found, "name")
    # The greatest id is in the holder's list; it is NULL where all are.
    place = F.coalesce(F.array_position("ids", F.col("greatest")), F.lit(1)) - 1
    each = met.select("*", place.alias("place"), F.posexplode("ids").alias("pos", "id"))
    return each.select(
        (F.col("id") * sign).alias("doc_id"),
        (F.col("greatest") * sign).alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("name") == F.col("holder")) & (F.col("pos") == F.col("place"))).alias("kept"),
        "text_sha256",
    )
