"""Hard negatives: for each anchor and positive, the best rows of other labels in a window below the positive's score.

Anchors are taken in blocks of a fixed number of bytes; each is broadcast to two passes over all rows. The first finds
the positives. Their upper limits then cut the scores of an anchor into disjoint slots; in the second pass every task
keeps the best few rows of each slot, and so does the merge of the tasks. As the slots lie in descending order, the
first rows of a window are the first rows of its slot and all slots after it: a few rows answer all windows, though
these overlap.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.tables import stored
from riskmart.session import work_dir

#: Bytes of a block of anchors as doubles; it is broadcast.
BLOCK_BYTES = 16 << 20
#: Anchors and rows that are multiplied at once.
TILE_ANCHORS, TILE_ROWS = 1_024, 2_048
#: Below every score.
NONE = -(1 << 63)
#: Doubles hold every whole number below this.
EXACT = 1 << 53
#: monotonically_increasing_id keeps the partition above these bits.
PARTITION_BITS = 33

PAIRS = "at long, slot int, score long, vec_id long"


def whole_numbers(rows: list | np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component: doubles where these are exact, else Python's integers."""
    made = np.floor(np.asarray(rows, np.float64) * scale)
    if not made.size or np.abs(made).max() < EXACT:
        return made
    flat = [math.floor(x * scale) if abs(x) < EXACT else int(x) * scale for x in np.asarray(rows, np.float64).ravel().tolist()]
    return np.array(flat, object).reshape(made.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a with all rows of b; one beyond 64 bits is an error."""
    most = [max(1, int(np.abs(x).max())) if x.size else 1 for x in (a, b)]
    if a.shape[1] * most[0] * most[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in a.tolist()], object).dot(np.array([[int(x) for x in row] for row in b.tolist()], object).T)
    if any(not NONE < x < 1 << 63 for x in exact.ravel().tolist()):
        raise OverflowError("a score does not fit 64 bits")
    return exact.astype(np.int64)


class Best:
    """The k best (score, id) of each anchor: higher scores first, ties by smaller id."""

    def __init__(self, anchors: int, k: int) -> None:
        self.score = np.full((anchors, k), NONE, np.int64)
        self.id = np.zeros((anchors, k), np.int64)

    def offer(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of the anchors `which` with rows whose ids ascend; NONE stands for no row."""
        k, n = self.score.shape[1], scores.shape[1]
        live = (scores > self.score[which, -1][:, None]) | (scores == self.score[which, -1][:, None]) & (scores > NONE)
        hit = live.any(1)
        which, scores = which[hit], scores[hit]
        if not len(which):
            return
        if n > k:
            known = scores[scores > NONE]
            if max(abs(int(known.min())), abs(int(known.max()))) < (1 << 61) // n:
                place = np.where(scores > NONE, scores * n + (n - 1 - np.arange(n)), NONE)
                top = np.argpartition(place, n - k, axis=1)[:, n - k :]
            else:  # ids ascend, so a stable sort keeps ties in order
                top = np.argsort(~scores, axis=1, kind="stable")[:, :k]
            scores, ids = np.take_along_axis(scores, top, 1), ids[top]
        else:
            ids = np.broadcast_to(ids, scores.shape)
        score, ident = np.concatenate([self.score[which], scores], 1), np.concatenate([self.id[which], ids], 1)
        order = np.lexsort((ident, ~score), axis=1)[:, :k]
        self.score[which], self.id[which] = np.take_along_axis(score, order, 1), np.take_along_axis(ident, order, 1)

    def rows(self, at: np.ndarray, slot: int) -> pa.RecordBatch:
        owner, place = np.nonzero(self.score > NONE)
        columns = [at[owner], np.full(len(owner), slot, np.int32), self.score[owner, place], self.id[owner, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["at", "slot", "score", "vec_id"])


@dataclass
class Anchors:
    """Anchors of one dimension: numbers, ids, labels and whole-number vectors; `limits` are upper limits of their slots,
    descending, and `floor` is the lowest score any window takes."""

    at: np.ndarray
    id: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    limits: np.ndarray | None = None
    floor: np.ndarray | None = None


def _tiles(batch: pa.RecordBatch, dims: set[int], scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """dimension, ids (ascending), labels and vectors of the batch's rows, a tile at a time."""
    column = batch.column("vector")
    size = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1]
    ids, labels = batch.column("vec_id").to_numpy(), np.array(batch.column("label").to_pylist(), object)
    for dim in dims & set(size.tolist()):
        here = np.flatnonzero(size == dim)
        here = here[np.argsort(ids[here], kind="stable")]
        for low in range(0, len(here), TILE_ROWS):
            some = here[low : low + TILE_ROWS]
            vectors = values[starts[some][:, None] + np.arange(dim)] if dim else np.zeros((len(some), 0))
            yield dim, ids[some], labels[some], whole_numbers(vectors, scale)


def _same(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether the label of each anchor (down) is that of each row (across)."""
    names = {name: k for k, name in enumerate(dict.fromkeys(anchors.tolist()))}
    return np.array([names[x] for x in anchors.tolist()])[:, None] == np.array([names.get(x, -1) for x in rows.tolist()])[None, :]


def positives_of(block: dict[int, Anchors], most: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best rows of each anchor's own label among the rows of a task, itself left out."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: Best(len(a.id), most) for dim, a in block.items()}
        for batch in batches:
            for dim, ids, labels, vectors in _tiles(batch, set(block), scale):
                anchors = block[dim]
                for label in set(labels.tolist()):
                    mine, rows = np.flatnonzero(anchors.label == label), np.flatnonzero(labels == label)
                    for low in range(0, len(mine), TILE_ANCHORS):
                        which = mine[low : low + TILE_ANCHORS]
                        scores = products(anchors.vector[which], vectors[rows])
                        scores[anchors.id[which][:, None] == ids[rows][None, :]] = NONE
                        best[dim].offer(which, scores, ids[rows])
        for dim, found in best.items():
            yield found.rows(block[dim].at, 0)

    return scan


def negatives_of(block: dict[int, Anchors], most: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best rows of other labels in each slot of each anchor among the rows of a task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: [Best(len(a.id), most) for _ in range(a.limits.shape[1])] for dim, a in block.items()}
        for batch in batches:
            for dim, ids, labels, vectors in _tiles(batch, set(block), scale):
                anchors = block[dim]
                for low in range(0, len(anchors.id), TILE_ANCHORS):
                    which = np.arange(low, min(low + TILE_ANCHORS, len(anchors.id)))
                    scores = products(anchors.vector[which], vectors)
                    limits = anchors.limits[which]
                    outside = _same(anchors.label[which], labels) | (scores < anchors.floor[which][:, None])
                    for slot, found in enumerate(best[dim]):
                        inside = ~outside & (scores <= limits[:, slot][:, None])
                        if slot + 1 < limits.shape[1]:
                            inside &= scores > limits[:, slot + 1][:, None]
                        found.offer(which, np.where(inside, scores, NONE), ids)
        for dim, slots in best.items():
            for slot, found in enumerate(slots):
                yield found.rows(block[dim].at, slot)

    return scan


def _first(pairs: DataFrame, most: int) -> DataFrame:
    """The best rows of each (anchor, slot) over all tasks, with their place from 1."""
    order = Window.partitionBy("at", "slot").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows (vec_id, label, vector).

    A score is the inner product of vectors whose components became floor(scale * x). Positives of an anchor are its
    first rows of the same label; for each, the first rows of other labels whose score lies between low and high percent
    of the positive's, both included, are listed from rank 1. Higher scores come first, ties by smaller vec_id.

    Rows with a NULL id, label or vector, or with a NULL or non-finite component, take no part. Rows of an anchor's own
    id are never its positives. Only vectors of the same length are compared; those of length 0 score 0. Repeated rows
    count as rows of their own, and a repeated anchor gives its rows as often. A window of a negative score is empty.
    A score beyond 64 bits ends the job with an error. Other columns take no part; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    chosen = rows.select(
        F.col("`vec_id`").cast("long").alias("vec_id"),
        F.col("`label`").cast("string").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = chosen.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(sound, F.lit(False)))
    asked = usable.filter("is_anchor").drop("is_anchor")
    longest, count = asked.agg(F.max(F.size("vector")), F.count("*")).first()
    out = work_dir(spark, "hard_negatives")
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not count:
        return empty
    per_block = max(1, block_bytes // (8 * max(1, longest)))
    anchors = stored(asked.repartition(math.ceil(count / per_block)).withColumn("at", F.monotonically_increasing_id()))
    number = F.struct(F.shiftright("at", PARTITION_BITS), F.floor((F.col("at") % (1 << PARTITION_BITS)) / per_block))
    blocks = anchors.groupBy(number).agg(F.min("at").alias("low"), F.max("at").alias("high")).select("low", "high").collect()
    scanned = usable.select("vec_id", "label", "vector")
    for first, last in sorted(map(tuple, blocks)):
        _mine_block(scanned, anchors.filter(F.col("at").between(first, last)), positives, negatives, low, high, scale, out)
    return spark.read.schema(empty.schema).parquet(out)


def _mine_block(rows: DataFrame, asked: DataFrame, positives: int, negatives: int, low: int, high: int, scale: int, out: str) -> None:
    """Both passes for one block of anchors; the result is appended to a folder before the broadcasts are freed."""
    spark = rows.sparkSession
    table = asked.toArrow()
    size = np.array([len(v) for v in table["vector"].to_pylist()])
    at, ids, labels = (table[c].to_numpy() for c in ("at", "vec_id", "label"))
    vectors = table["vector"].to_pylist()
    block = {}
    for dim in sorted(set(size.tolist())):
        here = np.flatnonzero(size == dim)
        made = whole_numbers(np.array([vectors[k] for k in here], np.float64).reshape(len(here), dim), scale)
        block[dim] = Anchors(at[here], ids[here], labels[here], made)
    shared = spark.sparkContext.broadcast(block)
    found = stored(_first(rows.mapInArrow(lambda batches: positives_of(shared.value, positives, scale)(batches), PAIRS), positives))

    # As many rows as the block has anchors, times the positives of each.
    known = found.select("at", "score").toArrow()
    of: dict[int, list[int]] = {}
    for anchor, score in zip(known["at"].to_pylist(), known["score"].to_pylist(), strict=True):
        of.setdefault(anchor, []).append(score)
    lists = []
    for anchors in block.values():
        limits = np.full((len(anchors.at), positives), NONE, np.int64)
        floor = np.full(len(anchors.at), (1 << 63) - 1, np.int64)
        for k, anchor in enumerate(anchors.at.tolist()):
            scores = [s for s in of.get(anchor, []) if s >= 0]
            upper = sorted({high * s // 100 for s in scores}, reverse=True)
            limits[k, : len(upper)] = upper
            if scores:
                floor[k] = min(-(-low * s // 100) for s in scores)
            lists.append((anchor, upper))
        anchors.limits, anchors.floor = limits, floor
    slots = spark.createDataFrame(lists, "at long, limits array<long>")
    cut = spark.sparkContext.broadcast(block)
    kept = _first(rows.mapInArrow(lambda batches: negatives_of(cut.value, negatives, scale)(batches), PAIRS), negatives)
    merged = kept.groupBy("at").agg(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), F.col("vec_id").alias("negative_id"))).alias("all"))

    # A window starts in the slot of its upper limit; the rows of that slot and of all after it, in order, begin with its own.
    start = F.array_position("limits", F.expr(f"score * {high} div 100")) - 1
    pairs = found.filter("score >= 0").withColumnRenamed("vec_id", "positive_id").join(slots, "at").join(merged, "at").withColumn("start", start)
    suffix = F.slice(F.sort_array(F.filter("all", lambda n: n["slot"] >= F.col("start"))), 1, negatives)
    window = F.filter(suffix, lambda n: (n["down"] * -100 >= F.col("score") * low) & (n["down"] * -100 <= F.col("score") * high))
    each = pairs.select("at", "positive_id", F.col("score").alias("positive_score"), F.posexplode(window).alias("pos", "n"))
    names = asked.select("at", F.col("vec_id").alias("anchor_id"))
    made = each.join(names, "at").select(
        "anchor_id",
        "positive_id",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("n.negative_id").alias("negative_id"),
        "positive_score",
        (-F.col("n.down")).alias("negative_score"),
    )
    made.write.mode("append").parquet(out)
    shared.destroy()
    cut.destroy()

