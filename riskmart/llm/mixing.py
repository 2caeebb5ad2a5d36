"""Mixing sources to target weights by cube-method balanced sampling.

A source whose target is m times its size takes each of its documents floor(m) times, and once more with probability
m - floor(m). Which documents get the extra copy is drawn by the cube method: probabilities move along null directions
of the constraints (tokens, documents) until they are 0 or 1, so both totals of a source stay where they were.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.tables import stored
from riskmart.llm.words import SPACES, buffers, pieces, plain

#: Most documents of one flight; a source has as many flights as it needs.
FLIGHT = 4096
#: Units that a source's last flight leaves to the landing, besides its own rest.
RESERVE = 12
#: What a document too many or too few weighs in the landing, as a share of a document's words.
DOCUMENT = 0.05
#: A target stops at so many times the source's size.
MOST = 3.0
#: Weights of the sources by code point, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
EPS = 1e-9


def count_words(texts: pa.Array) -> np.ndarray:
    data, ptr = buffers(texts)
    inside = ~SPACES[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = ptr[:-1][np.diff(ptr) > 0]
    first[heads] = inside[heads]
    total = np.concatenate([[0], np.cumsum(first)])
    return total[ptr[1:]] - total[ptr[:-1]]


def with_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), pa.array(count_words(part.column("text")), pa.int64())], ["doc_id", "source", "size"])

    return plain(docs, "doc_id", "source", "text").mapInArrow(run, "doc_id long, source string, size long")


def target_sizes(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size, target.

    Targets share the sum of all sizes by weight; one above `most` times its source's size stops there and its excess
    is shared again. So target = min(most * size, level * weight); each round fixes the level for the sources that are
    not at their ceiling and ends when none newly is. Only totals reach the driver.
    """
    spark = sizes.sparkSession
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    ranked = totals.select("source").orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (x[0][0], x[1]))
    ranks = spark.createDataFrame(ranked, "name string, place long")
    by_place = F.array(*(F.lit(float(w)) for w in weights))
    table = stored(
        totals.join(ranks, totals["source"].eqNullSafe(ranks["name"]))
        .select("source", "source_size", F.element_at(by_place, (F.col("place") % len(weights) + 1).cast("int")).alias("weight"))
    )
    whole = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("weight") * level >= F.col("source_size") * most
        open_weight, closed = table.agg(F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, F.col("source_size") * most))).first()
        if not open_weight:
            break
        new = (whole - float(closed or 0)) / open_weight
        if level is not None and new <= level * (1 + 1e-15):
            break
        level = new
    share = F.col("source_size") * most if level is None else F.least(F.col("weight") * level, F.col("source_size") * most)
    return table.select("source", "source_size", share.alias("target"))


def flight(size: np.ndarray, chance: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Move chances to 0 or 1 with sum(chance) and sum(size * chance) kept; two documents at most stay between."""
    p = chance.astype(float).copy()
    queue = [k for k in order if EPS < p[k] < 1 - EPS]
    hand: list[int] = []
    for k in queue:
        hand.append(k)
        while len(hand) == 3:
            a, b, c = hand
            sa, sb, sc = float(size[a]), float(size[b]), float(size[c])
            move = (sb - sc, sc - sa, sa - sb)
            if move == (0.0, 0.0, 0.0):
                move = (1.0, -1.0, 0.0)
            up = down = float("inf")
            for i, m in zip(hand, move, strict=True):
                if m > 0:
                    up, down = min(up, (1 - p[i]) / m), min(down, p[i] / m)
                elif m < 0:
                    up, down = min(up, p[i] / -m), min(down, (1 - p[i]) / -m)
            # up with chance down / (up + down), so that each chance is kept on average
            draw = int.from_bytes(hashlib.blake2b(f"{a} {b} {c} {len(p)} {sa} {sb} {sc}".encode(), digest_size=8).digest(), "big") / 2**64
            far = up if draw * (up + down) < down else -down
            for i, m in zip(hand, move, strict=True):
                p[i] = min(1.0, max(0.0, p[i] + far * m))
            hand = [i for i in hand if EPS < p[i] < 1 - EPS]
    p[p <= EPS] = 0.0
    p[p >= 1 - EPS] = 1.0
    return p


def landing(size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Set what is left of a source to 0 or 1: of all ways (a few thousand) the one nearest in tokens and documents."""
    p = chance.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    if not len(left):
        return p
    ways = np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1
    off = ways - p[left]
    cost = np.abs(off @ size[left].astype(float)) + DOCUMENT * size[left].mean() * np.abs(off.sum(1))
    p[left] = ways[int(np.argmin(cost))]
    return p


def _fly(last: bool):
    def run(group: pa.Table) -> pa.Table:
        keys = group.select(["doc_id", "copy"]).to_pandas()
        size, chance = group.column("size").to_numpy(), group.column("chance").to_numpy()
        rank = group.column("rank").to_numpy()
        order = np.lexsort((size, keys["copy"].to_numpy(), keys["doc_id"].fillna(-1).to_numpy(), rank))
        size, chance = size[order], chance[order]
        # The two units that a flight leaves may be large; a few more beside them make a landing that comes near.
        flying = max(0, len(size) - RESERVE) if last else len(size)
        p = flight(size, chance, np.arange(flying))
        p = landing(size, p) if last else p
        out = np.empty(len(p))
        out[order] = p
        return group.set_column(group.schema.get_field_index("chance"), "chance", pa.array(out))

    return run


def balanced(units: DataFrame, flight_size: int = FLIGHT) -> DataFrame:
    """Units (doc_id, copy, source, size, chance) with chance 0 or 1.

    Flights of bounded size run side by side; each leaves two units at most. Those fly again, fewer by a factor of
    flight_size / 2 in each round, until one flight per source is left, whose rest is landed.
    """
    kept = "doc_id long, copy long, source string, size long, base long, source_size long, target double, rank long, chance double, block long"
    done: list[DataFrame] = []
    left = units
    while True:
        counts = left.groupBy("source").agg(F.count("*").alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        last = most <= flight_size
        table = counts.select(F.col("source").alias("name"), F.ceil(F.col("n") / flight_size).alias("blocks"))
        dealt = (
            left.drop("block")
            .join(table, F.col("source").eqNullSafe(F.col("name")))
            .withColumn("block", F.pmod("rank", "blocks"))
            .select(*(c.split()[0] for c in kept.split(", ")))
        )
        flown = stored(dealt.groupBy("source", "block").applyInArrow(_fly(last), kept))
        if last:
            done.append(flown)
            break
        done.append(flown.filter((F.col("chance") == 0) | (F.col("chance") == 1)))
        left = flown.filter((F.col("chance") > 0) & (F.col("chance") < 1))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, flight_size: int = FLIGHT) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, times (copies the mix takes), taken (words).

    A NULL source is a source of its own, the last one. NULL and empty texts have size 0 and are taken like others.
    Rows that repeat a doc_id are separate documents with the same id. Documents of equal size are exchangeable; which
    are taken follows a hash of doc_id, so reruns agree. An empty table gives an empty one.
    """
    sizes = stored(with_sizes(docs))
    goals = target_sizes(sizes, weights, most)
    name = goals.select(F.col("source").alias("name"), "source_size", "target")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = (
        sizes.join(F.broadcast(name) if goals.count() <= 100_000 else name, F.col("source").eqNullSafe(F.col("name")))
        .groupBy("doc_id", "source", "size", "source_size", "target")
        .agg(F.count("*").alias("n"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .withColumn("base", F.floor(ratio + EPS))
        .withColumn("chance", F.greatest(F.lit(0.0), ratio - F.col("base")))
        .withColumn("rank", F.xxhash64("doc_id", "copy", "size"))
        .withColumn("block", F.lit(0).cast("long"))
    )
    times = F.col("base") + F.col("chance").cast("long")
    return balanced(units, flight_size).select("doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, flight_size: int = FLIGHT) -> DataFrame:
    """The rows of docs, with all their columns, as often as the mix takes them.

    Where rows repeat an id, its counts go to them from the largest down.
    """
    times = mix(plain(docs, "doc_id", "text", "source"), weights, most, flight_size)
    counts = times.groupBy(F.col("doc_id").alias("id")).agg(F.sort_array(F.collect_list("times"), asc=False).alias("counts"))
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("`doc_id`").cast("long").alias("key"), F.xxhash64("`source`", "`text`").alias("digest"), F.col("`text`").alias("body"))
    placed = row.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("digest", "body"))).select("row", "key", "place")
    joined = placed.join(counts, F.col("key").eqNullSafe(F.col("id")))
    n = F.element_at("counts", F.col("place"))
    repeated = joined.filter(n > 0).select("row", F.explode(F.sequence(F.lit(1).cast("long"), n)))
    return repeated.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
