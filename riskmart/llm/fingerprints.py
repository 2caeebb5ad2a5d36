"""Document fingerprints: SimHash, and a Hamming search over permuted block tables.

The 64-bit fingerprint of a text is the sign of the weighted votes of its terms' hash bits. Fingerprints within a Hamming
radius are found by tables: the bits fall into blocks, and two fingerprints that differ in r bits agree in all but r blocks
at most. Each table puts one choice of blocks in front and looks for fingerprints with equal front bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.tables import stored
from riskmart.llm.words import parts, pieces, plain, shingles, words

#: Term widths in words, and the votes of each.
WIDTHS: Mapping[int, int] = {2: 1, 3: 2}
RADIUS = 3
#: Fingerprints of one chunk of a table.
CHUNK_SIZE = 512
LANES = np.uint64(0x0101010101010101)


def votes(hashes: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """How many hashes of each segment have each bit set: one row of 64 per segment.

    Eight bits are added at once as the bytes of a word; runs are cut before a byte overflows.
    """
    n = np.diff(ptr)
    pieces_of = -(-n // 255)
    first = np.concatenate([[0], np.cumsum(pieces_of)])
    out = np.zeros((len(n), 64), np.int64)
    if not len(hashes):
        return out
    inner = np.arange(first[-1]) - np.repeat(first[:-1], pieces_of)
    cut = np.repeat(ptr[:-1], pieces_of) + inner * 255
    owner = np.repeat(np.arange(len(n)), pieces_of)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, cut).view(np.uint8).reshape(-1, 8).astype(np.int64)
        for lane in range(8):
            out[:, 8 * lane + bit] = np.bincount(owner, lanes[:, lane], len(n)).astype(np.int64)
    return out


def fingerprints(texts: pa.Array, widths: Mapping[int, int] = WIDTHS) -> np.ndarray:
    """One 64-bit fingerprint per text; 0 without words. Ties of votes give a 0 bit."""
    w = words(texts)
    balance = np.zeros((len(w.ptr) - 1, 64), np.int64)
    for width, weight in widths.items():
        hashes, ptr = shingles(w.hash, w.ptr, width)
        balance += weight * (2 * votes(hashes, ptr) - np.diff(ptr)[:, None])
    return ((balance > 0).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)


def simhash(rows: DataFrame, columns: Mapping[str, str], widths: Mapping[int, int] = WIDTHS) -> DataFrame:
    """The rows without the text columns (keys of `columns`), with the fingerprint of each as a long (its value)."""
    kept = [f for f in rows.schema.fields if f.name not in columns]
    wide = dict(widths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [batch.column(f) for f in names]
            for text in columns:
                values = [fingerprints(part.column(text), wide) for part in pieces(batch, text)]
                out.append(pa.array(np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(out, [*names, *columns.values()])

    names = [f.name for f in kept]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{c}` long" for c in columns.values()])
    return rows.select(*(F.col(f"`{c}`") for c in [*names, *columns])).mapInArrow(run, schema)


def with_next(docs: DataFrame, prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """doc_id, text and what `prepare` adds, each also as next_*: that of the row that follows by doc_id (then text).

    The first row follows the last; NULL ids come first. Ids are dealt to ranges by quantiles; each range also gets the
    first rows of the next one, so no range depends on another. Only one id per range reaches the driver. `prepare` sees
    the rows before they are dealt.
    """
    spark = docs.sparkSession
    rows = plain(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    ranges = 4 * parts(spark)
    points = sorted(set(rows.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 1 / (4 * ranges))))
    splits = [-float("inf"), *(points or [0.0]), float("inf")]
    with_key = rows.withColumn("key", F.coalesce(F.col("doc_id").cast("double"), F.lit(-float("inf"))))
    dealt = Bucketizer(splits=splits, inputCol="key", outputCol="range").transform(with_key)
    own = dealt.select("doc_id", "text", F.col("range").cast("int").alias("range"), F.lit(False).alias("guest"))
    starts = own.groupBy("range").agg(F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull()).alias("null_id")).orderBy("range").collect()
    firsts = [(None if s["null_id"] else s["low"], starts[k - 1]["range"]) for k, s in enumerate(starts)]
    heads = spark.createDataFrame(firsts, "first_id long, before int")
    guests = own.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("first_id"))).select("doc_id", "text", F.col("before").alias("range"), F.lit(True).alias("guest"))
    prepared = prepare(own.unionByName(guests))
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    led = [c for c in prepared.columns if c not in ("range", "guest")]
    following = prepared.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in led))
    return following.filter(~F.col("guest")).drop("range", "guest")


def likeness(a: Column, b: Column) -> Column:
    """1 less the share of bits that differ."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def tables(radius: int, n: int) -> tuple[list[list[int]], list[tuple[int, ...]]]:
    """Blocks of bits, and the blocks in front in each table: as many as make equal front bits rare among n fingerprints."""
    for extra in range(1, 5):
        blocks = radius + extra
        if extra * 64 // blocks >= np.log2(max(n, 2)) - 8 or extra == 4:
            break
    bits = [list(map(int, b)) for b in np.array_split(np.arange(64), blocks)]
    return bits, list(combinations(range(blocks), blocks - radius))


def near_counts(rows: DataFrame, queries: Column, radius: int = RADIUS) -> DataFrame:
    """fingerprint, n_within: for each distinct fingerprint of the rows (fingerprint long) that `queries` selects, the rows
    whose fingerprint differs from it in `radius` bits at most, itself included.

    Equal fingerprints are counted first. A table's bucket is cut into chunks, so no group meets in one task, and a query
    meets chunks, not single rows. A pair that agrees in several tables counts in the first of them.
    """
    counted = stored(rows.groupBy("fingerprint").agg(F.count("*").alias("weight"), F.max(queries.cast("int")).alias("asked")))
    n = counted.count()
    bits, fronts = tables(radius, n)
    masks = [sum(1 << b for block in front for b in bits[block]) for front in fronts]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    mask_of = F.array(*(F.lit(m).cast("long") for m in signed))
    keyed = counted.select("fingerprint", "weight", "asked", F.posexplode(mask_of).alias("table", "mask")).withColumn("front", F.col("fingerprint").bitwiseAND(F.col("mask")))
    salts = max(1, n // CHUNK_SIZE)
    chunks = (
        keyed.groupBy("table", "front", F.pmod(F.xxhash64("fingerprint"), F.lit(salts)).alias("salt"))
        .agg(F.collect_list(F.struct("fingerprint", "weight")).alias("members"))
        .select("table", "front", "members")
    )
    asked = keyed.filter("asked = 1").select("table", "front", "mask", F.col("fingerprint").alias("query"))

    def agrees_before(x: Column, table: Column) -> Column:
        return F.exists(F.slice(mask_of, F.lit(1), table), lambda m: x.bitwiseAND(m) == 0)

    def add(total: Column, m: Column) -> Column:
        x = F.col("query").bitwiseXOR(m["fingerprint"])
        return total + F.when((F.bit_count(x) <= radius) & ~agrees_before(x, F.col("table")), m["weight"]).otherwise(F.lit(0).cast("long"))

    met = asked.join(chunks, ["table", "front"]).select("query", F.aggregate("members", F.lit(0).cast("long"), add).alias("found"))
    return met.groupBy(F.col("query").alias("fingerprint")).agg(F.sum("found").alias("n_within"))
