"""Sharding by a permutation-filled lookup table: constant-time placement that moves few rows when shards change."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the table: prime, and at least 100 times the shards it is used for.
TABLE_SIZE = 16_381
#: The table is broadcast, so its size has a ceiling.
MOST_SLOTS = 1 << 20


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard index of each slot.

    Each shard has its own permutation of the slots (an offset and a step from its name). The shards take turns; in its
    turn a shard claims the first free slot of its permutation. So shares differ by one slot at most, and a table for
    one shard more or less keeps nearly all other slots.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if not len(shards) <= size <= MOST_SLOTS or any(size % k == 0 for k in range(2, math.isqrt(size) + 1)) or size < 2:
        raise ValueError(f"the table size must be a prime from the number of shards to {MOST_SLOTS}")
    at = [_number(f"offset {name}") % size for name in shards]
    step = [_number(f"step {name}") % (size - 1) + 1 for name in shards]
    table = [-1] * size
    free = size
    while True:
        for shard in range(len(shards)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % size
            table[at[shard]] = shard
            free -= 1
            if not free:
                return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key; NULL counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def _table(spark: SparkSession, shards: Sequence[str], size: int, slot: str, shard: str) -> DataFrame:
    text = ",".join(map(str, lookup_table(shards, size)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(text), ",").cast("array<int>")).alias(slot, shard))


def assign_shards(
    rows: DataFrame, key: str = "doc_id", shards: int | Sequence[str] = 64, size: int = TABLE_SIZE, shard: str = "shard", slot: str = "slot"
) -> DataFrame:
    """The rows with their `slot` and `shard` (index into the shards); both replace columns of these names.

    Only the table, of `size` rows, is broadcast; rows are neither shuffled nor grouped, so a hot key costs nothing.
    Equal keys get equal shards, repeated rows stay repeated, a NULL key is placed as the empty text, an empty table
    gives an empty one.
    """
    names = [f"shard-{k}" for k in range(shards)] if isinstance(shards, int) else list(shards)
    columns = [c for c in rows.columns if c not in (shard, slot)]
    # The row travels as one struct, so none of its columns can clash with those of the table.
    kept = rows.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), slot_of(F.col(f"`{key}`"), size).alias("at"))
    placed = kept.join(F.broadcast(_table(rows.sparkSession, names, size, "at", "owner")), "at")
    return placed.select(*(F.col("row").getField(c).alias(c) for c in columns), F.col("at").alias(slot), F.col("owner").alias(shard))
