"""Raw text to typed rows, one row per key where the table has a unique key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.casts import typed
from riskmart.specs import TableSpec


def cast_columns(raw: DataFrame, spec: TableSpec, on_bad: str = "error") -> DataFrame:
    types = {f.name: f.dataType for f in spec.typed_schema}
    return raw.select(
        *(typed(F.col(name), kind, types[name], on_bad).alias(name) for name, kind in spec.fields)
    )


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """Keep one row per key: the smallest by its remaining columns, NULLs first.

    An arbitrary survivor would be allowed; a fixed one makes reruns repeatable.
    It is an aggregate rather than a ranking window, so copies of a key collapse
    before the shuffle and a key with very many copies never fills one task.
    """
    rest = [name for name in df.columns if name != key]
    kept = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*(F.col(n) if n == key else F.col(f"kept.{n}").alias(n) for n in df.columns))


def stage(raw: DataFrame, spec: TableSpec, on_bad: str = "error") -> DataFrame:
    rows = cast_columns(raw, spec, on_bad)
    return one_per_key(rows, spec.unique_key) if spec.unique_key else rows
