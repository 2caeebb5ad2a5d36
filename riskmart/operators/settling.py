"""Columns that are computed once per row, whatever uses them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Add columns (expressions, or SQL text) that are computed once per row.

    The optimizer copies a plain column into every expression and pushed filter that uses it, and so computes it as
    many times over. It does not look into a generator, so the columns come out of one.
    """
    made = (F.expr(c) if isinstance(c, str) else c for c in columns.values())
    fields = (c.alias(name) for name, c in zip(columns, made, strict=True))
    return df.select("*", F.inline(F.array(F.struct(*fields))))
