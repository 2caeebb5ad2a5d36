"""The raw lake: Parquet files of text columns, one folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.specs import TableSpec


def raw_path(root: str, spec: TableSpec) -> str:
    return f"{root}/{spec.name}"


def raw_scan(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Scan landed files with the fixed text schema; nothing is inferred."""
    return spark.read.schema(spec.raw_schema).parquet(path)


def replace_raw_view(spark: SparkSession, spec: TableSpec, path: str, view: str | None = None) -> str:
    """(Re)define the SQL name of a raw folder.

    A view over the path is used rather than a catalog table, because the path
    reader honours the commit log of the streaming sink: files of a failed
    micro-batch are not seen.
    """
    view = view or f"raw_{spec.name}"
    raw_scan(spark, spec, path).createOrReplaceTempView(view)
    return view
