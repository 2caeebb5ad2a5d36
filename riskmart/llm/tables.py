"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.session import work_dir


def stored(rows: DataFrame) -> DataFrame:
    """The rows written as Parquet below spark.checkpoint.dir and read again: cuts the lineage, survives lost executors."""
    spark: SparkSession = rows.sparkSession
    path = work_dir(spark, "llm")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
