"""Typed and clean layers that take in what is new instead of being written anew every day.

The mark of raw files already taken is the checkpoint of a stream over the raw folder. Each of its batches lands in
partitions of its own (month, batch), so a batch that is run again replaces itself. Cleaning then rewrites only months
that may have changed: those of new rows, and those the moving end of the date rule has passed. Other months keep their
files. A mark of its own says up to which batch and by which dates the clean layer was made; where the dates moved
back, the layer is made anew.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.cleaning import Horizon, clean, with_month
from riskmart.operators.staging import one_per_key, stage
from riskmart.sinks.tables import distribute, write_layer, write_months
from riskmart.sinks.versions import CommitLog, VersionedFolder, exists
from riskmart.specs import MONTH, TableSpec

BATCH = "batch"
#: Raw files of one batch at most.
MAX_FILES = 100_000


def staged_schema(spec: TableSpec) -> T.StructType:
    """The typed columns with their partitions."""
    schema = spec.clean_schema
    return schema.add(BATCH, T.LongType())


def staged_partitions(spec: TableSpec) -> list[str]:
    return [MONTH, BATCH] if spec.has_event_time else [BATCH]


def stage_increment(spark: SparkSession, spec: TableSpec, raw: str, path: str, checkpoint: str, on_bad: str = "error", max_files: int = MAX_FILES) -> None:
    """Type the raw files that no earlier call has taken and land them below `path`.

    Clients are reduced to one row per key within each batch; reading them reduces the batches.
    """

    def land(rows: DataFrame, batch: int) -> None:
        typed = with_month(stage(rows, spec, on_bad), spec)
        if spec.has_event_time:
            typed = distribute(typed, MONTH)
        writer = typed.withColumn(BATCH, F.lit(batch).cast("long")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*staged_partitions(spec)).parquet(path)

    files = spark.readStream.schema(spec.raw_schema).option("maxFilesPerTrigger", max_files).parquet(raw)
    query = files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.start().awaitTermination()


def read_staged(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """All staged rows; one per key for a table that has a key."""
    rows = spark.read.schema(staged_schema(spec)).parquet(path)
    return one_per_key(rows.select(*spec.columns), spec.unique_key) if spec.unique_key else rows


def months_between(first: dt.date, last: dt.date) -> list[str]:
    """All months from that of the first to that of the last day."""
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]


def _changed_months(staged: DataFrame, mark: dict, horizon: Horizon, as_of: dt.date) -> list[str]:
    """Months inside the rule that new batches hold rows of, or that the end of the rule moved through."""
    end = min(as_of, horizon.end)
    inside = months_between(horizon.start, max(horizon.start, end))
    new = staged.where(F.col(BATCH) > mark["batch"]).where(F.col(MONTH).isin(inside)).select(MONTH).distinct()
    passed = months_between(dt.date.fromisoformat(mark["as_of"]), as_of) if mark["as_of"] < as_of.isoformat() else []
    return sorted({r[MONTH] for r in new.collect()} | set(passed) & set(inside))


def clean_increment(spark: SparkSession, spec: TableSpec, staged_path: str, path: str, marks: CommitLog, as_of: dt.date | None, horizon: Horizon) -> list[str] | None:
    """Bring the clean layer of an event table up to date; returns the months written, None for all of them.

    The months are written from all staged rows they have, so a call that is repeated writes the same. Nothing is
    written where neither rows nor dates have changed.
    """
    as_of = as_of or spark.sql("SELECT current_date()").first()[0]
    staged = spark.read.schema(staged_schema(spec)).parquet(staged_path)
    mark = marks.last(spark)
    rule = {"start": horizon.start.isoformat(), "end": horizon.end.isoformat()}
    newest = staged.where(F.col(BATCH) > (mark["batch"] if mark else -1)).agg(F.max(BATCH)).first()[0]
    months = None
    if mark is None or {k: mark[k] for k in rule} != rule or as_of.isoformat() < mark["as_of"] or not exists(spark, path):
        write_months(clean(staged, spec, as_of, horizon), spec, path)
    else:
        months = _changed_months(staged, mark, horizon, as_of)
        if months:
            rows = with_month(clean(staged.where(F.col(MONTH).isin(months)), spec, as_of, horizon), spec)
            writer = distribute(rows, MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(MONTH).parquet(path)
    last = newest if newest is not None else mark["batch"] if mark else -1
    if mark is None or months is None or months or last != mark["batch"] or as_of.isoformat() != mark["as_of"]:
        marks.add(spark, {"batch": last, "as_of": as_of.isoformat()} | rule)
    return months


def clean_keyed(spark: SparkSession, spec: TableSpec, staged_path: str, folder: VersionedFolder, as_of: dt.date | None) -> None:
    """The clean layer of a table with a key: one row per key over all batches, written as a new version."""
    rows = clean(read_staged(spark, spec, staged_path), spec, as_of)
    folder.replace(spark, lambda path: write_layer(rows, path))
    folder.expire(spark)
