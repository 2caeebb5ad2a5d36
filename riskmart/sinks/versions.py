"""Commit logs, and folders that are replaced by switching a name.

A replaced folder keeps its old rows until the new ones are written whole and a commit record names them, so a run that
fails half-way changes nothing for readers. Records and data are written by Spark's own committers, hence they work on
any store that Spark reads. One writer at a time is assumed, as with any full refresh.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as the catalog writes it."""
    files, place = _file_system(spark, path)
    return files.makeQualified(place).toString()


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    files, place = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


@dataclass(frozen=True)
class CommitLog:
    """Numbered records below a folder, each a JSON object; a record is there in full or not at all."""

    path: str

    def records(self, spark: SparkSession) -> list[tuple[int, dict[str, Any]]]:
        """All records, oldest first; a handful if old ones are dropped now and then."""
        if not exists(spark, self.path):
            return []
        rows = spark.read.schema("record string, seq long").json(self.path).where("record IS NOT NULL")
        return [(r["seq"], json.loads(r["record"])) for r in rows.orderBy("seq").collect()]

    def last(self, spark: SparkSession) -> dict[str, Any] | None:
        records = self.records(spark)
        return records[-1][1] if records else None

    def add(self, spark: SparkSession, record: dict[str, Any], keep: int = 30) -> None:
        """Append a record and drop all but the last `keep`."""
        before = [seq for seq, _ in self.records(spark)]
        seq = before[-1] + 1 if before else 0
        row = spark.createDataFrame([(json.dumps(record),)], "record string").coalesce(1)
        row.write.mode("overwrite").json(f"{self.path}/seq={seq}")
        for old in [*before, seq][:-keep]:
            delete(spark, f"{self.path}/seq={old}")


@dataclass(frozen=True)
class VersionedFolder:
    """Data folders below a path, and a log whose last record names those that make up the present content."""

    path: str

    @property
    def log(self) -> CommitLog:
        return CommitLog(f"{self.path}/commits")

    def folders(self, spark: SparkSession) -> list[str]:
        """The folders of the present content; none before the first commit."""
        record = self.log.last(spark)
        return [f"{self.path}/{name}" for name in record["folders"]] if record else []

    def read(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        folders = self.folders(spark)
        if not folders:
            raise FileNotFoundError(f"nothing is committed below {self.path}")
        return (spark.read.schema(schema) if schema else spark.read).parquet(*folders)

    def replace(self, spark: SparkSession, write: Callable[[str], None]) -> str:
        """Let `write` fill a new folder, then switch to it. Its rows may come from the present content."""
        return self._commit(spark, write, [])

    def append(self, spark: SparkSession, write: Callable[[str], None]) -> str:
        """Let `write` fill a new folder, then add it to the present content."""
        record = self.log.last(spark)
        return self._commit(spark, write, record["folders"] if record else [])

    def _commit(self, spark: SparkSession, write: Callable[[str], None], kept: list[str]) -> str:
        name = f"v-{uuid.uuid4().hex}"
        write(f"{self.path}/{name}")
        self.log.add(spark, {"folders": [*kept, name]})
        return f"{self.path}/{name}"

    def expire(self, spark: SparkSession, keep: int = 2) -> None:
        """Delete data that none of the last `keep` commits names, left-overs of failed runs included.

        Readers of the last commits are undisturbed; do not call it while a writer is at work.
        """
        records = self.log.records(spark)
        named = {name for _, record in records[-keep:] for name in record["folders"]}
        for seq, _ in records[:-keep]:
            delete(spark, f"{self.log.path}/seq={seq}")
        for name in children(spark, self.path):
            if name.startswith("v-") and name not in named:
                delete(spark, f"{self.path}/{name}")

