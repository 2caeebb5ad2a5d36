"""A raw lake by day of arrival, and the compaction of days that are over.

An ingest that drains a log often leaves many small files. Each batch lands in folders of its own (day, batch), so a
batch that is run again replaces itself. Compaction writes the batches of a day once more as few large files, in a
folder of its own; only then does a record say up to which batch the day is read from there. Until then, and if
compaction fails, readers see the batches: no row is seen twice or missed. Folders of other days are not even listed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskmart.operators.parsing import parse_json
from riskmart.sinks.tables import distribute
from riskmart.sinks.versions import CommitLog, children, delete
from riskmart.specs import TableSpec

ARRIVAL, PART = "arrival", "part"
BATCH, COMPACT = "b-", "c-"


def arriving(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """Complete rows as text, with the day they arrived on.

    That is the day of the broker's ``timestamp``; messages without one arrive on the day of their batch, which stays
    the same when the batch is run again.
    """
    day = F.current_date()
    if "timestamp" in messages.columns:
        day = F.coalesce(F.to_date("timestamp"), day)
    rows = parse_json(messages, spec.raw_schema, F.date_format(day, "yyyy-MM-dd").alias(ARRIVAL))
    return rows.select(*spec.columns, ARRIVAL).dropna(how="any", subset=spec.columns)


@dataclass(frozen=True)
class ArrivalLake:
    """The landed rows of one table below `root`. One ingest and one compaction may run at a time, also together."""

    root: str
    spec: TableSpec

    @property
    def path(self) -> str:
        return f"{self.root}/{self.spec.name}"

    @property
    def commits(self) -> CommitLog:
        return CommitLog(f"{self.root}/_commits/{self.spec.name}")

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*self.spec.raw_schema, *(T.StructField(c, T.StringType()) for c in (ARRIVAL, PART))])

    def land(self, rows: DataFrame, batch: int) -> None:
        """Write the rows of one batch; a batch of the same number is replaced."""
        writer = rows.withColumn(PART, F.lit(f"{BATCH}{batch}")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(ARRIVAL, PART).parquet(self.path)

    def start(self, messages: DataFrame, checkpoint: str) -> StreamingQuery:
        """Start draining a message stream."""
        stream = arriving(messages, self.spec).writeStream.foreachBatch(self.land)
        return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def days(self, spark: SparkSession, first: dt.date | None = None, last: dt.date | None = None) -> list[str]:
        """Days of arrival that have rows, from the first to the last one asked for."""
        found = sorted(n.split("=", 1)[1] for n in children(spark, self.path) if n.startswith(f"{ARRIVAL}="))
        low, high = (d.isoformat() if d else None for d in (first, last))
        return [d for d in found if (low is None or d >= low) and (high is None or d <= high)]

    def _parts(self, spark: SparkSession, day: str) -> list[str]:
        return [n.split("=", 1)[1] for n in children(spark, f"{self.path}/{ARRIVAL}={day}") if n.startswith(f"{PART}=")]

    def _compacted(self, spark: SparkSession) -> dict[str, list]:
        """For each compacted day the name of its part, and the last batch that it holds."""
        record = self.commits.last(spark)
        return record["days"] if record else {}

    def _present(self, spark: SparkSession, days: list[str]) -> dict[str, list[str]]:
        """The parts that make up each day now: the compacted one, and batches that came after it."""
        done = self._compacted(spark)
        out = {}
        for day in days:
            part, through = done.get(day, (None, -1))
            late = [p for p in self._parts(spark, day) if p.startswith(BATCH) and int(p[len(BATCH) :]) > through]
            out[day] = [*([part] if part else []), *late]
        return out

    def _read(self, spark: SparkSession, parts: dict[str, list[str]]) -> DataFrame:
        folders = [f"{self.path}/{ARRIVAL}={day}/{PART}={p}" for day, some in parts.items() for p in some]
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)

    def read(self, spark: SparkSession, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """The rows that arrived from the first to the last day, with their day; all rows by default, none if none landed."""
        return self._read(spark, self._present(spark, self.days(spark, first, last))).drop(PART)

    def compact(self, spark: SparkSession, before: dt.date) -> list[str]:
        """Bring each day before `before` that is in several parts into one; returns these days.

        Days are rebalanced, so a large one is spread over several files and tasks. Batches that land meanwhile are left
        for the next call. A call without new batches writes nothing.
        """
        present = self._present(spark, self.days(spark, last=before - dt.timedelta(days=1)))
        due = {day: parts for day, parts in present.items() if any(p.startswith(BATCH) for p in parts)}
        if not due:
            return []
        part = f"{COMPACT}{uuid.uuid4().hex}"
        rows = distribute(self._read(spark, due).withColumn(PART, F.lit(part)), ARRIVAL)
        rows.write.mode("append").partitionBy(ARRIVAL, PART).parquet(self.path)
        taken = {day: [part, max(int(p[len(BATCH) :]) for p in parts if p.startswith(BATCH))] for day, parts in due.items()}
        self.commits.add(spark, {"days": self._compacted(spark) | taken})
        return sorted(due)

    def expire(self, spark: SparkSession) -> int:
        """Delete parts that readers no longer use, left-overs of failed compactions included; returns how many.

        Do not call it while a reader that began before the last compaction, or a compaction, is at work.
        """
        gone = 0
        for day, parts in self._present(spark, self.days(spark)).items():
            for part in set(self._parts(spark, day)) - set(parts):
                delete(spark, f"{self.path}/{ARRIVAL}={day}/{PART}={part}")
                gone += 1
        return gone
