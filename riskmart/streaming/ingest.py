"""Drain message logs into the raw lake.

An ingest is stateless: parse, drop incomplete rows, append Parquet. The
checkpoint and the sink's commit log make the append exactly-once, so a later
run takes new messages only and a run without new messages changes nothing.
"""

from __future__ import annotations

import contextlib
import hashlib
import queue
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from riskmart.operators.parsing import ingest_rows
from riskmart.sources.messages import FileLog, KafkaLog
from riskmart.sources.raw import raw_path
from riskmart.specs import TableSpec


@dataclass(frozen=True)
class IngestReport:
    table: str
    messages_read: int
    rows_landed: int


def start_ingest(
    messages: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    compression: str = "snappy",
) -> StreamingQuery:
    """Start draining a message stream. ``availableNow`` stops at the offsets known at the
    start, yet respects the per-trigger limits of the source, which bound a batch."""
    received = messages.observe("received", F.count(F.lit(1)).alias("rows"))
    rows = ingest_rows(received, spec)
    if rows.schema.names != spec.columns:
        raise ValueError(f"{spec.name}: parsed columns {rows.schema.names} differ from {spec.columns}")
    return (
        rows.observe("landed", F.count(F.lit(1)).alias("rows"))
        .writeStream.format("parquet")
        .queryName(f"ingest_{spec.name}_{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", compression)
        .trigger(availableNow=True)
        .start()
    )


class BatchSums(StreamingQueryListener):
    """Adds up the observed row counts of every batch, per run of a query.

    Batches are taken from the listener's events, not from the progress a query retains, so none is missed however few
    are retained or however fast they follow each other. A run's last event comes after those of all its batches.
    """

    def __init__(self) -> None:
        self.rows: dict[str, Counter[str]] = defaultdict(Counter)
        self.ended: queue.Queue[str] = queue.Queue()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, metric in event.progress.observedMetrics.items():
            self.rows[str(event.progress.runId)][name] += metric["rows"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.put(str(event.runId))

    def report(self, spec: TableSpec, run: str) -> IngestReport:
        return IngestReport(spec.name, self.rows[run]["received"], self.rows[run]["landed"])


def finish_all(sums: BatchSums, running: dict[str, StreamingQuery], patience: float = 60.0) -> None:
    """Wait for all queries, by run id; the first failure of any is raised at once."""
    waiting = dict(running)
    while waiting:
        try:
            run = sums.ended.get(timeout=patience)
        except queue.Empty:
            if not any(query.isActive for query in waiting.values()):
                for query in waiting.values():
                    query.awaitTermination()
                raise RuntimeError("the queries ended, but not all of their events arrived") from None
            continue
        if run in waiting:
            waiting.pop(run).awaitTermination()


@contextlib.contextmanager
def scheduler_pool(spark: SparkSession, name: str) -> Iterator[None]:
    """Jobs and queries started inside go to a scheduler pool of their own.

    In fair mode Spark shares executors between pools. Without pools all queries of a thread share one, so that the
    first topic with much to drain holds up the others.
    """
    context, key = spark.sparkContext, "spark.scheduler.pool"
    before = context.getLocalProperty(key)
    context.setLocalProperty(key, name)
    try:
        yield
    finally:
        context.setLocalProperty(key, before)


def checkpoint_path(root: str, spec: TableSpec) -> str:
    return f"{root}/_checkpoints/{spec.name}"


def ingest_streams(
    spark: SparkSession, streams: Iterable[tuple[TableSpec, DataFrame]], lake: str
) -> dict[str, IngestReport]:
    """Drain several message streams at once in one session, each in a scheduler pool of its own; stop all when one fails."""
    sums = BatchSums()
    spark.streams.addListener(sums)
    running: dict[str, StreamingQuery] = {}
    tables: dict[str, TableSpec] = {}
    try:
        for spec, messages in streams:
            with scheduler_pool(spark, f"ingest_{spec.name}"):
                query = start_ingest(messages, spec, raw_path(lake, spec), checkpoint_path(lake, spec))
            running[str(query.runId)], tables[str(query.runId)] = query, spec
        finish_all(sums, running)
        return {spec.name: sums.report(spec, run) for run, spec in tables.items()}
    finally:
        for query in running.values():
            if query.isActive:
                query.stop()
        spark.streams.removeListener(sums)


def ingest_all(
    spark: SparkSession, log: KafkaLog | FileLog, specs: Iterable[TableSpec], lake: str
) -> dict[str, IngestReport]:
    """Drain one topic per table of a log."""
    return ingest_streams(spark, ((spec, log.stream(spark, spec.name)) for spec in specs), lake)
