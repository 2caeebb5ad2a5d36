"""Keyed JSON messages: building them, sending them, and reading them back.

A log is either a Kafka topic per table or a folder of files per table with the
same ``key, value`` columns. Both are reached through Spark's own connectors.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.casts import to_text

KEY = "client_id"
MESSAGE_SCHEMA = "key string, value string"


@dataclass(frozen=True)
class KafkaLog:
    """Topics ``<prefix><table>``. Needs the Kafka connector package on the session.

    Messages are keyed by client, so a busy client fills one topic partition;
    ``min_partitions`` splits such a partition over several tasks.
    """

    servers: str
    prefix: str = "raw_"
    max_offsets_per_trigger: int | None = 500_000_000
    min_partitions: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def topic(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def read_options(self, table: str) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic(table),
            "startingOffsets": "earliest",
            "failOnDataLoss": "false",
        }
        if self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return options | self.extra

    def write_options(self, table: str) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "topic": self.topic(table),
            "kafka.acks": "1",
            "kafka.retries": "3",
            "kafka.compression.type": "gzip",
        } | self.extra

    def stream(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.read_options(table)).load()

    def batch(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format("kafka").options(**self.read_options(table)).load()

    def append(self, messages: DataFrame, table: str) -> None:
        messages.write.format("kafka").options(**self.write_options(table)).save()


@dataclass(frozen=True)
class FileLog:
    """Folders ``<root>/<table>`` of Parquet or JSON files holding ``key, value`` rows."""

    root: str
    format: str = "parquet"
    max_files_per_trigger: int | None = 10_000

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def stream(self, spark: SparkSession, table: str) -> DataFrame:
        reader = spark.readStream.format(self.format).schema(MESSAGE_SCHEMA)
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return reader.load(self.path(table))

    def batch(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format(self.format).schema(MESSAGE_SCHEMA).load(self.path(table))

    def append(self, messages: DataFrame, table: str) -> None:
        messages.write.format(self.format).mode("append").save(self.path(table))


def as_text(df: DataFrame, as_floats: Iterable[str] = ()) -> DataFrame:
    """Every column as text, NULLs kept.

    ``as_floats`` names whole-number columns to print with ``.0``, the way ids
    look once a producer has held them in a nullable float column.
    """
    floats = set(as_floats)
    fields = []
    for column in df.schema:
        text = to_text(F.col(column.name), column.dataType)
        if column.name in floats:
            text = F.concat(text, F.lit(".0"))
        fields.append(text.alias(column.name))
    return df.select(*fields)


def to_messages(df: DataFrame, key: str = KEY, as_floats: Iterable[str] = ()) -> DataFrame:
    """One JSON message per row, keyed by client: every field is text or an explicit null."""
    flat = as_text(df, as_floats)
    value = F.to_json(F.struct(*flat.columns), {"ignoreNullFields": "false"})
    return flat.select(F.col(key).alias("key"), value.alias("value"))


def send(messages: DataFrame, log: KafkaLog | FileLog, table: str) -> int:
    """Append the messages to the log and return how many rows were sent."""
    sent = Observation(f"sent_{table}")
    log.append(messages.observe(sent, F.count(F.lit(1)).alias("rows")), table)
    return sent.get["rows"]
