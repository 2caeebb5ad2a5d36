"""Ingest that keeps what it rejects: each message lands either as a complete row or with the reason why not.

One streaming query writes both, by outcome and batch, in one pass over the messages. A batch that is run again
replaces its own partitions, so messages received = rows landed + rows rejected, whatever fails in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskmart.functions.casts import typed
from riskmart.specs import TableSpec

OUTCOME, BATCH = "outcome", "batch"
LANDED, REJECTED = "landed", "rejected"
#: What a rejected message keeps: its key, its text, and the first reason that applies.
REASON, KEY, VALUE = "reject_reason", "message_key", "message_value"
CORRUPT = "_corrupt"


def _listed(label: str, failing: dict[str, Column]) -> Column:
    """`label a,b` of the columns whose test fails, NULL if none does."""
    names = F.concat_ws(",", *(F.when(test, F.lit(name)) for name, test in failing.items()))
    return F.when(names != "", F.concat(F.lit(f"{label} "), names))


def audited(messages: DataFrame, spec: TableSpec, check_types: bool = True) -> DataFrame:
    """The columns of the table, then reason, key and text of rejected messages; reason is NULL for rows that land.

    Reasons, the first that applies: ``no message`` (a NULL value), ``unparsable`` (the text is no JSON object),
    ``missing a,b`` (fields absent or null), ``malformed a,b`` (text that the typed layer could not cast, with
    ``check_types``). Empty and very long texts are treated alike; extra fields are ignored.
    """
    text = F.col("value").cast("string")
    schema = T.StructType([*spec.raw_schema, T.StructField(CORRUPT, T.StringType())])
    data = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    key = F.col("key").cast("string") if "key" in messages.columns else F.lit(None).cast("string")
    # The struct is flattened by a generator, so that the text is parsed once whatever uses its fields.
    rows = messages.select(key.alias(KEY), text.alias(VALUE), F.inline(F.array(data)))
    kinds = {f.name: f.dataType for f in spec.typed_schema}
    missing = _listed("missing", {n: F.col(n).isNull() for n in spec.columns})
    broken = {n: F.col(n).isNotNull() & typed(F.col(n), k, kinds[n], "null").isNull() for n, k in spec.fields if k != "text"}
    malformed = _listed("malformed", broken) if check_types else F.lit(None).cast("string")
    none = F.when(F.col(VALUE).isNull(), F.lit("no message"))
    lost = F.when(F.col(CORRUPT).isNotNull() | F.coalesce(*spec.columns).isNull() & ~F.trim(VALUE).startswith("{"), F.lit("unparsable"))
    reason = F.coalesce(none, lost, missing, malformed)
    settled = rows.select(KEY, VALUE, *spec.columns, F.inline(F.array(F.struct(reason.alias(REASON)))))
    kept = (F.when(F.col(REASON).isNotNull(), F.col(c)).alias(c) for c in (KEY, VALUE))
    return settled.select(*spec.columns, REASON, *kept)


def audit_schema(spec: TableSpec) -> T.StructType:
    extra = [T.StructField(c, T.StringType()) for c in (REASON, KEY, VALUE, OUTCOME)]
    return T.StructType([*spec.raw_schema, *extra, T.StructField(BATCH, T.LongType())])


def write_batch(batch: DataFrame, number: int, path: str) -> None:
    """Write the outcomes of one batch; a batch of the same number is replaced."""
    outcome = F.when(F.col(REASON).isNull(), F.lit(LANDED)).otherwise(F.lit(REJECTED))
    rows = batch.withColumns({OUTCOME: outcome, BATCH: F.lit(number).cast("long")})
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    writer.partitionBy(OUTCOME, BATCH).parquet(path)


def start_audited_ingest(messages: DataFrame, spec: TableSpec, path: str, checkpoint: str, check_types: bool = True) -> StreamingQuery:
    """Start draining a message stream into `path`/outcome=…/batch=…"""

    rows = audited(messages, spec, check_types)
    stream = rows.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, path))
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _read(spark: SparkSession, spec: TableSpec, path: str, outcome: str) -> DataFrame:
    return spark.read.schema(audit_schema(spec)).parquet(path).where(F.col(OUTCOME) == outcome)


def landed_rows(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Complete rows, as the raw layer has them."""
    return _read(spark, spec, path, LANDED).select(*spec.columns)


def rejected_rows(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Rejected messages with reason, key, text, and the batch they came in."""
    return _read(spark, spec, path, REJECTED).select(REASON, KEY, VALUE, BATCH)


def audit_counts(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Messages per reason; the rows that landed have a NULL reason. All messages received are counted once."""
    rows = spark.read.schema(audit_schema(spec)).parquet(path)
    return rows.groupBy(REASON).agg(F.count(F.lit(1)).alias("messages"))


def replay(spark: SparkSession, spec: TableSpec, path: str, reason: str) -> DataFrame:
    """Rejected messages whose reason starts so, in the form of a log, to be sent again once their cause is mended."""
    rows = rejected_rows(spark, spec, path).where(F.col(REASON).startswith(reason))
    return rows.select(F.col(KEY).alias("key"), F.col(VALUE).alias("value"))
