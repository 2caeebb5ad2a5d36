"""The registered queries: each runs one operator over the whole benchmark tables.

Results are rendered for comparison with another engine: decimals as doubles,
dates and timestamps as text. The operators themselves return the typed columns
of :mod:`riskmart.specs`.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskmart.functions.draws import selected
from riskmart.operators import defects
from riskmart.operators.cleaning import clean, date_range
from riskmart.operators.mart import fraud_dashboard
from riskmart.operators.parsing import drop_incomplete, ingest_rows, parse_json
from riskmart.operators.profiles import login_profile, suspicious_count, tx_profile
from riskmart.operators.staging import stage
from riskmart.plans.colocated import colocated_dashboard, drop_colocated, write_colocated
from riskmart.plans.daily import DailyConfig, run_daily
from riskmart.plans.incremental import clean_increment, stage_increment
from riskmart.session import side_by_side, work_dir
from riskmart.sinks.serving import ParquetTarget, VersionedTarget, publish, wide_schema
from riskmart.sinks.tables import (
    ensure_table,
    read_clean,
    rebuild_table,
    refresh_table,
    register_folder,
    table_rows,
    write_bucketed,
    write_layer,
    write_months,
)
from riskmart.sinks.versions import CommitLog, VersionedFolder
from riskmart.sources.bench_tables import BOUNDS, WIDE, row_id, stream, table
from riskmart.sources.messages import FileLog, as_text, send, to_messages
from riskmart.sources.raw import raw_path, raw_scan, replace_raw_view
from riskmart.specs import MONTH, SPECS
from riskmart.streaming.arrivals import ARRIVAL, ArrivalLake
from riskmart.streaming.audit import audit_counts, rejected_rows, start_audited_ingest
from riskmart.streaming.ingest import IngestReport, ingest_all, ingest_streams

Query = Callable[[SparkSession, str], DataFrame]

DROP_SPLIT = "2024-01-16 00:00:00"
RANGE = (dt.date(1997, 3, 10), dt.date(1997, 6, 5))
BROKEN_RATE = 0.2
BROKEN_SEED = 600
BROKEN_LENGTH = 25
#: Messages of clients whose key has so many digits are cut off in the query of rejects.
BROKEN_KEY = 1
BUCKETS = 16
LAYER_SPLIT = "2000-03-10 00:00:00"
LAYER_FIRST_DAY = dt.date(2000, 9, 20)


def comparable(df: DataFrame) -> DataFrame:
    def render(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*(render(field) for field in df.schema))


def cleaned(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    horizon, as_of = BOUNDS[name]
    return clean(table(spark, sf_dir, name), WIDE[name], as_of, horizon)


# Messages and ingest


def q_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = WIDE["transactions"].of_kind("id")
    return to_messages(table(spark, sf_dir, "transactions"), as_floats=ids)


def q_message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = FileLog(work_dir(spark, "message_log"), format="json")
    send(to_messages(table(spark, sf_dir, "logins")), log, "logins")
    return log.batch(spark, "logins")


def q_parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a field the schema does not know; some of them are cut off mid-text."""
    rows = table(spark, sf_dir, "activity").withColumn("record_saved_at", F.col("activity_date"))
    messages = to_messages(rows)
    event_id = F.get_json_object("value", "$.ip_address").cast("bigint")
    broken = selected(event_id, BROKEN_SEED, BROKEN_RATE)
    cut = F.when(broken, F.left("value", F.lit(BROKEN_LENGTH))).otherwise(F.col("value"))
    return parse_json(messages.withColumn("value", cut), WIDE["activity"].raw_schema)


def _holey_messages(rows: DataFrame, name: str) -> DataFrame:
    return to_messages(defects.inject_nulls(rows, row_id(name), WIDE[name].rates.nulls))


def q_drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _holey_messages(table(spark, sf_dir, "transactions"), "transactions")
    return drop_incomplete(parse_json(messages, WIDE["transactions"].raw_schema))


def _ingest(spark: SparkSession, sf_dir: str, names: list[str], lake: str) -> dict[str, IngestReport]:
    return ingest_streams(
        spark, ((WIDE[n], _holey_messages(stream(spark, sf_dir, n), n)) for n in names), lake
    )


def ingest_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = work_dir(spark, f"ingest_{name}")
        _ingest(spark, sf_dir, [name], lake)
        return raw_scan(spark, WIDE[name], raw_path(lake, WIDE[name]))

    return query


def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops into a log, an ingest after each, and one more with nothing new."""
    spec = WIDE["activity"]
    root = work_dir(spark, "ingest_incremental")
    log, lake = FileLog(f"{root}/log"), f"{root}/raw"
    rows = table(spark, sf_dir, "activity")
    early = F.col("activity_date") < F.lit(DROP_SPLIT).cast("timestamp_ntz")
    for drop in (early, ~early):
        send(to_messages(rows.where(drop)), log, spec.name)
        ingest_all(spark, log, [spec], lake)
    ingest_all(spark, log, [spec], lake)
    return raw_scan(spark, spec, raw_path(lake, spec))


def q_ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows per table and client."""
    lake = work_dir(spark, "ingest_all")
    _ingest(spark, sf_dir, list(WIDE), lake)
    counts = None
    for name, spec in WIDE.items():
        rows = raw_scan(spark, spec, raw_path(lake, spec)).groupBy("client_id").agg(
            F.count(F.lit(1)).alias("landed_rows")
        )
        rows = rows.select(F.lit(name).alias("table_name"), "client_id", "landed_rows")
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


def q_ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = _ingest(spark, sf_dir, list(WIDE), work_dir(spark, "ingest_metrics"))
    rows = [(r.table, r.messages_read, r.rows_landed) for r in reports.values()]
    return spark.createDataFrame(rows, "table_name string, messages_read long, rows_landed long")


def _audited_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity as a stream of messages: some cut off mid-text, some with nulls, some with a client that is no number."""
    rows = defects.inject_nulls(stream(spark, sf_dir, "activity"), row_id("activity"), WIDE["activity"].rates.nulls)
    odd = F.when(F.col("activity_type") == "error", F.concat(F.lit("c"), F.col("client_id").cast("string")))
    messages = to_messages(rows.withColumn("client_id", F.coalesce(odd, F.col("client_id").cast("string"))))
    cut = F.when(F.length("key") == BROKEN_KEY, F.left("value", F.lit(BROKEN_LENGTH))).otherwise(F.col("value"))
    return messages.withColumn("value", cut)


def q_ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per reason of their rejection, and those that land."""
    spec, root = WIDE["activity"], work_dir(spark, "ingest_rejects")
    start_audited_ingest(_audited_messages(spark, sf_dir), spec, f"{root}/raw", f"{root}/marks").awaitTermination()
    return audit_counts(spark, spec, f"{root}/raw").withColumn("reject_reason", F.coalesce("reject_reason", F.lit("")))


def q_rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected messages themselves."""
    spec, root = WIDE["activity"], work_dir(spark, "rejected_messages")
    start_audited_ingest(_audited_messages(spark, sf_dir), spec, f"{root}/raw", f"{root}/marks").awaitTermination()
    return rejected_rows(spark, spec, f"{root}/raw").drop("batch")


def q_arrival_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day of arrival, which is that of the event here, once the days of the first half are compacted."""
    spec, root = WIDE["activity"], work_dir(spark, "arrival_lake")
    lake = ArrivalLake(f"{root}/raw", spec)
    messages = _holey_messages(stream(spark, sf_dir, "activity"), "activity")
    stamped = messages.withColumn("timestamp", F.get_json_object("value", "$.activity_date").cast("timestamp"))
    lake.start(stamped, f"{root}/marks").awaitTermination()
    days = lake.days(spark)
    lake.compact(spark, dt.date.fromisoformat(days[len(days) // 2]))
    lake.expire(spark)
    event_id = F.col("ip_address").cast("bigint")
    return lake.read(spark).groupBy(ARRIVAL).agg(F.count(F.lit(1)).alias("landed_rows"), F.sum(event_id).alias("id_sum"))


def q_raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = WIDE["payments"]
    path = raw_path(work_dir(spark, "raw_scan"), spec)
    write_layer(ingest_rows(_holey_messages(table(spark, sf_dir, "payments"), "payments"), spec), path)
    return spark.table(replace_raw_view(spark, spec, path))


# Typed and clean layers


def stage_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = WIDE[name]
        rows = table(spark, sf_dir, name)
        raw = as_text(rows, spec.of_kind("id"))
        if spec.unique_key:
            other = rows.withColumn("client_phone", F.concat(F.lit("+0-"), F.col("client_phone")))
            raw = raw.unionByName(as_text(other)).unionByName(raw)
        return comparable(stage(raw, spec))

    return query


def clean_query(name: str) -> Query:
    return lambda spark, sf_dir: comparable(cleaned(spark, sf_dir, name))


def q_month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = WIDE["transactions"]
    path = work_dir(spark, "month_partitions")
    write_months(cleaned(spark, sf_dir, "transactions"), spec, path)
    return comparable(read_clean(spark, spec, path))


def q_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = WIDE["payments"]
    path = work_dir(spark, "date_range")
    write_months(cleaned(spark, sf_dir, "payments"), spec, path)
    return comparable(date_range(read_clean(spark, spec, path), spec, *RANGE))


def q_refresh_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second refresh replaces what the first one wrote."""
    spec = WIDE["transactions"]
    location = work_dir(spark, "refresh_table")
    name = f"transactions_{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "transactions")
    ensure_table(spark, name, spec.typed_schema, location)
    refresh_table(spark, name, rows.where(F.col("currency") == "USD"))
    refresh_table(spark, name, rows)
    spark.sql(f"DROP TABLE {name}")
    return comparable(spark.read.schema(spec.typed_schema).parquet(location))


def q_rebuild_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as a catalog table, dropped and built again over an older one of other rows."""
    location, name = work_dir(spark, "rebuild_table"), f"mart_{uuid.uuid4().hex}"
    mart = unfiltered_mart(spark, sf_dir)
    rebuild_table(spark, name, mart.where(F.col("risk_score") == 0), location)
    rebuild_table(spark, name, mart, location)
    spark.sql(f"DROP TABLE {name}")
    return comparable(VersionedFolder(location).read(spark))


def q_bucketed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients in hash buckets, loaded twice."""
    location, name = work_dir(spark, "bucketed_table"), f"clients_{uuid.uuid4().hex}"
    for _ in range(2):
        write_bucketed(table(spark, sf_dir, "clients"), name, location, BUCKETS)
    spark.sql(f"DROP TABLE {name}")
    return comparable(spark.read.parquet(location))


def q_layer_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each clean table as its collected statistics give them."""
    root, mark = work_dir(spark, "layer_statistics"), uuid.uuid4().hex

    def load(name: str) -> tuple[str, int]:
        spec, catalog_name = WIDE[name], f"{name}_{mark}"
        write_months(cleaned(spark, sf_dir, name), spec, f"{root}/{name}")
        month = [MONTH] if spec.has_event_time else []
        register_folder(spark, catalog_name, spec.clean_schema, f"{root}/{name}", *month)
        rows = table_rows(spark, catalog_name)
        spark.sql(f"DROP TABLE {catalog_name}")
        return name, rows

    return spark.createDataFrame(side_by_side(spark, load, WIDE), "table_name string, row_count long")


def q_stage_int32(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SPECS["transactions"]
    return comparable(stage(as_text(table(spark, sf_dir, "transactions"), spec.of_kind("id")), spec))


def q_stage_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with a fraction, months that do not exist, amounts of three fraction digits, and NULLs."""
    spec = WIDE["transactions"]
    rows = as_text(table(spark, sf_dir, "transactions"))
    key = F.col("transaction_id").cast("bigint")
    broken = {
        "client_id": F.when(key % 7 == 0, F.concat("client_id", F.lit(".5"))),
        "transaction_date": F.when(key % 11 == 0, F.lit("2024-13-45 00:00:00")).when(key % 11 == 1, F.lit(None)),
        "amount": F.when(key % 5 == 0, F.concat("amount", F.lit("5"))).when(key % 5 == 1, F.lit("n/a")),
    }
    gone = {"transaction_date": key % 11 == 1}
    columns = {n: F.when(~gone.get(n, F.lit(False)), F.coalesce(c, n)) for n, c in broken.items()}
    return comparable(stage(rows.withColumns(columns), spec, on_bad="null"))


# Profiles and mart


def q_tx_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(tx_profile(table(spark, sf_dir, "transactions")))


def q_login_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return login_profile(table(spark, sf_dir, "logins"))


def suspicious_query(method: str) -> Query:
    """Hot clients are looked for at any size, so that both routes carry rows."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tx = table(spark, sf_dir, "transactions")
        return suspicious_count(tx, method=method, hot_limit=1_000)

    return query


def unfiltered_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud_dashboard(*(table(spark, sf_dir, n) for n in ("clients", "transactions", "logins")))


def q_fraud_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = fraud_dashboard(*(cleaned(spark, sf_dir, n) for n in ("clients", "transactions", "logins")))
    return comparable(mart)


def q_fraud_dashboard_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(unfiltered_mart(spark, sf_dir))


def q_colocated_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unfiltered mart over bucketed tables; some clients count as hot at any size."""
    root, mark = work_dir(spark, "colocated_mart"), uuid.uuid4().hex
    names = {name: f"{name}_{mark}" for name in ("clients", "transactions", "logins")}
    for name, catalog_name in names.items():
        write_colocated(table(spark, sf_dir, name), catalog_name, f"{root}/{name}", BUCKETS, hot_limit=1_000)
    write_layer(colocated_dashboard(spark, names), f"{root}/mart")
    for catalog_name in names.values():
        drop_colocated(spark, catalog_name)
    return comparable(spark.read.parquet(f"{root}/mart"))


def q_risk_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unfiltered_mart(spark, sf_dir).select("client_id", "financial_risk", "activity_risk")


def q_risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unfiltered_mart(spark, sf_dir).select("client_id", "risk_score")


def q_publish_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "publish_mart")
    write_layer(unfiltered_mart(spark, sf_dir), f"{root}/mart")
    target = ParquetTarget(f"{root}/serving")
    publish(spark.read.parquet(f"{root}/mart"), target, schema=wide_schema())
    return comparable(spark.read.parquet(target.path))


def q_publish_mart_int32(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "publish_mart_int32")
    write_layer(unfiltered_mart(spark, sf_dir), f"{root}/mart")
    target = ParquetTarget(f"{root}/serving")
    publish(spark.read.parquet(f"{root}/mart"), target)
    return comparable(spark.read.parquet(target.path))


def q_publish_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full mart, then an empty one, which leaves the served rows alone."""
    root = work_dir(spark, "publish_empty")
    write_layer(unfiltered_mart(spark, sf_dir), f"{root}/mart")
    mart, target = spark.read.parquet(f"{root}/mart"), ParquetTarget(f"{root}/serving")
    for rows in (mart, mart.where("client_id IS NULL")):
        publish(rows, target, schema=wide_schema())
    return comparable(spark.read.parquet(target.path))


def q_serving_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Served rows that come after a larger client of their file, and files whose clients reach into the next."""
    target = ParquetTarget(work_dir(spark, "serving_order"))
    publish(unfiltered_mart(spark, sf_dir), target, schema=wide_schema())
    served = spark.read.parquet(target.path)
    rows = served.select("client_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("client_id").over(Window.partitionBy("file").orderBy("at"))
    files = rows.withColumn("late", before > F.col("client_id")).groupBy("file").agg(
        F.count("*").alias("n"), F.count_if("late").alias("late"), F.min("client_id").alias("low"), F.max("client_id").alias("high")
    )
    # One row per file from here on.
    after = F.lead("low").over(Window.orderBy("low", "high"))
    return files.withColumn("reaches", F.col("high") >= after).agg(
        F.sum("n").alias("rows_served"),
        F.sum("late").alias("rows_out_of_order"),
        F.count_if("reaches").alias("files_overlapping"),
    )


def q_versioned_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see of the served mart after a first run, after one that fails half-way, and after a third."""
    target = VersionedTarget(work_dir(spark, "versioned_mart"))
    mart = unfiltered_mart(spark, sf_dir)
    broken = F.when(F.col("risk_score") == 3, F.raise_error(F.lit("stopped"))).otherwise(F.col("risk_score"))
    publish(mart.where(F.col("risk_score") == 0), target, schema=wide_schema())
    with contextlib.suppress(PySparkException):
        publish(mart.withColumn("risk_score", broken), target, schema=wide_schema())
    after_failure = target.read(spark)
    publish(mart, target, schema=wide_schema())
    seen = {"after_failure": after_failure, "after_success": target.read(spark)}
    first, second = (rows.withColumn("seen", F.lit(name)) for name, rows in seen.items())
    return comparable(first.unionByName(second))


def q_incremental_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of transactions, the layers brought up to date after each, and once more on a later day."""
    spec, root = WIDE["transactions"], work_dir(spark, "incremental_layers")
    log, lake, (horizon, as_of) = FileLog(f"{root}/log"), f"{root}/raw", BOUNDS["transactions"]
    marks = CommitLog(f"{root}/marks/clean")
    rows = table(spark, sf_dir, "transactions")
    early = F.col("transaction_date") < F.lit(LAYER_SPLIT).cast("timestamp_ntz")
    for drop, day in ((early, LAYER_FIRST_DAY), (~early, LAYER_FIRST_DAY), (F.lit(False), as_of)):
        send(to_messages(rows.where(drop)), log, spec.name)
        ingest_all(spark, log, [spec], lake)
        stage_increment(spark, spec, raw_path(lake, spec), f"{root}/ods", f"{root}/marks/stage")
        clean_increment(spark, spec, f"{root}/ods", f"{root}/dds", marks, day, horizon)
    return comparable(read_clean(spark, spec, f"{root}/dds"))


# Defect injection


def q_inject_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "clients")
    return comparable(defects.inject_nulls(rows, row_id("clients"), WIDE["clients"].rates.nulls))


def q_inject_bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "activity")
    return comparable(defects.inject_bad_dates(rows, "activity_date", row_id("activity")))


def q_inject_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "transactions")
    return comparable(defects.inject_duplicates(rows, row_id("transactions"), 0.05))


def q_inject_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(defects.inject_outliers(table(spark, sf_dir, "transactions"), row_id("transactions")))


def q_inject_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = table(spark, sf_dir, "transactions")
    return comparable(defects.inject_bursts(tx, table(spark, sf_dir, "clients"), BOUNDS["transactions"][0]))


def _dirty(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return defects.inject_defects(table(spark, sf_dir, name), WIDE[name], row_id(name))


def q_inject_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_dirty(spark, sf_dir, "transactions"))


def q_defects_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    horizon, as_of = BOUNDS["transactions"]
    return comparable(clean(_dirty(spark, sf_dir, "transactions"), WIDE["transactions"], as_of, horizon))


def q_shuffle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(defects.shuffle_rows(table(spark, sf_dir, "logins"), row_id("logins")))


def q_daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty messages of all five tables through every layer; the published mart."""
    root = work_dir(spark, "daily_run")
    log, target = FileLog(f"{root}/log"), ParquetTarget(f"{root}/serving")

    def produce(name: str) -> int:
        dirty = _dirty(spark, sf_dir, name)
        return send(to_messages(dirty, as_floats=WIDE[name].of_kind("id")), log, name)

    side_by_side(spark, produce, WIDE)
    run_daily(spark, DailyConfig(log, root, target, bounds=BOUNDS, wide_ids=True))
    return comparable(spark.read.parquet(target.path))


QUERIES: dict[str, Query] = {
    "fraud_dashboard": q_fraud_dashboard,
    "fraud_dashboard_unfiltered": q_fraud_dashboard_unfiltered,
    "tx_profile": q_tx_profile,
    "login_profile": q_login_profile,
    "suspicious_count": suspicious_query("bands"),
    "suspicious_count_join": suspicious_query("salt"),
    "colocated_mart": q_colocated_mart,
    "risk_flags": q_risk_flags,
    "risk_score": q_risk_score,
    **{f"stage_{name}": stage_query(name) for name in WIDE},
    **{f"clean_{name}": clean_query(name) for name in WIDE},
    "to_messages": q_to_messages,
    "message_log": q_message_log,
    "parse_json": q_parse_json,
    "drop_incomplete": q_drop_incomplete,
    **{f"ingest_{name}": ingest_query(name) for name in WIDE},
    "ingest_incremental": q_ingest_incremental,
    "ingest_all": q_ingest_all,
    "ingest_metrics": q_ingest_metrics,
    "ingest_rejects": q_ingest_rejects,
    "rejected_messages": q_rejected_messages,
    "arrival_lake": q_arrival_lake,
    "raw_scan": q_raw_scan,
    "refresh_table": q_refresh_table,
    "month_partitions": q_month_partitions,
    "date_range": q_date_range,
    "publish_mart": q_publish_mart,
    "publish_mart_int32": q_publish_mart_int32,
    "publish_empty": q_publish_empty,
    "serving_order": q_serving_order,
    "stage_int32": q_stage_int32,
    "stage_malformed": q_stage_malformed,
    "rebuild_table": q_rebuild_table,
    "bucketed_table": q_bucketed_table,
    "layer_statistics": q_layer_statistics,
    "versioned_mart": q_versioned_mart,
    "incremental_layers": q_incremental_layers,
    "inject_nulls": q_inject_nulls,
    "inject_bad_dates": q_inject_bad_dates,
    "inject_duplicates": q_inject_duplicates,
    "inject_outliers": q_inject_outliers,
    "inject_bursts": q_inject_bursts,
    "inject_defects": q_inject_defects,
    "defects_cleaned": q_defects_cleaned,
    "shuffle_rows": q_shuffle_rows,
    "daily_run": q_daily_run,
}
