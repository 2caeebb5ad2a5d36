"""Parsing, staging, cleaning."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskmart import CLIENTS, LOGINS, SPECS, TRANSACTIONS
from riskmart.operators.cleaning import Horizon, clean, date_range
from riskmart.operators.parsing import drop_incomplete, ingest_rows, parse_json
from riskmart.operators.staging import one_per_key, stage
from riskmart.sinks.tables import read_clean, write_months
from riskmart.sources.messages import KafkaLog, as_text, to_messages

AS_OF = dt.date(2025, 6, 15)


def test_parse_and_drop(spark):
    values = ['{"client_id":"1.0","amount":"5.5","extra":"z"}', '{"client_id":null,"amount":"1"}', "garbage"]
    messages = spark.createDataFrame([(v.encode(),) for v in values], "value binary")
    schema = spark.createDataFrame([], "client_id string, amount string").schema
    parsed = parse_json(messages, schema)
    assert parsed.count() == 3
    assert [tuple(r) for r in drop_incomplete(parsed).collect()] == [("1.0", "5.5")]


def test_messages_keep_nulls_and_keys(spark):
    rows = spark.createDataFrame([(7, None, "a\"b")], "client_id int, amount double, note string")
    message = to_messages(rows).first()
    assert message["key"] == "7"
    assert message["value"] == '{"client_id":"7","amount":null,"note":"a\\"b"}'


@pytest.mark.parametrize("name", list(SPECS))
def test_raw_schema_is_text_and_typed_schema_matches(spark, name):
    spec = SPECS[name]
    empty = spark.createDataFrame([], spec.raw_schema)
    assert {f.dataType.simpleString() for f in spec.raw_schema} == {"string"}
    got = [(f.name, f.dataType) for f in stage(empty, spec).schema]
    assert got == [(f.name, f.dataType) for f in spec.typed_schema]


def test_message_round_trip(spark):
    row = (3, 1001, dt.datetime(2025, 3, 1, 12, 34, 56, 789012), "deposit", "ACC1", "USD", Decimal("12.50"))
    typed = spark.createDataFrame([row], TRANSACTIONS.typed_schema)
    landed = ingest_rows(to_messages(typed, as_floats=TRANSACTIONS.of_kind("id")), TRANSACTIONS)
    assert landed.first()["client_id"] == "3.0"
    assert tuple(stage(landed, TRANSACTIONS).first()) == row[:2] + (row[2].replace(microsecond=0),) + row[3:]


def client(client_id, name="A", birthday="1990-01-01"):
    return (client_id, name, "B", "e", "p", "a", birthday)


def test_dedup_joins_both_spellings_of_an_id(spark):
    raw = spark.createDataFrame([client("1", "Z"), client("1.0", "Y"), client("2.0")], CLIENTS.raw_schema)
    got = {r["client_id"]: r["client_first_name"] for r in stage(raw, CLIENTS).collect()}
    assert got == {1: "Y", 2: "A"}


def test_dedup_puts_nulls_first_and_keeps_null_key(spark):
    rows = spark.createDataFrame([(1, "x"), (1, None), (None, "n"), (None, "m")], "k int, v string")
    assert {tuple(r) for r in one_per_key(rows, "k").collect()} == {(1, None), (None, "m")}


@pytest.mark.parametrize(
    "value, as_of, kept",
    [
        ("2022-12-31 23:59:59", AS_OF, False),
        ("2023-01-01 00:00:00", AS_OF, True),
        ("2025-06-14 23:59:59", AS_OF, True),
        ("2025-06-15 00:00:00", AS_OF, False),
        ("2100-01-01 00:00:00", AS_OF, False),
        ("1800-01-01 00:00:00", AS_OF, False),
        (None, AS_OF, False),
        ("2025-12-31 00:00:00", dt.date(2027, 1, 1), True),
        ("2026-01-01 00:00:00", dt.date(2027, 1, 1), False),
    ],
)
def test_date_rule(spark, value, as_of, kept):
    rows = spark.createDataFrame([("1", value, "i", "l", "d")], LOGINS.raw_schema)
    assert clean(stage(rows, LOGINS), LOGINS, as_of).count() == kept


def test_default_as_of_is_today(spark):
    today = dt.datetime.now().replace(hour=0, minute=0, second=0, microsecond=0)
    days = [(1, today + dt.timedelta(days=n), "i", "l", "d") for n in (-2, 2)]
    rows = spark.createDataFrame(days, LOGINS.typed_schema)
    horizon = Horizon(dt.date(2023, 1, 1), dt.date(2100, 1, 1))
    assert clean(rows, LOGINS, horizon=horizon).count() == 1


@pytest.mark.parametrize(
    "birthday, kept",
    [("1919-12-31", 0), ("1920-01-01", 1), ("2010-01-01", 1), ("2010-01-02", 0), (None, 0)],
)
def test_birthday_rule(spark, birthday, kept):
    rows = stage(spark.createDataFrame([client("1", birthday=birthday)], CLIENTS.raw_schema), CLIENTS)
    assert clean(rows, CLIENTS, AS_OF).count() == kept


def test_birthday_before_today(spark):
    rows = stage(spark.createDataFrame([client("1", birthday="2000-05-05")], CLIENTS.raw_schema), CLIENTS)
    assert clean(rows, CLIENTS, dt.date(2000, 5, 5)).count() == 0


def test_only_logins_need_a_client(spark):
    at = dt.datetime(2025, 1, 1)
    logins = spark.createDataFrame([(None, at, "i", "l", "d")], LOGINS.typed_schema)
    tx = spark.createDataFrame([(None, 1, at, "t", "a", "USD", Decimal(1))], TRANSACTIONS.typed_schema)
    assert clean(logins, LOGINS, AS_OF).count() == 0
    assert clean(tx, TRANSACTIONS, AS_OF).count() == 1


def test_date_filters_reach_the_scan(spark, sf_dir):
    from riskmart.sources.bench_tables import BOUNDS, WIDE, table

    horizon, as_of = BOUNDS["transactions"]
    plan = explain(clean(table(spark, sf_dir, "transactions"), WIDE["transactions"], as_of, horizon))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def explain(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_month_partitions_are_pruned(spark, tmp_path):
    days = [dt.datetime(2024, m, d) for m in range(1, 13) for d in (1, 28)]
    rows = [(1, i, day, "t", "a", "USD", Decimal(i)) for i, day in enumerate(days)]
    path = str(tmp_path / "tx")
    write_months(spark.createDataFrame(rows, TRANSACTIONS.typed_schema), TRANSACTIONS, path)
    stored = read_clean(spark, TRANSACTIONS, path)
    assert {r["ym"] for r in stored.select("ym").distinct().collect()} == {f"2024-{m:02d}" for m in range(1, 13)}
    part = date_range(stored, TRANSACTIONS, dt.date(2024, 3, 2), dt.date(2024, 5, 1))
    assert sorted(r["transaction_date"] for r in part.collect()) == [
        dt.datetime(2024, 3, 28), dt.datetime(2024, 4, 1), dt.datetime(2024, 4, 28)
    ]
    assert "PartitionFilters: [isnotnull(ym" in explain(part)
    months = {f.split("ym=")[1][:7] for f in part.select(F.input_file_name().alias("f")).toPandas()["f"]}
    assert months == {"2024-03", "2024-04"}


def test_text_of_every_type(spark):
    rows = spark.createDataFrame(
        [(1, dt.date(2000, 1, 2), dt.datetime(2000, 1, 2, 3, 4, 5), Decimal("1.50"))],
        "client_id int, d date, t timestamp_ntz, m decimal(15,2)",
    )
    assert tuple(as_text(rows, ["client_id"]).first()) == ("1.0", "2000-01-02", "2000-01-02 03:04:05", "1.50")


def test_kafka_options():
    log = KafkaLog("broker:9092", min_partitions=64)
    read, write = log.read_options("logins"), log.write_options("logins")
    assert read["subscribe"] == write["topic"] == "raw_logins"
    assert read["startingOffsets"] == "earliest" and read["failOnDataLoss"] == "false"
    assert read["minPartitions"] == "64"
    assert (write["kafka.acks"], write["kafka.retries"], write["kafka.compression.type"]) == ("1", "3", "gzip")
