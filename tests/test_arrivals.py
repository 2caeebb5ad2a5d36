"""The raw lake by day of arrival, and its compaction."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart import ACTIVITY
from riskmart.operators.staging import stage
from riskmart.sources.messages import to_messages
from riskmart.streaming.arrivals import ARRIVAL, ArrivalLake

DAYS = [dt.date(2025, 6, d) for d in (1, 2, 3)]


def drop(spark, log, first, n, days=DAYS):
    """Messages `first` to `first + n`, dealt over the days; every seventh has a null."""
    rows = [(str(k % 5), "2025-01-01 00:00:00", None if k % 7 == 0 else "login", "/a", f"ip{k}", "d") for k in range(first, first + n)]
    messages = to_messages(spark.createDataFrame(rows, ACTIVITY.raw_schema))
    number = F.regexp_extract("value", r"ip(\d+)", 1).cast("int")
    stamps = F.array(*(F.lit(f"{d} 12:00:00").cast("timestamp") for d in days))
    messages.withColumn("timestamp", F.get(stamps, number % len(days))).coalesce(1).write.mode("append").parquet(log)


def drain(spark, lake, log, marks):
    reader = spark.readStream.schema("key string, value string, timestamp timestamp").option("maxFilesPerTrigger", 1)
    lake.start(reader.parquet(log), marks).awaitTermination()


def expected(n, days=DAYS):
    return Counter((f"ip{k}", str(days[k % len(days)])) for k in range(n) if k % 7)


def seen(rows):
    return Counter((r["ip_address"], r[ARRIVAL]) for r in rows.collect())


@pytest.fixture
def places(tmp_path):
    return ArrivalLake(str(tmp_path / "lake"), ACTIVITY), str(tmp_path / "log"), str(tmp_path / "marks")


def files(rows):
    return {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}


def test_rows_are_the_same_before_and_after_compaction(spark, places):
    lake, log, marks = places
    for k in range(4):
        drop(spark, log, k * 30, 30)
    drain(spark, lake, log, marks)
    before = lake.read(spark)
    assert seen(before) == expected(120) and len(files(before)) == 12
    assert lake.compact(spark, DAYS[2]) == [str(d) for d in DAYS[:2]]
    after = lake.read(spark)
    assert seen(after) == expected(120) and len(files(after)) == 2 + 4
    assert lake.compact(spark, DAYS[2]) == []
    assert lake.expire(spark) == 8 and seen(lake.read(spark)) == expected(120)
    assert stage(lake.read(spark).drop(ARRIVAL), ACTIVITY).count() == sum(expected(120).values())


def test_one_day_lists_that_day_only(spark, places):
    lake, log, marks = places
    drop(spark, log, 0, 60)
    drain(spark, lake, log, marks)
    for _ in range(2):
        rows = lake.read(spark, DAYS[1], DAYS[1])
        assert rows.inputFiles() and all(f"{ARRIVAL}={DAYS[1]}" in f for f in rows.inputFiles())
        assert seen(rows) == Counter({k: n for k, n in expected(60).items() if k[1] == str(DAYS[1])})
        lake.compact(spark, dt.date(2025, 7, 1))
    assert seen(lake.read(spark, first=DAYS[1])) == Counter({k: n for k, n in expected(60).items() if k[1] >= str(DAYS[1])})
    assert lake.read(spark, dt.date(2026, 1, 1)).isEmpty()


def test_late_batches_join_a_compacted_day(spark, places):
    lake, log, marks = places
    drop(spark, log, 0, 30)
    drain(spark, lake, log, marks)
    lake.compact(spark, dt.date(2025, 7, 1))
    drop(spark, log, 30, 30)
    drain(spark, lake, log, marks)
    assert seen(lake.read(spark)) == expected(60)
    assert len(lake.compact(spark, dt.date(2025, 7, 1))) == 3
    assert lake.expire(spark) == 3 * 3 and seen(lake.read(spark)) == expected(60) and len(files(lake.read(spark))) == 3


def test_a_failed_compaction_changes_nothing(spark, places, monkeypatch):
    lake, log, marks = places
    drop(spark, log, 0, 30)
    drain(spark, lake, log, marks)

    def lost(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError, match="lost"):
        patch.setattr("riskmart.sinks.versions.CommitLog.add", lost)
        lake.compact(spark, dt.date(2025, 7, 1))
    assert seen(lake.read(spark)) == expected(30)
    assert lake.expire(spark) == 3 and seen(lake.read(spark)) == expected(30)
    assert len(lake.compact(spark, dt.date(2025, 7, 1))) == 3 and seen(lake.read(spark)) == expected(30)


def test_a_batch_that_is_run_again_lands_once(spark, places, monkeypatch):
    lake, log, marks = places
    drop(spark, log, 0, 30)
    drop(spark, log, 30, 30)

    def written_then_lost(self, rows: DataFrame, batch: int, write=ArrivalLake.land):
        write(self, rows, batch)
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(StreamingQueryException, match="lost"):
        patch.setattr(ArrivalLake, "land", written_then_lost)
        drain(spark, lake, log, marks)
    lake.compact(spark, dt.date(2025, 7, 1))  # takes the batch that does not count as done yet
    drain(spark, lake, log, marks)
    assert seen(lake.read(spark)) == expected(60)


def test_without_timestamps_rows_arrive_on_the_day_of_their_batch(spark, places):
    lake, log, marks = places
    assert lake.read(spark).isEmpty() and lake.compact(spark, DAYS[0]) == [] and lake.expire(spark) == 0
    rows = spark.createDataFrame([("1", "2025-01-01 00:00:00", "login", "/a", "ip1", "d")], ACTIVITY.raw_schema)
    to_messages(rows).write.parquet(log)
    lake.start(spark.readStream.schema("key string, value string").parquet(log), marks).awaitTermination()
    today = spark.sql("SELECT current_date()").first()[0]
    (day,) = lake.days(spark)
    assert (today - dt.date.fromisoformat(day)).days in (0, 1) and lake.read(spark).count() == 1
