"""Versioned folders, and layers that take in what is new."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskmart import CLIENTS, TRANSACTIONS
from riskmart.operators.cleaning import Horizon, clean
from riskmart.plans import daily, incremental
from riskmart.plans.daily import DailyConfig, run_daily
from riskmart.sinks import serving, tables
from riskmart.sinks.versions import CommitLog, VersionedFolder, exists
from riskmart.sources.messages import FileLog, send, to_messages
from riskmart.specs import MONTH

HORIZON = Horizon(dt.date(2024, 1, 1), dt.date(2026, 1, 1))


def numbers(spark, n):
    return spark.range(n)


def test_a_folder_is_switched_as_a_whole(spark, tmp_path):
    folder = VersionedFolder(str(tmp_path / "f"))
    with pytest.raises(FileNotFoundError):
        folder.read(spark)
    folder.replace(spark, lambda path: numbers(spark, 3).write.parquet(path))
    failing = numbers(spark, 9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        folder.replace(spark, lambda path: failing.repartition(4).write.parquet(path))
    assert folder.read(spark).count() == 3
    # New rows may come from the old ones.
    folder.replace(spark, lambda path: folder.read(spark).union(numbers(spark, 2)).write.parquet(path))
    assert folder.read(spark).count() == 5
    folder.append(spark, lambda path: numbers(spark, 4).write.parquet(path))
    assert folder.read(spark).count() == 9 and len(folder.folders(spark)) == 2


def test_expiry_keeps_what_the_last_commits_name(spark, tmp_path):
    folder = VersionedFolder(str(tmp_path / "f"))
    paths = [folder.replace(spark, lambda path, n=n: numbers(spark, n).write.parquet(path)) for n in range(1, 5)]
    numbers(spark, 1).write.parquet(f"{folder.path}/v-left-over")
    folder.expire(spark, keep=2)
    assert [exists(spark, p) for p in paths] == [False, False, True, True]
    assert not exists(spark, f"{folder.path}/v-left-over")
    assert folder.read(spark).count() == 4 and len(folder.log.records(spark)) == 2
    folder.replace(spark, lambda path: numbers(spark, 7).write.parquet(path))
    assert folder.read(spark).count() == 7


def test_a_half_written_record_counts_for_nothing(spark, tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    assert log.last(spark) is None
    for k in range(4):
        log.add(spark, {"k": k}, keep=2)
    (tmp_path / "log" / "seq=9" / "_temporary").mkdir(parents=True)
    (tmp_path / "log" / "seq=9" / "_temporary" / "part-0.json").write_text('{"record": "{}"}')
    assert [r for _, r in log.records(spark)] == [{"k": 2}, {"k": 3}]


def test_a_table_name_is_switched(spark, tmp_path):
    for n in (2, 4):
        tables.rebuild_table(spark, "switched", numbers(spark, n), str(tmp_path / "t"))
        assert spark.table("switched").count() == n
    with pytest.raises(PySparkException):
        tables.rebuild_table(spark, "switched", numbers(spark, 3).select(F.raise_error(F.lit("no")).cast("long").alias("id")), str(tmp_path / "t"))
    assert spark.table("switched").count() == 4
    tables.rebuild_table(spark, "switched", numbers(spark, 1).withColumn("more", F.lit("x")), str(tmp_path / "t"))
    assert spark.table("switched").columns == ["id", "more"]
    spark.sql("DROP TABLE switched")


def test_a_served_name_follows_the_last_publication(spark, tmp_path):
    from test_streaming_and_sinks import BARE, FULL, MART

    target = serving.VersionedTarget(str(tmp_path / "s"), "served_mart")
    mart = spark.createDataFrame([FULL, BARE], MART)
    for rows in (mart, mart.limit(1), mart):
        assert serving.publish(rows, target)
        assert spark.table("served_mart").count() == target.read(spark).count() == rows.count()
    assert not serving.publish(mart.limit(0), target) and spark.table("served_mart").count() == 2
    spark.sql("DROP TABLE served_mart")
    plain = serving.VersionedTarget(str(tmp_path / "p"))
    for n in (1, 2):
        serving.publish(mart, plain, "append")
        assert plain.read(spark).count() == 2 * n


def payment(k, day, client=1):
    return (client, k, dt.datetime.combine(day, dt.time(1)), "deposit", "A", "USD", Decimal(k))


class Layers:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.log = CommitLog(f"{root}/marks")

    def drop(self, rows, name):
        raw = self.spark.createDataFrame(rows, TRANSACTIONS.typed_schema)
        raw.select(*(F.col(c).cast("string") for c in TRANSACTIONS.columns)).coalesce(1).write.mode("append").parquet(f"{self.root}/raw")

    def stage(self, on_bad="error"):
        incremental.stage_increment(self.spark, TRANSACTIONS, f"{self.root}/raw", f"{self.root}/ods", f"{self.root}/check", on_bad)

    def clean(self, as_of, horizon=HORIZON):
        return incremental.clean_increment(self.spark, TRANSACTIONS, f"{self.root}/ods", f"{self.root}/dds", self.log, as_of, horizon)

    def rows(self):
        return sorted(r[0] for r in tables.read_clean(self.spark, TRANSACTIONS, f"{self.root}/dds").select("transaction_id").collect())

    def files(self):
        found = tables.read_clean(self.spark, TRANSACTIONS, f"{self.root}/dds").select(MONTH, F.col("_metadata.file_path").alias("f")).distinct()
        out = {}
        for r in found.collect():
            out.setdefault(r[MONTH], set()).add(r["f"])
        return out

    def full(self, as_of, horizon=HORIZON):
        staged = self.spark.read.schema(incremental.staged_schema(TRANSACTIONS)).parquet(f"{self.root}/ods")
        return sorted(r[0] for r in clean(staged, TRANSACTIONS, as_of, horizon).select("transaction_id").collect())


def test_only_changed_months_are_written(spark, tmp_path):
    layers, day = Layers(spark, tmp_path), dt.date
    layers.drop([payment(1, day(2024, 1, 5)), payment(2, day(2024, 2, 5)), payment(3, day(2024, 5, 20)), payment(4, day(1700, 1, 1))], "a")
    layers.stage()
    assert layers.clean(day(2024, 5, 10)) is None  # the first time: all of them
    assert layers.rows() == [1, 2]
    before = layers.files()
    layers.drop([payment(5, day(2024, 2, 9)), payment(6, day(2100, 1, 1)), payment(7, day(2024, 3, 1))], "b")
    layers.stage()
    assert layers.clean(day(2024, 5, 10)) == ["2024-02", "2024-03"]
    after = layers.files()
    assert layers.rows() == [1, 2, 5, 7] == layers.full(day(2024, 5, 10))
    assert after["2024-01"] == before["2024-01"] and not after["2024-02"] & before["2024-02"]
    # Nothing new: nothing is written.
    layers.stage()
    assert layers.clean(day(2024, 5, 10)) == [] and layers.files() == after
    # A later day lets in rows that were staged long ago.
    assert layers.clean(day(2024, 6, 2)) == ["2024-05", "2024-06"]
    assert layers.rows() == [1, 2, 3, 5, 7] and layers.files()["2024-01"] == before["2024-01"]
    # An earlier day, and other bounds, make the layer anew.
    assert layers.clean(day(2024, 2, 6)) is None and layers.rows() == [1, 2] == layers.full(day(2024, 2, 6))
    later = Horizon(day(2024, 2, 1), day(2026, 1, 1))
    assert layers.clean(day(2024, 6, 2), later) is None and layers.rows() == [2, 3, 5, 7]


def test_a_failed_batch_lands_once(spark, tmp_path):
    layers = Layers(spark, tmp_path)
    layers.drop([payment(1, dt.date(2024, 1, 5)), payment(2, dt.date(2024, 2, 5))], "a")
    bad = spark.createDataFrame([("x", "9", "2024-01-01 00:00:00", "t", "a", "USD", "1")], TRANSACTIONS.raw_schema)
    bad.write.mode("append").parquet(f"{tmp_path}/raw")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        layers.stage()
    for _ in range(2):
        layers.stage("null")
        layers.clean(dt.date(2024, 5, 1))
        assert layers.rows() == [1, 2, 9]


def test_a_clean_run_that_is_repeated_writes_the_same(spark, tmp_path, monkeypatch):
    layers = Layers(spark, tmp_path)
    for k, month in enumerate((1, 2)):
        layers.drop([payment(k, dt.date(2024, month, 5))], str(k))
        layers.stage()
        if k:  # the run ends before its mark is set
            with monkeypatch.context() as patch:
                patch.setattr(CommitLog, "add", lambda *_: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError, match="lost"):
                    layers.clean(dt.date(2024, 5, 1))
        layers.clean(dt.date(2024, 5, 1))
    assert layers.rows() == [0, 1]


def test_months_between():
    assert incremental.months_between(dt.date(2023, 11, 30), dt.date(2024, 2, 1)) == ["2023-11", "2023-12", "2024-01", "2024-02"]


def drops(spark, log, part):
    """Two drops; the second brings late rows, a client's other spelling, and copies."""
    at = [dt.datetime(2025, m, 3, 4, 5, 6) for m in (1, 2, 4)][: part + 2]
    rows = {
        "activity": [(1, t, "login", "/", "ip", "d") for t in at],
        "clients": [(1, "AB"[part], "B", "e", "p", "a", dt.date(1990, 1, 1)), (2 + part, "C", "D", "e", "p", "a", dt.date(1990, 1, 1))],
        "logins": [(1, t, "ip", "1, 2", "d") for t in at * 6],
        "payments": [(1, 5, t, "USD", Decimal("1.50"), "card") for t in at],
        "transactions": [(1, 6, t, "deposit", "acc", "USD", Decimal(1 + 99 * part)) for t in at for _ in range(4 - 3 * part)],
    }
    from riskmart import SPECS

    for name, values in rows.items():
        send(to_messages(spark.createDataFrame(values, SPECS[name].typed_schema)), log, name)


def test_incremental_runs_equal_a_full_refresh(spark, tmp_path):
    log, as_of = FileLog(str(tmp_path / "log")), dt.date(2025, 6, 15)
    grown = DailyConfig(log, str(tmp_path / "grown"), serving.VersionedTarget(str(tmp_path / "s1")), as_of, HORIZON, incremental=True, catalog="g_")
    whole = DailyConfig(log, str(tmp_path / "whole"), serving.VersionedTarget(str(tmp_path / "s2")), as_of, HORIZON)
    for part in (0, 1):
        drops(spark, log, part)
        run_daily(spark, grown)
    run_daily(spark, whole)
    for name, spec in grown.specs().items():
        a, b = (daily.clean_layer(spark, c, name).select(*spec.columns) for c in (grown, whole))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()
        assert spark.table(f"g_dds_{name}").count() == a.count()
        if spec.has_event_time:
            want = {r[MONTH]: r["count"] for r in spark.table(f"g_dds_{name}").groupBy(MONTH).count().collect()}
            assert tables.partition_rows(spark, f"g_dds_{name}", MONTH) == want
        spark.sql(f"DROP TABLE g_ods_{name}")
        spark.sql(f"DROP TABLE g_dds_{name}")
    assert spark.table("g_dm_fraud_dashboard").count() == 3
    spark.sql("DROP TABLE g_dm_fraud_dashboard")
    first, second = (sorted(map(tuple, c.target.read(spark).collect())) for c in (grown, whole))
    assert first == second and len(first) == 3


def test_clients_of_several_batches_keep_the_smallest_row(spark, tmp_path):
    for names in (["Z", "Y"], ["A", "X"]):
        rows = [(str(k), n, "B", "e", "p", "a", "1990-01-01") for k, n in enumerate(names)]
        spark.createDataFrame(rows, CLIENTS.raw_schema).write.mode("append").parquet(f"{tmp_path}/raw")
        incremental.stage_increment(spark, CLIENTS, f"{tmp_path}/raw", f"{tmp_path}/ods", f"{tmp_path}/check")
    got = incremental.read_staged(spark, CLIENTS, f"{tmp_path}/ods").collect()
    assert {r["client_id"]: r["client_first_name"] for r in got} == {0: "A", 1: "X"}


def test_a_failed_mart_leaves_the_old_one(spark, tmp_path, monkeypatch):
    log, as_of = FileLog(str(tmp_path / "log")), dt.date(2025, 6, 15)
    config = DailyConfig(log, str(tmp_path / "root"), serving.VersionedTarget(str(tmp_path / "s")), as_of, HORIZON)
    drops(spark, log, 0)
    run_daily(spark, config)
    before = sorted(map(tuple, config.folder("dm", "fraud_dashboard").read(spark).collect()))
    drops(spark, log, 1)
    broken = daily.fraud_dashboard

    def failing(**frames):
        mart = broken(**frames)
        return mart.withColumn("first_name", F.when(F.col("client_id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("first_name")))

    monkeypatch.setattr(daily, "fraud_dashboard", failing)
    with pytest.raises(PySparkException):
        run_daily(spark, config)
    assert sorted(map(tuple, config.folder("dm", "fraud_dashboard").read(spark).collect())) == before
    assert config.target.read(spark).count() == len(before)
    monkeypatch.setattr(daily, "fraud_dashboard", broken)
    run_daily(spark, config)
    assert config.target.read(spark).count() == 3


def test_only_written_months_are_counted_again(spark, tmp_path, monkeypatch):
    """A second run analyzes the months it wrote; a plan over the table has its row count."""
    layers, analyzed = Layers(spark, tmp_path), []
    real = tables.analyze_partitions
    monkeypatch.setattr(daily, "analyze_partitions", lambda s, t, c, v: (analyzed.append(list(v)), real(s, t, c, analyzed[-1]))[1])
    config = DailyConfig(FileLog("none"), str(tmp_path), serving.VersionedTarget("none"), incremental=True)
    monkeypatch.setattr(daily, "SPECS", {"transactions": TRANSACTIONS})
    monkeypatch.setattr(daily, "replace_raw_view", lambda *_: None)
    config.folder("dm", "fraud_dashboard").replace(spark, lambda path: spark.range(1).write.parquet(path))
    ods, dds = f"{tmp_path}/ods/transactions", f"{tmp_path}/dds/transactions"
    for rows in ([payment(1, dt.date(2024, 1, 5)), payment(2, dt.date(2024, 2, 5))], [payment(3, dt.date(2024, 2, 6))]):
        layers.drop(rows, "x")
        incremental.stage_increment(spark, TRANSACTIONS, f"{tmp_path}/raw", ods, f"{tmp_path}/check")
        months = incremental.clean_increment(spark, TRANSACTIONS, ods, dds, layers.log, dt.date(2024, 5, 1), HORIZON)
        daily.register_layers(spark, config, "g_", months={"transactions": months})
    assert analyzed == [["2024-01", "2024-02"], ["2024-02"]]
    assert tables.partition_rows(spark, "g_dds_transactions", MONTH) == {"2024-01": 1, "2024-02": 2}
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        assert spark.table("g_dds_transactions")._jdf.queryExecution().optimizedPlan().stats().rowCount().get() == 3
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
        for table in ("g_ods_transactions", "g_dds_transactions", "g_dm_fraud_dashboard"):
            spark.sql(f"DROP TABLE {table}")
