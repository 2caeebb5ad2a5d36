import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException

from riskmart import ACTIVITY, SPECS, TRANSACTIONS
from riskmart.operators import defects
from riskmart.operators.parsing import ingest_rows
from riskmart.plans.daily import DailyConfig, run_daily
from riskmart.session import work_dir
from riskmart.sinks import serving, tables
from riskmart.sources.bench_tables import BOUNDS, WIDE, row_id, table
from riskmart.sources.messages import FileLog, send, to_messages
from riskmart.sources.raw import raw_path, raw_scan, replace_raw_view
from riskmart.streaming.ingest import ingest_all, start_ingest


def activity(n, client="1.0"):
    return [(client, "2025-01-01 00:00:00", "login", "/a", f"ip{i}", "d") for i in range(n)]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_ingest_takes_new_messages_only(spark, tmp_path, fmt):
    log, lake = FileLog(str(tmp_path / "log"), fmt), str(tmp_path / "raw")
    counts = []
    for drop in (activity(3) + activity(1, None), activity(2, "2.0"), None):
        if drop:
            rows = spark.createDataFrame(drop, ACTIVITY.raw_schema)
            assert send(to_messages(rows), log, "activity") == len(drop)
        report = ingest_all(spark, log, [ACTIVITY], lake)["activity"]
        landed = raw_scan(spark, ACTIVITY, raw_path(lake, ACTIVITY)).count()
        counts.append((report.messages_read, report.rows_landed, landed))
    assert counts == [(4, 3, 3), (2, 2, 5), (0, 0, 5)]


def test_many_batches_add_up(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"), max_files_per_trigger=1)
    for n in (1, 2, 3):
        send(to_messages(spark.createDataFrame(activity(n), ACTIVITY.raw_schema).coalesce(1)), log, "activity")
    report = ingest_all(spark, log, [ACTIVITY], str(tmp_path / "raw"))["activity"]
    assert (report.messages_read, report.rows_landed) == (6, 6)


def test_stream_equals_batch(spark, tmp_path, sf_dir):
    spec = WIDE["logins"]
    holey = defects.inject_nulls(table(spark, sf_dir, "logins"), row_id("logins"), 0.05)
    log, lake = FileLog(str(tmp_path / "log")), str(tmp_path / "raw")
    send(to_messages(holey), log, "logins")
    ingest_all(spark, log, [spec], lake)
    streamed = raw_scan(spark, spec, raw_path(lake, spec))
    batch = ingest_rows(log.batch(spark, "logins"), spec)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert 0 < batch.count() < holey.count()


def test_raw_view_is_replaced(spark, tmp_path):
    for n in (1, 2):
        path = str(tmp_path / str(n))
        spark.createDataFrame(activity(n), ACTIVITY.raw_schema).write.parquet(path)
        view = replace_raw_view(spark, ACTIVITY, path)
        assert view == "raw_activity" and spark.table(view).count() == n
    start_checks = spark.table(view).schema
    assert start_checks == ACTIVITY.raw_schema


def test_failed_stream_is_reported(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"))
    send(to_messages(spark.createDataFrame(activity(1), ACTIVITY.raw_schema)), log, "activity")
    wrong = log.stream(spark, "activity").drop("value")
    with pytest.raises(AnalysisException):
        start_ingest(wrong, ACTIVITY, str(tmp_path / "raw"), str(tmp_path / "cp"))


def transactions(spark, n, month=1):
    rows = [(1, i, dt.datetime(2024, month, 2), "deposit", "A", "USD", Decimal(i)) for i in range(n)]
    return spark.createDataFrame(rows, TRANSACTIONS.typed_schema)


def test_refresh_replaces_all_partitions(spark, tmp_path):
    from riskmart.operators.cleaning import with_month

    args = (TRANSACTIONS.clean_schema, str(tmp_path / "t"), "ym")
    tables.ensure_table(spark, "tx_clean", *args)
    tables.ensure_table(spark, "tx_clean", *args)
    for n, month in ((5, 1), (3, 2)):
        tables.refresh_table(spark, "tx_clean", with_month(transactions(spark, n, month), TRANSACTIONS))
        assert spark.table("tx_clean").count() == n
    tables.analyze_table(spark, "tx_clean")
    assert "rows" in str(spark.sql("DESCRIBE EXTENDED tx_clean").where("col_name = 'Statistics'").collect())
    spark.sql("DROP TABLE tx_clean")


def test_rebuild_table(spark, tmp_path):
    for n in (2, 4):
        tables.rebuild_table(spark, "tx_mart", transactions(spark, n), str(tmp_path / "m"))
        assert spark.table("tx_mart").count() == n
    spark.sql("DROP TABLE tx_mart")


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    for name in ("left_b", "right_b"):
        tables.write_bucketed(transactions(spark, 9), name, str(tmp_path / name), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_b").join(spark.table("right_b"), "client_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE left_b")
        spark.sql("DROP TABLE right_b")


def test_distribute_asks_for_a_rebalance(spark):
    plan = tables.distribute(transactions(spark, 3), "client_id")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


MART = (
    "client_id long, first_name string, last_name string, total_transactions long, "
    "avg_transaction_amount decimal(38,2), max_transaction_amount decimal(15,2), "
    "suspicious_transaction_count long, login_count long, financial_risk boolean, "
    "activity_risk boolean, risk_score int"
)
FULL = (1, "A", "B", 5, Decimal("20.80"), Decimal("100.00"), 1, 12, True, False, 3)
BARE = (2, "C", "D", None, None, None, None, None, None, None, 0)


def test_serving_types_and_null_policies(spark):
    mart = spark.createDataFrame([FULL, BARE], MART)
    out = serving.serving_frame(mart)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in serving.SERVING_SCHEMA]
    rows = {r["client_id"]: tuple(r) for r in out.collect()}
    assert rows[1][8:10] == (1, 0)
    assert rows[2][3:] == (0, 0, 0, 0, 0, 0, 0, 0)
    kept = serving.serving_frame(mart, "keep").where("client_id = 2").first()
    assert tuple(kept)[3:10] == (None,) * 7
    with pytest.raises(Exception, match="does not take NULL"):
        serving.serving_frame(mart, "fail").collect()
    with pytest.raises(ValueError):
        serving.serving_frame(mart, "skip")


def test_publish_modes_and_empty_mart(spark, tmp_path):
    target = serving.ParquetTarget(str(tmp_path / "serving"))
    mart = spark.createDataFrame([FULL, BARE], MART)
    assert not serving.publish(mart.limit(0), target)
    assert not (tmp_path / "serving").exists()
    for mode, rows in (("append", 2), ("append", 4), ("overwrite", 2)):
        assert serving.publish(mart, target, mode)
        assert spark.read.parquet(target.path).count() == rows
    with pytest.raises(ValueError):
        serving.publish(mart, target, "ignore")


def test_jdbc_options():
    target = serving.JdbcTarget("jdbc:x", "t", create_options="ENGINE = MergeTree() ORDER BY client_id")
    options = target.options()
    assert options["createTableOptions"].endswith("ORDER BY client_id") and options["truncate"] == "true"
    assert target.read_options(1, 9)["partitionColumn"] == "client_id"


def test_work_dir_follows_the_session(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_work_dir_without_the_setting():
    class Session:
        def __init__(self, master):
            self.sparkContext = type("Context", (), {"master": master})
            self.conf = {}

    first, second = (work_dir(Session("local[2]"), "x") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    with pytest.raises(ValueError, match="share"):
        work_dir(Session("yarn"), "x")


def test_second_daily_run_adds_to_the_lake(spark, tmp_path, sf_dir):
    """The lake accumulates; staging, clean layer and mart are refreshed; publish replaces."""
    log, target = FileLog(str(tmp_path / "log")), serving.ParquetTarget(str(tmp_path / "serving"))
    config = DailyConfig(log, str(tmp_path), target, bounds=BOUNDS, wide_ids=True)
    clients = None
    for run in (1, 2):
        for name, spec in WIDE.items():
            send(to_messages(table(spark, sf_dir, name), as_floats=spec.of_kind("id")), log, name)
        reports = run_daily(spark, config)
        assert set(reports) == set(SPECS)
        mart = spark.read.parquet(target.path)
        totals = mart.selectExpr("count(*) AS n", "sum(total_transactions) AS tx").first()
        clients = clients or totals
        assert totals["n"] == clients["n"] and totals["tx"] == run * clients["tx"]


def test_layers_have_sql_names(spark, tmp_path):
    """The daily steps from the command line; then every layer by name, twice, with a month dropped between."""
    from riskmart.__main__ import main, parse
    from riskmart.plans.daily import register_layers

    log = FileLog(str(tmp_path / "log"))
    moment = [dt.datetime(2025, m, 3, 4, 5, 6, 7) for m in (1, 2)]
    rows = {
        "activity": [(1, t, "login", "/", "ip", "d") for t in moment],
        "clients": [(1, "A", "B", "e", "p", "a", dt.date(1990, 1, 1))],
        "logins": [(1, t, "ip", "1, 2", "d") for t in moment * 6],
        "payments": [(1, 5, t, "USD", Decimal("1.50"), "card") for t in moment],
        "transactions": [(1, 6, t, "deposit", "acc", "USD", Decimal("2.50")) for t in moment],
    }
    for name, values in rows.items():
        send(to_messages(spark.createDataFrame(values, SPECS[name].typed_schema)), log, name)
    root = str(tmp_path / "root")
    args = ["--root", root, "--files", log.root, "--as-of", "2025-06-15"]
    for step in ("ingest", "stage", "clean", "mart", "publish"):
        main([step, *args], spark)
    config = DailyConfig(log, root, serving.ParquetTarget(f"{root}/serving"))
    register_layers(spark, config, "t_")
    assert tuple(spark.table("t_dm_fraud_dashboard").first())[:4] == (1, "A", "B", 2)
    assert spark.read.parquet(config.target.path).first()["risk_score"] == 2
    count = "SELECT count(*) AS n FROM t_dds_logins"
    assert spark.sql(count).first()["n"] == 12 == spark.table("t_ods_logins").count()
    main(["clean", *args, "--from", "2025-02-01"], spark)
    register_layers(spark, config, "t_", statistics=False)
    assert spark.sql(count).first()["n"] == 6
    assert [r[0] for r in spark.sql("SHOW PARTITIONS t_dds_logins").collect()] == ["ym=2025-02"]
    assert parse(["daily", *args]).publish_mode == "overwrite"
    for name in SPECS:
        spark.sql(f"DROP TABLE t_ods_{name}")
        spark.sql(f"DROP TABLE t_dds_{name}")
    spark.sql("DROP TABLE t_dm_fraud_dashboard")


def test_jobs_side_by_side(spark):
    from riskmart.session import side_by_side

    assert side_by_side(spark, lambda n: spark.range(n).count(), [3, 1, 2]) == [3, 1, 2]
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda n: 1 // n, [1, 0])


def test_cluster_settings_only_off_local(monkeypatch):
    import riskmart.session as session

    seen = {}

    class Builder:
        def __getattr__(self, name):
            return lambda *args: seen.update([args]) or self if name == "config" else self

    monkeypatch.setattr(session, "SparkSession", type("S", (), {"builder": Builder()}))
    session.build_session(master="local[2]", spark__x="1")
    assert seen["spark.x"] == "1" and "spark.sql.adaptive.advisoryPartitionSizeInBytes" not in seen
    session.build_session()
    assert seen["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "8192"


def test_jdbc_overwrite_never_drops_a_table_unasked(spark):
    rows = spark.range(1)
    with pytest.raises(ValueError, match="create_options"):
        serving.JdbcTarget("jdbc:clickhouse://none/db", "t").write(rows, "overwrite")
    assert serving.JdbcTarget("jdbc:mysql://none/db", "t").keeps_table(spark)
