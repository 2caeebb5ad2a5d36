"""Rejected messages, batch sums by listener, and scheduler pools."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from riskmart import ACTIVITY, LOGINS, TRANSACTIONS
from riskmart.operators.parsing import ingest_rows
from riskmart.sources.messages import FileLog, send, to_messages
from riskmart.streaming import audit, ingest
from riskmart.streaming.ingest import ingest_all, ingest_streams

GOOD = '{"client_id":"1.0","transaction_id":"2","transaction_date":"2024-01-01 00:00:00.5","transaction_type":"t","account_number":"a","currency":"USD","amount":"5.50"%s}'
CASES = {
    GOOD % ',"extra":"z"': None,
    GOOD.replace('"5.50"', "null") % "": "missing amount",
    GOOD.replace('"t"', "null").replace('"a"', "null") % "": "missing transaction_type,account_number",
    GOOD.replace("5.50", "1.2.3").replace('"2"', '"x"') % "": "malformed transaction_id,amount",
    GOOD.replace("2024-01-01 00", "yesterday") % "": "malformed transaction_date",
    GOOD.replace('"1.0"', "null").replace("5.50", "n/a") % "": "missing client_id",
    (GOOD % "")[:60]: "unparsable",
    "garbage": "unparsable",
    "": "unparsable",
    "{}": "missing " + ",".join(TRANSACTIONS.columns),
    None: "no message",
    GOOD % (',"long":"' + "x" * 300_000 + '"'): None,
}


def messages(spark, values):
    return spark.createDataFrame([(str(k), v) for k, v in enumerate(values)], "key string, value string")


def test_each_message_has_one_outcome(spark):
    rows = audit.audited(messages(spark, [*CASES, "garbage"]), TRANSACTIONS).collect()
    assert sorted((r["reject_reason"] or "", r["message_value"] or "") for r in rows if r["reject_reason"]) == sorted(
        (reason, value or "") for value, reason in [*CASES.items(), ("garbage", "unparsable")] if reason
    )
    landed = [r for r in rows if r["reject_reason"] is None]
    assert len(landed) == 2 and all(r["message_key"] is None and r["message_value"] is None for r in landed)


def test_without_type_checks_the_same_rows_land_as_in_a_plain_ingest(spark):
    batch = messages(spark, list(CASES))
    checked = audit.audited(batch, TRANSACTIONS, check_types=False).where("reject_reason IS NULL").select(*TRANSACTIONS.columns)
    plain = ingest_rows(batch, TRANSACTIONS)
    assert checked.exceptAll(plain).isEmpty() and plain.exceptAll(checked).isEmpty() and plain.count() == 4


def test_the_text_is_parsed_once(spark):
    plan = audit.audited(messages(spark, ["x"]), TRANSACTIONS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_received_is_landed_plus_rejected(spark, tmp_path, monkeypatch):
    log = FileLog(str(tmp_path / "log"), max_files_per_trigger=1)
    path, marks = str(tmp_path / "raw"), str(tmp_path / "marks")
    sent = 0
    for n in (2, 3):
        for _ in range(n):
            sent += send(messages(spark, list(CASES)).coalesce(1), log, "transactions")

        def start():
            audit.start_audited_ingest(log.stream(spark, "transactions"), TRANSACTIONS, path, marks).awaitTermination()

        if n == 3:  # a batch is written, but the run ends before it counts as done

            def written_then_lost(*args, write=audit.write_batch):
                write(*args)
                raise OSError("lost")

            with monkeypatch.context() as patch, pytest.raises(StreamingQueryException, match="lost"):
                patch.setattr(audit, "write_batch", written_then_lost)
                start()
        start()
    counts = {r["reject_reason"]: r["messages"] for r in audit.audit_counts(spark, TRANSACTIONS, path).collect()}
    assert sum(counts.values()) == sent == 5 * len(CASES)
    assert counts[None] == 10 == audit.landed_rows(spark, TRANSACTIONS, path).count()
    assert counts["unparsable"] == 15
    again = audit.replay(spark, TRANSACTIONS, path, "missing")
    assert again.count() == 20 and again.columns == ["key", "value"]
    assert {r["value"] for r in again.collect()} == {v for v, reason in CASES.items() if reason and reason.startswith("missing")}


def activity(spark, n):
    rows = [("1", "2025-01-01 00:00:00", "login" if i else None, "/a", f"ip{i}", "d") for i in range(n)]
    return spark.createDataFrame(rows, ACTIVITY.raw_schema).coalesce(1)


@pytest.mark.parametrize("retained", [1, 50])
def test_sums_do_not_depend_on_retained_progress(spark, tmp_path, retained):
    log = FileLog(str(tmp_path / "log"), max_files_per_trigger=1)
    for n in range(1, 9):
        send(to_messages(activity(spark, n)), log, "activity")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(retained))
    try:
        report = ingest_all(spark, log, [ACTIVITY], str(tmp_path / "raw"))["activity"]
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (report.messages_read, report.rows_landed) == (36, 28)


def test_the_failure_of_one_table_ends_all(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"))
    for name in ("activity", "logins"):
        send(to_messages(activity(spark, 2)), log, name)
    broken = log.stream(spark, "logins").withColumn("value", F.when(F.length("value") > 0, F.raise_error(F.lit("broken"))))
    with pytest.raises(Exception, match="broken"):
        ingest_streams(spark, [(ACTIVITY, log.stream(spark, "activity")), (LOGINS, broken)], str(tmp_path / "raw"))
    assert not [q for q in spark.streams.active if q.name and q.name.startswith("ingest_")]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_each_query_has_a_pool_of_its_own(spark, tmp_path):
    """The pools that Spark's status store has for the stages of the queries."""
    log = FileLog(str(tmp_path / "log"))
    for name in ("activity", "logins"):
        send(to_messages(activity(spark, 2)), log, name)
    ingest_all(spark, log, [ACTIVITY, LOGINS], str(tmp_path / "raw"))
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    pools = {stages.apply(k).schedulingPool() for k in range(stages.size())}
    assert {"ingest_activity", "ingest_logins"} <= pools


def test_events_that_never_come_are_an_error(spark):
    class Done:
        isActive = False

        def awaitTermination(self):
            return True

    with pytest.raises(RuntimeError, match="events"):
        ingest.finish_all(ingest.BatchSums(), {"x": Done()}, patience=0.01)
