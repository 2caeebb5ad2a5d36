import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskmart import SPECS
from riskmart.functions.draws import MODULUS, constants, draw, selected
from riskmart.operators import defects
from riskmart.operators.cleaning import Horizon, clean
from riskmart.sources.bench_tables import BOUNDS, WIDE, row_id, table

N = 20_000


def by_hand(row_id, seed):
    multiplier, offset = constants(seed)
    base = row_id % MODULUS
    mixed = (base * multiplier + offset) % MODULUS
    mixed = (mixed * mixed + base) % MODULUS
    return (mixed * mixed + offset) % MODULUS


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(N).withColumnRenamed("id", "row")


@pytest.mark.parametrize("seed", [0, 7, 400])
def test_draw_matches_arithmetic(spark, seed):
    values = [0, 1, -5, MODULUS, 2**62, -(2**62)]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", draw(F.col("v"), seed).alias("d"))
    assert {r["v"]: r["d"] for r in rows.collect()} == {v: by_hand(v, seed) for v in values}


def test_rate_and_independence(ids):
    hits = ids.select(*(selected(F.col("row"), s, 0.05).cast("int").alias(f"s{s}") for s in range(4)))
    row = hits.agg(*(F.avg(c).alias(c) for c in hits.columns), F.avg(F.col("s0") * F.col("s1")).alias("both")).first()
    assert all(abs(row[f"s{s}"] - 0.05) < 0.006 for s in range(4))
    assert abs(row["both"] - 0.0025) < 0.0015


def test_null_id_is_never_selected(spark):
    rows = spark.createDataFrame([(None, "a")], "id bigint, v string")
    out = defects.inject_duplicates(defects.inject_nulls(rows, F.col("id"), 1.0), F.col("id"), 1.0)
    assert [tuple(r) for r in out.collect()] == [(None, "a")]


def test_nulls_only_in_named_columns(ids):
    rows = ids.select("row", F.lit("x").alias("a"), F.lit("y").alias("b"))
    out = defects.inject_nulls(rows, F.col("row"), 0.1, seed=3, columns=["a"])
    want = rows.where(selected(F.col("row"), 3, 0.1)).count()
    assert out.where(F.col("a").isNull()).count() == want > 0
    assert out.where(F.col("b").isNull() | F.col("row").isNull()).isEmpty()


def test_duplicates_add_exactly_the_drawn_copies(ids):
    out = defects.inject_duplicates(ids, F.col("row"), 0.05, copy_column="copy")
    assert out.where("copy = 0").count() == N
    copies = out.where("copy > 0").count()
    assert abs(copies / N - 0.05) < 0.006
    assert out.agg(F.max("copy")).first()[0] >= 2


@pytest.mark.parametrize("at_least_one, want", [(True, 3), (False, 2)])
def test_at_least_one_copy(spark, at_least_one, want):
    rows = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert defects.inject_duplicates(rows, F.col("id"), 0.0, at_least_one=at_least_one).count() == want


def test_outliers_scale_amounts(ids):
    rows = ids.withColumn("amount", F.lit(Decimal("12.34")).cast("decimal(15,2)"))
    out = defects.inject_outliers(rows, F.col("row"))
    assert out.dtypes == rows.dtypes
    counts = {r["amount"]: r["count"] for r in out.groupBy("amount").count().collect()}
    assert set(counts) == {Decimal("12.34"), Decimal("123.40")}
    assert abs(counts[Decimal("123.40")] / N - 0.01) < 0.003


def test_bursts(spark, sf_dir):
    horizon = Horizon(dt.date(2024, 1, 1), dt.date(2024, 3, 1))
    clients = table(spark, sf_dir, "clients")
    rows = defects.burst_rows(clients, horizon).collect()
    assert len(rows) == 80 and len({r["client_id"] for r in rows}) == 4
    assert len({(r["client_id"], r["transaction_date"]) for r in rows}) == 8
    for r in rows:
        assert dt.datetime(2024, 1, 1) <= r["transaction_date"] < dt.datetime(2024, 3, 1)
        assert Decimal(100) <= r["amount"] <= Decimal(10000) and 1000 <= r["transaction_id"] < 10000


def test_burst_field_disappears_at_parse(spark, sf_dir):
    from riskmart.operators.parsing import parse_json
    from riskmart.sources.messages import to_messages

    tx = table(spark, sf_dir, "transactions")
    horizon = BOUNDS["transactions"][0]
    out = defects.inject_bursts(tx, table(spark, sf_dir, "clients"), horizon, saved_at=dt.datetime(2024, 1, 1))
    assert out.where("record_saved_at IS NOT NULL").count() == 80
    assert parse_json(to_messages(out), WIDE["transactions"].raw_schema).columns == tx.columns


def test_cleaning_removes_every_injected_date(spark, sf_dir):
    name, (horizon, as_of) = "transactions", BOUNDS["transactions"]
    rows = table(spark, sf_dir, name)
    bad = defects.inject_bad_dates(rows, "transaction_date", row_id(name))
    touched = selected(F.col("transaction_id"), 100, 0.05)
    years = bad.where(touched).select(F.year("transaction_date").alias("y")).distinct()
    assert {r["y"] for r in years.collect()} == set(defects.BAD_YEARS)
    kept = clean(bad, WIDE[name], as_of, horizon)
    assert kept.where(touched).isEmpty() and not kept.isEmpty()


@pytest.mark.parametrize("name", list(SPECS))
def test_defects_repeat_and_keep_schema(spark, sf_dir, name):
    rows = table(spark, sf_dir, name)
    first, second = (defects.inject_defects(rows, WIDE[name], row_id(name)) for _ in range(2))
    assert first.columns == rows.columns
    assert [f.dataType for f in first.schema] == [f.dataType for f in rows.schema]
    assert first.exceptAll(second.repartition(3)).isEmpty()
    assert first.count() > rows.count()


def test_shuffle_keeps_rows_and_changes_order(ids):
    out = [r["row"] for r in defects.shuffle_rows(ids, F.col("row")).collect()]
    assert sorted(out) == list(range(N)) and out != list(range(N))


def test_payments_have_ids_of_their_own(spark, sf_dir):
    ids = table(spark, sf_dir, "payments").select(row_id("payments").alias("v"))
    assert ids.distinct().count() == ids.count()


def test_draws_stay_out_of_later_filters(spark, sf_dir):
    """Cleaning dirty rows computes no draw a second time."""
    horizon, as_of = BOUNDS["transactions"]
    dirty = defects.inject_defects(table(spark, sf_dir, "transactions"), WIDE["transactions"], row_id("transactions"))
    cleaned = clean(dirty, WIDE["transactions"], as_of, horizon)

    def mods(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("pmod")

    assert 0 < mods(cleaned) <= mods(dirty)


def test_rows_are_copied_as_often_as_they_are_drawn(spark):
    ids = spark.range(20_000).select(F.col("id").alias("row"))
    out = defects.inject_duplicates(ids, F.col("row"), 2.0, at_least_one=False)
    copies = [r["count"] - 1 for r in out.groupBy("row").count().collect()]
    assert max(copies) > 4
    assert abs(sum(copies) / 20_000 - 2.0) < 0.06


def test_each_draw_is_computed_once(spark, sf_dir):
    """Every draw takes one modulus a round, whatever it is used for; the start takes one per operator."""
    dirty = defects.inject_defects(table(spark, sf_dir, "transactions"), WIDE["transactions"], row_id("transactions"))
    plan = dirty._jdf.queryExecution().optimizedPlan().toString()
    outliers, nulls, dates, copies = 1 + 3, 1 + 3 * len(WIDE["transactions"].columns), 1 + 3 * 4 + 3, 1 + 3
    assert plan.count("pmod(") <= outliers + nulls + dates + 2 * copies


def test_rounds_make_the_draw(ids):
    rows = defects.with_draws(ids, F.col("row") * 7 - 50, a=0, b=401)
    want = ids.select(*(draw(F.col("row") * 7 - 50, s).alias("d") for s in (0, 401)))
    assert rows.columns == ["row", "a", "b"]
    assert sorted(map(tuple, rows.select("a", "b").collect())) == sorted(map(tuple, want.collect()))
