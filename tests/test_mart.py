import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from riskmart import CLIENTS
from riskmart.operators.mart import fraud_dashboard
from riskmart.operators import profiles
from riskmart.operators.profiles import login_profile, suspicious_count, tx_profile

AMOUNTS = {
    1: [1, 1, 1, 1, 100],
    2: [5, 15],
    4: [10, 2, 2, 2, 2, 2],
    5: [1, 1, 1, 1, 100],
    99: [7],
    None: [1, 1, 1, 1, 90],
}
LOGINS = {2: 11, 4: 10, 5: 12, 77: 1}
ROUTES = [
    {},
    {"hot_limit": 1_000},
    {"hot_limit": 2},
    {"method": "salt"},
    {"method": "salt", "hot_limit": 3, "rows_per_salt": 7},
]


def transactions(spark, rows):
    return spark.createDataFrame(rows, "client_id int, amount decimal(15,2)")


@pytest.fixture
def golden(spark):
    tx = transactions(spark, [(c, Decimal(a)) for c, amounts in AMOUNTS.items() for a in amounts])
    logins = spark.createDataFrame([(c,) for c, n in LOGINS.items() for _ in range(n)], "client_id int")
    names = [(i, f"F{i}", f"L{i}", "e", "p", "a", dt.date(1990, 1, 1)) for i in range(1, 6)]
    return spark.createDataFrame(names, CLIENTS.typed_schema), tx, logins


@pytest.mark.parametrize("options", ROUTES)
def test_golden_mart(golden, options):
    got = {
        r["client_id"]: tuple(r)[3:] for r in fraud_dashboard(*golden, **options).collect()
    }
    money = Decimal
    assert got == {
        1: (5, money("20.80"), money("100.00"), 1, None, True, None, 3),
        2: (2, money("10.00"), money("15.00"), 0, 11, False, True, 2),
        3: (None, None, None, None, None, None, None, 0),
        4: (6, money("3.33"), money("10.00"), 0, 10, False, False, 0),
        5: (5, money("20.80"), money("100.00"), 1, 12, True, True, 3),
    }


def test_rows_without_client(golden):
    profile = {r["client_id"]: r for r in tx_profile(golden[1]).collect()}
    assert set(profile) == set(AMOUNTS)
    assert profile[None]["total_transactions"] == 5
    assert profile[None]["suspicious_transaction_count"] == 0
    assert None not in {r["client_id"] for r in tx_profile(golden[1], keep_unknown=False).collect()}


def test_all_amounts_null(spark):
    row = tx_profile(transactions(spark, [(1, None), (1, None)])).first()
    assert tuple(row) == (1, 2, None, None, 0, None)


def test_login_profile_counts_null_clients(spark):
    logins = spark.createDataFrame([(1,), (1,), (None,)], "client_id int")
    assert {tuple(r) for r in login_profile(logins).collect()} == {(1, 2), (None, 1)}


def brute_force(rows, factor):
    by_client = defaultdict(list)
    for client, amount in rows:
        by_client[client].append(amount)
    out = {}
    for client, amounts in by_client.items():
        known = [Fraction(a) for a in amounts if a is not None]
        mean = sum(known) / len(known) if known else None
        out[client] = sum(a > Fraction(str(factor)) * mean for a in known) if client is not None else 0
    return out


@pytest.mark.parametrize("options", ROUTES)
@pytest.mark.parametrize("factor", [3, 2.5, 0.5])
def test_suspicious_count_on_skewed_rows(spark, options, factor):
    """One client holds a third of the rows, and a third of those are copies of one row."""
    rng = random.Random(11)
    rows = [(1, Decimal("3.00"))] * 300
    rows += [(1, Decimal(rng.randrange(1, 5000)) / 100) for _ in range(600)]
    rows += [
        (rng.randrange(2, 90), rng.choice([None, Decimal(rng.randrange(-500, 90_000)) / 100]))
        for _ in range(1500)
    ]
    rows += [(None, Decimal(1)), (None, Decimal(1000))]
    got = suspicious_count(transactions(spark, rows), factor, **options)
    assert {tuple(r) for r in got.collect()} == set(brute_force(rows, factor).items())


def test_amount_just_above_threshold_passes_the_bucket_filter(spark):
    """Means that are repeating decimals, amounts one cent on either side of three means."""
    rows = []
    for client in range(1, 60):
        others = [Decimal(client) / 100 + Decimal("0.07")] * 4 + [Decimal("0.01")] * 2
        n, rest = len(others) + 1, sum(others)
        edge = (3 * rest / (n - 3)).quantize(Decimal("0.01"))
        for step in (-1, 0, 1):
            rows += [(client * 10 + step + 1, a) for a in [*others, edge + step * Decimal("0.01")]]
    for options in ROUTES:
        got = suspicious_count(transactions(spark, rows), **options)
        assert {tuple(r) for r in got.collect()} == set(brute_force(rows, 3).items())


def test_invariants_on_tables(spark, sf_dir):
    from riskmart.plans.registered import unfiltered_mart
    from riskmart.sources.bench_tables import table

    mart = unfiltered_mart(spark, sf_dir)
    assert mart.count() == table(spark, sf_dir, "clients").count()
    flag = F.coalesce("financial_risk", F.lit(False))
    count = F.coalesce("suspicious_transaction_count", F.lit(0))
    assert mart.where(flag != (count > 0)).isEmpty()
    assert mart.where(flag & (F.col("total_transactions") < 4)).isEmpty()
    assert mart.where(~F.col("risk_score").isin(0, 2, 3)).isEmpty()


def spread_amounts(spark, clients, n):
    """Log-normal amounts whose scale differs by client; every third row is of client 1."""
    u, v = (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1 << 30)) / (1 << 30) for k in (1, 2))
    client = F.when(F.col("id") % 3 == 0, 1).otherwise(F.pmod(F.xxhash64("id"), F.lit(clients)))
    scale = F.pow(F.lit(10.0), F.pmod(F.xxhash64("client_id"), F.lit(300)) / 100)
    amount = scale * 20 * F.exp(0.8 * F.sqrt(-2 * F.log(u + 1e-9)) * F.cos(6.283185307 * v))
    rows = spark.range(n).withColumn("client_id", client)
    return rows.select(F.col("id").alias("transaction_id"), "client_id", amount.cast("decimal(15,2)").alias("amount"))


@pytest.fixture(scope="module")
def spread(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("spread") / "tx")
    spread_amounts(spark, 1_500, 200_000).write.parquet(path)
    return spark.read.parquet(path)


def test_few_rows_are_read_again(spread):
    """Rows that pass on to the second shuffle stay below the suspicious ones, however many clients share a block."""
    profile = profiles.band_profile(spread, 3).select("client_id", F.inline("open"))
    suspicious = suspicious_count(spread).agg(F.sum("suspicious_transaction_count")).first()[0]
    rows = spread.select("client_id", "amount", profiles.band_of().alias("band"))
    cold = profile.where("client_id <> 1").select("client_id", "band")
    assert 0 < profiles.passing(rows, cold).count() < suspicious
    assert profile.where("client_id <> 1").agg(F.sum("n")).first()[0] <= profiles.passing(rows, cold).count()
    assert profile.agg(F.sum("n")).first()[0] < suspicious


def test_a_full_bloom_filter_loses_nothing(spread, monkeypatch):
    want = {tuple(r) for r in suspicious_count(spread, method="salt").collect()}
    monkeypatch.setattr(profiles, "MOST_BLOCKS", 1)
    monkeypatch.setattr(profiles, "WORDS", 1)
    for hot_limit in (1, 100, 100_000):
        assert {tuple(r) for r in suspicious_count(spread, hot_limit=hot_limit).collect()} == want


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan ==\n   ")[0]


def test_rows_are_summed_up_once(spark, spread):
    """One scan and one shuffle by band and one by client serve all branches; the second scan is of the rows read again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(tx_profile(spread, hot_limit=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert sum("partial_collect_list(" in line and "client_id, client_id#" in line for line in plan.splitlines()) == 1


def test_nothing_is_read_again_where_bands_tell_all(spark, sf_dir):
    """With ten orders a client no band holds more rows than are known from its least, largest and sum."""
    from riskmart.sources.bench_tables import table

    plan = executed(tx_profile(table(spark, sf_dir, "transactions")))
    assert plan.count("FileScan") == 1


def test_hot_bands_meet_their_thresholds_by_broadcast(spark, spread):
    """With every band hot, no row is shuffled by client before it is counted."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(tx_profile(spread, hot_limit=100_000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [client_id" in plan
    assert not any("Exchange hashpartitioning(client_id" in line and "band#" in line and "_groupingexpression" not in line for line in plan.splitlines())


def test_unknown_method(spark):
    with pytest.raises(ValueError, match="method"):
        tx_profile(transactions(spark, []), method="window")


@pytest.fixture
def laid_out(spark, spread, tmp_path):
    """Transactions, logins and clients in buckets, two of the clients hot; and rows without a client."""
    from riskmart.plans import colocated

    none = spark.createDataFrame([(1, None, Decimal(5)), (2, None, Decimal(500))], spread.schema)
    frames = {
        "transactions": spread.unionByName(none),
        "logins": spread.where("amount > 400").select("client_id"),
        "clients": spark.range(1, 1_400).select(
            F.col("id").alias("client_id"), F.lit("A").alias("client_first_name"), F.lit("B").alias("client_last_name")
        ),
    }
    names = {name: f"laid_{name}" for name in frames}
    for name, rows in frames.items():
        colocated.write_colocated(rows, names[name], str(tmp_path / name), 4, hot_limit=2_300 if name != "clients" else 1)
    yield frames, names
    for name in names.values():
        colocated.drop_colocated(spark, name)


def test_mart_over_buckets_shuffles_no_client(spark, laid_out):
    from riskmart.plans.colocated import colocated_dashboard

    frames, names = laid_out
    assert spark.table("laid_transactions_spread").select("client_id").distinct().count() > 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = colocated_dashboard(spark, names)
        got = sorted(map(repr, mart.collect()))
        plan = executed(mart)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(map(repr, fraud_dashboard(frames["clients"], frames["transactions"], frames["logins"]).collect()))
    # What follows a shuffle by client is made of the spread tables alone, and meets the clients by broadcast.
    main = plan.splitlines()
    assert any("SortMergeJoin [client_id" in line and "LeftOuter" in line for line in main)
    cold = [k for k, line in enumerate(main) if "FileScan" in line and "laid_" in line and "_cold" in line]
    assert len(cold) == 4
    for k in cold:
        depth, above = main[k].index("FileScan"), []
        for line in reversed(main[:k]):
            place = len(line) - len(line.lstrip(" :+-*"))
            if place < depth:
                above.append(line)
                depth = place
        assert not any("Exchange hashpartitioning" in line for line in above)
