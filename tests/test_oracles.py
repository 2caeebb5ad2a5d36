"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as entry_points
from riskmart.plans.registered import QUERIES as REGISTERED

# The queries of the optional part are tested beside it.
QUERIES = {name: query for name, query in entry_points.queries().items() if name in REGISTERED}
ORACLES = {name: sql for name, sql in entry_points.oracle_sql().items() if name in REGISTERED}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    assert sorted(duck.sql(ORACLES[name]).columns) == columns
    got = sorted(map(repr, (tuple(row) for row in df.select(*columns).collect())))
    want = sorted(map(repr, duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()))
    assert got == want


def test_entry_has_one_row_per_client(spark):
    df = entry_points.entry(spark)
    assert df.count() == df.select("client_id").distinct().count() > 0


def test_unfiltered_mart_scores(spark, duck, sf_dir):
    """Score counts against the rule written with a plain floating-point mean.

    No client of the test tables sits close enough to the threshold for the
    exact and the floating-point form to differ.
    """
    want = duck.sql("""
        WITH t AS (SELECT o_custkey AS k, MAX(o_totalprice) > 3 * AVG(o_totalprice) AS f FROM orders GROUP BY 1),
             l AS (SELECT user_id AS k, COUNT(*) > 10 AS f FROM events GROUP BY 1)
        SELECT CASE WHEN t.f THEN 3 WHEN l.f THEN 2 ELSE 0 END AS score, COUNT(*)
        FROM customer LEFT JOIN t ON t.k = c_custkey LEFT JOIN l ON l.k = c_custkey GROUP BY 1
    """).fetchall()
    scores = QUERIES["risk_score"](spark, sf_dir).groupBy("risk_score").count().collect()
    assert sorted(map(tuple, scores)) == sorted(want)
    assert {score for score, _ in want} == {0, 2, 3}
