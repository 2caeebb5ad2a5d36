"""Seeded defect injection over any DataFrame, to test the layers at scale.

Every operator takes ``row_id``, an integer expression that identifies a row,
and touches the rows chosen by :mod:`riskmart.functions.draws`. A rerun with
the same seed injects the same defects.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.draws import chosen, copy_thresholds, draw, rounds, start
from riskmart.operators.cleaning import Horizon, midnight
from riskmart.operators.settling import settled
from riskmart.specs import TableSpec

# Impossible years, and the domains burst rows draw from.
BAD_YEARS = (1700, 1800, 2100, 2200)
TRANSACTION_TYPES = ("deposit", "withdrawal", "transfer")
CURRENCIES = ("USD", "RUB")
BURST_CENTS = (10_000, 1_000_000)
BURST_IDS = (1_000, 10_000)


def _pick(value: Column, options: tuple) -> Column:
    index = F.pmod(value, F.lit(len(options)).cast("bigint")).cast("int") + 1
    return F.element_at(F.array(*(F.lit(o) for o in options)), index)


def _within(value: Column, first: int, end: int) -> Column:
    return F.pmod(value, F.lit(end - first).cast("bigint")) + F.lit(first)


def with_draws(df: DataFrame, row_id: Column, **seeds: int) -> DataFrame:
    """Add a draw per name and seed, round by round.

    Nothing is shared between expressions inside a generator either, and a draw written out holds the id six times,
    its first round four times. So each round is settled before the next one uses it.
    """
    rows = settled(df, _start=start(row_id))
    steps = {name: rounds(seed) for name, seed in seeds.items()}
    held = ["_start"]
    for k in range(3):
        last = {name: F.col(f"_{k - 1}_{name}") if k else F.col("_start") for name in seeds}
        made = {name if k == 2 else f"_{k}_{name}": steps[name][k](last[name], F.col("_start")) for name in seeds}
        rows = settled(rows, **made)
        held += made if k < 2 else []
    return rows.drop(*held)


def inject_nulls(
    df: DataFrame, row_id: Column, rate: float, seed: int = 0, columns: Iterable[str] | None = None
) -> DataFrame:
    """Null out each column on its own at the given rate."""
    columns = list(columns or df.columns)
    hit = {name: f"_null_{i}" for i, name in enumerate(columns)}
    rows = with_draws(df, row_id, **{drawn: seed + i for i, drawn in enumerate(hit.values())})
    return rows.select(
        *(
            F.when(chosen(F.col(hit[n]), rate), F.lit(None)).otherwise(F.col(n)).alias(n) if n in hit else F.col(n)
            for n in df.columns
        )
    )


def inject_bad_dates(
    df: DataFrame,
    date_column: str,
    row_id: Column,
    rate: float = 0.05,
    seed: int = 100,
    years: tuple[int, ...] = BAD_YEARS,
) -> DataFrame:
    """Replace dates by midnight of some day in one of the impossible years."""
    rows = with_draws(df, row_id, _hit=seed, _year=seed + 1, _month=seed + 2, _day=seed + 3)
    month, day = _within(F.col("_month"), 1, 13).cast("int"), _within(F.col("_day"), 1, 29).cast("int")
    zero = F.lit(0)
    bad = F.make_timestamp_ntz(_pick(F.col("_year"), years), month, day, zero, zero, zero)
    kept = F.when(chosen(F.col("_hit"), rate), bad).otherwise(F.col(date_column))
    return settled(rows, _date=kept).withColumn(date_column, F.col("_date")).drop("_hit", "_year", "_month", "_day", "_date")


def inject_duplicates(
    df: DataFrame,
    row_id: Column,
    rate: float,
    seed: int = 200,
    at_least_one: bool = True,
    copy_column: str | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Draw rows with replacement and append the drawn copies, in one pass over the rows.

    ``at_least_one`` also copies the row with the smallest draw, which matters
    for tiny tables only and costs a second scan of the id; ``ids`` may name a
    frame to take ``row_id`` from that is cheaper to scan. ``copy_column`` keeps
    the number of the copy, 0 for the original row.
    """
    drawn, number = F.col("_draw"), copy_column or "_copy"
    rows = with_draws(df, row_id, _draw=seed)
    copies = F.lit(0)
    for limit in copy_thresholds(rate):
        copies = copies + F.when(drawn < F.lit(limit), F.lit(1)).otherwise(F.lit(0))
    if at_least_one:
        only_ids = (df if ids is None else ids).select(row_id.alias("_id"))
        smallest = with_draws(only_ids, F.col("_id"), _draw=seed).agg(F.min(drawn)).scalar()
        copies = F.greatest(copies, F.when(drawn == smallest, F.lit(1)).otherwise(F.lit(0)))
    # The count is a column of its own: inside the generator nothing is shared between expressions.
    counted = rows.withColumn(number, F.coalesce(copies, F.lit(0))).drop("_draw")
    out = counted.withColumn(number, F.explode(F.sequence(F.lit(0), F.col(number))))
    return out if copy_column else out.drop(number)


def inject_outliers(
    df: DataFrame, row_id: Column, rate: float = 0.01, seed: int = 300, factor: int = 10
) -> DataFrame:
    """Scale some amounts up."""
    kind = df.schema["amount"].dataType
    large = (F.col("amount") * F.lit(Decimal(factor))).cast(kind)
    rows = with_draws(df, row_id, _outlier=seed)
    return rows.withColumn("amount", F.when(chosen(F.col("_outlier"), rate), large).otherwise(F.col("amount"))).drop("_outlier")


def burst_rows(
    clients: DataFrame,
    horizon: Horizon,
    seed: int = 400,
    clients_hit: int = 4,
    instants: int = 2,
    rows: int = 10,
) -> DataFrame:
    """Transactions of a few drawn clients that share a few instants.

    ``clients`` holds each client once; those with the smallest draws are hit.
    """
    seconds = (horizon.end - horizon.start).days * 86_400
    client = F.col("client_id")
    hit = clients.select("client_id").where(client.isNotNull())
    hit = hit.orderBy(draw(client, seed), client).limit(clients_hit)
    expanded = hit.select("client_id", F.explode(F.sequence(F.lit(1), F.lit(instants))).alias("instant"))
    expanded = expanded.select(
        "client_id", "instant", F.explode(F.sequence(F.lit(1), F.lit(rows))).alias("nr")
    )
    instant_id = client * F.lit(instants + 1) + F.col("instant")
    row_id = instant_id * F.lit(rows + 1) + F.col("nr")
    after = F.make_dt_interval(secs=_within(draw(instant_id, seed + 1), 0, seconds))
    cents = _within(draw(row_id, seed + 4), BURST_CENTS[0], BURST_CENTS[1] + 1)
    return expanded.select(
        client,
        _within(draw(row_id, seed + 2), *BURST_IDS).alias("transaction_id"),
        (midnight(horizon.start) + after).alias("transaction_date"),
        _pick(draw(row_id, seed + 3), TRANSACTION_TYPES).alias("transaction_type"),
        F.concat(F.lit("ACC"), draw(row_id, seed + 5).cast("string")).alias("account_number"),
        _pick(draw(row_id, seed + 6), CURRENCIES).alias("currency"),
        (cents.cast("decimal(12,0)") / F.lit(Decimal(100))).cast("decimal(15,2)").alias("amount"),
    )


def inject_bursts(
    tx: DataFrame,
    clients: DataFrame,
    horizon: Horizon,
    seed: int = 400,
    saved_at: dt.datetime | None = None,
    **counts: int,
) -> DataFrame:
    """Append burst rows; ``saved_at`` adds a field that only burst rows carry."""
    burst = burst_rows(clients, horizon, seed, **counts)
    ids = {name: tx.schema[name].dataType for name in ("client_id", "transaction_id")}
    burst = burst.withColumns({name: F.col(name).cast(kind) for name, kind in ids.items()})
    if saved_at is not None:
        burst = burst.withColumn("record_saved_at", F.lit(saved_at.isoformat(" ")).cast("timestamp_ntz"))
    return tx.unionByName(burst, allowMissingColumns=True)


def shuffle_rows(df: DataFrame, row_id: Column, seed: int = 500) -> DataFrame:
    """Order rows by a draw. A global sort: worth it only where order leaves Spark."""
    return df.orderBy(draw(row_id, seed), row_id)


def inject_defects(
    df: DataFrame, spec: TableSpec, row_id: Column, seed: int = 0, at_least_one: bool = True
) -> DataFrame:
    """All defects of a table at its own rates, in the order outliers, nulls, dates, copies."""
    rates = spec.rates
    hidden = F.col("_row_id")
    out = df.withColumn("_row_id", row_id)
    if rates.outliers:
        out = inject_outliers(out, hidden, rates.outliers, seed + 300)
    out = inject_nulls(out, hidden, rates.nulls, seed, df.columns)
    if rates.bad_dates:
        out = inject_bad_dates(out, spec.date_column, hidden, rates.bad_dates, seed + 100)
    ids = df.select(row_id.alias("_row_id"))
    return inject_duplicates(out, hidden, rates.duplicates, seed + 200, at_least_one, ids=ids).drop("_row_id")
