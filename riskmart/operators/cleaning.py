"""Date, birthday and key rules between the typed and the clean layer.

All rules are plain comparisons with literals, so they reach the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.specs import MONTH, TableSpec


@dataclass(frozen=True)
class Horizon:
    """Event dates are kept in [start, end)."""

    start: dt.date
    end: dt.date


# The default horizon, and the first and last accepted birthday.
DEFAULT_HORIZON = Horizon(dt.date(2023, 1, 1), dt.date(2026, 1, 1))
FIRST_BIRTHDAY = dt.date(1920, 1, 1)
LAST_BIRTHDAY = dt.date(2010, 1, 1)


def midnight(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def _today(as_of: dt.date | None) -> Column:
    return F.lit(as_of) if as_of else F.current_date()


def date_rule(date: Column, horizon: Horizon, as_of: dt.date | None) -> Column:
    """Inside the horizon and before the start of today."""
    return (
        date.isNotNull()
        & (date >= midnight(horizon.start))
        & (date < _today(as_of).cast("timestamp_ntz"))
        & (date < midnight(horizon.end))
    )


def birthday_rule(birthday: Column, as_of: dt.date | None) -> Column:
    """Between the first and last accepted birthday, both included, and before today."""
    return (
        birthday.isNotNull()
        & birthday.between(F.lit(FIRST_BIRTHDAY), F.lit(LAST_BIRTHDAY))
        & (birthday < _today(as_of))
    )


def clean(
    staged: DataFrame,
    spec: TableSpec,
    as_of: dt.date | None = None,
    horizon: Horizon = DEFAULT_HORIZON,
) -> DataFrame:
    """Rows that pass the rules of the table; ``as_of`` is today unless given."""
    date = F.col(spec.date_column)
    rule = date_rule(date, horizon, as_of) if spec.has_event_time else birthday_rule(date, as_of)
    if spec.require_client:
        rule = rule & F.col("client_id").isNotNull()
    return staged.where(rule).select(*spec.columns)


def month_of(date: Column) -> Column:
    """``yyyy-MM`` of a zone-less timestamp, without a detour over the session time zone."""
    return F.left(date.cast("date").cast("string"), F.lit(7))


def with_month(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the partition column of event tables."""
    return df.withColumn(MONTH, month_of(F.col(spec.date_column))) if spec.has_event_time else df


def date_range(df: DataFrame, spec: TableSpec, start: dt.date, end: dt.date) -> DataFrame:
    """Rows with a date in [start, end) of a month-partitioned table.

    A filter on the timestamp alone does not prune partitions derived from it,
    so the months of the range are stated as well.
    """
    date = F.col(spec.date_column)
    last_day = max(start, end - dt.timedelta(days=1))
    months = F.col(MONTH).between(F.lit(start.isoformat()[:7]), F.lit(last_day.isoformat()[:7]))
    return df.where(months & (date >= midnight(start)) & (date < midnight(end)))
