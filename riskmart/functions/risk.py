"""Risk rules of the mart. Comparisons with NULL stay NULL; the score treats NULL as false."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiple of the mean, logins a client may have, and the two scores.
AMOUNT_FACTOR = 3
LOGIN_LIMIT = 10
FINANCIAL_SCORE = 3
ACTIVITY_SCORE = 2


def exceeds_mean(amount: Column, n: Column, total: Column, factor: float = AMOUNT_FACTOR) -> Column:
    """``amount > factor * total / n`` without a division, hence exact on decimals."""
    return amount * n > total * F.lit(Decimal(str(factor)))


def mean(total: Column, n: Column, digits: int = 2) -> Column:
    """Decimal mean, rounded half away from zero; NULL when there is nothing to average."""
    return F.round(total / F.nullif(n, F.lit(0)), digits)


def activity_risk(logins: Column, limit: int = LOGIN_LIMIT) -> Column:
    return logins > F.lit(limit)


def risk_score(financial: Column, activity: Column) -> Column:
    """A priority, not a sum: the financial flag wins."""
    return (
        F.when(financial, F.lit(FINANCIAL_SCORE))
        .when(activity, F.lit(ACTIVITY_SCORE))
        .otherwise(F.lit(0))
    )
