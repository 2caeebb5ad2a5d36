"""The mart: one row per client, with statistics, risk flags and a score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.risk import AMOUNT_FACTOR, LOGIN_LIMIT, activity_risk, risk_score
from riskmart.operators.profiles import login_profile, tx_profile


def join_profiles(clients: DataFrame, transactions: DataFrame, logins: DataFrame) -> DataFrame:
    """Left joins keep every client; a client without rows keeps NULL statistics."""
    names = clients.select(
        "client_id",
        F.col("client_first_name").alias("first_name"),
        F.col("client_last_name").alias("last_name"),
    )
    return names.join(transactions, "client_id", "left").join(logins, "client_id", "left")


def fraud_dashboard(
    clients: DataFrame,
    transactions: DataFrame,
    logins: DataFrame,
    factor: float = AMOUNT_FACTOR,
    login_limit: int = LOGIN_LIMIT,
    **options,
) -> DataFrame:
    """The mart over the three clean tables; ``options`` go to :func:`tx_profile`."""
    joined = join_profiles(
        clients,
        tx_profile(transactions, factor, keep_unknown=False, **options),
        login_profile(logins),
    )
    return finished(joined, login_limit)


def finished(joined: DataFrame, login_limit: int = LOGIN_LIMIT) -> DataFrame:
    """Flags and score of clients that have met their profiles, in the columns of the mart."""
    flagged = joined.withColumn("activity_risk", activity_risk(F.col("login_count"), login_limit))
    return flagged.select(
        "client_id",
        "first_name",
        "last_name",
        "total_transactions",
        "avg_transaction_amount",
        "max_transaction_amount",
        "suspicious_transaction_count",
        "login_count",
        "financial_risk",
        "activity_risk",
        risk_score(F.col("financial_risk"), F.col("activity_risk")).alias("risk_score"),
    )
