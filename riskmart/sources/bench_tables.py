"""The five tables, typed, mapped from the benchmark star schema.

Ids stay 64 bits wide here (``TableSpec.wide``): order keys outgrow 32 bits
long before 100 TB.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.draws import MODULUS
from riskmart.operators.cleaning import Horizon
from riskmart.specs import SPECS

WIDE = {name: spec.wide() for name, spec in SPECS.items()}

TRADE_HORIZON = Horizon(dt.date(1996, 1, 1), dt.date(2001, 1, 1))
TRADE_AS_OF = dt.date(2000, 12, 1)
WEB_HORIZON = Horizon(dt.date(2024, 1, 1), dt.date(2024, 2, 1))
WEB_AS_OF = dt.date(2024, 1, 25)
BIRTHDAY_AS_OF = dt.date(2025, 6, 15)

# Horizon and as-of date per table; clients use the as-of date only.
BOUNDS = {
    "activity": (WEB_HORIZON, WEB_AS_OF),
    "clients": (WEB_HORIZON, BIRTHDAY_AS_OF),
    "logins": (WEB_HORIZON, WEB_AS_OF),
    "payments": (TRADE_HORIZON, TRADE_AS_OF),
    "transactions": (TRADE_HORIZON, TRADE_AS_OF),
}

SOURCE_TABLE = {
    "activity": "events",
    "clients": "customer",
    "logins": "events",
    "payments": "lineitem",
    "transactions": "orders",
}


def _currency(key: str) -> Column:
    return F.when(F.col(key) % 2 == 0, F.lit("USD")).otherwise(F.lit("RUB"))


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(15,2)")


def _clients(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    text = key.cast("string")
    return customer.select(
        key.alias("client_id"),
        F.col("c_name").alias("client_first_name"),
        F.col("c_mktsegment").alias("client_last_name"),
        F.concat(F.lit("c"), text, F.lit("@example.com")).alias("client_email"),
        F.concat(F.lit("+1-"), text).alias("client_phone"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("client_address"),
        F.date_add(F.lit(dt.date(1910, 1, 1)), (key * 37 % 40000).cast("int")).alias("client_birthday"),
    )


def _transactions(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_orderstatus").alias("transaction_type"),
        F.col("o_orderpriority").alias("account_number"),
        _currency("o_orderkey").alias("currency"),
        _money("o_totalprice").alias("amount"),
    )


def _payments(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_suppkey").alias("client_id"),
        F.col("l_orderkey").alias("payment_id"),
        F.col("l_shipdate").alias("payment_date"),
        _currency("l_orderkey").alias("currency"),
        _money("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("payment_method"),
    )


def _logins(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("client_id"),
        F.col("ts").alias("login_date"),
        F.col("event_id").cast("string").alias("ip_address"),
        _money("value").cast("string").alias("location"),
        F.col("props").alias("device"),
    )


def _activity(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("client_id"),
        F.col("ts").alias("activity_date"),
        F.col("event_type").alias("activity_type"),
        F.col("props").alias("activity_location"),
        F.col("event_id").cast("string").alias("ip_address"),
        F.col("props").alias("device"),
    )


MAPPING = {
    "activity": _activity,
    "clients": _clients,
    "logins": _logins,
    "payments": _payments,
    "transactions": _transactions,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return MAPPING[name](spark.read.parquet(f"{sf_dir}/{SOURCE_TABLE[name]}.parquet"))


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same rows as a file stream. The pattern accepts a single file as well as a folder."""
    base = f"{sf_dir}/{SOURCE_TABLE[name]}"
    schema = spark.read.parquet(f"{base}.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 10_000)
    return MAPPING[name](reader.parquet(f"{base}.parque[t]"))


def row_id(name: str) -> Column:
    """An integer that identifies a row of the table, for seeded draws."""
    if name in ("activity", "logins"):
        return F.col("ip_address").cast("bigint")
    if name == "payments":
        # An order has several payments, also to one client; the amount tells them apart.
        order = F.pmod(F.col("payment_id") * 1_000_003 + F.col("client_id"), F.lit(MODULUS).cast("bigint"))
        return order * 1_000_003 + (F.col("amount") * 100).cast("bigint")
    return F.col("client_id" if name == "clients" else "transaction_id")
