"""Clean tables laid out by client, and the mart over them without a shuffle of their rows.

A table becomes two catalog tables: `<name>_cold` in hash buckets by client, one sorted file each, and `<name>_spread`
with the rows of clients that would overfill a bucket (at most `hot_limit` clients can have that share of all rows) and
of no client at all. Aggregates and joins by client run bucket by bucket on the first; the second is aggregated with
map-side combine, and as it holds few clients its result is broadcast. The layout pays where tables are read more often
than written: the shuffle by client happens once, at the load.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.risk import AMOUNT_FACTOR, LOGIN_LIMIT
from riskmart.operators.mart import finished
from riskmart.operators.profiles import CLIENT, HOT_LIMIT, hot_clients, login_profile, tx_profile
from riskmart.sinks.tables import write_bucketed, write_layer

PROFILED = ("transactions", "logins")


def write_colocated(df: DataFrame, name: str, location: str, buckets: int, hot_limit: int = HOT_LIMIT) -> None:
    """Lay a table out by client under the names `<name>_cold` and `<name>_spread`; both are replaced.

    Give all tables that are joined the same number of buckets.
    """
    spark = df.sparkSession
    keys = f"{location}/hot_clients"
    write_layer(hot_clients(df, hot_limit), keys)
    hot = F.broadcast(spark.read.schema(df.select(CLIENT).schema).parquet(keys))
    known = df.where(F.col(CLIENT).isNotNull())
    cold = known.join(hot, CLIENT, "left_anti").repartition(buckets, CLIENT)
    write_bucketed(cold, f"{name}_cold", f"{location}/cold", buckets)
    spread = known.join(hot, CLIENT, "left_semi").unionByName(df.where(F.col(CLIENT).isNull()))
    spread.write.mode("overwrite").option("path", f"{location}/spread").saveAsTable(f"{name}_spread")


def drop_colocated(spark: SparkSession, name: str) -> None:
    for part in ("cold", "spread"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_{part}")


def _both(clients: DataFrame, cold: DataFrame, spread: DataFrame) -> DataFrame:
    """Profiles of the clients: bucket by bucket from the cold rows, by broadcast from the spread ones.

    No client is in both, so whichever side has a value holds all of it.
    """
    values = [c for c in cold.columns if c != CLIENT]
    few = spread.where(F.col(CLIENT).isNotNull()).select(CLIENT, *(F.col(c).alias(f"_{c}") for c in values))
    met = clients.join(cold, CLIENT, "left").join(F.broadcast(few), CLIENT, "left")
    return met.select(*clients.columns, *(F.coalesce(c, f"_{c}").alias(c) for c in values))


def colocated_dashboard(spark: SparkSession, names: Mapping[str, str], factor: float = AMOUNT_FACTOR, login_limit: int = LOGIN_LIMIT) -> DataFrame:
    """The mart over tables that :func:`write_colocated` laid out; same rows as ``fraud_dashboard``.

    `names` maps clients, transactions and logins to their catalog names. Clients have one row each, so all of them
    are expected in buckets; a client that is not is taken from the spread table as well.
    """
    parts = {name: (spark.table(f"{names[name]}_cold"), spark.table(f"{names[name]}_spread")) for name in names}
    cold, spread = parts["clients"]
    tx = (tx_profile(parts["transactions"][0], factor, method="local"), tx_profile(parts["transactions"][1], factor))
    logins = tuple(login_profile(part) for part in parts["logins"])

    def joined(clients: DataFrame) -> DataFrame:
        people = clients.select(CLIENT, F.col("client_first_name").alias("first_name"), F.col("client_last_name").alias("last_name"))
        return finished(_both(_both(people, *tx), *logins), login_limit)

    mart = joined(cold)
    return mart if spread.isEmpty() else mart.unionByName(joined(spread))
