"""Writing the typed, clean and mart layers.

``distribute`` stands for a hash distribution by client. It asks adaptive
execution for a rebalance rather than fixing the partitions by hash: rows of a
client stay together, files get an even size, and a client too large for one
file is split over several.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskmart.operators.cleaning import with_month
from riskmart.sinks.versions import VersionedFolder, children, qualified
from riskmart.specs import MONTH, TableSpec


def distribute(df: DataFrame, *columns: str) -> DataFrame:
    return df.hint("rebalance", *columns)


def write_layer(df: DataFrame, path: str, *by: str) -> None:
    """Full refresh of a folder: what was there before is replaced. Do not read ``path`` in ``df``.

    Without ``by`` the rows are written where they are; naming columns costs a
    shuffle of the whole table.
    """
    rows = distribute(df, *by) if by else df
    rows.write.mode("overwrite").parquet(path)


def write_months(df: DataFrame, spec: TableSpec, path: str) -> None:
    """Full refresh of a month-partitioned folder (event tables), or of a plain one (clients).

    Rows are brought together by month first; otherwise every task would write a
    small file into every month. Months above the advisory size are split.
    """
    if not spec.has_event_time:
        write_layer(df, path)
        return
    rows = distribute(with_month(df, spec), MONTH)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MONTH).parquet(path)


def read_typed(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    return spark.read.schema(spec.typed_schema).parquet(path)


def read_clean(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Includes the month column of event tables; its type is fixed, since a month looks like a date."""
    return spark.read.schema(spec.clean_schema).parquet(path)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    *partition_by: str,
) -> None:
    """Create an external Parquet table in the catalog unless it exists."""
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING parquet{parts} LOCATION '{location}'")


def _same(a: T.StructType, b: T.StructType) -> bool:
    return {(f.name, f.dataType) for f in a} == {(f.name, f.dataType) for f in b}


def point_table(spark: SparkSession, name: str, schema: T.StructType, location: str, *partition_by: str) -> None:
    """Let a catalog name stand for a written folder, whatever it stood for before.

    An existing table of the same columns is switched over in the catalog, so it is never absent; other columns, or
    partitions in another folder, make it be dropped and created again. Data is not touched: the tables are external.
    """
    if spark.catalog.tableExists(name):
        at = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()[1]
        moved = at != qualified(spark, location)
        if not _same(spark.table(name).schema, schema) or moved and partition_by:
            spark.sql(f"DROP TABLE {name}")
        elif moved:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    ensure_table(spark, name, schema, location, *partition_by)
    if len(partition_by) == 1:
        sync_partitions(spark, name, location, partition_by[0])
    elif partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")


def sync_partitions(spark: SparkSession, name: str, location: str, column: str) -> None:
    """Add and drop partitions as the folder has them. Unlike a repair it leaves the statistics of the others alone."""
    found = {n.split("=", 1)[1] for n in children(spark, location) if n.startswith(f"{column}=")}
    known = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for verb, values in (("ADD IF NOT EXISTS", found - known), ("DROP IF EXISTS", known - found)):
        if values:
            separator = " " if verb.startswith("ADD") else ", "
            parts = separator.join(f"PARTITION (`{column}` = '{v}')" for v in sorted(values))
            spark.sql(f"ALTER TABLE {name} {verb} {parts}")


def register_folder(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    *partition_by: str,
    statistics: bool = True,
) -> None:
    """Give a written layer folder a catalog name, take in new partitions, and collect statistics."""
    point_table(spark, name, schema, location, *partition_by)
    if statistics:
        analyze_table(spark, name)


def refresh_table(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Replace the content of a catalog table, all partitions included."""
    columns = spark.table(name).columns
    session_mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    if session_mode.lower() != "static":
        raise ValueError("a full refresh needs spark.sql.sources.partitionOverwriteMode=static")
    df.select(*columns).write.insertInto(name, overwrite=True)


def rebuild_table(spark: SparkSession, name: str, df: DataFrame, location: str) -> None:
    """Make a catalog table anew from a query, below a folder of versions.

    The rows are written first and the name is switched afterwards: until then, and if the query fails, the table
    holds its old rows.
    """
    folder = VersionedFolder(location)
    point_table(spark, name, df.schema, folder.replace(spark, lambda path: write_layer(df, path)))
    folder.expire(spark)


def analyze_partitions(spark: SparkSession, name: str, column: str, values: Iterable[str]) -> None:
    """Row counts and sizes of some partitions, and of the whole table; other partitions keep theirs.

    The whole is counted from file footers, no column is read. The cost-based optimizer takes its row count from there.
    """
    for value in values:
        spark.sql(f"ANALYZE TABLE {name} PARTITION (`{column}` = '{value}') COMPUTE STATISTICS")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def partition_rows(spark: SparkSession, name: str, column: str) -> dict[str, int | None]:
    """Rows per partition as the collected statistics have them, without reading the table; None where there are none."""
    out: dict[str, int | None] = {}
    for (part,) in spark.sql(f"SHOW PARTITIONS {name}").collect():
        value = part.split("=", 1)[1]
        told = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION (`{column}` = '{value}')").where("col_name = 'Partition Statistics'")
        text = told.select("data_type").first()
        found = re.search(r"(\d+) rows", text[0]) if text else None
        out[value] = int(found[1]) if found else None
    return out


def analyze_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def table_rows(spark: SparkSession, name: str) -> int | None:
    """The row count that the collected statistics hold, without reading the table; None where there are none."""
    text = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").select("data_type").first()
    found = re.search(r"(\d+) rows", text[0]) if text else None
    return int(found[1]) if found else None


def write_bucketed(df: DataFrame, name: str, location: str, buckets: int, key: str = "client_id") -> None:
    """A bucketed catalog table: joins and aggregates on the key need no shuffle.

    A bucket holds all rows of its keys, so use it for tables with one row per
    client, or where no client holds more rows than one task can read.
    """
    (
        df.write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", location)
        .saveAsTable(name)
    )
