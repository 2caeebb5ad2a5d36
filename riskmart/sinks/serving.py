"""Publishing the mart to a serving store."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.sinks.tables import point_table
from riskmart.sinks.versions import VersionedFolder

DECIMAL = T.DecimalType(15, 2)

# Columns and types of the serving table.
SERVING_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.IntegerType(), False),
        T.StructField("first_name", T.StringType(), False),
        T.StructField("last_name", T.StringType(), False),
        T.StructField("total_transactions", T.IntegerType(), False),
        T.StructField("avg_transaction_amount", DECIMAL, False),
        T.StructField("max_transaction_amount", DECIMAL, False),
        T.StructField("suspicious_transaction_count", T.IntegerType(), False),
        T.StructField("login_count", T.IntegerType(), False),
        T.StructField("financial_risk", T.ByteType(), False),
        T.StructField("activity_risk", T.ByteType(), False),
        T.StructField("risk_score", T.IntegerType(), False),
    ]
)


def wide_schema(schema: T.StructType = SERVING_SCHEMA) -> T.StructType:
    """The serving columns with 64-bit ids and counts."""
    wide = {"client_id", "total_transactions", "suspicious_transaction_count", "login_count"}
    return T.StructType(
        [T.StructField(f.name, T.LongType(), f.nullable) if f.name in wide else f for f in schema]
    )


def _fill(value: Column, field_: T.StructField, null_policy: str) -> Column:
    if null_policy == "keep":
        return value
    if null_policy == "fail":
        message = F.lit(f"{field_.name} is NULL, but the serving column does not take NULL")
        return F.when(value.isNull(), F.raise_error(message)).otherwise(value)
    empty = F.lit("") if isinstance(field_.dataType, T.StringType) else F.lit(0)
    return F.coalesce(value, empty.cast(field_.dataType))


def serving_frame(
    mart: DataFrame, null_policy: str = "zero", schema: T.StructType = SERVING_SCHEMA
) -> DataFrame:
    """Narrow the mart to the serving types.

    The serving columns take no NULL: ``zero`` writes 0 or an empty string,
    ``fail`` stops the job, and ``keep`` passes NULL on for stores that allow it.
    """
    if null_policy not in ("zero", "fail", "keep"):
        raise ValueError(f"null_policy must be 'zero', 'fail' or 'keep', not {null_policy!r}")
    return mart.select(
        *(_fill(F.col(f.name).cast(f.dataType), f, null_policy).alias(f.name) for f in schema)
    )


@dataclass(frozen=True)
class ParquetTarget:
    """A folder of files ordered by client, so that readers can skip by client range."""

    path: str

    def write(self, rows: DataFrame, mode: str) -> None:
        ordered = rows.repartitionByRange("client_id").sortWithinPartitions("client_id")
        ordered.write.mode(mode).parquet(self.path)


@dataclass(frozen=True)
class VersionedTarget:
    """Like :class:`ParquetTarget`, but readers go on seeing the last published rows until new ones are whole.

    They read through :meth:`read`, or through the catalog name ``table`` if one is given.
    """

    path: str
    table: str | None = None

    @property
    def folder(self) -> VersionedFolder:
        return VersionedFolder(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.folder.read(spark)

    def write(self, rows: DataFrame, mode: str) -> None:
        spark, fill = rows.sparkSession, lambda path: ParquetTarget(path).write(rows, "errorifexists")
        if mode == "append":
            self.folder.append(spark, fill)
        else:
            self.folder.replace(spark, fill)
        if self.table:
            folders = self.folder.folders(spark)
            if len(folders) > 1:
                raise ValueError("a table name stands for one folder: publish with mode='overwrite'")
            point_table(spark, self.table, rows.schema, folders[0])
        self.folder.expire(spark)


@dataclass(frozen=True)
class JdbcTarget:
    """A table behind a JDBC driver; its jar must be on the session.

    ``create_options`` is appended to the CREATE TABLE statement, for instance
    an engine with its sort order. ``overwrite`` truncates and keeps the table
    where Spark knows that the database can; elsewhere Spark drops the table and
    creates it again, so ``overwrite`` is refused there without ``create_options``.
    """

    url: str
    table: str
    partitions: int = 16
    batch_size: int = 50_000
    create_options: str | None = None
    column_types: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        options = {
            "url": self.url,
            "dbtable": self.table,
            "numPartitions": str(self.partitions),
            "batchsize": str(self.batch_size),
            "truncate": "true",
        }
        if self.create_options:
            options["createTableOptions"] = self.create_options
        if self.column_types:
            options["createTableColumnTypes"] = self.column_types
        return options | self.properties

    def read_options(self, low: int, high: int) -> dict[str, str]:
        """Options of a read split by client range over several tasks."""
        return {
            "url": self.url,
            "dbtable": self.table,
            "partitionColumn": "client_id",
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(self.partitions),
        } | self.properties

    def read(self, spark: SparkSession, low: int, high: int) -> DataFrame:
        """The serving table, one task per range of clients; ``low`` and ``high`` only place the ranges."""
        return spark.read.format("jdbc").options(**self.read_options(low, high)).load()

    def keeps_table(self, spark: SparkSession) -> bool:
        """Whether Spark truncates a table of this URL rather than dropping it."""
        cascades = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).isCascadingTruncateTable()
        return cascades.isDefined() and not cascades.get()

    def write(self, rows: DataFrame, mode: str) -> None:
        if mode == "overwrite" and not self.create_options and not self.keeps_table(rows.sparkSession):
            raise ValueError("overwrite would drop this table: give create_options to create it again, or append")
        rows.write.format("jdbc").options(**self.options()).mode(mode).save()


def publish(
    mart: DataFrame,
    target: ParquetTarget | VersionedTarget | JdbcTarget,
    mode: str = "overwrite",
    null_policy: str = "zero",
    schema: T.StructType = SERVING_SCHEMA,
) -> bool:
    """Write the mart to the target from the executors; an empty mart is skipped.

    Pass a stored mart: the emptiness check of a query would run most of it.
    ``append`` adds another full copy on every run; ``overwrite`` replaces it.
    Returns whether rows were written.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    if mart.isEmpty():
        return False
    target.write(serving_frame(mart, null_policy, schema), mode)
    return True
