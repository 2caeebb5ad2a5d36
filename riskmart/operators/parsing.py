"""Messages to text rows. Stateless, so the same code serves batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.specs import TableSpec


def parse_json(messages: DataFrame, schema: T.StructType, *keep: Column) -> DataFrame:
    """Parse ``value`` by a fixed schema and keep only its fields, after the columns of the message named in ``keep``.

    Extra JSON fields and broker metadata disappear; text that is not JSON gives
    a row of NULLs. The struct is flattened by ``inline`` rather than by selecting
    its fields: the optimizer would copy the parse into every selected field and
    into every filter on one, and so parse a message many times over.
    """
    data = F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE"})
    return messages.select(*keep, F.inline(F.array(data)))


def drop_incomplete(rows: DataFrame) -> DataFrame:
    """Completeness rule: any NULL column removes the row."""
    return rows.dropna(how="any")


def ingest_rows(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """What an ingest lands: parsed, complete text rows."""
    return drop_incomplete(parse_json(messages, spec.raw_schema))
