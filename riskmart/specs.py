"""One specification per table; every layer is driven by it.

A column has a *kind* which decides its type in the typed layers and the cast
that produces it from text. In the message and raw layers all columns are text.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

KINDS = {
    "id": T.IntegerType(),
    "text": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "amount": T.DecimalType(15, 2),
}

MONTH = "ym"


@dataclass(frozen=True)
class DefectRates:
    """Share of rows (or cells, for nulls) that defect injection touches."""

    nulls: float
    duplicates: float
    bad_dates: float = 0.0
    outliers: float = 0.0


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[tuple[str, str], ...]
    date_column: str
    rates: DefectRates
    unique_key: str | None = None
    require_client: bool = False
    id_type: T.DataType = KINDS["id"]

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]

    def of_kind(self, kind: str) -> list[str]:
        return [name for name, k in self.fields if k == kind]

    @property
    def has_event_time(self) -> bool:
        """Event tables carry a timestamp and are partitioned by month; clients carry a birthday."""
        return dict(self.fields)[self.date_column] == "timestamp"

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns])

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(n, self.id_type if k == "id" else KINDS[k]) for n, k in self.fields]
        )

    @property
    def clean_schema(self) -> T.StructType:
        """The typed columns, plus the month partition for event tables."""
        schema = self.typed_schema
        return schema.add(MONTH, T.StringType()) if self.has_event_time else schema

    def wide(self) -> TableSpec:
        """The same table with 64-bit ids, for sources whose keys do not fit 32 bits."""
        return replace(self, id_type=T.LongType())


# Fixed values from here on: names, column order and kinds of the tables, and their defect rates.

ACTIVITY = TableSpec(
    name="activity",
    fields=(
        ("client_id", "id"),
        ("activity_date", "timestamp"),
        ("activity_type", "text"),
        ("activity_location", "text"),
        ("ip_address", "text"),
        ("device", "text"),
    ),
    date_column="activity_date",
    rates=DefectRates(nulls=0.05, duplicates=0.05, bad_dates=0.05),
)

CLIENTS = TableSpec(
    name="clients",
    fields=(
        ("client_id", "id"),
        ("client_first_name", "text"),
        ("client_last_name", "text"),
        ("client_email", "text"),
        ("client_phone", "text"),
        ("client_address", "text"),
        ("client_birthday", "date"),
    ),
    date_column="client_birthday",
    rates=DefectRates(nulls=0.07, duplicates=0.04),
    unique_key="client_id",
)

LOGINS = TableSpec(
    name="logins",
    fields=(
        ("client_id", "id"),
        ("login_date", "timestamp"),
        ("ip_address", "text"),
        ("location", "text"),
        ("device", "text"),
    ),
    date_column="login_date",
    rates=DefectRates(nulls=0.05, duplicates=0.05, bad_dates=0.05),
    require_client=True,
)

PAYMENTS = TableSpec(
    name="payments",
    fields=(
        ("client_id", "id"),
        ("payment_id", "id"),
        ("payment_date", "timestamp"),
        ("currency", "text"),
        ("amount", "amount"),
        ("payment_method", "text"),
    ),
    date_column="payment_date",
    rates=DefectRates(nulls=0.05, duplicates=0.05, bad_dates=0.05),
)

TRANSACTIONS = TableSpec(
    name="transactions",
    fields=(
        ("client_id", "id"),
        ("transaction_id", "id"),
        ("transaction_date", "timestamp"),
        ("transaction_type", "text"),
        ("account_number", "text"),
        ("currency", "text"),
        ("amount", "amount"),
    ),
    date_column="transaction_date",
    rates=DefectRates(nulls=0.04, duplicates=0.05, bad_dates=0.05, outliers=0.01),
)

SPECS = {spec.name: spec for spec in (ACTIVITY, CLIENTS, LOGINS, PAYMENTS, TRANSACTIONS)}
