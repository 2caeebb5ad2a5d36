"""Text to typed columns and back.

``on_bad="error"`` lets malformed text fail the job (ANSI casts);
``on_bad="null"`` turns it into NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text formats of timestamps and dates.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
DATE_FORMAT = "yyyy-MM-dd"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}"
# Sign, first digit, other digits and exponent of a double in scientific form.
SCIENTIFIC = r"^(-?)(\d)\.(\d+)E(-?\d+)$"


def _cast(text: Column, target: T.DataType, on_bad: str) -> Column:
    if on_bad not in ("error", "null"):
        raise ValueError(f"on_bad must be 'error' or 'null', not {on_bad!r}")
    return text.cast(target) if on_bad == "error" else text.try_cast(target)


def id_from_text(text: Column, target: T.DataType, on_bad: str = "error") -> Column:
    """``17.0`` and ``17`` both give 17. Only a trailing ``.0`` is removed, so ``1.05`` stays bad."""
    whole = F.when(text.endswith(".0"), F.substr(text, F.lit(1), F.length(text) - 2)).otherwise(text)
    return _cast(whole, target, on_bad)


def amount_from_text(text: Column, target: T.DataType, on_bad: str = "error") -> Column:
    return _cast(text, target, on_bad)


def timestamp_from_text(text: Column, on_bad: str = "error") -> Column:
    """Zone-less timestamp at second precision; a fraction behind it is cut off."""
    seconds = F.left(text, F.lit(19))
    if on_bad == "error":
        return F.to_timestamp_ntz(seconds, F.lit(TIMESTAMP_FORMAT))
    return F.when(text.rlike(TIMESTAMP_PATTERN), seconds.try_cast(T.TimestampNTZType()))


def date_from_text(text: Column, on_bad: str = "error") -> Column:
    day = F.left(text, F.lit(10))
    if on_bad == "error":
        return F.to_date(day, DATE_FORMAT)
    return F.when(text.rlike(DATE_PATTERN), day.try_cast(T.DateType()))


def typed(text: Column, kind: str, target: T.DataType, on_bad: str = "error") -> Column:
    """The typed form of a text column of the given kind."""
    if kind == "id":
        return id_from_text(text, target, on_bad)
    if kind == "amount":
        return amount_from_text(text, target, on_bad)
    if kind == "timestamp":
        return timestamp_from_text(text, on_bad)
    if kind == "date":
        return date_from_text(text, on_bad)
    return text


def _plain_number(text: Column) -> Column:
    """The digits of a double as the message producers write them: an exponent only from 1e16 up or below 1e-4."""
    sign, head, rest, exponent = (F.regexp_extract(text, SCIENTIFIC, k) for k in range(1, 5))
    tail = F.when(rest == "0", F.lit("")).otherwise(rest)
    power = exponent.cast("int")
    digits = F.concat(head, tail)
    size = F.length(digits)
    large = F.when(size <= power + 1, F.concat(F.rpad(digits, power + 1, F.lit("0")), F.lit(".0"))).otherwise(
        F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, size))
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    mantissa = F.when(tail == "", head).otherwise(F.concat(head, F.lit("."), tail))
    written = F.concat(mantissa, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    body = F.when((power >= 0) & (power < 16), large).when((power < 0) & (power >= -4), small).otherwise(written)
    return F.when(text.rlike(SCIENTIFIC), F.concat(sign, body)).otherwise(text)


def to_text(value: Column, source: T.DataType) -> Column:
    """Text form of any column. NaN is a missing value; doubles are written in the form of Python's ``str``, with the digits the JVM gives."""
    if not isinstance(source, (T.DoubleType, T.FloatType)):
        return value.cast("string")
    return F.when(F.isnan(value), F.lit(None)).otherwise(_plain_number(value.cast("string")))
