"""Column expressions: parsing, cleaning, banding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, FloatType, StructType, TimestampNTZType, TimestampType

# Upper bounds of the risk bands and the default decision threshold.
LOW_BELOW = 0.25
MEDIUM_BELOW = 0.60
DEFAULT_THRESHOLD = 0.5


def parse_date(column: Column | str) -> Column:
    """Text to date; NULL where malformed."""
    return F.try_to_date(column)


def as_date(name: str, dtype: DataType) -> Column:
    """A column usable for ordering by time: dates and timestamps as they are, text parsed."""
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return F.col(name)
    return parse_date(name)


def nan_to_null(name: str, dtype: DataType) -> Column:
    """NaN counts as missing everywhere, as it would otherwise poison every aggregate."""
    column = F.col(name)
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.nanvl(column, F.lit(None).cast(dtype))
    return column


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def number_sql(name: str) -> str:
    """A column as double, NULL where its text is no number or the number is NaN.

    ``nanvl`` names the value once; a CASE would evaluate the column's expression twice.
    """
    return f"nanvl(try_cast({quoted(name)} AS DOUBLE), CAST(NULL AS DOUBLE))"


def coerce_numeric(name: str) -> Column:
    return F.expr(number_sql(name))


def fill_missing(column: Column, value: float = 0.0) -> Column:
    """``value`` for NULL and NaN."""
    return F.when(column.isNull() | F.isnan(column), F.lit(value)).otherwise(column)


def risk_band(probability: Column) -> Column:
    return (
        F.when(probability < LOW_BELOW, "low")
        .when(probability < MEDIUM_BELOW, "medium")
        .when(probability.isNotNull(), "high")
    )


def threshold_label(probability: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    return (probability >= threshold).cast("int")


def hash_bucket(column: Column | str, buckets: int = 100) -> Column:
    """Stable bucket of a key: the first 32 bits of its md5, modulo ``buckets``."""
    text = F.col(column).cast("string") if isinstance(column, str) else column.cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def statement_cycle(explicit: Column, statement_date: Column, now: Column | None = None) -> Column:
    """The stated cycle, else the month of the statement date text, else the current UTC month."""
    current = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()) if now is None else now
    return F.coalesce(
        F.nullif(explicit, F.lit("")),
        F.when(F.length(statement_date) >= 7, F.substring(statement_date, 1, 7)),
        F.date_format(current, "yyyy-MM"),
    )


def decode_message(body: Column, schema: StructType, encoded: bool = True) -> Column:
    """Base64 JSON text to a struct.  Bad base64 and bad JSON give NULL; a JSON value that
    is not an object gives NULL fields, so validate on a required one."""
    text = F.try_to_binary(body, F.lit("base64")).cast("string") if encoded else body
    return F.from_json(text, schema)


def json_object(text: Column) -> Column:
    """Whether the text is a JSON object at all."""
    return F.coalesce(F.json_object_keys(text).isNotNull(), F.lit(False))
