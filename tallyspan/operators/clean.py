"""Cleaning of statement tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from tallyspan.functions.scalar import as_date, coerce_numeric, nan_to_null, parse_date
from tallyspan.spec import require_columns

# Fixed value: columns with more than this share missing are dropped.
MISSING_THRESHOLD = 80.0


def nan_as_null(df: DataFrame) -> DataFrame:
    """Every floating column with NaN turned into NULL."""
    return df.select(*[nan_to_null(f.name, f.dataType).alias(f.name) for f in df.schema.fields])


def clean_dates(df: DataFrame, column: str, parsed: str | None = None) -> DataFrame:
    """Parse a text date; malformed text becomes NULL and is flagged in ``{parsed}_rejected``."""
    name = parsed or column
    value = parse_date(column)
    rejected = F.col(column).isNotNull() & value.isNull()
    return df.withColumns({f"{name}_rejected": rejected, name: value})


def filter_dates(
    df: DataFrame, column: str, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Rows within the dates, both inclusive and each optional.

    The bound is put on the column itself, so that it reaches the file scan: a
    timestamp is "through day d" if it is before d + 1.
    """
    when = as_date(column, df.schema[column].dataType)  # text is parsed, malformed text falls out
    if start is not None:
        df = df.where(when >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.where(when < F.date_add(F.lit(str(end)).cast("date"), 1))
    return df


def missing_percent(df: DataFrame) -> DataFrame:
    """(column, missing_pct) with NULL and NaN both missing; one pass, one row, then turned."""
    row = df.agg(
        *[
            F.try_divide(
                F.count_if(nan_to_null(f.name, f.dataType).isNull()) * 100.0, F.count(F.lit(1))
            ).alias(f.name)
            for f in df.schema.fields
        ]
    )
    return row.unpivot([], df.columns, "column", "missing_pct")


def sparse_columns(df: DataFrame, required: Sequence[str], threshold: float = MISSING_THRESHOLD) -> list[str]:
    """Names of the columns more than ``threshold`` percent missing, the required ones apart.
    The driver receives one number per column."""
    if not 0 <= threshold <= 100:
        raise ValueError("The missing threshold must be between 0 and 100.")
    require_columns(df, required)
    found = {r["column"]: r["missing_pct"] for r in missing_percent(df).collect()}
    if not found or all(v is None for v in found.values()):
        raise ValueError("Input dataset is empty.")
    return [c for c in df.columns if c not in required and found[c] > threshold]


def drop_sparse_columns(
    df: DataFrame, required: Sequence[str], threshold: float = MISSING_THRESHOLD
) -> tuple[DataFrame, list[str]]:
    dropped = sparse_columns(df, required, threshold)
    return df.drop(*dropped), dropped


def cast_categoricals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Named columns to text where present."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns if c in df.columns})


def coerce_numbers(df: DataFrame, columns: Sequence[str], missing: str = "omit") -> DataFrame:
    """Named columns to double, NULL where not a number.  An absent column is left out,
    or added as NULL with ``missing="null"``."""
    changed: dict[str, Column] = {c: coerce_numeric(c) for c in columns if c in df.columns}
    if missing == "null":
        changed |= {c: F.lit(None).cast("double") for c in columns if c not in df.columns}
    return df.withColumns(changed)


def downcast_floats(df: DataFrame) -> DataFrame:
    """Every double column to float."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("float") for f in df.schema.fields if isinstance(f.dataType, DoubleType)}
    )


def align_categories(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Hold text columns to their known categories: an unseen value becomes NULL, an
    absent column the first category."""

    def one(name: str, known: Sequence[str]) -> Column:
        if name not in df.columns:
            return F.lit(known[0] if known else "")
        return F.when(F.col(name).isin(list(known)), F.col(name))

    return df.withColumns({n: one(n, k) for n, k in categories.items()})


def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) of every category of the text columns: a table, so of any size."""
    known = df.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "column", "value")
    return known.where(F.col("value").isNotNull()).distinct()


def align_to_table(df: DataFrame, known: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``align_categories`` with the categories of a ``category_table``.

    A column's categories join by value, by broadcast where Spark knows them to be small, so a
    column may have more of them than a driver holds.  An absent column gets its first category.
    """
    names = df.columns
    for i, c in enumerate(columns):
        own = known.where(F.col("column") == c)
        if c in names:
            side = own.select(F.col("value").alias(f"_known_{i}"))
            value = F.when(F.col(f"_known_{i}").isNotNull(), F.col(c))
            df = df.join(side, F.col(c).cast("string") == F.col(f"_known_{i}"), "left").withColumn(c, value).drop(f"_known_{i}")
        else:
            first = own.agg(F.coalesce(F.min("value"), F.lit("")).alias(c))
            df = df.join(F.broadcast(first))  # one row
            names = [*names, c]
    return df.select(*names)


def learn_categories(df: DataFrame, columns: Sequence[str], limit: int = 10_000) -> dict[str, list[str]]:
    """Sorted categories per text column as lists, to be kept in a document beside a model.

    Lists go through the driver, so a column with more than ``limit`` of them is an error;
    ``category_table`` and ``align_to_table`` take columns of any size.
    """
    known = category_table(df, columns)
    sizes = {r["column"]: r["count"] for r in known.groupBy("column").count().collect()}
    large = sorted(c for c, n in sizes.items() if n > limit)
    if large:
        raise ValueError(f"Too many categories in {large}.")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in known.collect():
        found[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in found.items()}


def split_features_target(df: DataFrame, key: str, target: str) -> tuple[list[str], list[str], DataFrame]:
    """(numeric feature columns, text feature columns, frame with an integer target)."""
    require_columns(df, [key, target])
    rest = [f for f in df.schema.fields if f.name not in (key, target)]
    text = [f.name for f in rest if isinstance(f.dataType, StringType)]
    numeric = [f.name for f in rest if f.name not in text]
    return numeric, text, df.withColumn(target, F.col(target).cast("int"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in full.  Copies combine before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def sorted_within(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows of a key together and in order inside each file; no global sort."""
    return df.repartition(key).sortWithinPartitions(key, *order)
