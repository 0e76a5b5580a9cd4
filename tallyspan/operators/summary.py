"""Descriptive summaries of statements, labels and numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.operators.quantiles import grouped_quantiles
from tallyspan.operators.skew import join_small
from tallyspan.spec import HOT_ROWS


def statement_counts(df: DataFrame, key: str) -> DataFrame:
    """How many entities have how many statements."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_statements"))
    return per_key.groupBy("n_statements").agg(F.count(F.lit(1)).alias("n_keys"))


def statement_describe(df: DataFrame, key: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of the statements per entity.

    Works on the histogram of counts; its size is the number of different counts,
    at most about the square root of twice the number of statements.
    """
    n, w = F.col("n_statements").cast("double"), F.col("n_keys")
    whole = Window.partitionBy(F.lit(0))  # the histogram is small, and only it is gathered
    histogram = statement_counts(df, key).withColumn("_mean", F.sum(n * w).over(whole) / F.sum(w).over(whole))
    total, first, apart = F.sum(w), F.sum(n * w), F.sum(w * (n - F.col("_mean")) * (n - F.col("_mean")))
    row = histogram.agg(
        F.coalesce(total, F.lit(0).cast("bigint")).alias("count"),
        F.try_divide(first, total).alias("mean"),
        F.when(total > 1, F.sqrt(apart / (total - 1))).alias("std"),
        F.min(n).alias("min"),
        F.percentile("n_statements", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), w).alias("_q"),
        F.max(n).alias("max"),
    )
    return row.select(
        "count", "mean", "std", "min",
        F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"),
        "max",
    )


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Rows and share per class; the shares come from a handful of class rows."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_all")).first()["_all"]
    return counts.withColumn("share", F.col("n") / F.lit(total).cast("double"))


def categorical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values counting NULL as one, and percent missing, per column."""
    values = df.select(*[F.col(c).cast("string") for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    kinds = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return kinds.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_unique"),
        (F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)) * 100.0 / F.sum("n")).alias(
            "missing_pct"
        ),
    )


def rate_by_category(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Mean target and rows per observed category, all columns in one pass."""
    values = df.select(F.col(target).alias("_target"), *[F.col(c).cast("string") for c in columns])
    return (
        values.unpivot(["_target"], list(columns), "column", "category")
        .where(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("_target").alias("rate"))
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from min to max, the last one closed; empty bins included."""
    if bins <= 0:
        raise ValueError("At least one bin is needed.")
    values = df.select(F.col(column).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    low, high = values.agg(F.min("v"), F.max("v")).first()
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").alias("bin"))
    if low is None:
        low = high = 0.0
    if low == high:  # a constant column gets a unit range around it
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    counts = values.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def box_stats(
    df: DataFrame, columns: Sequence[str], group: str, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Quartiles, and whiskers at the furthest value within 1.5 IQR, per group and column."""
    values = (
        df.select(F.col(group).alias("_group"), *[F.col(c).cast("double") for c in columns])
        .unpivot(["_group"], list(columns), "column", "v")
        .where(F.col("v").isNotNull())
    )
    keys = ["_group", "column"]
    quartiles = grouped_quantiles(values, keys, "v", [0.25, 0.5, 0.75], hot_rows).select(
        *keys,
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )
    # one row per class and column; unsplit, such a join would send a class to one task
    boxed = join_small(values, quartiles, keys)
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    whiskered = boxed.groupBy(*keys, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.min(F.when(F.col("v") >= F.col("q1") - spread, F.col("v"))).alias("whisker_low"),
        F.max(F.when(F.col("v") <= F.col("q3") + spread, F.col("v"))).alias("whisker_high"),
    )
    return whiskered.withColumnRenamed("_group", group)


def scale_pos_weight(df: DataFrame, target: str) -> DataFrame:
    """Negatives per positive; NULL without positives."""
    positive, total = F.sum(F.col(target).cast("bigint")), F.count(target)
    return df.agg(
        positive.alias("positives"),
        (total - positive).alias("negatives"),
        F.when(positive > 0, (total - positive) / positive).alias("scale_pos_weight"),
    )


def positive_weight(df: DataFrame, target: str) -> float:
    weight = scale_pos_weight(df, target).first()["scale_pos_weight"]
    if weight is None:
        raise ValueError("No positive examples in target.")
    return weight
