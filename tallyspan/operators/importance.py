"""Ranking and selecting features by importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.skew import running_sums


def cumulative_importance(df: DataFrame, feature: str = "feature", importance: str = "importance") -> DataFrame:
    """(feature, importance, importance_fraction, cumulative_importance, rank), most
    important first, names breaking ties.  A total of 0 gives fractions of 0."""
    rows = df.select(
        F.col(feature).alias("feature"),
        F.col(importance).cast("double").alias("importance"),
        F.lit(1).cast("bigint").alias("_one"),
    )
    order = [F.col("importance").desc(), F.col("feature").asc()]
    ranked = running_sums(rows, [], order, ["importance", "_one"])
    share = lambda c: F.when(F.col("importance_total") > 0, F.col(c) / F.col("importance_total")).otherwise(0.0)
    return ranked.select(
        "feature",
        "importance",
        share("importance").alias("importance_fraction"),
        share("importance_cum").alias("cumulative_importance"),
        F.col("_one_cum").alias("rank"),
    )


def selection_size(ranked: DataFrame, threshold: float, min_features: int, max_features: int) -> int:
    """How many of the ranked features reach the cumulative threshold, within the limits."""
    if not 0 < threshold <= 1:
        raise ValueError("The selection threshold must be in (0, 1].")
    if min_features <= 0:
        raise ValueError("min_features must be positive.")
    if max_features < min_features:
        raise ValueError("max_features must be at least min_features.")
    total, within = ranked.agg(
        F.count(F.lit(1)), F.count_if(F.col("cumulative_importance") <= threshold)
    ).first()
    if total == 0:
        raise ValueError("Cannot select features from an empty importance table.")
    reached = within if within == total else within + 1
    return min(max(reached, min_features), max_features, total)


def select_features(
    df: DataFrame, threshold: float = 0.95, min_features: int = 300, max_features: int = 1000,
    feature: str = "feature", importance: str = "importance",
) -> DataFrame:
    """The ranked table with ``selected`` marking the chosen features."""
    ranked = cumulative_importance(df, feature, importance)
    size = selection_size(ranked, threshold, min_features, max_features)
    return ranked.withColumn("selected", F.col("rank") <= size)


def top_importance(df: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` most important features by ``importance_mean`` if present, else ``importance``."""
    column = "importance_mean" if "importance_mean" in df.columns else "importance"
    return df.orderBy(F.col(column).desc(), "feature").limit(n)


def mean_fold_importance(df: DataFrame, folds: int, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Mean and sample std over all folds of (feature, fold, importance) rows.

    A feature absent from a fold counts as 0 there, so the folds need no outer join:
    the denominator is simply the number of folds.
    """
    value = F.col("importance").cast("double")
    # at most one value per fold and feature; distances are taken from the mean itself
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_s"), F.collect_list(value).alias("_v"))
    mean = F.col("_s") / folds
    if folds > 1:
        apart = F.aggregate("_v", F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean))
        std = F.sqrt((apart + (folds - F.size("_v")) * mean * mean) / (folds - 1))
    else:
        std = F.lit(0.0)
    return sums.select(*keys, mean.alias("importance_mean"), std.alias("importance_std"))


def top_missing(missing: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` columns with the highest missing percentage."""
    return missing.orderBy(F.col("missing_pct").desc(), "column").limit(n)
