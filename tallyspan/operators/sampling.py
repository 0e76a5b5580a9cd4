"""Splits, samples and folds that any engine reproduces, because only hashes decide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.scalar import hash_bucket
from tallyspan.operators.skew import CELL, cell, hash_rank, ordered_slices, slice_totals

# Seed and number of folds.
SEED = 42
FOLDS = 5

# Up to this many first rows are merged in one task.
ONE_TASK_ROWS = 10_000


def hash_split(df: DataFrame, key: str, train_ratio: float) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the key's hash bucket; all rows of a key fall on one side, those
    without a key on the test side."""
    if not 0 < train_ratio < 1:
        raise ValueError("The train ratio must be between 0 and 1.")
    edge = round(train_ratio * 100)
    bucket = hash_bucket(key)
    return df.where(bucket < edge), df.where(F.coalesce(bucket >= edge, F.lit(True)))


def limited_scan(
    df: DataFrame, max_rows: int | None, order: Sequence[str], one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """The whole table, or its first ``max_rows`` rows along ``order``.

    A few rows are merged in one task; more are cut from range slices, one row of which
    gives its size, and slices that lie beyond the limit are not read.
    """
    if max_rows is None:
        return df
    if max_rows <= 1:
        raise ValueError("max_rows must be greater than 1.")
    if max_rows <= one_task_rows:
        return df.orderBy(*order).limit(max_rows)
    sliced = ordered_slices(df, order)
    offsets = slice_totals(sliced, [], {"_n": F.count(F.lit(1))}).where(F.col("_n_before") < max_rows)
    joined = sliced.select(*df.columns, cell([])).join(F.broadcast(offsets), CELL)
    place = F.row_number().over(Window.partitionBy(CELL).orderBy(*order)) + F.col("_n_before")
    return joined.select(*df.columns, place.alias("_place")).where(F.col("_place") <= max_rows).select(*df.columns)


def balanced_sample(df: DataFrame, key: str, target: str, max_rows: int, seed: int = SEED) -> DataFrame:
    """Half positives (at least one), the rest negatives; both in hash order."""
    if max_rows <= 1:
        raise ValueError("max_rows must be greater than 1.")
    positives = max(1, max_rows // 2)
    share = F.when(F.col(target) == 1, positives).when(F.col(target) == 0, max_rows - positives)
    ranked = hash_rank(df, [target], [key], seed, rank="_rank", limit=share)
    return ranked.drop("_rank", "_rank_of")


def stratified_sample(
    df: DataFrame, key: str, target: str, fraction: float, seed: int = SEED
) -> DataFrame:
    """The same exact fraction of every class, rounded to the nearest row."""
    wanted = F.round(F.col("_rank_of") * F.lit(fraction))
    ranked = hash_rank(df, [target], [key], seed, rank="_rank", limit=wanted)
    return ranked.drop("_rank", "_rank_of")


def bernoulli_stratified(df: DataFrame, target: str, fractions: dict[int, float], seed: int = SEED) -> DataFrame:
    """Each row kept independently with its class's probability: no shuffle at all."""
    return df.sampleBy(target, fractions, seed)


def stratified_folds(
    df: DataFrame, key: str, target: str, folds: int = FOLDS, seed: int = SEED, name: str = "fold"
) -> DataFrame:
    """Fold 1..k per row; within every class, fold sizes differ by at most one."""
    if folds < 2:
        raise ValueError("At least two folds are needed.")
    ranked = hash_rank(df, [target], [key], seed, rank="_rank")
    return ranked.withColumn(name, ((F.col("_rank") - 1) % folds + 1).cast("int")).drop("_rank", "_rank_of")


def sample_n(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows in hash order, or all when there are fewer."""
    ranked = hash_rank(df, [], [key], seed, rank="_rank", limit=F.lit(n))
    return ranked.drop("_rank", "_rank_of")


def sample_rate(df: DataFrame, rate: float, seed: int = SEED) -> DataFrame:
    """Each row kept independently with probability ``rate``."""
    return df.sample(withReplacement=False, fraction=rate, seed=seed)
