"""Ordered work on groups of any size.

Spark puts one window partition, and one exact percentile, in one task.  That is
right for ordinary keys and wrong for a key that owns a third of the table.  The
helpers here find such keys and cut ordered data into contiguous slices, so that
every window runs inside a slice and only one row per slice crosses slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.session import ensure_checkpoint_dir, materialise
from tallyspan.spec import HOT_ROWS

# Up to this many keys are broadcast; more are joined as Spark chooses.
MAX_HOT_KEYS = 100_000

SLICE = "_slice"
# (group, slice) as one value.  A struct is never NULL even if the group is, so windows
# and plain equi-joins both hash on it, and a join after a window moves nothing.
CELL = "_cell"


def null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys; keeps one copy of the keys."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    condition = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    )
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{c}" for c in on])


def join_small(df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe join with a table that should be tiny; broadcast only if a count proves it.

    Beyond the bound Spark chooses the join, with adaptive skew handling.
    """
    kept = materialise(small)
    return null_safe(df, F.broadcast(kept) if kept.count() <= MAX_HOT_KEYS else kept, on, how)


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS, key_rows: int | None = None,
    total: int | None = None,
) -> DataFrame | None:
    """Keys with more than ``key_rows`` rows, or None: always None if the whole input
    has no more than ``hot_rows``.  ``key_rows`` is ``hot_rows`` unless given; ``total`` spares a count.

    The first count reads no columns and settles small inputs; the second is a
    map-side combined count of the key columns alone.
    """
    if hot_rows is None:
        return None
    total = df.count() if total is None else total
    if total <= hot_rows:
        return None
    bar = hot_rows if key_rows is None else min(key_rows, hot_rows)
    found = materialise(df.groupBy(*keys).count().where(F.col("count") > bar).select(*keys))
    return None if found.isEmpty() else found


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS, key_rows: int | None = None,
    total: int | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of hot keys (None when there are none)."""
    hot = hot_keys(df, keys, hot_rows, key_rows, total)
    if hot is None:
        return df, None
    small = F.broadcast(hot) if hot.count() <= MAX_HOT_KEYS else hot
    return null_safe(df, small, keys, "left_anti"), null_safe(df, small, keys, "left_semi")


def ordered_slices(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Cut rows into balanced slices, contiguous in ``order``, numbered in ``_slice``.

    Range bounds come from a sample, so the result is checkpointed: whatever reads
    a slice number later, or recomputes after a lost executor, sees the same cut.
    Rows with equal order values share a slice.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return (
        df.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id()).checkpoint()
    )


def cell(by: Sequence[str]) -> Column:
    return F.struct(*by, SLICE).alias(CELL)


def slice_totals(sliced: DataFrame, by: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Per cell: what lies before the slice (``{name}_before``) and in the whole group
    (``{name}_total``).  A group spans few slices, so this table has at most
    #slices + #groups rows."""
    per_slice = sliced.groupBy(*by, SLICE).agg(*[c.alias(n) for n, c in sums.items()])
    group = [*by] if by else [F.lit(0)]
    before = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    return per_slice.select(
        *by,
        cell(by),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in sums],
        *[F.sum(n).over(whole).alias(f"{n}_total") for n in sums],
    )


def running_sums(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], sums: Sequence[str]
) -> DataFrame:
    """Inclusive running sums of ``sums`` within ``by`` along ``order``.

    Adds ``{name}_cum`` and ``{name}_total``.  ``order`` must be unique within
    ``by``.  The window, and the join after it, hash on the cell, so a single group of
    any size still spreads over all tasks.
    """
    sliced = ordered_slices(df, [*[F.col(c) for c in by], *order])
    offsets = slice_totals(sliced, by, {s: F.sum(s) for s in sums}).drop(*by)
    inside = (
        Window.partitionBy(CELL).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    celled = sliced.select(*df.columns, cell(by))
    local = celled.select("*", *[F.sum(s).over(inside).alias(f"{s}_cum") for s in sums])
    return local.join(offsets, CELL).select(
        *df.columns,
        *[(F.col(f"{s}_cum") + F.col(f"{s}_before")).alias(f"{s}_cum") for s in sums],
        *[F.col(f"{s}_total") for s in sums],
    )


def hash_key(columns: Sequence[str], seed: int | str = "") -> Column:
    """Seeded md5 of the columns: a shuffle order any engine reproduces."""
    parts = [F.col(c).cast("string") for c in columns]
    if seed != "":
        parts.append(F.lit(str(seed)))
    return F.md5(F.concat_ws("|", *parts))


def hash_rank(
    df: DataFrame,
    by: Sequence[str],
    id_columns: Sequence[str],
    seed: int | str = "",
    rank: str = "rank",
    limit: Column | None = None,
    digits: int = 4,
) -> DataFrame:
    """1-based rank of each row within ``by`` in seeded hash order, plus ``{rank}_of``,
    the size of the group.  With ``limit`` (over ``by`` and ``{rank}_of``) only ranks up
    to it are kept, and slices that lie wholly beyond it are dropped before the shuffle.

    Hash values are uniform, so their leading digits already are balanced,
    ordered, reproducible slices: no sampling and no checkpoint is needed.
    """
    keyed = df.withColumn("_hash", hash_key(id_columns, seed)).withColumn(
        SLICE, F.substring("_hash", 1, digits)
    )
    offsets = slice_totals(keyed, by, {"_n": F.count(F.lit(1))}).withColumnRenamed(
        "_n_total", f"{rank}_of"
    )
    if limit is not None:
        offsets = offsets.where(F.col("_n_before") < limit)
    inside = Window.partitionBy(CELL).orderBy("_hash", *id_columns)
    joined = keyed.withColumn(CELL, cell(by)).join(offsets.drop(*by), CELL)
    ranked = joined.select(
        *df.columns,
        (F.row_number().over(inside) + F.col("_n_before")).alias(rank),
        f"{rank}_of",
    )
    return ranked if limit is None else ranked.where(F.col(rank) <= limit)
