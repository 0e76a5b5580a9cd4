"""Position of each statement within its entity, and the statement before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.operators.skew import CELL, SLICE, cell, ordered_slices, slice_totals, split_hot
from tallyspan.spec import HOT_ROWS, TIE, Spec

FROM_START = "_rn_asc"
FROM_END = "_rn_desc"
PREVIOUS = "_prev"
COPY_BLOCK = 1_000_000


def sequence_parts(
    df: DataFrame, spec: Spec, lagged: Column | None = None, hot_rows: int | None = HOT_ROWS,
    key_rows: int | None = None, total: int | None = None, tasks: int | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """``with_sequence`` kept apart for ordinary and for hot entities, the ordinary ones dealt to ``tasks``."""
    usual, hot = split_hot(df, [spec.id], hot_rows, key_rows, total)
    if tasks is not None:
        usual = usual.repartition(tasks, spec.id)
    return _sequence(usual, spec, lagged), None if hot is None else _sequence_sliced(hot, spec, lagged)


def with_sequence(
    df: DataFrame, spec: Spec, lagged: Column | None = None, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Add the position from the start and from the end of the entity's history, and
    in ``_prev`` the value of ``lagged`` on the row before."""
    columns = df.columns
    df, spec = spec.total_order(df)
    usual, hot = sequence_parts(df, spec, lagged, hot_rows)
    both = usual if hot is None else usual.unionByName(hot)
    return both if TIE in columns else both.drop(TIE)


def _sequence(df: DataFrame, spec: Spec, lagged: Column | None) -> DataFrame:
    """One shuffle and one sort: the position from the end is the group size minus the
    position from the start, which also makes the two orders exact opposites."""
    ordered = Window.partitionBy(spec.id).orderBy(*spec.order())
    whole = Window.partitionBy(spec.id)
    return df.select(
        "*",
        F.row_number().over(ordered).alias(FROM_START),
        *([F.lag(lagged).over(ordered).alias(PREVIOUS)] if lagged is not None else []),
        F.count(F.lit(1)).over(whole).alias("_size"),
    ).select(
        *df.columns,
        F.col(FROM_START).cast("bigint").alias(FROM_START),
        (F.col("_size") - F.col(FROM_START) + 1).alias(FROM_END),
        *([PREVIOUS] if lagged is not None else []),
    )


def _sequence_sliced(df: DataFrame, spec: Spec, lagged: Column | None) -> DataFrame:
    """The same columns for entities too large for one task.

    Windows run inside time slices; what a slice needs from the ones before it - how
    many rows they hold, and the last value - is one row per slice.
    """
    rows = df if spec.unique_order else number_copies(df)
    extra = [] if spec.unique_order else [F.xxhash64(*df.columns), F.col("_copy")]
    order = [*spec.order(), *extra]
    sliced = ordered_slices(rows, [F.col(spec.id), *order])
    inside = Window.partitionBy(CELL).orderBy(*order)
    local = sliced.withColumn(CELL, cell([spec.id])).select(
        "*",
        F.row_number().over(inside).alias("_at"),
        *([F.lag(lagged).over(inside).alias("_inside")] if lagged is not None else []),
    )
    edges = slice_totals(sliced, [spec.id], {"_n": F.count(F.lit(1))}).drop(spec.id)
    columns = [
        *df.columns,
        (F.col("_n_before") + F.col("_at")).alias(FROM_START),
        (F.col("_n_total") - F.col("_n_before") - F.col("_at") + 1).alias(FROM_END),
    ]
    if lagged is not None:
        tail_order = F.struct(*[c for c in spec.order_columns], *[e.alias(f"_o{i}") for i, e in enumerate(extra)])
        tails = sliced.groupBy(spec.id, SLICE).agg(
            F.max_by(F.struct(lagged.alias("v")), tail_order).alias("_tail")
        )
        carried = F.lag("_tail").over(Window.partitionBy(spec.id).orderBy(SLICE))
        edges = edges.join(tails.select(cell([spec.id]), carried.alias("_carried")), CELL)
        columns.append(
            F.when(F.col("_at") == 1, F.col("_carried.v")).otherwise(F.col("_inside")).alias(PREVIOUS)
        )
    return local.join(edges, CELL).select(*columns)


def number_copies(df: DataFrame) -> DataFrame:
    """Number identical rows 0, 1, 2... in ``_copy``.

    Copies are first combined into one row with a count, then dealt out again in
    blocks, so a row repeated any number of times is never gathered in one task.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    last_block = F.floor((F.col("_n") - 1) / COPY_BLOCK)
    blocks = counted.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("_b"))
    spread = blocks.repartition(*df.columns, "_b")
    start = F.col("_b") * COPY_BLOCK
    end = F.least(start + COPY_BLOCK, F.col("_n")) - 1
    return spread.select(*df.columns, F.explode(F.sequence(start, end)).alias("_copy"))


def latest_rows(df: DataFrame, spec: Spec, n: int = 1) -> DataFrame:
    """The last ``n`` statements of each entity.

    Catalyst keeps the best ``n`` rows per entity already before the shuffle
    (WindowGroupLimit), so hot entities send ``n`` rows per task.
    """
    columns = df.columns
    df, spec = spec.total_order(df)
    newest_first = [F.col(c).desc_nulls_last() for c in spec.order_columns]
    rank = F.row_number().over(Window.partitionBy(spec.id).orderBy(*newest_first))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).select(*columns)
