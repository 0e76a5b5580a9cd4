"""Exact grouped quantiles for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.skew import join_small, null_safe, running_sums, split_hot
from tallyspan.session import materialise
from tallyspan.spec import HOT_ROWS


# In an input too large for one task, a group beyond this many rows is large as well:
# a scan task meets many groups at once and would hold the values of all of them.
GROUP_ROWS = 10_000

# A sketch misses a rank by one part in ``SKETCH`` of its group at most; a bracket reaches
# ``MARGIN`` such parts to each side of the wanted rank.
SKETCH = 10_000
MARGIN = 4


def grouped_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Linearly interpolated quantiles per group as ``quantiles: array<double>``.

    The built-in ``percentile`` keeps a group's distinct values in one task, which
    suits ordinary groups; larger ones go through ``distributed_quantiles``.
    """
    present = df.where(F.col(value).isNotNull())
    usual, hot = split_hot(present, by, hot_rows, GROUP_ROWS)
    exact = usual.groupBy(*by).agg(
        F.percentile(value, F.array(*[F.lit(float(p)) for p in probs])).alias("quantiles")
    )
    if hot is None:
        return exact
    return exact.unionByName(distributed_quantiles(hot, by, value, probs))


def between(low: Column, high: Column, part: Column) -> Column:
    """Linear interpolation that stays put where there is nothing to cross, so that two
    infinite ends give Infinity and not NaN."""
    return F.when((low == high) | (part == 0), low).otherwise(low + (high - low) * part)


def distributed_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]
) -> DataFrame:
    """The same quantiles read off a running count of a compressed histogram.

    A sketch brackets each wanted rank.  Values inside a bracket are counted one by one,
    those between brackets only as a whole, so that what is sorted is about a thousandth
    of a group for each probability.  Should a bracket miss its rank, which the histogram
    shows, its group is counted again with every value kept.
    """
    present = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    found = materialise(ranked_ends(bracketed(present, by, probs), by, probs))
    missed = found.where("lost").select(*by).distinct()
    if not missed.isEmpty():
        again = null_safe(present, missed, by, "left_semi")
        whole = ranked_ends(every_value(again, by), by, probs)
        found = null_safe(found, missed, by, "left_anti").unionByName(whole)
    return (
        found.select(*by, "i", between(F.col("lo"), F.col("hi"), F.col("part")).alias("q"))
        .groupBy(*by)
        .agg(F.array_sort(F.collect_list(F.struct("i", "q"))).alias("pairs"))
        .select(*by, F.col("pairs.q").alias("quantiles"))
    )


def every_value(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """The histogram with every distinct value: (by, _part, _v, _n)."""
    return values.groupBy(*by, F.lit(0).alias("_part"), "_v").agg(F.count(F.lit(1)).alias("_n"))


def bracketed(values: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The histogram (by, _part, _v, _n) that keeps values inside brackets only.

    ``_part`` is the number of brackets that begin at or below a value; the rows of a part
    that lie above its bracket are one row without a value, which sorts after the others.
    Groups smaller than the sketch is fine keep every value.
    """
    reach, wanted = MARGIN / SKETCH, sorted(set(probs))
    bounds = [max(0.0, p - reach) for p in wanted] + [min(1.0, p + reach) for p in wanted]
    size = len(wanted)
    v = F.nanvl("_v", F.lit(float("inf")))  # the sketch has no place for NaN, which sorts last
    sketch = F.percentile_approx(v, F.array(*[F.lit(b) for b in bounds]), F.lit(SKETCH))
    open_ends = F.array(*[F.lit(e) for e in [float("-inf")] * size + [float("inf")] * size])
    brackets = values.groupBy(*by).agg(
        F.when(F.count(F.lit(1)) < SKETCH, open_ends).otherwise(sketch).alias("_b")
    )
    begun = F.lit(0)
    for i in range(size):
        begun = begun + F.when(v >= F.get("_b", F.lit(i)), 1).otherwise(0)
    placed = join_small(values, brackets, by).select(*by, begun.alias("_part"), "_v", "_b")
    inside = v <= F.get("_b", F.col("_part") - 1 + size)
    return placed.groupBy(*by, "_part", F.when((F.col("_part") > 0) & inside, F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )


def ranked_ends(histogram: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(by, i, lo, hi, part, lost) for each probability: the values at the ranks around it and
    how far it lies between them; lost if a rank fell outside the brackets."""
    placed = running_sums(histogram, by, [F.col("_part").asc(), F.col("_v").asc_nulls_last()], ["_n"])
    first, past = F.col("_n_cum") - F.col("_n"), F.col("_n_cum")
    wanted = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("_n_total") - 1)).alias("at")
            )
            for i, p in enumerate(probs)
        ]
    )

    def touches(w):
        low, high = F.floor(w["at"]), F.ceil(w["at"])
        return ((low >= first) & (low < past)) | ((high >= first) & (high < past))

    hits = placed.select(
        *by, "_v", first.alias("_first"), past.alias("_past"),
        F.explode(F.filter(wanted, touches)).alias("w"),
    )
    at, low, high = F.col("w.at"), F.floor("w.at"), F.ceil("w.at")
    here = lambda p: F.when((p >= F.col("_first")) & (p < F.col("_past")), F.col("_v"))
    return hits.groupBy(*by, F.col("w.i").alias("i")).agg(
        F.max(here(low)).alias("lo"),
        F.max(here(high)).alias("hi"),
        F.max(at - low).alias("part"),
        F.max(F.col("_v").isNull()).alias("lost"),
    )
