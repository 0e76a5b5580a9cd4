"""Population stability of every numeric column, all columns in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.scalar import coerce_numeric
from tallyspan.operators.quantiles import grouped_quantiles
from tallyspan.session import materialise
from tallyspan.spec import HOT_ROWS, infer_continuous

# Drift threshold, number of bins, and the share that stands in for an empty bin.
PSI_THRESHOLD = 0.2
BINS = 10
EMPTY_SHARE = 0.0001


def numeric_in_common(baseline: DataFrame, current: DataFrame, exclude: Sequence[str]) -> list[str]:
    present = set(current.columns)
    return [c for c in infer_continuous(baseline, exclude) if c in present]


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_name, v) rows without missing values."""
    return (
        df.select(*[coerce_numeric(c).alias(c) for c in columns])
        .unpivot([], list(columns), "feature_name", "v")
        .where(F.col("v").isNotNull())
    )


def quantile_edges(
    values: DataFrame, bins: int = BINS, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Distinct sorted quantile edges per feature of (feature_name, v) rows."""
    probs = [i / bins for i in range(bins + 1)]
    return grouped_quantiles(values, ["feature_name"], "v", probs, hot_rows).select(
        "feature_name", F.array_sort(F.array_distinct("quantiles")).alias("edges")
    )


def _bin(value: Column, edges: Column, bins: int) -> Column:
    """0-based bin of a value inside the edges; the last bin is closed.  Written as a sum
    of comparisons, so it stays in generated code."""
    inner_above = [
        ((F.size(edges) - 1 > i) & (value >= F.get(edges, F.lit(i)))) for i in range(1, bins)
    ]
    total = F.lit(0)
    for above in inner_above:
        total = total + F.when(above, 1).otherwise(0)
    return total


OUTSIDE = -1


def binned_counts(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = BINS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One row per column: ``edges`` and ``counts``, an array of (current?, bin, n).

    Both sides are counted in one pass; values outside the edges count in bin -1.  The
    edges are one row per column of the feature table, a size its schema fixes, so they
    are broadcast and no value is shuffled before it is counted.
    """
    base = long_values(baseline, columns)
    edges = materialise(quantile_edges(base, bins, hot_rows))  # read twice below
    both = base.withColumn("_current", F.lit(False)).unionByName(
        long_values(current, columns).withColumn("_current", F.lit(True))
    )
    e = F.col("edges")
    inside = (F.size(e) >= 2) & (F.col("v") >= F.get(e, F.lit(0))) & (F.col("v") <= F.element_at(e, -1))
    place = F.when(inside, _bin(F.col("v"), e, bins)).otherwise(OUTSIDE)
    counted = (
        both.join(F.broadcast(edges), "feature_name", "left")
        .groupBy("feature_name", F.col("_current").alias("current"), place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    packed = counted.groupBy("feature_name").agg(
        F.collect_list(F.struct("current", "bin", "n")).alias("counts")
    )
    return packed.join(F.broadcast(edges), "feature_name", "left")


def _count(current: bool, bin_number: Column | None = None) -> Column:
    """Rows of one side, in one bin or in all."""
    side = lambda c: c["current"] if current else ~c["current"]
    here = (lambda c: side(c) & (c["bin"] == bin_number)) if bin_number is not None else side
    zero = F.lit(0).cast("bigint")
    return F.aggregate("counts", zero, lambda acc, c: acc + F.when(here(c), c["n"]).otherwise(zero))


def _bins() -> Column:
    """Every bin as (bin, lower, upper, baseline_n, current_n); none below two edges."""
    last = F.size("edges") - 2
    numbers = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        numbers,
        lambda i: F.struct(
            i.alias("bin"), F.get("edges", i).alias("lower"), F.get("edges", i + 1).alias("upper"),
            _count(False, i).alias("baseline_n"), _count(True, i).alias("current_n"),
        ),
    )


def psi_bins(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = BINS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """(feature_name, bin, lower, upper, baseline_n, current_n) for every bin, empty ones too.
    Current values outside the baseline range are in no bin."""
    counted = binned_counts(baseline, current, columns, bins, hot_rows)
    return counted.where(F.col("edges").isNotNull()).select("feature_name", F.inline(_bins()))


def psi(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = BINS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """(feature_name, psi, baseline_rows, current_rows).

    0 where the baseline is constant, NaN where a side has no values.  An empty bin
    counts as a share of ``EMPTY_SHARE``.
    """
    counted = binned_counts(baseline, current, columns, bins, hot_rows)
    zero = F.lit(0).cast("bigint")
    rows = counted.select(
        "feature_name", _bins().alias("bins"),
        _count(False).alias("baseline_rows"), _count(True).alias("current_rows"),
    ).withColumns(
        {
            "b_all": F.aggregate("bins", zero, lambda acc, x: acc + x["baseline_n"]),
            "c_all": F.aggregate("bins", zero, lambda acc, x: acc + x["current_n"]),
        }
    )

    def share(count: Column, total: Column) -> Column:
        part = count / F.greatest(total, F.lit(1).cast("bigint"))
        return F.when(part == 0, EMPTY_SHARE).otherwise(part)

    def term(x: Column) -> Column:
        b, c = share(x["baseline_n"], F.col("b_all")), share(x["current_n"], F.col("c_all"))
        return (c - b) * F.ln(c / b)

    index = F.aggregate("bins", F.lit(0.0), lambda acc, x: acc + term(x))
    # a column without any value on either side has no row yet
    names = baseline.sparkSession.createDataFrame([(c,) for c in columns], "feature_name string")
    joined = names.join(rows.withColumn("_psi", index), "feature_name", "left")
    b_rows, c_rows = F.coalesce("baseline_rows", zero), F.coalesce("current_rows", zero)
    value = F.when((b_rows == 0) | (c_rows == 0), F.lit(float("nan"))).otherwise(F.col("_psi"))
    return joined.select(
        "feature_name", value.alias("psi"), b_rows.alias("baseline_rows"), c_rows.alias("current_rows")
    )


def drift_report(
    baseline: DataFrame,
    current: DataFrame,
    exclude: Sequence[str],
    *,
    bins: int = BINS,
    threshold: float = PSI_THRESHOLD,
    baseline_dates: tuple[str | None, str | None] = (None, None),
    current_dates: tuple[str | None, str | None] = (None, None),
    computed_at: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One row per numeric column the two tables share, most drifted first.  The dates are
    recorded, not applied."""
    columns = numeric_in_common(baseline, current, exclude)
    scored = psi(baseline, current, columns, bins, hot_rows)
    text = lambda v: F.lit(v).cast("string")
    return scored.select(
        "feature_name",
        "psi",
        (~F.isnan("psi") & (F.col("psi") > threshold)).alias("drifted"),
        F.lit(threshold).alias("threshold"),
        "baseline_rows",
        "current_rows",
        text(baseline_dates[0]).alias("baseline_start_date"),
        text(baseline_dates[1]).alias("baseline_end_date"),
        text(current_dates[0]).alias("current_start_date"),
        text(current_dates[1]).alias("current_end_date"),
        (F.current_timestamp() if computed_at is None else computed_at).alias("computed_at"),
    ).orderBy(F.when(F.isnan("psi"), None).otherwise(F.col("psi")).desc_nulls_last(), "feature_name")


def drift_alerts(
    report: DataFrame, thresholds: Mapping[str, float], default: float = PSI_THRESHOLD
) -> DataFrame:
    """Each feature against its own threshold, or the default one."""
    own = F.lit(default)
    if thresholds:
        pairs = [F.lit(x) for item in thresholds.items() for x in item]
        own = F.coalesce(F.create_map(*pairs)[F.col("feature_name")], F.lit(default))
    return report.select(
        "feature_name", "psi", own.alias("alert_threshold"),
        (~F.isnan("psi") & (F.col("psi") > own)).alias("alert"),
    )
