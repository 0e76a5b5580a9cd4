"""Entity-level behavioural features from statement rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.names import (
    CATEGORY_STATS, NUMERIC_STATS, RECENT_WINDOWS, Feature, all_features, parse_feature,
)
from tallyspan.functions.scalar import as_date, coerce_numeric, number_sql, quoted
from tallyspan.operators.quantiles import distributed_quantiles
from tallyspan.operators.sequence import FROM_END, FROM_START, PREVIOUS, sequence_parts
from tallyspan.operators.skew import null_safe
from tallyspan.spec import HOT_ROWS, Spec, require_columns

# Up to this many raw columns the aggregates are spelled out per column; beyond it
# the columns are exploded into (position, value) rows after the shuffle.
WIDE_COLUMNS = 8
# A task explodes and sorts about so many values at most; they stay in its memory.
TASK_VALUES = 1_000_000


def prepare_statements(df: DataFrame, spec: Spec, continuous: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Only the columns the features need, typed: dates parsed, numbers double, NaN as NULL."""
    require_columns(df, [spec.id, *spec.order_columns])
    dtype = df.schema[spec.date].dataType
    has_target = spec.target is not None and spec.target in df.columns
    alias = _aliases(spec, [*continuous, *categorical])
    return df.select(
        spec.id,
        as_date(spec.date, dtype).alias(spec.date),
        *spec.tiebreak,
        *([spec.target] if has_target else []),
        *[F.expr(f"{number_sql(c)} AS {quoted(alias[c])}") for c in continuous],
        *[F.expr(f"CAST({quoted(c)} AS STRING) AS {quoted(alias[c])}") for c in categorical],
    )


def _aliases(spec: Spec, columns: Sequence[str]) -> dict[str, str]:
    """Names of the value columns; one that is also the id or in the order gets a second name."""
    roles = {spec.id, *spec.order_columns}
    return {c: f"{c}_value" if c in roles else c for c in columns}


# What the secondary sort of an entity's values gives each of them: its rank among the present
# values of its place, how many those are, and whether it is the first of its kind there.
RANK = "_rank"
PRESENT = "_present"
NEW = "_new"


def exact_median(value: str) -> str:
    """The mean of the two middle values, picked by rank: nothing of a group is held in memory."""
    middle = lambda place: f"max({value}) FILTER (WHERE {RANK} = {place})"
    return f"({middle(f'({PRESENT} + 1) DIV 2')} + {middle(f'{PRESENT} DIV 2 + 1')}) / 2"


def numeric_stats(value: str, change: str, approx: bool, skip_nulls: bool) -> dict[str, str]:
    """SQL of every numeric statistic over ``value`` and its ``change`` from the row before."""
    if skip_nulls:
        last = f"max_by({value}, {FROM_START}) FILTER (WHERE {value} IS NOT NULL)"
        first = f"min_by({value}, {FROM_START}) FILTER (WHERE {value} IS NOT NULL)"
    else:
        last = f"max({value}) FILTER (WHERE {FROM_END} = 1)"
        first = f"max({value}) FILTER (WHERE {FROM_START} = 1)"
    stats = {
        "mean": f"avg({value})",
        "std": f"stddev_samp({value})",
        "min": f"min({value})",
        "max": f"max({value})",
        "median": f"percentile_approx({value}, 0.5)" if approx else exact_median(value),
        "last": last,
        "first": first,
        "diff_mean": f"avg({change})",
        "diff_std": f"stddev_samp({change})",
        "diff_min": f"min({change})",
        "diff_max": f"max({change})",
        "last_minus_mean": f"{last} - avg({value})",
    }
    for n in RECENT_WINDOWS:
        recent = f"FILTER (WHERE {FROM_END} <= {n})"
        stats |= {
            f"mean_{n}m": f"avg({value}) {recent}",
            f"std_{n}m": f"stddev_samp({value}) {recent}",
            f"min_{n}m": f"min({value}) {recent}",
            f"max_{n}m": f"max({value}) {recent}",
            f"last_{n}m": (
                f"max_by({value}, {FROM_START}) FILTER (WHERE {value} IS NOT NULL AND {FROM_END} <= {n})"
                if skip_nulls
                else last
            ),
        }
    return stats


def category_stats(value: str, approx: bool, skip_nulls: bool) -> dict[str, str]:
    """SQL of every statistic of a text column.  The exact distinct count counts the values that
    differ from the one before in sorted order: several count(DISTINCT) would multiply the rows."""
    return {
        "count": f"count({value})",
        "nunique": (
            f"approx_count_distinct({value})" if approx else f"count({NEW}) FILTER (WHERE {NEW})"
        ),
        "last": (
            f"max_by({value}, {FROM_START}) FILTER (WHERE {value} IS NOT NULL)"
            if skip_nulls
            else f"max({value}) FILTER (WHERE {FROM_END} = 1)"
        ),
    }


def plan_features(wanted: Sequence[str], continuous: Sequence[str], categorical: Sequence[str]) -> list[Feature]:
    """The requested features that these columns can give; others are left to ``align``."""
    parsed = [parse_feature(n) for n in dict.fromkeys(wanted)]
    numeric, category = set(continuous), set(categorical)
    return [
        p
        for p in parsed
        if p is not None
        and (
            (p.raw in numeric and p.stat not in ("count", "nunique"))
            or (p.raw in category and p.stat in CATEGORY_STATS)
        )
    ]


def build_features(
    df: DataFrame,
    spec: Spec,
    wanted: Sequence[str] | None = None,
    *,
    dialect: str = "batch",
    approx: bool = False,
    null_policy: str = "row",
    layout: str = "auto",
    missing: str = "omit",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One row per entity with all (or only the ``wanted``) features.

    ``null_policy="row"`` takes the value on the latest row for ``last`` even if NULL,
    ``"skip"`` the latest non-NULL one.  ``approx`` swaps the exact median and distinct
    count for sketches.  ``layout`` is "wide", "long" or chosen by column count.
    ``missing="null"`` adds spec columns the input lacks as NULL instead of leaving
    them out.  Only raw columns that some wanted feature needs are read.
    """
    if missing == "null":
        absent = [c for c in (*(spec.continuous or ()), *spec.categorical) if c not in df.columns]
        df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in absent])
    continuous, categorical = spec.continuous_in(df), spec.categorical_in(df)
    df, spec = spec.total_order(df)
    if wanted is None:
        features = all_features(continuous, categorical, dialect)
    else:
        features = plan_features(wanted, continuous, categorical)
        used = {f.raw for f in features}
        continuous = [c for c in continuous if c in used]
        categorical = [c for c in categorical if c in used]
    base = prepare_statements(df, spec, continuous, categorical)
    has_target = spec.target is not None and spec.target in df.columns
    if not features and not has_target:
        return base.select(spec.id).distinct()
    if layout == "auto":
        layout = "wide" if len(continuous) + len(categorical) <= WIDE_COLUMNS else "long"
    options = {"approx": approx, "skip_nulls": null_policy == "skip"}

    core = _Core(spec, continuous, categorical, features, has_target, options)
    shaped, lagged = core.shape(base, layout)
    # one task sorts an entity's values of every column, so the bound is on values
    places = max(1, len(continuous) + len(categorical))
    key_rows = None if hot_rows is None else max(1, hot_rows // places)
    total = None if hot_rows is None else shaped.count()
    exploded = layout == "long" or core.ranked
    # partitions are sized by the rows that are shuffled, but each becomes one per place after it
    tasks = None if not exploded or total is None else math.ceil(total * places / TASK_VALUES)
    if tasks is not None and tasks <= df.sparkSession.sparkContext.defaultParallelism:
        tasks = None
    usual, hot = sequence_parts(shaped, spec, lagged, hot_rows, key_rows, total, tasks)
    if not exploded:
        result = core.wide(usual)
    else:
        result = core.long(core.wide_to_long(usual) if layout == "wide" else usual)
    if hot is None:
        return result
    if layout == "wide":
        hot = core.wide_to_long(hot)
    return result.unionByName(core.hot(hot))


class _Core:
    """The two layouts of the same aggregation, over rows that carry their sequence.

    In the long layout a row is exploded into places.  Exact medians and distinct counts need the
    values of a place in order: every column then has a place of its own, and the places of an
    entity, which one task already holds, are sorted there once more (a sort that spills).
    Otherwise place i holds continuous column i and, at once, categorical column i.
    """

    def __init__(self, spec, continuous, categorical, features, has_target, options):
        self.spec = spec
        self.continuous, self.categorical = continuous, categorical
        self.features = features
        self.target = [spec.target] if has_target else []
        self.options = options
        self.alias = _aliases(spec, [*continuous, *categorical])
        self.is_number = set(continuous)
        self.changing = [
            c for c in continuous if any(f.raw == c and f.stat.startswith("diff_") for f in features)
        ]
        numeric = {f.stat for f in features if f.raw in self.is_number}
        category = {f.stat for f in features if f.raw not in self.is_number}
        self.numeric = [s for s in NUMERIC_STATS if s in numeric]
        self.category = [s for s in CATEGORY_STATS if s in category]
        self.ranked = not options["approx"] and ("median" in self.numeric or "nunique" in self.category)

    def carried(self) -> list:
        return [F.max(t).alias(t) for t in self.target]

    # -- layouts -----------------------------------------------------------

    def shape(self, base: DataFrame, layout: str) -> tuple[DataFrame, Column | None]:
        """Rows as they go through the shuffle, and what to remember from the row before."""
        if layout == "long":
            return self.to_arrays(base, self.spec.order_columns), F.col("_values") if self.changing else None
        if not self.changing:
            return base, None
        return base, F.struct(*[F.col(self.alias[c]).alias(c) for c in self.changing])

    def to_arrays(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        names = lambda columns: ", ".join(quoted(self.alias[c]) for c in columns)
        return df.select(
            self.spec.id, *keep, *self.target,
            F.expr(f"CAST(array({names(self.continuous)}) AS ARRAY<DOUBLE>) AS _values"),
            F.expr(f"CAST(array({names(self.categorical)}) AS ARRAY<STRING>) AS _texts"),
        )

    def wide_to_long(self, seq: DataFrame) -> DataFrame:
        """Sequenced wide rows with their values, and previous values, as arrays."""
        keep = [FROM_START, FROM_END]
        if self.changing:
            before = ", ".join(
                f"{PREVIOUS}.{quoted(c)}" if c in self.changing else "NULL" for c in self.continuous
            )
            seq = seq.withColumn(PREVIOUS, F.expr(f"CAST(array({before}) AS ARRAY<DOUBLE>)"))
            keep.append(PREVIOUS)
        return self.to_arrays(seq, keep)

    # -- aggregation -------------------------------------------------------

    def wide(self, seq: DataFrame) -> DataFrame:
        recipes = {}
        for c in self.continuous:
            v = quoted(self.alias[c])
            recipes[c] = numeric_stats(v, f"({v} - {PREVIOUS}.{quoted(c)})", **self.options)
        for c in self.categorical:
            recipes[c] = category_stats(quoted(self.alias[c]), **self.options)
        return seq.groupBy(self.spec.id).agg(
            *self.carried(), *[F.expr(f"{recipes[f.raw][f.stat]} AS {quoted(f.name)}") for f in self.features]
        )

    def explode(self, seq: DataFrame, apart: bool = False) -> DataFrame:
        """A row per place, text columns behind the continuous ones if ``apart``.  The rows are
        already hashed on the entity, so the exploded ones feed the aggregation in the same
        task and are never shuffled."""
        texts = f"concat(CAST(array_repeat(NULL, {len(self.continuous)}) AS ARRAY<STRING>), _texts)" if apart else "_texts"
        arrays = ["_values AS v", f"{texts} AS t"]
        if self.changing:
            arrays.append(f"coalesce({PREVIOUS}, CAST(array() AS ARRAY<DOUBLE>)) AS p")
        entries = F.arrays_zip(*[F.expr(a) for a in arrays])
        exploded = seq.select(
            self.spec.id, *self.target, FROM_START, FROM_END, F.posexplode(entries).alias("_at", "_e")
        )
        change = ["_e.v - _e.p AS _d"] if self.changing else []
        kept = [quoted(c) for c in (self.spec.id, *self.target)]
        return exploded.selectExpr(
            *kept, FROM_START, FROM_END, "_at", "_e.v AS _v", "_e.t AS _t", *change
        )

    def in_order(self, long: DataFrame) -> DataFrame:
        """The rank of every value inside its place, from one sort within the task, and the place's
        last text: as part of the key it keeps texts out of the aggregation's buffers, which then
        are of fixed size and compiled."""
        values = Window.partitionBy(self.spec.id, "_at").orderBy(F.col("_v").asc_nulls_last(), F.col("_t").asc_nulls_last())
        whole = values.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ranks = [F.row_number().over(values).alias(RANK), F.count("_v").over(whole).alias(PRESENT)]
        if "nunique" in self.category:
            ranks.append((F.col("_t").isNotNull() & ~F.col("_t").eqNullSafe(F.lag("_t").over(values))).alias(NEW))
        if "last" in self.category:
            newest = f"max_by(_t, CASE WHEN _t IS NOT NULL THEN {FROM_START} END)"
            last = newest if self.options["skip_nulls"] else f"max(CASE WHEN {FROM_END} = 1 THEN _t END)"
            ranks.append(F.expr(last).over(whole).alias("c_last"))
        return long.select("*", *ranks)

    def long_stats(self, long: DataFrame, without: Sequence[str] = ()) -> DataFrame:
        """One row per (entity, place); what ``long`` already has of a place is part of the key."""
        have = [f"c_{s}" for s in self.category if f"c_{s}" in long.columns]
        numeric = numeric_stats("_v", "_d", **self.options)
        category = category_stats("_t", **self.options)
        wanted = [(numeric[s], f"n_{s}") for s in self.numeric if s not in without]
        wanted += [(category[s], f"c_{s}") for s in self.category if s not in without and f"c_{s}" not in have]
        if not wanted:
            wanted = [("count(1)", "_rows")]
        return long.groupBy(self.spec.id, "_at", *have).agg(
            *self.carried(), *[F.expr(f"{sql} AS {name}") for sql, name in wanted]
        )

    def gather(self, stats: DataFrame, apart: bool = False) -> DataFrame:
        """Back to one row per entity: the stats of place i sit at place i of an array."""
        names = [f"n_{s}" for s in self.numeric] + [f"c_{s}" for s in self.category]
        rows = stats.groupBy(self.spec.id).agg(
            *self.carried(), F.array_sort(F.collect_list(F.struct("_at", *names))).alias("_s")
        )
        place = {c: i for columns in (self.continuous, self.categorical) for i, c in enumerate(columns)}
        if apart:
            place |= {c: len(self.continuous) + i for i, c in enumerate(self.categorical)}
        kind = lambda f: "n" if f.raw in self.is_number else "c"
        return rows.selectExpr(
            *[quoted(c) for c in (self.spec.id, *self.target)],
            *[f"_s[{place[f.raw]}].{kind(f)}_{f.stat} AS {quoted(f.name)}" for f in self.features],
        )

    def long(self, seq: DataFrame) -> DataFrame:
        if not self.ranked:
            return self.gather(self.long_stats(self.explode(seq)))
        return self.gather(self.long_stats(self.in_order(self.explode(seq, apart=True))), apart=True)

    def hot(self, seq: DataFrame) -> DataFrame:
        """Hot entities: everything that combines before the shuffle in one aggregation, the
        exact median and distinct count - which do not - as distributed jobs of their own."""
        long = self.explode(seq)
        if self.options["approx"]:
            return self.gather(self.long_stats(long))
        keys = [self.spec.id, "_at"]
        stats = self.long_stats(long, without=("median", "nunique"))
        if "median" in self.numeric:
            middle = distributed_quantiles(long, keys, "_v", [0.5]).select(
                *keys, F.col("quantiles")[0].alias("n_median")
            )
            stats = null_safe(stats, middle, keys, "left")
        if "nunique" in self.category:
            kinds = (
                long.where(F.col("_t").isNotNull()).select(*keys, "_t").distinct()
                .groupBy(*keys).agg(F.count(F.lit(1)).alias("c_nunique"))
            )
            stats = null_safe(stats, kinds, keys, "left").withColumn(
                "c_nunique", F.coalesce("c_nunique", F.lit(0).cast("bigint"))
            )
        return self.gather(stats)


def attach_labels(
    features: DataFrame, labels: DataFrame, key: str, how: str = "left", check_unique: bool = True
) -> DataFrame:
    """Join labels to features.  Repeated label keys would repeat feature rows, so they are an error."""
    require_columns(labels, [key])
    if check_unique:
        repeated = labels.groupBy(key).count().where(F.col("count") > 1)
        if not repeated.isEmpty():
            raise ValueError(f"Labels repeat values of {key}.")
    return features.join(labels, on=key, how=how)


def align_features(
    df: DataFrame, key: str, names: Sequence[str], absent: float = 0.0, null_as: float | None = None
) -> DataFrame:
    """The key and exactly these features, in this order.  Absent columns become a
    literal; NULL and NaN values stay unless ``null_as`` is given."""
    if not names:
        raise ValueError("The feature list must not be empty.")
    have = set(df.columns)

    def one(name: str) -> Column:
        if name not in have:
            return F.lit(absent).alias(name)
        if null_as is None:
            return F.col(name)
        return F.coalesce(coerce_numeric(name), F.lit(null_as)).alias(name)

    return df.select(key, *[one(n) for n in names])
