"""Feature-engine queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.catalog.base import (
    EV_SPEC, EV_SQL, EVN_SQL, LABEL_SQL, OD_SPEC, OL_SPEC, OL_SQL,
    entity_labels, events, gappy_events, order_lines, orders, query, r, rounded, table,
)
from tallyspan.functions.names import CATEGORY_STATS, NUMERIC_STATS, feature_name
from tallyspan.operators.features import align_features, attach_labels, build_features
from tallyspan.operators.sequence import FROM_END, FROM_START, PREVIOUS, latest_rows, with_sequence
from tallyspan.spec import Spec

DIGITS = 6


def numeric_sql(column: str, skip_nulls: bool = False) -> dict[str, str]:
    """Every numeric statistic of a column in SQL, over rows with ra, rd and d_{column}."""
    c, d = column, f"d_{column}"
    if skip_nulls:
        last = f"arg_max({c}, ra) FILTER (WHERE {c} IS NOT NULL)"
        first = f"arg_min({c}, ra) FILTER (WHERE {c} IS NOT NULL)"
        recent_last = {n: f"arg_max({c}, ra) FILTER (WHERE {c} IS NOT NULL AND rd <= {n})" for n in (3, 6)}
    else:
        last, first = f"max({c}) FILTER (WHERE rd = 1)", f"max({c}) FILTER (WHERE ra = 1)"
        recent_last = {3: last, 6: last}
    stats = {
        "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "max": f"max({c})",
        "median": f"median({c})", "last": last, "first": first,
        "diff_mean": f"avg({d})", "diff_std": f"stddev_samp({d})",
        "diff_min": f"min({d})", "diff_max": f"max({d})", "last_minus_mean": f"{last} - avg({c})",
    }
    for n in (3, 6):
        within = f"FILTER (WHERE rd <= {n})"
        stats |= {
            f"mean_{n}m": f"avg({c}) {within}", f"std_{n}m": f"stddev_samp({c}) {within}",
            f"min_{n}m": f"min({c}) {within}", f"max_{n}m": f"max({c}) {within}",
            f"last_{n}m": recent_last[n],
        }
    return stats


def category_sql(column: str, skip_nulls: bool = False) -> dict[str, str]:
    last = (
        f"arg_max({column}, ra) FILTER (WHERE {column} IS NOT NULL)"
        if skip_nulls
        else f"max({column}) FILTER (WHERE rd = 1)"
    )
    return {"count": f"count({column})", "nunique": f"count(DISTINCT {column})", "last": last}


def sequence_sql(source: str, spec: Spec, name: str = "seq") -> str:
    up = ", ".join(f"{c} ASC NULLS FIRST" for c in spec.order_columns)
    down = ", ".join(f"{c} DESC NULLS LAST" for c in spec.order_columns)
    diffs = "".join(
        f",\n    {c} - lag({c}) OVER (PARTITION BY {spec.id} ORDER BY {up}) AS d_{c}" for c in spec.continuous
    )
    return f"""{name} AS (
  SELECT *, row_number() OVER (PARTITION BY {spec.id} ORDER BY {up}) AS ra,
    row_number() OVER (PARTITION BY {spec.id} ORDER BY {down}) AS rd{diffs}
  FROM {source})"""


def feature_columns_sql(
    spec: Spec, numeric=NUMERIC_STATS, category=CATEGORY_STATS, skip_nulls=False, digits=DIGITS, dialect="batch"
) -> str:
    parts = [
        r(numeric_sql(c, skip_nulls)[s], feature_name(c, s, dialect), digits)
        for c in spec.continuous for s in numeric
    ] + [
        f"{category_sql(c, skip_nulls)[s]} AS {feature_name(c, s)}" for c in spec.categorical for s in category
    ]
    return ",\n  ".join(parts)


def features_sql(with_sql: str, source: str, spec: Spec, **choices) -> str:
    return f"""WITH {with_sql}, {sequence_sql(source, spec)}
SELECT {spec.id},
  {feature_columns_sql(spec, **choices)}
FROM seq GROUP BY {spec.id}"""


def some(spec: Spec, numeric=(), category=()) -> list[str]:
    return [feature_name(c, s) for c in spec.continuous for s in numeric] + [
        feature_name(c, s) for c in spec.categorical for s in category
    ]


def of_events(spark, sf_dir, numeric=(), category=(), source=events, **options) -> DataFrame:
    names = some(EV_SPEC, numeric, category)
    return rounded(build_features(source(spark, sf_dir), EV_SPEC, names, **options), DIGITS)


def events_sql(numeric=(), category=(), gaps=False, **choices) -> str:
    with_sql, source = (EVN_SQL, "evn") if gaps else (EV_SQL, "ev")
    return features_sql(with_sql, source, EV_SPEC, numeric=numeric, category=category, **choices)


@query("customer_features", events_sql(NUMERIC_STATS, CATEGORY_STATS))
def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(build_features(events(spark, sf_dir), EV_SPEC), DIGITS)


# about half of the users count as hot: they are cut into slices
@query("customer_features_hot", events_sql(NUMERIC_STATS, CATEGORY_STATS))
def customer_features_hot(spark, sf_dir):
    return rounded(build_features(events(spark, sf_dir), EV_SPEC, hot_rows=200), DIGITS)


# orders dated by year alone, so that most rows of a customer tie
YEARLY_SQL = "od AS (SELECT o_custkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS day, o_totalprice, o_orderstatus, o_orderpriority FROM orders)"
TIED_SPEC = Spec("o_custkey", "day", continuous=("o_totalprice",), categorical=("o_orderstatus", "o_orderpriority"))
TIED_SQL = features_sql(
    YEARLY_SQL, "od",
    Spec("o_custkey", "day", ("o_totalprice", "o_orderstatus", "o_orderpriority"), None, TIED_SPEC.continuous, TIED_SPEC.categorical),
    numeric=NUMERIC_STATS, category=CATEGORY_STATS,
)


def _tied(spark, sf_dir, **options):
    day = F.trunc("o_orderdate", "year").alias("day")
    rows = orders(spark, sf_dir).select("o_custkey", day, "o_totalprice", "o_orderstatus", "o_orderpriority")
    return rounded(build_features(rows, TIED_SPEC, **options), DIGITS)


@query("tied_features", TIED_SQL)
def tied_features(spark, sf_dir):
    """Ties are broken by all value columns in spec order."""
    return _tied(spark, sf_dir)


@query("tied_features_hot", TIED_SQL)
def tied_features_hot(spark, sf_dir):
    """The same answer where large customers are cut into slices and columns travel as arrays."""
    return _tied(spark, sf_dir, hot_rows=30, layout="long")


@query("customer_features_gaps", events_sql(NUMERIC_STATS, CATEGORY_STATS, gaps=True))
def customer_features_gaps(spark, sf_dir):
    return rounded(build_features(gappy_events(spark, sf_dir), EV_SPEC), DIGITS)


@query("customer_features_skip_nulls", events_sql(NUMERIC_STATS, CATEGORY_STATS, gaps=True, skip_nulls=True))
def customer_features_skip_nulls(spark, sf_dir):
    return rounded(build_features(gappy_events(spark, sf_dir), EV_SPEC, null_policy="skip"), DIGITS)


@query(
    "customer_features_notebook_names",
    events_sql(NUMERIC_STATS, CATEGORY_STATS, dialect="notebook"),
)
def customer_features_notebook_names(spark, sf_dir):
    return rounded(build_features(events(spark, sf_dir), EV_SPEC, dialect="notebook"), DIGITS)


@query("order_features", features_sql("od AS (SELECT * FROM orders)", "od", OD_SPEC))
def order_features(spark, sf_dir):
    return rounded(build_features(orders(spark, sf_dir), OD_SPEC))


@query("customer_features_wide", features_sql(OL_SQL, "ol", OL_SPEC))
def customer_features_wide(spark, sf_dir):
    return rounded(build_features(order_lines(spark, sf_dir), OL_SPEC, layout="long"))


# forty columns, each the value scaled and mixed with the other one, for the width of a real table
MATRIX_COLUMNS = tuple(f"m{i}" for i in range(1, 41))
MATRIX_SPEC = Spec("user_id", "ts", ("event_id",), None, MATRIX_COLUMNS, ("event_type",), True)
MATRIX_SQL = f"""{EVN_SQL}, mx AS (SELECT user_id, ts, event_id, event_type,
  {", ".join(f"value * {i} + k AS m{i}" for i in range(1, 41))} FROM evn)"""


@query("feature_matrix", features_sql(MATRIX_SQL, "mx", MATRIX_SPEC))
def feature_matrix(spark, sf_dir):
    rows = gappy_events(spark, sf_dir)
    columns = [(F.col("value") * i + F.col("k")).alias(f"m{i}") for i in range(1, 41)]
    return rounded(build_features(rows.select("user_id", "ts", "event_id", "event_type", *columns), MATRIX_SPEC))


@query("full_stats", events_sql(("mean", "std", "min", "max", "median")))
def full_stats(spark, sf_dir):
    return of_events(spark, sf_dir, ("mean", "std", "min", "max", "median"))


@query(
    "approx_median",
    f"""WITH {EV_SQL} SELECT user_id, {r("quantile_disc(value, 0.5)", "value_median")},
  {r("quantile_disc(k, 0.5)", "k_median")} FROM ev GROUP BY user_id""",
)
def approx_median(spark, sf_dir):
    return rounded(build_features(events(spark, sf_dir), EV_SPEC, some(EV_SPEC, ("median",)), approx=True))


@query("first_last", events_sql(("first", "last"), gaps=True))
def first_last(spark, sf_dir):
    return of_events(spark, sf_dir, ("first", "last"), source=gappy_events)


@query("first_last_nonnull", events_sql(("first", "last", "last_3m"), ("last",), gaps=True, skip_nulls=True))
def first_last_nonnull(spark, sf_dir):
    return of_events(
        spark, sf_dir, ("first", "last", "last_3m"), ("last",), source=gappy_events, null_policy="skip"
    )


def _recent(n: int) -> list[str]:
    return [f"{s}_{n}m" for s in ("mean", "std", "min", "max", "last")]


@query("recent_3", events_sql(_recent(3), gaps=True))
def recent_3(spark, sf_dir):
    return of_events(spark, sf_dir, _recent(3), source=gappy_events)


@query("recent_6", events_sql(_recent(6), gaps=True))
def recent_6(spark, sf_dir):
    return of_events(spark, sf_dir, _recent(6), source=gappy_events)


DIFFS = ("diff_mean", "diff_std", "diff_min", "diff_max")


@query("diff_stats", events_sql(DIFFS, gaps=True))
def diff_stats(spark, sf_dir):
    return of_events(spark, sf_dir, DIFFS, source=gappy_events)


@query("last_minus_mean", events_sql(("last_minus_mean",)))
def last_minus_mean(spark, sf_dir):
    return of_events(spark, sf_dir, ("last_minus_mean",))


@query("cat_stats", events_sql((), CATEGORY_STATS, gaps=True))
def cat_stats(spark, sf_dir):
    return of_events(spark, sf_dir, (), CATEGORY_STATS, source=gappy_events)


@query("cat_nunique_approx", events_sql((), ("nunique",)))
def cat_nunique_approx(spark, sf_dir):
    return of_events(spark, sf_dir, (), ("nunique",), approx=True)


@query(
    "carried_target",
    f"""WITH {LABEL_SQL}, od AS (SELECT o.*, target FROM orders o JOIN lab ON o_custkey = c_custkey)
SELECT o_custkey, max(target) AS target, {r("avg(o_totalprice)", "o_totalprice_mean")}
FROM od GROUP BY o_custkey""",
)
def carried_target(spark, sf_dir):
    spec = Spec(OD_SPEC.id, OD_SPEC.date, OD_SPEC.tiebreak, "target", OD_SPEC.continuous, (), True)
    labels = entity_labels(spark, sf_dir).withColumnRenamed("c_custkey", "o_custkey")
    return rounded(build_features(orders(spark, sf_dir).join(labels, "o_custkey"), spec, ["o_totalprice_mean"]))


def _labeled_sql(how: str) -> str:
    # customers of the first two market segments only are labelled, so that the kinds of join differ
    return f"""WITH lab AS (
  SELECT c_custkey, CAST(c_acctbal < 0 AS INTEGER) AS target FROM customer
  WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
SELECT o_custkey, {r("avg(o_totalprice)", "o_totalprice_mean")}, {r("max(o_totalprice)", "o_totalprice_max")},
  max(target) AS target
FROM orders {how} JOIN lab ON o_custkey = c_custkey GROUP BY o_custkey"""


def _labeled(spark, sf_dir, how):
    features = build_features(orders(spark, sf_dir), OD_SPEC, ["o_totalprice_mean", "o_totalprice_max"])
    segments = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    labels = segments.select(F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") < 0).cast("int").alias("target"))
    return rounded(attach_labels(features, labels, "o_custkey", how))


@query("features_labeled", _labeled_sql("LEFT"))
def features_labeled(spark, sf_dir):
    return _labeled(spark, sf_dir, "left")


@query("features_labeled_inner", _labeled_sql("INNER"))
def features_labeled_inner(spark, sf_dir):
    return _labeled(spark, sf_dir, "inner")


ALIGNED = ["value_mean", "value_last_3m", "value_not_there", "event_type_nunique"]


@query(
    "align_features",
    f"""WITH {EVN_SQL}, {sequence_sql("evn", EV_SPEC)}
SELECT user_id, {r("avg(value)", "value_mean")}, {r("coalesce(max(value) FILTER (WHERE rd = 1), 0.0)", "value_last_3m")},
  CAST(0.0 AS DOUBLE) AS value_not_there, CAST(count(DISTINCT event_type) AS DOUBLE) AS event_type_nunique
FROM seq GROUP BY user_id""",
)
def aligned(spark, sf_dir):
    built = build_features(gappy_events(spark, sf_dir), EV_SPEC, ALIGNED)
    return rounded(align_features(built, "user_id", ALIGNED, absent=0.0, null_as=0.0))


@query(
    "statement_rank",
    """SELECT o_custkey, o_orderkey,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS from_start,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS from_end
FROM orders""",
)
def statement_rank(spark, sf_dir):
    return with_sequence(orders(spark, sf_dir), OD_SPEC).select(
        "o_custkey", "o_orderkey", F.col(FROM_START).alias("from_start"), F.col(FROM_END).alias("from_end")
    )


@query(
    "month_diff",
    f"""SELECT o_custkey, o_orderkey,
  {r("o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)", "o_totalprice_diff", 4)}
FROM orders""",
)
def month_diff(spark, sf_dir):
    rows = with_sequence(orders(spark, sf_dir), OD_SPEC, F.col("o_totalprice"))
    change = (F.col("o_totalprice") - F.col(PREVIOUS)).alias("o_totalprice_diff")
    return rounded(rows.select("o_custkey", "o_orderkey", change), 4)


def _tail_sql(n: int) -> str:
    return f"""SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rd FROM orders)
WHERE rd <= {n}"""


def _tail(spark, sf_dir, n):
    return latest_rows(orders(spark, sf_dir), OD_SPEC, n).select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"
    )


@query("latest_statement", _tail_sql(1))
def latest_statement(spark, sf_dir):
    return _tail(spark, sf_dir, 1)


@query("tail_3", _tail_sql(3))
def tail_3(spark, sf_dir):
    return _tail(spark, sf_dir, 3)


@query("rolling13", _tail_sql(13))
def rolling13(spark, sf_dir):
    return _tail(spark, sf_dir, 13)


ROLLING_SPEC = EV_SPEC


@query(
    "rolling13_features",
    f"""WITH {EV_SQL}, last13 AS (SELECT * EXCLUDE (arrival) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS arrival FROM ev) WHERE arrival <= 13),
{sequence_sql("last13", EV_SPEC)}
SELECT user_id,
  {feature_columns_sql(EV_SPEC)}
FROM seq GROUP BY user_id""",
)
def rolling13_features(spark, sf_dir):
    window = latest_rows(events(spark, sf_dir), EV_SPEC, 13)
    return rounded(build_features(window, EV_SPEC, hot_rows=None), DIGITS)
