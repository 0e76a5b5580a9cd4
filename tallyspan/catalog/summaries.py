"""Descriptive queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.catalog.base import (
    EVN_SQL, LABEL_SQL, OD_SPEC, entity_labels, gappy_events, orders, query, r, rounded, rs, table,
)
from tallyspan.operators.sequence import latest_rows
from tallyspan.operators.summary import (
    box_stats, categorical_summary, class_balance, histogram, rate_by_category, scale_pos_weight,
    statement_counts, statement_describe,
)


@query(
    "statement_counts",
    """SELECT n_statements, count(*) AS n_keys FROM (
  SELECT o_custkey, count(*) AS n_statements FROM orders GROUP BY o_custkey) GROUP BY n_statements""",
)
def statement_counts_query(spark, sf_dir):
    return statement_counts(orders(spark, sf_dir), "o_custkey")


@query(
    "statement_describe",
    f"""SELECT count(*) AS count, {r("avg(n)", "mean")}, {r("stddev_samp(n)", "std")},
  CAST(min(n) AS DOUBLE) AS min, {r("quantile_cont(n, 0.25)", "p25")}, {r("quantile_cont(n, 0.5)", "p50")},
  {r("quantile_cont(n, 0.75)", "p75")}, CAST(max(n) AS DOUBLE) AS max
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)""",
)
def statement_describe_query(spark, sf_dir):
    return rounded(statement_describe(orders(spark, sf_dir), "o_custkey"))


@query(
    "class_balance",
    f"""WITH {LABEL_SQL} SELECT target, count(*) AS n, {r("count(*) / (SELECT count(*) FROM lab)", "share")}
FROM lab GROUP BY target""",
)
def class_balance_query(spark, sf_dir):
    return rounded(class_balance(entity_labels(spark, sf_dir), "target"))


@query(
    "cat_summary",
    f"""WITH {EVN_SQL}
SELECT 'event_type' AS "column", count(DISTINCT coalesce(event_type, '<missing>')) AS n_unique,
  {r("100.0 * (count(*) - count(event_type)) / count(*)", "missing_pct")} FROM evn
UNION ALL
SELECT 'user_id', count(DISTINCT user_id), 0.0 FROM evn""",
)
def cat_summary(spark, sf_dir):
    return rounded(categorical_summary(gappy_events(spark, sf_dir), ["event_type", "user_id"]))


@query(
    "default_rate_by_cat",
    f"""WITH {LABEL_SQL}, latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rd
    FROM orders) LEFT JOIN lab ON o_custkey = c_custkey WHERE rd = 1)
SELECT 'o_orderstatus' AS "column", o_orderstatus AS category, count(*) AS n, {r("avg(target)", "rate")}
FROM latest GROUP BY o_orderstatus
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*), {rs('avg(target)')}
FROM latest GROUP BY o_orderpriority""",
)
def default_rate_by_cat(spark, sf_dir):
    labels = entity_labels(spark, sf_dir).withColumnRenamed("c_custkey", "o_custkey")
    latest = latest_rows(orders(spark, sf_dir), OD_SPEC).join(labels, "o_custkey", "left")
    return rounded(rate_by_category(latest, ["o_orderstatus", "o_orderpriority"], "target"))


@query(
    "histogram_50",
    f"""WITH b AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 50 AS w FROM orders),
c AS (SELECT least(CAST(floor((o_totalprice - lo) / w) AS BIGINT), 49) AS bin, count(*) AS n FROM orders, b GROUP BY 1)
SELECT g.bin, {r("lo + g.bin * w", "lower", 4)}, {r("lo + (g.bin + 1) * w", "upper", 4)}, coalesce(n, 0) AS n
FROM (SELECT range AS bin FROM range(50)) g CROSS JOIN b LEFT JOIN c ON g.bin = c.bin""",
)
def histogram_50(spark, sf_dir):
    return rounded(histogram(orders(spark, sf_dir), "o_totalprice", 50), 4)


@query(
    "box_by_class",
    f"""WITH {LABEL_SQL}, latest AS (
  SELECT target, o_totalprice AS v FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rd FROM orders)
  JOIN lab ON o_custkey = c_custkey WHERE rd = 1),
q AS (SELECT target, quantile_cont(v, 0.25) AS q1, median(v) AS median, quantile_cont(v, 0.75) AS q3 FROM latest GROUP BY target)
SELECT l.target, 'o_totalprice' AS "column", {r("q1", "q1", 4)}, {r("median", "median", 4)}, {r("q3", "q3", 4)}, count(*) AS n,
  {r("min(v)", "min", 4)}, {r("max(v)", "max", 4)},
  {r("min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1))", "whisker_low", 4)},
  {r("max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1))", "whisker_high", 4)}
FROM latest l JOIN q ON l.target = q.target GROUP BY l.target, q1, median, q3""",
)
def box_by_class(spark, sf_dir):
    labels = entity_labels(spark, sf_dir).withColumnRenamed("c_custkey", "o_custkey")
    latest = latest_rows(orders(spark, sf_dir), OD_SPEC).join(labels, "o_custkey")
    return rounded(box_stats(latest, ["o_totalprice"], "target"), 4)


@query(
    "scale_pos_weight",
    f"""SELECT CAST(sum(quality) AS BIGINT) AS positives, CAST(count(*) - sum(quality) AS BIGINT) AS negatives,
  {r("(count(*) - sum(quality)) / sum(quality)", "scale_pos_weight")} FROM labels""",
)
def scale_pos_weight_query(spark, sf_dir):
    return rounded(scale_pos_weight(table(spark, sf_dir, "labels"), "quality"))
