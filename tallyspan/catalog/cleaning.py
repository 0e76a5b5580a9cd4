"""Cleaning, parsing and scalar queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.catalog.base import EVN_SQL, SCORED_SQL, events, gappy_events, orders, query, r, rounded, scored, table
from tallyspan.functions.names import raw_column
from tallyspan.functions.scalar import decode_message, fill_missing, risk_band, statement_cycle
from tallyspan.operators.clean import (
    align_categories, cast_categoricals, clean_dates, coerce_numbers, drop_sparse_columns, duplicate_count,
    filter_dates, missing_percent,
)
from tallyspan.operators.importance import top_missing

DATE_TEXT_SQL = """CASE WHEN o_orderkey % 11 = 0 THEN 'not a date' WHEN o_orderkey % 13 = 0 THEN NULL
  ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


def _date_text():
    key = F.col("o_orderkey")
    return (
        F.when(key % 11 == 0, "not a date").when(key % 13 == 0, None)
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )


@query(
    "clean_dates",
    f"""SELECT o_orderkey, TRY_CAST(t AS DATE) AS order_date,
  t IS NOT NULL AND TRY_CAST(t AS DATE) IS NULL AS order_date_rejected
FROM (SELECT o_orderkey, {DATE_TEXT_SQL} AS t FROM orders)""",
)
def clean_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = orders(spark, sf_dir).select("o_orderkey", _date_text().alias("t"))
    return clean_dates(text, "t", "order_date").select("o_orderkey", "order_date", "order_date_rejected")


@query(
    "date_window",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-03-31'""",
)
def date_window(spark, sf_dir):
    return filter_dates(orders(spark, sf_dir), "o_orderdate", "1996-03-01", "1997-03-31").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


# a column that is missing nine times in ten, to be dropped
SPARSE_SQL = f"""{EVN_SQL}, gaps AS (
  SELECT *, CASE WHEN event_id % 10 = 0 THEN value END AS rare FROM evn)"""
GAP_COLUMNS = ("event_id", "event_type", "k", "rare", "ts", "user_id", "value")


def _gaps(spark, sf_dir):
    rows = gappy_events(spark, sf_dir)
    return rows.withColumn("rare", F.when(F.col("event_id") % 10 == 0, F.col("value"))).select(*GAP_COLUMNS)


def _missing_sql(tail: str = "") -> str:
    parts = "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r(f'100.0 * (count(*) - count({c})) / count(*)', 'missing_pct')} FROM gaps"
        for c in GAP_COLUMNS
    )
    return f"WITH {SPARSE_SQL}\nSELECT * FROM ({parts}) {tail}"


@query("missing_pct", _missing_sql())
def missing_pct(spark, sf_dir):
    return rounded(missing_percent(_gaps(spark, sf_dir)))


@query("top_missing", _missing_sql("ORDER BY missing_pct DESC, \"column\" LIMIT 3"))
def top_missing_columns(spark, sf_dir):
    return rounded(top_missing(missing_percent(_gaps(spark, sf_dir)), 3))


@query(
    "drop_sparse",
    f"WITH {SPARSE_SQL} SELECT event_id, event_type, k, ts, user_id, value FROM gaps",
)
def drop_sparse(spark, sf_dir):
    return drop_sparse_columns(_gaps(spark, sf_dir), ["user_id", "ts"])[0]


@query(
    "cast_cat",
    "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer",
)
def cast_cat(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return cast_categoricals(customers, ["c_nationkey", "c_mktsegment", "not_there"])


NUMBER_TEXT_SQL = "CASE WHEN l_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END"


@query(
    "coerce_numeric",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, TRY_CAST({NUMBER_TEXT_SQL} AS DOUBLE) AS quantity FROM lineitem""",
)
def coerce_numeric_query(spark, sf_dir):
    text = F.when(F.col("l_orderkey") % 9 == 0, "n/a").otherwise(F.col("l_quantity").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.alias("quantity"))
    return coerce_numbers(rows, ["quantity"])


@query(
    "align_categories",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'error', 'view') THEN event_type END AS event_type,
  'web' AS channel FROM events""",
)
def align_categories_query(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type")
    return align_categories(rows, {"event_type": ["click", "error", "view"], "channel": ["web", "branch"]})


@query("fill_missing", f"WITH {EVN_SQL} SELECT event_id, coalesce(value, 0.0) AS value FROM evn")
def fill_missing_query(spark, sf_dir):
    return gappy_events(spark, sf_dir).select("event_id", fill_missing(F.col("value")).alias("value"))


@query(
    "risk_band",
    f"""WITH {SCORED_SQL} SELECT doc_id, model,
  CASE WHEN prediction < 0.25 THEN 'low' WHEN prediction < 0.60 THEN 'medium' ELSE 'high' END AS risk_category
FROM scored""",
)
def risk_band_query(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "model", risk_band(F.col("prediction")).alias("risk_category"))


@query(
    "statement_cycle",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '2023-12' WHEN event_id % 7 = 0 THEN '2030-01'
  ELSE strftime(ts, '%Y-%m') END AS cycle FROM events""",
)
def statement_cycle_query(spark, sf_dir):
    """Stated every fifth time, date text too short every seventh (a fixed clock then), else from the date."""
    key = F.col("event_id")
    explicit = F.when(key % 5 == 0, "2023-12").otherwise("")
    text = F.when(key % 7 == 0, "2024").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    clock = F.lit("2030-01-15 00:00:00").cast("timestamp")
    return events(spark, sf_dir).select("event_id", statement_cycle(explicit, text, clock).alias("cycle"))


@query("json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    """The properties, wrapped as transport would, decoded again."""
    body = F.base64(F.col("props").cast("binary"))
    rows = table(spark, sf_dir, "events").select("event_id", decode_message(body, "k bigint").alias("p"))
    return rows.select("event_id", F.col("p.k").alias("k"))


# Name endings, and whether they name a statistic.
SUFFIXES = {
    "_mean": True, "_last_3m": True, "_diff_std": True, "_last_minus_mean": True, "_lag": True, "_std_diff": True,
    "_nunique": True, "_unknown": False,
}


@query(
    "raw_columns",
    f"""SELECT DISTINCT p_type || s AS name, CASE WHEN known THEN p_type END AS raw
FROM (SELECT replace(p_type, ' ', '_') AS p_type FROM part)
CROSS JOIN (VALUES {", ".join(f"('{s}', {str(known).lower()})" for s, known in SUFFIXES.items())}) AS t(s, known)""",
)
def raw_columns_query(spark, sf_dir):
    base = table(spark, sf_dir, "part").select(F.replace("p_type", F.lit(" "), F.lit("_")).alias("t")).distinct()
    names = base.select(F.explode(F.array(*[F.concat("t", F.lit(s)) for s in SUFFIXES])).alias("name"))
    return names.select("name", raw_column("name").alias("raw"))


@query(
    "duplicate_count",
    """WITH doubled AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 5 = 0)
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM doubled)) AS BIGINT) AS duplicates FROM doubled""",
)
def duplicate_count_query(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return duplicate_count(lines.union(lines.where(F.col("l_orderkey") % 5 == 0)))
