"""Split, sample and fold queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.catalog.base import IMPORTANCE_SQL, LABEL_SQL, entity_labels, importance, orders, query, r, rounded
from tallyspan.operators.importance import cumulative_importance, select_features, top_importance
from tallyspan.operators.refresh import restrict_to_keys
from tallyspan.operators.sampling import (
    balanced_sample, hash_split, limited_scan, sample_n, stratified_folds, stratified_sample,
)

BUCKET_SQL = "CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100"


def _split_sql(side: str) -> str:
    return f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {BUCKET_SQL} {side} 29"


def _split(spark, sf_dir):
    return hash_split(orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", 0.29)


@query("hash_split_train", _split_sql("<"))
def hash_split_train(spark, sf_dir):
    return _split(spark, sf_dir)[0]


@query("hash_split_test", _split_sql(">="))
def hash_split_test(spark, sf_dir):
    return _split(spark, sf_dir)[1]


@query("scan_limit", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500")
def scan_limit(spark, sf_dir):
    return limited_scan(orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice"), 500, ["o_orderkey"])


RANKED_SQL = f"""{LABEL_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY h, c_custkey) AS rk, count(*) OVER (PARTITION BY target) AS n_of
  FROM (SELECT *, md5(c_custkey || '|42') AS h FROM lab))"""


@query(
    "balanced_sample",
    f"WITH {RANKED_SQL} SELECT c_custkey, target FROM ranked WHERE rk <= 50 AND target IN (0, 1)",
)
def balanced_sample_query(spark, sf_dir):
    return balanced_sample(entity_labels(spark, sf_dir), "c_custkey", "target", 100)


STRATIFIED_SQL = f"{RANKED_SQL}, half AS (SELECT c_custkey, target FROM ranked WHERE rk <= round(n_of * 0.5))"


@query("stratified_half", f"WITH {STRATIFIED_SQL} SELECT c_custkey, target FROM half")
def stratified_half(spark, sf_dir):
    return stratified_sample(entity_labels(spark, sf_dir), "c_custkey", "target", 0.5)


@query(
    "sampled_statements",
    f"""WITH {STRATIFIED_SQL} SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM half)""",
)
def sampled_statements(spark, sf_dir):
    chosen = stratified_half(spark, sf_dir).select(F.col("c_custkey").alias("o_custkey"))
    rows = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    return restrict_to_keys(rows, chosen, "o_custkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "stratified_folds",
    f"WITH {RANKED_SQL} SELECT c_custkey, target, CAST((rk - 1) % 5 + 1 AS INTEGER) AS fold FROM ranked",
)
def stratified_folds_query(spark, sf_dir):
    return stratified_folds(entity_labels(spark, sf_dir), "c_custkey", "target")


@query(
    "sample_n",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY md5(c_custkey || '|42'), c_custkey LIMIT 120",
)
def sample_n_query(spark, sf_dir):
    from tallyspan.catalog.base import table

    return sample_n(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_custkey", 120)


CUMULATIVE_SQL = f"""{IMPORTANCE_SQL}, cum AS (
  SELECT feature, importance, importance / sum(importance) OVER () AS importance_fraction,
    sum(importance) OVER w / sum(importance) OVER () AS cumulative_importance, row_number() OVER w AS rank
  FROM imp WINDOW w AS (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING))"""


@query(
    "importance_cumulative",
    f"""WITH {CUMULATIVE_SQL} SELECT feature, importance, {r("importance_fraction", "importance_fraction", 9)},
  {r("cumulative_importance", "cumulative_importance", 9)}, rank FROM cum""",
)
def importance_cumulative(spark, sf_dir):
    return rounded(cumulative_importance(importance(spark, sf_dir)), 9)


@query(
    "selected_features",
    f"""WITH {CUMULATIVE_SQL}, size AS (
  SELECT least(greatest(count(*) FILTER (WHERE cumulative_importance <= 0.8)
    + CAST(count(*) FILTER (WHERE cumulative_importance <= 0.8) < count(*) AS INTEGER), 30), 1000, count(*)) AS k FROM cum)
SELECT feature, importance, rank FROM cum, size WHERE rank <= k""",
)
def selected_features(spark, sf_dir):
    chosen = select_features(importance(spark, sf_dir), 0.8, 30, 1000)
    return chosen.where("selected").select("feature", "importance", "rank")


@query("top_importance", f"WITH {IMPORTANCE_SQL} SELECT * FROM imp ORDER BY importance DESC, feature LIMIT 30")
def top_importance_query(spark, sf_dir):
    return top_importance(importance(spark, sf_dir), 30)
