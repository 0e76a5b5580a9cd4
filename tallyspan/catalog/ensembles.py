"""Scoring by fixed ensembles: the same node table scored by the library and walked by SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.catalog.base import OD_SPEC, orders, query, r, rounded, rs, table
from tallyspan.catalog.evaluation import CONFUSION_SQL, RATES_SQL
from tallyspan.catalog.modelling import BAND_SQL, counted_documents
from tallyspan.operators.ensemble import NODES, NodeModel
from tallyspan.operators.features import build_features
from tallyspan.operators.model import batch_score, holdout_report, score_statements, tiered_score
from tallyspan.operators.sampling import hash_split

# Fixed values: (tree, node, feature, threshold, low, high, value) of two small ensembles.
DOCUMENT_TREES = (
    (0, 0, "n_chars", 1800.0, 1, 2, None),
    (0, 1, "n_gaps", 120.0, 3, 4, None),
    (0, 2, "n_stops", 30.0, 5, 6, None),
    (0, 3, None, None, None, None, -0.9),
    (0, 4, None, None, None, None, -0.25),
    (0, 5, None, None, None, None, 0.15),
    (0, 6, None, None, None, None, 0.7),
    (1, 0, "n_lines", 6.0, 1, 2, None),
    (1, 1, None, None, None, None, -0.125),
    (1, 2, "n_digits", 0.0, 3, 4, None),
    (1, 3, None, None, None, None, 0.0625),
    (1, 4, None, None, None, None, -0.375),
    (2, 0, "n_gaps", 700.0, 1, 2, None),
    (2, 1, None, None, None, None, 0.05),
    (2, 2, None, None, None, None, 0.45),
)
ORDER_TREES = (
    (0, 0, "o_totalprice_mean", 150000.0, 1, 2, None),
    (0, 1, "o_totalprice_last", 60000.0, 3, 4, None),
    (0, 2, "o_totalprice_std_3m", 50000.0, 5, 6, None),
    (0, 3, None, None, None, None, -0.8),
    (0, 4, None, None, None, None, -0.3),
    (0, 5, None, None, None, None, 0.2),
    (0, 6, None, None, None, None, 0.6),
    (1, 0, "o_orderstatus_nunique", 1.0, 1, 2, None),
    (1, 1, None, None, None, None, -0.1),
    (1, 2, "o_totalprice_last", 200000.0, 3, 4, None),
    (1, 3, None, None, None, None, 0.05),
    (1, 4, None, None, None, None, 0.4),
)
DOCUMENT_FEATURES = ["n_chars", "n_gaps", "n_digits", "n_lines", "n_stops"]
ORDER_FEATURES = ["o_totalprice_mean", "o_totalprice_last", "o_totalprice_std_3m", "o_orderstatus_nunique"]


def model_of(spark, trees, numeric) -> NodeModel:
    rows = [(t, n, f, at, None, low, high, v) for t, n, f, at, low, high, v in trees]
    return NodeModel.of_table(spark.createDataFrame(rows, NODES), "logistic", numeric)


def _literal(value) -> str:
    return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else repr(value)


def walk_sql(trees, inputs: str, key: str, features: list[str]) -> str:
    """CTEs after ``inputs``: every row walks down every tree, a level a step; ``p`` has the probability."""
    rows = ", ".join(f"({', '.join(map(_literal, row))})" for row in trees)
    return f"""nodes(tree, node, feature, threshold, lo, hi, leaf) AS (VALUES {rows}),
given AS (SELECT {key}, unnest({features!r}) AS feature, unnest([{", ".join(f"coalesce(CAST({f} AS DOUBLE), 0.0)" for f in features)}]) AS x FROM {inputs}),
steps AS (SELECT {key}, tree, 0 AS node FROM {inputs}, (SELECT DISTINCT tree FROM nodes)
  UNION ALL SELECT s.{key}, s.tree, CASE WHEN g.x <= n.threshold THEN n.lo ELSE n.hi END
  FROM steps s JOIN nodes n ON n.tree = s.tree AND n.node = s.node JOIN given g ON g.{key} = s.{key} AND g.feature = n.feature),
p AS (SELECT {key}, 1.0 / (1.0 + exp(-2.0 * CAST(sum(leaf) AS DOUBLE))) AS p
  FROM steps s JOIN nodes n ON n.tree = s.tree AND n.node = s.node WHERE n.leaf IS NOT NULL GROUP BY {key})"""


def count_of(pattern: str) -> str:
    return f"len(regexp_extract_all(text, '{pattern}'))"


COUNTED_SQL = f"""docs AS (SELECT doc_id, n_chars, {count_of('[ \\t\\n\\x0b\\f\\r]+')} AS n_gaps, {count_of('[0-9]')} AS n_digits,
  {count_of('\\n')} AS n_lines, {count_of('[.!?]')} AS n_stops FROM documents)"""
BAND = BAND_SQL.format(p="p")


@query(
    "ensemble_batch_scores",
    f"""WITH RECURSIVE {COUNTED_SQL}, {walk_sql(DOCUMENT_TREES, "docs", "doc_id", DOCUMENT_FEATURES)}
SELECT doc_id, {r("p", "default_probability")}, {BAND} AS risk_category, 'fixed' AS scoring_job FROM p""",
)
def ensemble_batch_scores(spark, sf_dir):
    model = model_of(spark, DOCUMENT_TREES, DOCUMENT_FEATURES)
    return rounded(batch_score(model, counted_documents(spark, sf_dir), "doc_id", "fixed").drop("scored_at"))


TEST_SQL = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 80"


@query(
    "ensemble_holdout_report",
    f"""WITH RECURSIVE {COUNTED_SQL}, {walk_sql(DOCUMENT_TREES, "docs", "doc_id", DOCUMENT_FEATURES)},
scored AS (SELECT 'final' AS model, quality AS target, p AS prediction FROM p JOIN labels USING (doc_id) WHERE {TEST_SQL}),
g AS (SELECT model, prediction, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target <> 1) AS neg
  FROM scored GROUP BY model, prediction),
cv AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn FROM g
  WINDOW w AS (ORDER BY prediction DESC ROWS UNBOUNDED PRECEDING)),
ranked AS (SELECT model, sum(pos * (tn - cn + neg / 2)) / nullif(max(tp) * max(tn), 0) AS roc_auc,
  sum(pos * cp / (cp + cn)) / nullif(max(tp), 0) AS pr_auc FROM cv GROUP BY model),
conf AS (SELECT model, count(*) AS n_rows, {CONFUSION_SQL} FROM scored GROUP BY model)
SELECT conf.*, {r("roc_auc", "roc_auc")}, {r("pr_auc", "pr_auc")}, {RATES_SQL}, CAST(0.5 AS DOUBLE) AS threshold
FROM conf JOIN ranked USING (model)""",
)
def ensemble_holdout_report(spark, sf_dir):
    """The metrics of the ensemble on the test side of the split."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    _, test = hash_split(counted_documents(spark, sf_dir).join(labels, "doc_id"), "doc_id", 0.8)
    return rounded(holdout_report(model_of(spark, DOCUMENT_TREES, DOCUMENT_FEATURES), test, "target"))


ORDERS_SQL = """ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS i FROM orders),
feats AS (SELECT o_custkey, avg(o_totalprice) AS o_totalprice_mean, max(o_totalprice) FILTER (WHERE i = 1) AS o_totalprice_last,
  stddev_samp(o_totalprice) FILTER (WHERE i <= 3) AS o_totalprice_std_3m, count(DISTINCT o_orderstatus) AS o_orderstatus_nunique,
  count(*) AS n FROM ranked GROUP BY o_custkey)"""


@query(
    "ensemble_statement_scores",
    f"""WITH RECURSIVE {ORDERS_SQL}, {walk_sql(ORDER_TREES, "feats", "o_custkey", ORDER_FEATURES)}
SELECT o_custkey, {r("p", "default_probability")}, {BAND} AS risk_category, n AS n_statements, CAST(4 AS INTEGER) AS n_engineered_features
FROM p JOIN feats USING (o_custkey)""",
)
def ensemble_statement_scores(spark, sf_dir):
    """From raw statements to scores."""
    return rounded(score_statements(model_of(spark, ORDER_TREES, ORDER_FEATURES), orders(spark, sf_dir), OD_SPEC))


@query(
    "ensemble_tiered_scores",
    f"""WITH RECURSIVE {ORDERS_SQL}, {walk_sql(ORDER_TREES, "feats", "o_custkey", ORDER_FEATURES)},
tiers AS (SELECT c_custkey AS o_custkey, CASE WHEN f.o_custkey IS NULL THEN 'INSUFFICIENT_DATA' WHEN c_custkey % 3 = 0 THEN 'realtime'
  WHEN c_custkey % 2 = 0 THEN 'fallback' ELSE 'INSUFFICIENT_DATA' END AS tier_used FROM customer LEFT JOIN feats f ON f.o_custkey = c_custkey)
SELECT o_custkey, CASE WHEN tier_used <> 'INSUFFICIENT_DATA' THEN {rs("p")} END AS risk_score,
  CASE WHEN tier_used <> 'INSUFFICIENT_DATA' THEN {BAND} END AS risk_category, tier_used FROM tiers LEFT JOIN p USING (o_custkey)""",
)
def ensemble_tiered_scores(spark, sf_dir):
    """Every third customer has a cached vector, every second a stored one, some have neither."""
    features = build_features(orders(spark, sf_dir), OD_SPEC, ORDER_FEATURES)
    vector = F.create_map(*[x for n in ORDER_FEATURES for x in (F.lit(n), F.col(n).cast("double"))])
    cache = features.where("o_custkey % 3 = 0").select("o_custkey", vector.alias("features"))
    stored = features.where("o_custkey % 2 = 0")
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return rounded(tiered_score(model_of(spark, ORDER_TREES, ORDER_FEATURES), asked, cache, stored, "o_custkey"))
