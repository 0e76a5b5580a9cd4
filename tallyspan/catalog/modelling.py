"""Training and scoring queries.  The models are small; their inputs are whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.catalog.base import EV_SPEC, OD_SPEC, events, entity_labels, orders, query, table
from tallyspan.operators.features import attach_labels, build_features
from tallyspan.operators.model import (
    batch_score, cross_validate, explained_rows, fit_model, holdout_report, permutation_importance, score_statements,
    search, tiered_score, train_final,
)
from tallyspan.operators.sampling import hash_split
from tallyspan.session import materialise

ROUNDS = 3
SMALL = {"maxDepth": 3}
# A search space that suits a few hundred rows.
SMALL_SPACE = {
    "stepSize": (0.05, 0.3, "log"),
    "maxDepth": (2, 4, "int"),
    "minInstancesPerNode": (1, 10, "int"),
    "subsamplingRate": (0.55, 1.0, "float"),
    "featureSubsetStrategy": (0.55, 1.0, "float"),
}


def counted_documents(spark, sf_dir) -> DataFrame:
    """Documents with counts over their whole text."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        F.regexp_count(text, F.lit(r"\s+")).alias("n_gaps"),
        F.regexp_count(text, F.lit(r"\d")).alias("n_digits"),
        F.regexp_count(text, F.lit(r"\n")).alias("n_lines"),
        F.regexp_count(text, F.lit(r"[.!?]")).alias("n_stops"),
    )


def training_rows(spark, sf_dir) -> DataFrame:
    """The labelled ones, which training reads repeatedly."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    return materialise(counted_documents(spark, sf_dir).join(labels, "doc_id"))


@query("oof_predictions")
def oof_predictions(spark, sf_dir):
    run = cross_validate(
        training_rows(spark, sf_dir), "doc_id", "target", folds=3, rounds=ROUNDS,
        params={"boosted_trees": SMALL, "random_forest": SMALL},
    )
    return run.oof


@query("final_model_importance")
def final_model_importance(spark, sf_dir):
    final = train_final(
        training_rows(spark, sf_dir), "doc_id", "target", selector_rounds=ROUNDS, final_rounds=ROUNDS,
        min_features=2, max_features=4, **SMALL,
    )
    return final.importance


def _documents_model(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    train, test = hash_split(rows, "doc_id", 0.8)
    model = fit_model(
        train, "doc_id", "target", ["n_chars", "n_gaps", "n_digits", "n_lines", "n_stops"], ["lang", "source"], ROUNDS, **SMALL
    )
    return model, rows, test


@query("holdout_report")
def holdout(spark, sf_dir):
    model, _, test = _documents_model(spark, sf_dir)
    return holdout_report(model, test, "target")


@query("batch_scores")
def batch_scores(spark, sf_dir):
    model, _, _ = _documents_model(spark, sf_dir)
    return batch_score(model, counted_documents(spark, sf_dir), "doc_id", "catalogue")


@query("permutation_importance")
def permutation(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    run = cross_validate(
        rows, "doc_id", "target", families=["boosted_trees"], folds=2, rounds=ROUNDS, params={"boosted_trees": SMALL}
    )
    fold, model = run.best("boosted_trees", "target")
    chosen = explained_rows(rows, run.oof, "doc_id", "boosted_trees", fold)
    return permutation_importance(model, chosen, "doc_id", "target")


@query("search_trials")
def search_trials(spark, sf_dir):
    return search(
        training_rows(spark, sf_dir), "doc_id", "target", trials=2, folds=2, rounds=ROUNDS, space=SMALL_SPACE
    )


ORDER_FEATURES = ["o_totalprice_mean", "o_totalprice_last", "o_totalprice_std_3m", "o_orderstatus_nunique"]


def _orders_model(spark, sf_dir):
    labels = entity_labels(spark, sf_dir).withColumnRenamed("c_custkey", "o_custkey")
    features = build_features(orders(spark, sf_dir), OD_SPEC, ORDER_FEATURES)
    rows = materialise(attach_labels(features, labels, "o_custkey", "inner"))
    return fit_model(rows, "o_custkey", "target", ORDER_FEATURES, [], ROUNDS, **SMALL), rows


@query("score_from_statements")
def score_from_statements(spark, sf_dir):
    model, _ = _orders_model(spark, sf_dir)
    return score_statements(model, orders(spark, sf_dir), OD_SPEC)


@query("tiered_scores")
def tiered_scores(spark, sf_dir):
    """Every third entity has a cached vector, every second a stored one."""
    model, rows = _orders_model(spark, sf_dir)
    vector = F.create_map(*[x for n in ORDER_FEATURES for x in (F.lit(n), F.col(n).cast("double"))])
    cache = rows.where(F.col("o_custkey") % 3 == 0).select("o_custkey", vector.alias("features"))
    stored = rows.where(F.col("o_custkey") % 2 == 0).drop("target")
    asked = orders(spark, sf_dir).select("o_custkey")
    return tiered_score(model, asked, cache, stored, "o_custkey")


# What SQL can say of scores: how many, of whom, in what range, in which band.
BAND_SQL = "CASE WHEN {p} < 0.25 THEN 'low' WHEN {p} < 0.60 THEN 'medium' ELSE 'high' END"


def _inside(score: str):
    return F.coalesce(F.every(F.col(score).between(0.0, 1.0)), F.lit(False))


@query(
    "oof_coverage",
    """SELECT model, count(*) AS n, count(DISTINCT doc_id) AS ids, CAST(sum(quality) AS BIGINT) AS positives,
  CAST(3 AS BIGINT) AS folds, true AS inside
FROM documents JOIN labels USING (doc_id) CROSS JOIN (VALUES ('boosted_trees'), ('random_forest')) AS m(model) GROUP BY model""",
)
def oof_coverage(spark, sf_dir):
    """Every labelled row is scored once by each model, by a fold that did not see it."""
    return oof_predictions(spark, sf_dir).groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("ids"), F.sum("target").alias("positives"),
        F.countDistinct("fold").alias("folds"), _inside("prediction").alias("inside"),
    )


@query(
    "batch_score_coverage",
    """SELECT count(*) AS n, count(DISTINCT doc_id) AS ids, true AS inside, true AS banded, 'catalogue' AS job FROM documents""",
)
def batch_score_coverage(spark, sf_dir):
    banded = F.every(F.col("risk_category") == F.expr(BAND_SQL.format(p="default_probability")))
    return batch_scores(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("ids"), _inside("default_probability").alias("inside"),
        banded.alias("banded"), F.max("scoring_job").alias("job"),
    )


@query(
    "tiered_score_coverage",
    """SELECT CASE WHEN o_custkey % 3 = 0 THEN 'realtime' WHEN o_custkey % 2 = 0 THEN 'fallback' ELSE 'INSUFFICIENT_DATA' END AS tier_used,
  count(DISTINCT o_custkey) AS n, true AS agrees
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""",
)
def tiered_score_coverage(spark, sf_dir):
    """Scores and bands are there, and agree, exactly where there is data."""
    score = F.col("risk_score")
    without = score.isNull() & F.col("risk_category").isNull()
    within = score.between(0.0, 1.0) & (F.col("risk_category") == F.expr(BAND_SQL.format(p="risk_score")))
    right = F.when(F.col("tier_used") == "INSUFFICIENT_DATA", without).otherwise(F.coalesce(within, F.lit(False)))
    return tiered_scores(spark, sf_dir).groupBy("tier_used").agg(
        F.count(F.lit(1)).alias("n"), F.every(right).alias("agrees")
    )
