"""Model-evaluation queries over two scored models with tied scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.catalog.base import SCORED_SQL, query, r, rounded, rs, scored, table
from tallyspan.operators.evaluate import (
    FOLD_METRICS, best_fold, best_fold_rows, compare_models, confusion, evaluate, flatten_metrics, fold_metrics,
    mean_fold_metrics, pr_points,
    ranking_metrics, roc_points, standardize_oof, with_timings,
)
from tallyspan.operators.importance import mean_fold_importance

CONFUSION_SQL = """count(*) FILTER (WHERE target <> 1 AND prediction < 0.5) AS true_negative,
    count(*) FILTER (WHERE target <> 1 AND prediction >= 0.5) AS false_positive,
    count(*) FILTER (WHERE target = 1 AND prediction < 0.5) AS false_negative,
    count(*) FILTER (WHERE target = 1 AND prediction >= 0.5) AS true_positive"""
RATES_SQL = f"""{r("coalesce(true_positive / nullif(true_positive + false_positive, 0), 0.0)", "precision")},
  {r("coalesce(true_positive / nullif(true_positive + false_negative, 0), 0.0)", "recall")},
  {r("coalesce(2 * true_positive / nullif(2 * true_positive + false_positive + false_negative, 0), 0.0)", "f1")}"""


def curve_sql(by: str) -> str:
    """Ranking metrics of each group, from the running counts over distinct scores."""
    return f"""{SCORED_SQL}, g AS (
  SELECT {by}, prediction, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target <> 1) AS neg
  FROM scored GROUP BY {by}, prediction),
cv AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER (PARTITION BY {by}) AS p,
    sum(neg) OVER (PARTITION BY {by}) AS n FROM g
  WINDOW w AS (PARTITION BY {by} ORDER BY prediction DESC ROWS UNBOUNDED PRECEDING)),
rank_metrics AS (SELECT {by}, sum(pos * (n - cn + neg / 2)) / nullif(max(p) * max(n), 0) AS roc_auc,
    sum(pos * cp / (cp + cn)) / nullif(max(p), 0) AS pr_auc FROM cv GROUP BY {by})"""


def report_sql(by: str) -> str:
    return f"""{curve_sql(by)}, conf AS (
  SELECT {by}, count(*) AS n_rows, {CONFUSION_SQL} FROM scored GROUP BY {by}),
report AS (SELECT conf.*, {r("roc_auc", "roc_auc")}, {r("pr_auc", "pr_auc")},
  {RATES_SQL}, CAST(0.5 AS DOUBLE) AS threshold FROM conf JOIN rank_metrics USING ({by}))"""


@query(
    "confusion_matrix",
    f"WITH {SCORED_SQL} SELECT model, {CONFUSION_SQL} FROM scored GROUP BY model",
)
def confusion_matrix(spark, sf_dir):
    return confusion(scored(spark, sf_dir), "target", "prediction", by=["model"]).select(
        "model", "true_negative", "false_positive", "false_negative", "true_positive"
    )


@query(
    "threshold_metrics",
    f"""WITH {SCORED_SQL}, conf AS (SELECT model, {CONFUSION_SQL} FROM scored GROUP BY model)
SELECT model, {RATES_SQL} FROM conf""",
)
def threshold_metrics(spark, sf_dir):
    return rounded(
        confusion(scored(spark, sf_dir), "target", "prediction", by=["model"]).select(
            "model", "precision", "recall", "f1"
        )
    )


@query("roc_auc", f"WITH {curve_sql('model')} SELECT model, {r('roc_auc', 'roc_auc')} FROM rank_metrics")
def roc_auc(spark, sf_dir):
    return rounded(ranking_metrics(scored(spark, sf_dir), "target", "prediction", ["model"]).select("model", "roc_auc"))


@query("average_precision", f"WITH {curve_sql('model')} SELECT model, {r('pr_auc', 'pr_auc')} FROM rank_metrics")
def average_precision(spark, sf_dir):
    return rounded(ranking_metrics(scored(spark, sf_dir), "target", "prediction", ["model"]).select("model", "pr_auc"))


@query(
    "roc_points",
    f"""WITH {curve_sql('model')}
SELECT model, {r("cn / n", "fpr")}, {r("cp / p", "tpr")}, prediction AS threshold FROM cv
UNION ALL SELECT DISTINCT model, 0.0, 0.0, CAST('inf' AS DOUBLE) FROM scored""",
)
def roc_points_query(spark, sf_dir):
    return rounded_but(roc_points(scored(spark, sf_dir), "target", "prediction", ["model"]), "threshold")


@query(
    "roc_corner_points",
    f"""WITH {curve_sql('model')}, s AS (SELECT *, lead(pos) OVER w AS np, lead(neg) OVER w AS nn, row_number() OVER w AS i
  FROM cv WINDOW w AS (PARTITION BY model ORDER BY prediction DESC))
SELECT model, {r("cn / n", "fpr")}, {r("cp / p", "tpr")}, prediction AS threshold FROM s
WHERE i = 1 OR np IS NULL OR np <> pos OR nn <> neg
UNION ALL SELECT DISTINCT model, 0.0, 0.0, CAST('inf' AS DOUBLE) FROM scored""",
)
def roc_corner_points(spark, sf_dir):
    points = roc_points(scored(spark, sf_dir), "target", "prediction", ["model"], drop_collinear=True)
    return rounded_but(points, "threshold")


def rounded_but(df, *kept):
    """Rounded, but these columns as they are: infinity cannot be rounded."""
    hidden = df.withColumns({c: F.struct(c) for c in kept})
    return rounded(hidden).withColumns({c: F.col(f"{c}.{c}") for c in kept})


@query(
    "pr_points",
    f"""WITH {curve_sql('model')}
SELECT model, {r("cp / (cp + cn)", "precision")}, {r("cp / p", "recall")}, prediction AS threshold,
  {r("p / (p + n)", "baseline")} FROM cv
UNION ALL SELECT model, 1.0, 0.0, NULL, {rs('avg(target)')} FROM scored GROUP BY model""",
)
def pr_points_query(spark, sf_dir):
    return rounded(pr_points(scored(spark, sf_dir), "target", "prediction", ["model"]))


@query("oof_report", f"WITH {report_sql('model')} SELECT * FROM report")
def oof_report(spark, sf_dir):
    return rounded(evaluate(scored(spark, sf_dir), "target", "prediction"))


@query("fold_metrics", f"WITH {report_sql('model, fold')} SELECT * FROM report")
def fold_metrics_query(spark, sf_dir):
    return rounded(fold_metrics(scored(spark, sf_dir), "target", "prediction"))


FULL_FOLD_SQL = f"""{curve_sql('model, fold')}, conf AS (
  SELECT model, fold, {CONFUSION_SQL} FROM scored GROUP BY model, fold),
fm AS (SELECT model, fold, roc_auc, pr_auc, coalesce(true_positive / nullif(true_positive + false_positive, 0), 0.0) AS precision,
  coalesce(true_positive / nullif(true_positive + false_negative, 0), 0.0) AS recall,
  coalesce(2 * true_positive / nullif(2 * true_positive + false_positive + false_negative, 0), 0.0) AS f1
  FROM conf JOIN rank_metrics USING (model, fold))"""


@query(
    "fold_means",
    f"""WITH {FULL_FOLD_SQL} SELECT model, {r("avg(roc_auc)", "mean_roc_auc")}, {r("avg(pr_auc)", "mean_pr_auc")},
  {r("avg(precision)", "mean_precision")}, {r("avg(recall)", "mean_recall")}, {r("avg(f1)", "mean_f1")} FROM fm GROUP BY model""",
)
def fold_means(spark, sf_dir):
    return rounded(mean_fold_metrics(fold_metrics(scored(spark, sf_dir), "target", "prediction")))


@query(
    "best_fold",
    f"""WITH {FULL_FOLD_SQL} SELECT model, fold AS best_fold FROM fm
QUALIFY row_number() OVER (PARTITION BY model ORDER BY roc_auc DESC, fold) = 1""",
)
def best_fold_query(spark, sf_dir):
    return best_fold(fold_metrics(scored(spark, sf_dir), "target", "prediction"))


@query(
    "best_fold_rows",
    f"""WITH {FULL_FOLD_SQL}, best AS (SELECT model, fold FROM fm
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY roc_auc DESC, fold) = 1)
SELECT s.model, s.fold, doc_id, target, prediction FROM scored s JOIN best USING (model, fold)""",
)
def best_fold_rows_query(spark, sf_dir):
    rows = scored(spark, sf_dir)
    chosen = best_fold_rows(rows, fold_metrics(rows, "target", "prediction"))
    return chosen.select("model", "fold", "doc_id", "target", "prediction")


@query(
    "standardize_oof",
    f"""WITH {SCORED_SQL} SELECT doc_id, target, prediction, -1 AS fold,
  CASE model WHEN 'length' THEN 'lightgbm' ELSE 'xgboost' END AS model FROM scored""",
)
def standardize_oof_query(spark, sf_dir):
    rows = scored(spark, sf_dir)
    named = {"length": ("lightgbm", "lgbm_oof"), "toxicity": ("xgboost", "xgb_oof")}
    one = lambda own, model, column: standardize_oof(
        rows.where(F.col("model") == own).select("doc_id", "target", F.col("prediction").alias(column)), model, "doc_id", "target"
    )
    first, second = (one(own, *names) for own, names in named.items())
    return first.unionByName(second)


def _comparison(spark, sf_dir):
    report = evaluate(scored(spark, sf_dir), "target", "prediction")
    timed = with_timings(report.where("model = 'length'"), 1, 10.0, 2.5)
    plain = with_timings(report.where("model = 'toxicity'"), 2, 4.0, None).drop("n_features")
    return compare_models([timed, plain])


COMPARISON_SQL = f"""{report_sql('model')}, cmp AS (
  SELECT model, n_rows, CASE WHEN model = 'length' THEN 1 END AS n_features, roc_auc, pr_auc, precision, recall, f1, threshold,
  CASE WHEN model = 'length' THEN 10.0 ELSE 4.0 END AS training_time_seconds,
  CASE WHEN model = 'length' THEN 2.5 END AS inference_time_seconds,
  CASE WHEN model = 'length' THEN 12.5 END AS total_time_seconds FROM report)"""


@query("model_comparison", f"WITH {COMPARISON_SQL} SELECT * FROM cmp")
def model_comparison(spark, sf_dir):
    return rounded(_comparison(spark, sf_dir))


@query(
    "model_ranking",
    f"WITH {curve_sql('model')} SELECT model, {r('roc_auc', 'roc_auc')}, row_number() OVER (ORDER BY rank_metrics.roc_auc DESC, model) AS place FROM rank_metrics",
)
def model_ranking(spark, sf_dir):
    """Models in order of ROC-AUC; there are as many rows as models."""
    ranked = ranking_metrics(scored(spark, sf_dir), "target", "prediction", ["model"])
    in_order = ranked.agg(
        F.reverse(F.array_sort(F.collect_list(F.struct("roc_auc", "model")))).alias("rows")
    ).select(F.posexplode("rows").alias("at", "row"))
    return rounded(in_order.select("row.model", "row.roc_auc", (F.col("at") + 1).cast("bigint").alias("place")))


# orders of each pair of customers by fold: every pair is absent from three of the five folds
FOLD_IMPORTANCE_SQL = """fi AS (
  SELECT 'pair_' || CAST(o_custkey // 2 AS VARCHAR) AS feature, o_custkey % 5 + 1 AS fold, count(*) AS importance
  FROM orders GROUP BY 1, 2)"""


@query(
    "importance_mean",
    f"""WITH {FOLD_IMPORTANCE_SQL}, grid AS (
  SELECT feature, fold, coalesce(importance, 0) AS importance
  FROM (SELECT DISTINCT feature FROM fi) CROSS JOIN (SELECT range AS fold FROM range(1, 6)) LEFT JOIN fi USING (feature, fold))
SELECT feature, {r("avg(importance)", "importance_mean")}, {r("stddev_samp(importance)", "importance_std")}
FROM grid GROUP BY feature""",
)
def importance_mean(spark, sf_dir):
    name = F.concat(F.lit("pair_"), F.floor(F.col("o_custkey") / 2).cast("string"))
    per_fold = table(spark, sf_dir, "orders").groupBy(
        name.alias("feature"), (F.col("o_custkey") % 5 + 1).alias("fold")
    ).agg(F.count(F.lit(1)).alias("importance"))
    return rounded(mean_fold_importance(per_fold, 5))


REPORT_FIELDS = (
    "n_rows", "true_negative", "false_positive", "false_negative", "true_positive", "roc_auc", "pr_auc", "precision",
    "recall", "f1", "threshold",
)


def _long_sql(named: str, fields, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT model, {named.format(field=x)} AS key, {rs(f'CAST({x} AS DOUBLE)')} AS value FROM {source} WHERE {x} IS NOT NULL"
        for x in fields
    )


@query(
    "metrics_long",
    f"""SELECT * FROM (WITH {report_sql('model')} {_long_sql("'{field}'", REPORT_FIELDS, "report")})
UNION ALL SELECT * FROM (WITH {FULL_FOLD_SQL} {_long_sql("'fold_' || fold || '_{field}'", FOLD_METRICS, "fm")})""",
)
def metrics_long(spark, sf_dir):
    rows = scored(spark, sf_dir)
    report = evaluate(rows, "target", "prediction")
    return rounded(flatten_metrics(report, fold_metrics(rows, "target", "prediction")))
