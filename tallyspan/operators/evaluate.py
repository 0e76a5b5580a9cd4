"""Model evaluation over (id, target, prediction, fold, model) rows.

Equal scores are combined first; every curve is then a running count over the
distinct scores, which ``running_sums`` spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.scalar import DEFAULT_THRESHOLD
from tallyspan.operators.skew import join_small, null_safe, running_sums

# Column order of the comparison table, names of the fold metrics,
# and the short names under which older prediction files keep their scores.
COMPARISON_COLUMNS = (
    "model", "n_rows", "n_features", "roc_auc", "pr_auc", "precision", "recall", "f1",
    "threshold", "training_time_seconds", "inference_time_seconds", "total_time_seconds",
)
FOLD_METRICS = ("roc_auc", "pr_auc", "precision", "recall", "f1")
SCORE_ALIASES = {"lightgbm": "lgbm_oof", "xgboost": "xgb_oof"}


def standardize_oof(
    df: DataFrame, model: str, key: str, target: str, prediction: str | None = None,
    aliases: Mapping[str, str] = SCORE_ALIASES,
) -> DataFrame:
    """Bring a table of out-of-fold scores to (key, target, prediction, fold, model)."""
    if prediction is None:
        choices = ["prediction", f"{model}_oof", aliases.get(model, "")]
        prediction = next((c for c in choices if c in df.columns), None)
        if prediction is None:
            raise ValueError(f"Could not find prediction column for {model}.")
    fold = F.col("fold") if "fold" in df.columns else F.lit(-1)
    return df.select(
        key, target, F.col(prediction).alias("prediction"),
        fold.cast("int").alias("fold"), F.lit(model).alias("model"),
    )


def score_counts(df: DataFrame, target: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = (F.col(target) == 1).cast("bigint")
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )


def score_curve(df: DataFrame, target: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: positives and negatives at it, at or above it, and in all."""
    return running_sums(score_counts(df, target, score, by), by, [F.col("score").desc()], ["pos", "neg"])


def _ratio(top, bottom):
    return F.when(bottom > 0, top / bottom)


def _ratio_or_zero(top, bottom):
    return F.coalesce(_ratio(top, bottom), F.lit(0.0))


def ranking_metrics(df: DataFrame, target: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and average precision per group; NULL when a class is empty."""
    pos, neg = F.col("pos"), F.col("neg")
    below = F.col("neg_total") - F.col("neg_cum")
    wins = F.sum(pos * (below + neg / 2))
    precision_mass = F.sum(pos * F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum")))
    curve = score_curve(df, target, score, by)
    total_pos, total_neg = F.sum(pos), F.sum(neg)
    return curve.groupBy(*by).agg(
        _ratio(wins, total_pos.cast("double") * total_neg).alias("roc_auc"),
        _ratio(precision_mass, total_pos).alias("pr_auc"),
    )


def called_positive(score: Column, threshold: float) -> Column:
    """A missing score (NULL or NaN) never calls a row positive."""
    return F.coalesce((score >= threshold) & ~F.isnan(score), F.lit(False))


def confusion(
    df: DataFrame, target: str, score: str, threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts, precision, recall and F1 (0 where undefined) in one aggregation."""
    actual, called = F.col(target) == 1, called_positive(F.col(score), threshold)
    counts = df.groupBy(*by).agg(
        F.count_if(~actual & ~called).alias("true_negative"),
        F.count_if(~actual & called).alias("false_positive"),
        F.count_if(actual & ~called).alias("false_negative"),
        F.count_if(actual & called).alias("true_positive"),
    )
    return _with_rates(counts)


def _with_rates(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    return counts.withColumns(
        {
            "precision": _ratio_or_zero(tp, tp + fp),
            "recall": _ratio_or_zero(tp, tp + fn),
            "f1": _ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        }
    )


def evaluate(
    df: DataFrame, target: str, score: str, by: Sequence[str] = ("model",),
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """All metrics of every group in one job: the confusion counts are sums over the same
    score table that the ranking metrics run along."""
    pos, neg = F.col("pos"), F.col("neg")
    called = called_positive(F.col("score"), threshold)
    below = F.col("neg_total") - F.col("neg_cum")
    total_pos, total_neg = F.sum(pos), F.sum(neg)
    zero = F.lit(0).cast("bigint")
    counts = score_curve(df, target, score, by).groupBy(*by).agg(
        (total_pos + total_neg).alias("n_rows"),
        _ratio(F.sum(pos * (below + neg / 2)), total_pos.cast("double") * total_neg).alias("roc_auc"),
        _ratio(F.sum(pos * F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))), total_pos).alias("pr_auc"),
        F.sum(F.when(called, zero).otherwise(neg)).alias("true_negative"),
        F.sum(F.when(called, neg).otherwise(zero)).alias("false_positive"),
        F.sum(F.when(called, zero).otherwise(pos)).alias("false_negative"),
        F.sum(F.when(called, pos).otherwise(zero)).alias("true_positive"),
    )
    return _with_rates(counts).withColumn("threshold", F.lit(threshold))


def with_timings(
    report: DataFrame, n_features: int | None = None,
    training_seconds: float | None = None, inference_seconds: float | None = None,
) -> DataFrame:
    """Add the size and timing fields; the total is NULL unless both parts are known."""
    total = (
        training_seconds + inference_seconds
        if training_seconds is not None and inference_seconds is not None
        else None
    )
    number = lambda v: F.lit(v).cast("double")
    return report.withColumns(
        {
            "n_features": F.lit(n_features).cast("int"),
            "training_time_seconds": number(training_seconds),
            "inference_time_seconds": number(inference_seconds),
            "total_time_seconds": number(total),
        }
    )


def fold_metrics(df: DataFrame, target: str, score: str, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    return evaluate(df, target, score, ("model", "fold"), threshold)


def mean_fold_metrics(folds: DataFrame) -> DataFrame:
    return folds.groupBy("model").agg(*[F.avg(m).alias(f"mean_{m}") for m in FOLD_METRICS])


def roc_points(
    df: DataFrame, target: str, score: str, by: Sequence[str] = (), drop_collinear: bool = False
) -> DataFrame:
    """(fpr, tpr, threshold) from (0, 0) on, one point per distinct score.

    ``drop_collinear`` leaves out points in the middle of a run of equal steps: the
    same positives and negatives at their own and at the next lower score.
    """
    curve = score_curve(df, target, score, by)
    points = curve.select(
        *by, "pos", "neg",
        _ratio(F.col("neg_cum").cast("double"), F.col("neg_total")).alias("fpr"),
        _ratio(F.col("pos_cum").cast("double"), F.col("pos_total")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    if drop_collinear:
        points = _corners(curve, by)
    start = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    origin = start.select(
        *by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return points.select(*by, "fpr", "tpr", "threshold").unionByName(origin)


def _corners(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    """The ends, and points where the step to the next point differs from the step before.

    The next score's step is fetched by an equi-join on the running row number.
    """
    numbered = running_sums(
        curve.withColumn("_one", F.lit(1).cast("bigint")), by, [F.col("score").desc()], ["_one"]
    )
    following = numbered.select(
        *by, (F.col("_one_cum") - 1).alias("_one_cum"), F.col("pos").alias("_pos"), F.col("neg").alias("_neg")
    )
    joined = null_safe(numbered, following, [*by, "_one_cum"], "left")
    end = F.col("_pos").isNull() | (F.col("_one_cum") == 1)
    bent = end | (F.col("_pos") != F.col("pos")) | (F.col("_neg") != F.col("neg"))
    return joined.where(bent).select(
        *by,
        _ratio(F.col("neg_cum").cast("double"), F.col("neg_total")).alias("fpr"),
        _ratio(F.col("pos_cum").cast("double"), F.col("pos_total")).alias("tpr"),
        F.col("score").alias("threshold"),
    )


def pr_points(df: DataFrame, target: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(precision, recall, threshold, baseline), closed by recall 0 at precision 1;
    ``baseline`` is the share of positives."""
    curve = score_curve(df, target, score, by)
    base = _ratio(F.col("pos_total").cast("double"), F.col("pos_total") + F.col("neg_total"))
    points = curve.select(
        *by,
        (F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))).alias("precision"),
        _ratio(F.col("pos_cum").cast("double"), F.col("pos_total")).alias("recall"),
        F.col("score").alias("threshold"),
        base.alias("baseline"),
    )
    share = F.avg((F.col(target) == 1).cast("double"))
    end = df.groupBy(*by).agg(share.alias("baseline")).select(
        *by, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"), "baseline",
    )
    return points.unionByName(end)


def compare_models(reports: Sequence[DataFrame], rank_by: str = "roc_auc") -> DataFrame:
    """Reports of any shape under one fixed set of columns, best first."""
    table = reports[0]
    for other in reports[1:]:
        table = table.unionByName(other, allowMissingColumns=True)
    absent = {c: F.lit(None).cast("double") for c in COMPARISON_COLUMNS if c not in table.columns}
    return table.withColumns(absent).select(*COMPARISON_COLUMNS).orderBy(
        F.col(rank_by).desc_nulls_last(), "model"
    )


def best_fold(folds: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The fold with the highest metric per model; the earliest wins a tie."""
    return folds.groupBy("model").agg(
        F.max_by("fold", F.struct(F.col(metric), -F.col("fold"))).alias("best_fold")
    )


def best_fold_rows(oof: DataFrame, folds: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """Rows scored in their model's best fold.  One row per model is joined, so the
    scores themselves are not moved."""
    best = best_fold(folds, metric).withColumnRenamed("best_fold", "fold")
    return join_small(oof, best, ["model", "fold"], "left_semi")


def flatten_metrics(reports: DataFrame, folds: DataFrame | None = None) -> DataFrame:
    """(model, key, value): every numeric report field, and ``fold_{n}_{metric}``."""
    numeric = [
        f.name for f in reports.schema.fields if f.name != "model" and f.dataType.typeName() != "string"
    ]
    long = reports.select("model", *[F.col(c).cast("double") for c in numeric]).unpivot(
        ["model"], numeric, "key", "value"
    )
    if folds is not None:
        per_fold = folds.select("model", "fold", *FOLD_METRICS).unpivot(
            ["model", "fold"], list(FOLD_METRICS), "metric", "value"
        )
        named = F.concat(F.lit("fold_"), F.col("fold").cast("string"), F.lit("_"), F.col("metric"))
        long = long.unionByName(per_fold.select("model", named.alias("key"), "value"))
    return long.where(F.col("value").isNotNull())
