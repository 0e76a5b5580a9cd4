"""Metrics against brute force over all pairs and thresholds."""

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tallyspan.operators.evaluate import (
    best_fold, best_fold_rows, compare_models, confusion, evaluate, flatten_metrics, fold_metrics, pr_points,
    ranking_metrics, roc_points, score_curve, standardize_oof, with_timings,
)


def brute_auc(y, s):
    p, n = s[y == 1], s[y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in p for b in n])


def brute_ap(y, s):
    total, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        called = s >= t
        recall, precision = (y[called] == 1).sum() / (y == 1).sum(), (y[called] == 1).mean()
        total += (recall - last) * precision
        last = recall
    return total


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    y = (rng.random(400) < 0.3).astype(int)
    return y, np.round(np.clip(0.4 * y + rng.random(400) * 0.6, 0, 1), 2)


@pytest.fixture(scope="module")
def oof(spark, data):
    y, s = data
    rows = [(i, int(a), float(b), i % 3 + 1, "m") for i, (a, b) in enumerate(zip(*data))]
    rows += [(i, int(a), 0.5, i % 3 + 1, "flat") for i, a in enumerate(y)]
    rows += [(i, 0, float(b), i % 3 + 1, "nopos") for i, b in enumerate(s)]
    return spark.createDataFrame(rows, "id int, target int, prediction double, fold int, model string").repartition(4)


def test_ranking(oof, data):
    got = {r["model"]: r for r in ranking_metrics(oof, "target", "prediction", ["model"]).collect()}
    assert got["m"]["roc_auc"] == pytest.approx(brute_auc(*data), abs=1e-12)
    assert got["m"]["pr_auc"] == pytest.approx(brute_ap(*data), abs=1e-12)
    assert got["flat"]["roc_auc"] == 0.5
    assert got["nopos"]["roc_auc"] is None and got["nopos"]["pr_auc"] is None


def test_auc_ignores_monotone_transforms(oof, data):
    bent = oof.where("model = 'm'").withColumn("prediction", F.exp("prediction") * 3 - 1)
    assert ranking_metrics(bent, "target", "prediction").first()["roc_auc"] == pytest.approx(brute_auc(*data))


def test_confusion_and_threshold(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.49), (0, 0.1)], "target int, p double")
    got = confusion(df, "target", "p").first()
    assert [got[c] for c in ("true_negative", "false_positive", "false_negative", "true_positive")] == [1, 1, 1, 1]
    assert got["precision"] == got["recall"] == got["f1"] == 0.5
    none = confusion(df, "target", "p", 2.0).first()
    assert none["precision"] == none["recall"] == none["f1"] == 0.0


def test_evaluate_agrees_with_parts(oof):
    whole = {r["model"]: r for r in evaluate(oof, "target", "prediction").collect()}
    for r in confusion(oof, "target", "prediction", by=["model"]).collect():
        for c in ("true_negative", "false_positive", "false_negative", "true_positive", "precision", "recall", "f1"):
            assert whole[r["model"]][c] == r[c]
    assert whole["m"]["n_rows"] == 400


def test_roc_points(oof, data):
    y, s = data
    m = oof.where("model = 'm'")
    got = sorted((r["threshold"], r["fpr"], r["tpr"]) for r in roc_points(m, "target", "prediction").collect())
    want = [(t, (s[y == 0] >= t).mean(), (s[y == 1] >= t).mean()) for t in sorted(set(s))]
    np.testing.assert_allclose(got[:-1], want)
    assert got[-1] == (float("inf"), 0.0, 0.0)
    corners = roc_points(m, "target", "prediction", drop_collinear=True).toPandas().sort_values(["fpr", "tpr"])
    assert len(corners) < len(got)
    area = np.trapezoid(corners["tpr"], corners["fpr"])
    assert area == pytest.approx(brute_auc(y, s))


def test_pr_points(oof, data):
    y, s = data
    got = pr_points(oof.where("model = 'm'"), "target", "prediction").toPandas()
    end = got[got["threshold"].isna()]
    assert list(end["precision"]) == [1.0] and list(end["recall"]) == [0.0]
    assert got["baseline"].to_numpy() == pytest.approx(y.mean())
    for _, r in got[got["threshold"].notna()].iterrows():
        called = s >= r["threshold"]
        assert r["precision"] == pytest.approx(y[called].mean())
        assert r["recall"] == pytest.approx(y[called].sum() / y.sum())


def test_curve_runs_in_slices(oof):
    plan = plan_of(score_curve(oof, "target", "prediction"))
    windows = [line for line in plan.splitlines() if "Window [" in line and "pos_cum" in line]
    assert windows and all("_cell" in line for line in windows)


def test_best_fold(spark):
    rows = [("a", 1, 0.7), ("a", 2, 0.9), ("a", 3, 0.9), ("b", 1, None), ("b", 2, 0.1)]
    folds = spark.createDataFrame(rows, "model string, fold int, roc_auc double")
    got = {r["model"]: r["best_fold"] for r in best_fold(folds).collect()}
    assert got == {"a": 2, "b": 2}
    oof = spark.createDataFrame([("a", 2, 1), ("a", 3, 2), ("b", 2, 3)], "model string, fold int, id int")
    assert sorted(r["id"] for r in best_fold_rows(oof, folds).collect()) == [1, 3]


def test_standardize(spark):
    def columns(schema, model, **kw):
        df = spark.createDataFrame([], schema)
        return standardize_oof(df, model, "id", "target", **kw).columns

    want = ["id", "target", "prediction", "fold", "model"]
    assert columns("id int, target int, prediction double, fold int", "x") == want
    assert columns("id int, target int, x_oof double", "x") == want
    assert columns("id int, target int, xgb_oof double", "xgboost") == want
    with pytest.raises(ValueError, match="prediction column"):
        columns("id int, target int, other double", "x")
    one = spark.createDataFrame([(1, 0, 0.3)], "id int, target int, s double")
    assert standardize_oof(one, "x", "id", "target", "s").first()["fold"] == -1


def test_comparison_and_flattening(oof):
    report = evaluate(oof, "target", "prediction")
    timed = with_timings(report.where("model = 'm'"), 3, 5.0, 1.0)
    table = compare_models([timed, report.where("model = 'flat'")]).collect()
    assert [r["model"] for r in table] == ["m", "flat"]
    assert table[0]["total_time_seconds"] == 6.0 and table[1]["total_time_seconds"] is None
    assert with_timings(report, 1, 5.0, None).first()["total_time_seconds"] is None
    folds = fold_metrics(oof.where("model = 'm'"), "target", "prediction")
    long = {r["key"]: r["value"] for r in flatten_metrics(timed, folds).collect()}
    assert long["n_rows"] == 400.0 and {"fold_1_roc_auc", "fold_3_f1"} <= set(long)
