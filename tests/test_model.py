"""Training and scoring: coverage, ranges and errors, not particular numbers."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.operators import model as m
from tallyspan.operators.evaluate import ranking_metrics
from tallyspan.spec import Spec

SMALL = {"maxDepth": 2}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    data = []
    for i in range(240):
        signal, noise = float(rng.normal()), float(rng.normal())
        t = int(signal + 0.3 * rng.normal() > 0.5)
        data.append((i, signal if i % 17 else None, noise, "pqr"[i % 3] if i % 13 else None, t))
    return spark.createDataFrame(data, "id int, signal double, noise double, kind string, target int").repartition(4)


@pytest.fixture(scope="module")
def run(rows):
    return m.cross_validate(rows, "id", "target", folds=2, rounds=2, params={"boosted_trees": SMALL, "random_forest": SMALL})


def test_cross_validation(run):
    oof = run.oof.toPandas()
    for _, g in oof.groupby("model"):
        assert sorted(g["id"]) == list(range(240)) and g["prediction"].between(0, 1).all()
        assert set(g["fold"]) == {1, 2}
    assert set(run.models) == {(f, k) for f in m.FAMILIES for k in (1, 2)}
    metrics = run.fold_metrics("target").toPandas()
    assert (metrics["roc_auc"] > 0.7).all()
    weights = run.importance.toPandas()
    assert set(weights["feature"]) == {"signal", "noise", "kind"}
    assert weights.groupby("feature")["importance"].mean().idxmax() == "signal"
    fold, best = run.best("boosted_trees", "target")
    assert best is run.models["boosted_trees", fold]


def test_final_and_scoring(spark, rows, tmp_path):
    final = m.train_final(rows, "id", "target", selector_rounds=2, final_rounds=2, threshold=0.5, min_features=1, max_features=2, **SMALL)
    assert final.selected[0] == "signal" and len(final.selected) <= 2
    assert final.importance.where("selected").count() == len(final.selected)
    scored = m.batch_score(final.model, rows, "id", "job-1").toPandas()
    assert len(scored) == 240 and scored["default_probability"].between(0, 1).all()
    assert set(scored["risk_category"]) <= {"low", "medium", "high"} and set(scored["scoring_job"]) == {"job-1"}
    with pytest.raises(ValueError, match="no rows"):
        m.batch_score(final.model, rows.limit(0), "id", "job-1")
    report = m.holdout_report(final.model, rows, "target").first()
    assert report["n_rows"] == 240 and report["roc_auc"] > 0.8
    final.model.save(spark, str(tmp_path / "model"))
    again = m.RiskModel.load(spark, str(tmp_path / "model"))
    a, b = (x.probability(rows).orderBy("id").toPandas()["prediction"] for x in (final.model, again))
    assert again.features == final.model.features and np.allclose(a, b)
    # absent features and unseen categories are scored, not refused
    odd = rows.select("id", F.lit("new").alias("kind"))
    assert m.batch_score(final.model, odd, "id", "j").count() == 240
    with pytest.raises(ValueError):
        m.train_final(rows, "id", "target", selector_rounds=0)
    with pytest.raises(ValueError, match="No positive"):
        m.train_final(rows.withColumn("target", F.lit(0)), "id", "target", selector_rounds=1)


def test_permutation(rows, run):
    fold, model = run.best("boosted_trees", "target")
    chosen = m.explained_rows(rows, run.oof, "id", "boosted_trees", fold)
    assert chosen.count() == run.oof.where(f"model = 'boosted_trees' AND fold = {fold}").count()
    assert m.explained_rows(rows, run.oof, "id", "boosted_trees", fold, 30).count() == 30
    got = m.permutation_importance(model, chosen, "id", "target").toPandas()
    assert list(got["feature"])[0] == "signal" and len(got) == 3
    assert got["importance"].iloc[0] > 0.1
    assert m.permutation_importance(model, chosen, "id", "target", top=1).count() == 1


def test_search(rows):
    space = {"stepSize": (0.05, 0.3, "log"), "maxDepth": (2, 3, "int"), "subsamplingRate": (0.6, 1.0, "float")}
    trials = m.search(rows, "id", "target", trials=2, folds=2, rounds=2, space=space)
    got = trials.toPandas()
    assert list(got["trial"]) == [0, 1] and got["best"].sum() == 1
    assert got.loc[got["best"], "score"].iloc[0] == got["score"].max()
    assert 2 <= m.best_params(trials)["maxDepth"] <= 3
    assert m.draw_params(1) == m.draw_params(1) != m.draw_params(2)
    assert set(m.draw_params(0)) == set(m.SEARCH_SPACE)
    with pytest.raises(ValueError):
        m.search(rows, "id", "target", metric="accuracy")


def test_statements_and_tiers(spark):
    rng = np.random.default_rng(9)
    data = [(f"k{i}", dt.date(2024, 1, d), float(rng.normal() + 2 * (i % 2))) for i in range(40) for d in range(1, 6)]
    history = spark.createDataFrame(data, "id string, day date, x double")
    spec = Spec("id", "day", continuous=("x",))
    from tallyspan.operators.features import build_features

    names = ["x_mean", "x_last"]
    features = build_features(history, spec, names).withColumn("target", F.substring("id", 2, 9).cast("int") % 2)
    model = m.fit_model(features, "id", "target", names, [], 2, **SMALL)
    got = m.score_statements(model, history, spec).toPandas()
    assert len(got) == 40 and set(got["n_statements"]) == {5} and set(got["n_engineered_features"]) == {2}
    truth = spark.createDataFrame([(r.id, int(r.id[1:]) % 2, r.default_probability) for r in got.itertuples()], "id string, target int, p double")
    assert ranking_metrics(truth, "target", "p").first()["roc_auc"] > 0.8
    asked = spark.createDataFrame([("k0",), ("k1",), ("zz",)], "id string")
    cache = features.where("id = 'k0'").select("id", F.create_map(F.lit("x_mean"), F.col("x_mean"), F.lit("x_last"), F.col("x_last")).alias("features"))
    tiers = {r["id"]: r for r in m.tiered_score(model, asked, cache, features, "id").collect()}
    assert {k: r["tier_used"] for k, r in tiers.items()} == {"k0": "realtime", "k1": "fallback", "zz": "INSUFFICIENT_DATA"}
    assert tiers["zz"]["risk_score"] is None and tiers["zz"]["risk_category"] is None
    direct = dict(zip(got["id"], got["default_probability"]))
    assert tiers["k0"]["risk_score"] == pytest.approx(direct["k0"]) and tiers["k1"]["risk_score"] == pytest.approx(direct["k1"])


def test_batch_plan(spark, tmp_path):
    from tallyspan.plans import batch

    rng = np.random.default_rng(10)
    data = []
    for i in range(60):
        for d in range(1, 5):
            data.append((f"k{i}", f"2024-01-0{d}", float(rng.normal() + i % 2), None if d > 1 or i else 1.0, i % 4))
    statements = spark.createDataFrame(data, "id string, day string, x double, rare double, c int")
    labels = spark.createDataFrame([(f"k{i}", i % 2) for i in range(58)], "id string, target int")
    spec = Spec("id", "day", categorical=("c",), target="target")
    got = batch.run(
        spark, statements, labels, spec, "target", str(tmp_path), "plan", selector_rounds=1, final_rounds=1,
        min_features=2, max_features=5, **SMALL,
    )
    assert got.dropped == ["rare"] and got.holdout.first()["n_rows"] > 0
    assert spark.table(got.predictions).count() == 60
    assert got.drift.count() > 0
    split = {r["id"] for r in spark.table("plan_train").collect()}, {r["id"] for r in spark.table("plan_test").collect()}
    assert len(split[0] | split[1]) == 60 and not split[0] & split[1]
    carried = batch.features_with_labels(statements.withColumn("target", F.lit(1)), spec)
    assert carried.columns.count("target") == 1
    joined = batch.features_with_labels(statements.withColumn("target", F.lit(1)), spec, labels, "2024-01-02", "2024-01-03")
    assert joined.columns.count("target") == 1 and joined.where("c_count <> 2").count() == 0
    with pytest.raises(ValueError, match="empty"):
        batch.preprocess(statements.limit(0), spec)
