"""The command-line steps, one after the other, on a small CSV."""

import base64
import datetime as dt
import json

import numpy as np
import pytest

from tallyspan.jobs import MESSAGE, run
from tallyspan.operators.model import RiskModel
from tallyspan.sources.store import Store
from tallyspan.sources.writers import read_document, read_latest, write_feature_list
from tallyspan.streaming.rolling import read_vectors


def test_steps(spark, tmp_path):
    rng = np.random.default_rng(11)
    lines, labels = ["id,day,x,y,kind,rare"], ["id,target"]
    for i in range(80):
        labels.append(f"k{i},{i % 2}")
        for d in range(1, 6):
            lines.append(f"k{i},2024-01-0{d},{rng.normal() + 2 * (i % 2):.3f},{rng.normal():.3f},{'pq'[d % 2]},")
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "l.csv").write_text("\n".join(labels) + "\n")
    at = lambda name: str(tmp_path / name)
    common = ["--id", "id", "--date", "day", "--categorical", "kind", "--overwrite"]
    step = lambda name, *args: run(spark, [name, *common, *args])

    schema = "id string, day string, x double, y double, kind string, rare double"
    step("preprocess", "--input", at("s.csv"), "--schema", schema, "--output", at("clean"))
    clean = spark.read.parquet(at("clean"))
    assert "rare" not in clean.columns and dict(clean.dtypes)["day"] == "date"
    step("features", "--input", at("clean"), "--labels", at("l.csv"), "--output", at("features"))
    features = spark.read.parquet(at("features"))
    assert features.count() == 80 and {"x_mean", "kind_nunique", "target"} <= set(features.columns)
    step("features", "--input", at("clean"), "--end-date", "2024-01-02", "--output", at("early"))
    assert spark.read.parquet(at("early")).where("kind_count <> 2").count() == 0
    step("split", "--input", at("features"), "--train", at("train"), "--test", at("test"), "--train-ratio", "0.7")
    params = ["--params", '{"maxDepth": 2}', "--rounds", "2"]
    step("train", "--input", at("train"), "--output", at("out"), "--holdout", at("test"), "--selector-rounds", "1",
         "--min-features", "1", "--max-features", "4", *params)
    assert spark.read.csv(at("out/holdout_predictions"), header=True).columns == ["id", "target", "prediction"]
    step("train", "--input", at("train"), "--output", at("small"), "--selector-rounds", "1", "--max-rows", "20",
         "--balanced-sample", "--min-features", "1", "--max-features", "4", *params)
    for _ in range(2):
        step("score", "--model", at("out/model"), "--input", at("features"), "--output", at("scores"), "--publish", at("served"))
    assert spark.read.parquet(at("scores")).count() == 80
    served = Store(spark, at("served"), "id")
    assert served.read().dtypes[:2] == [("id", "string"), ("default_probability", "double")] and served.read().count() == 80
    report = spark.read.json(at("out/report/json")).first()
    assert report["n_rows"] == report["positives"] + report["negatives"] == spark.read.parquet(at("train")).count()
    assert 1 <= report["n_selected"] <= 4 < report["n_features"] and report["n_trees"] == 2 == report["final_rounds"]
    assert json.loads(report["params"]) == {"maxDepth": 2} and report["training_time_seconds"] > 0
    step("score-statements", "--model", at("out/model"), "--input", at("clean"), "--output", at("scores2"))
    a, b = ({r["id"]: r["default_probability"] for r in spark.read.parquet(at(p)).collect()} for p in ("scores", "scores2"))
    assert a == pytest.approx(b)
    for _ in range(2):  # a repeated run replaces its report
        step("drift", "--baseline", at("train"), "--current", at("test"), "--output", at("drift"), "--run", "may",
             "--alerts", '{"x_mean": 1e9}')
    drift = spark.read.parquet(at("drift/report/history"))
    assert 40 < drift.count() == drift.select("feature_name").distinct().count()
    assert spark.read.csv(at("drift/report/csv"), header=True).count() == drift.count()
    assert spark.read.parquet(at("drift/alerts/history")).where("feature_name = 'x_mean' AND NOT alert").count() == 1
    step("tune", "--input", at("train"), "--output", at("tuned"), "--trials", "1", "--folds", "2", "--rounds", "2")
    result = read_document(spark, at("tuned/result"))
    assert (result["metric"], result["n_trials"], result["best_trial"]) == ("roc_auc", 1, 0)
    assert result["best_score"] == result["mean_roc_auc"] and result["best_params"]["maxDepth"] >= 3
    step("train", "--input", at("train"), "--output", at("again"), "--selector-rounds", "1", "--rounds", "2",
         "--tuned", at("tuned"), "--min-features", "1", "--max-features", "4")
    again = spark.read.json(at("again/report/json")).first()
    assert again["tuned_score"] == result["best_score"] and json.loads(again["params"]) == result["best_params"]
    step("cross-validate", "--input", at("train"), "--output", at("cv"), "--folds", "2", "--rounds", "2")
    assert spark.read.json(at("cv/metrics/json")).selectExpr("size(fold_metrics) AS n").first()["n"] == 2
    folds = spark.read.parquet(at("cv/fold_importance"))
    n_features = len(features.columns) - 2
    assert folds.count() == 4 * n_features and folds.select("model", "fold").distinct().count() == 4
    mean = {r["feature"]: r for r in spark.read.parquet(at("cv/importance")).where("model = 'boosted_trees'").collect()}
    by_fold = [r["importance"] for r in folds.where("model = 'boosted_trees' AND feature = 'x_mean'").collect()]
    assert len(mean) == n_features and mean["x_mean"]["importance_mean"] == pytest.approx(np.mean(by_fold))
    assert mean["x_mean"]["importance_std"] == pytest.approx(np.std(by_fold, ddof=1))
    model = RiskModel.load(spark, at("cv/models/random_forest/fold_2"))
    assert model.probability(features).count() == 80
    step("evaluate", "--input", at("cv/oof"), "--output", at("report"))
    assert spark.read.csv(at("report/comparison"), header=True).count() == 2
    step("evaluate", "--input", at("cv/oof"), at("cv/oof"), "--names", "may,june", "--output", at("report2"))
    names = {r["model"] for r in spark.read.csv(at("report2/comparison"), header=True).collect()}
    assert names == {f"{n}/{m}" for n in ("may", "june") for m in ("boosted_trees", "random_forest")}
    with pytest.raises(ValueError, match="name for each"):
        step("evaluate", "--input", at("cv/oof"), "--names", "may,june", "--output", at("report3"))
    spark.createDataFrame([("k1", "2024-01"), ("k2", "2023-12")], "id string, statement_cycle string").write.parquet(at("changes"))
    step("refresh", "--history", at("clean"), "--changes", at("changes"), "--features", at("out/selected_features"),
         "--serving", at("serving"), "--cycle", "2024-01")
    assert [r["id"] for r in read_latest(spark, at("serving")).collect()] == ["k1"]


def test_streams(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    say = lambda place, text: (base64.b64encode(text.encode()).decode(), dt.datetime(2024, 1, 1), place)
    rows = [say(i, json.dumps({"id": f"k{i % 2}", "day": f"2024-01-0{i + 1}", "x": float(i)})) for i in range(6)]
    spark.createDataFrame([*rows, say(6, "nothing")], MESSAGE).write.parquet(at("messages"))
    write_feature_list(spark, ["x_mean", "x_last"], at("wanted"))
    common = ["--id", "id", "--date", "day", "--input", at("messages"), "--schema", "id string, day string, x double"]
    for _ in range(2):  # nothing new the second time
        run(spark, ["ingest", *common, "--output", at("root"), "--checkpoint", at("c1")])
        run(spark, ["stream-features", *common, "--output", at("root"), "--checkpoint", at("c2"), "--features", at("wanted")])
    assert [spark.read.parquet(at(f"root/{n}")).count() for n in ("history", "changes", "rejects")] == [6, 6, 1]
    found = {r["id"]: r["features"] for r in read_vectors(spark, at("root"), "id").collect()}
    assert found == {"k0": {"x_mean": 2.0, "x_last": 4.0}, "k1": {"x_mean": 3.0, "x_last": 5.0}}


def test_bad_arguments(spark):
    with pytest.raises(SystemExit):
        run(spark, ["nothing"])
    with pytest.raises(SystemExit):
        run(spark, ["score", "--id", "id"])
