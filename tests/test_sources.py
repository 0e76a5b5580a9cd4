"""Readers, writers and table loads."""

import json

import pytest
from pyspark.sql import functions as F

from tallyspan.sources import readers, writers


@pytest.fixture
def features(spark):
    return spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, None)], "id string, p double, q double")


def test_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,day,x\na,2020-01-02,1.5\nb,,oops\n")
    got = readers.read_statements_csv(spark, str(tmp_path / "s.csv"), "id string, day string, x double").collect()
    assert [tuple(r) for r in got] == [("a", "2020-01-02", 1.5), ("b", None, None)]
    (tmp_path / "l.csv").write_text("id,target\na,1\nb,0\n")
    labels = readers.read_labels_csv(spark, str(tmp_path / "l.csv"), "id", "target")
    assert labels.dtypes == [("id", "string"), ("target", "int")] and labels.count() == 2


def test_parquet_modes(spark, features, tmp_path):
    path = str(tmp_path / "p")
    writers.write_parquet(features, path)
    with pytest.raises(Exception, match="(?i)exist"):
        writers.write_parquet(features, path)
    writers.write_parquet(features, path, overwrite=True)
    assert readers.read_parquet(spark, path).count() == 2
    assert any(p.name.endswith(".snappy.parquet") for p in (tmp_path / "p").iterdir())


def test_load_table(spark, features):
    assert writers.load_table(features, "t_load") == ("t_load", 2, 3)
    assert writers.load_table(features, "t_load", "append").rows == 4
    with pytest.raises(ValueError, match="not empty"):
        writers.load_table(features, "t_load", "empty")
    writers.load_table(features.limit(0), "t_load")
    assert writers.load_table(features, "t_load", "empty").rows == 2  # an empty table may be loaded
    with pytest.raises(ValueError):
        writers.load_table(features, "t_load", "merge")
    assert readers.read_table(spark, "t_load").count() == 2
    assert readers.read_table(spark, "t_load", 2, ("id",)).first()["id"] == "a"
    assert writers.create_table_as(features.limit(1), "t_ctas").count() == 1
    assert writers.create_table_as(features, "t_ctas").count() == 2
    assert writers.write_staging(features, "t_staging").count() == 2


def test_versioned_upsert(spark, features, tmp_path):
    root = str(tmp_path / "serving")
    assert writers.latest_version(spark, root) is None
    with pytest.raises(ValueError):
        writers.read_latest(spark, root)
    assert writers.upsert_versioned(spark, features, root, "id") == 1
    fresh = spark.createDataFrame([("b", 9.0), ("c", 7.0)], "id string, p double")
    assert writers.upsert_versioned(spark, fresh, root, "id") == 2
    want = {("a", 1.0, 2.0), ("b", 9.0, None), ("c", 7.0, None)}
    assert {tuple(r) for r in writers.read_latest(spark, root).collect()} == want
    # a version that never finished is not read
    (tmp_path / "serving" / "version=3").mkdir()
    assert writers.latest_version(spark, root) == 2


def test_feature_list(spark, tmp_path):
    path = str(tmp_path / "list")
    writers.write_feature_list(spark, ["x_mean", "y_last"], path)
    assert readers.read_feature_list(spark, path) == ["x_mean", "y_last"]
    (tmp_path / "bad.json").write_text("[]")
    with pytest.raises(ValueError, match="non-empty"):
        readers.read_feature_list(spark, str(tmp_path / "bad.json"))
    assert readers.read_feature_list(spark, str(tmp_path / "none.json"), missing_ok=True) == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_feature_list(spark, str(tmp_path / "none.json"))


def test_metrics(spark, tmp_path):
    report = spark.createDataFrame([("m", 0.9)], "model string, roc_auc double")
    folds = spark.createDataFrame([("m", 2, 0.8), ("m", 1, 0.7)], "model string, fold int, roc_auc double")
    writers.write_metrics(report, str(tmp_path / "r"), folds)
    nested = json.loads(spark.read.text(str(tmp_path / "r/json")).first()["value"])
    assert [f["fold"] for f in nested["fold_metrics"]] == [1, 2]
    assert spark.read.csv(str(tmp_path / "r/csv"), header=True).columns == ["model", "roc_auc"]


def test_predictions_and_drift(spark, tmp_path):
    scored = spark.createDataFrame([("a", 0.2, "low", "j")], "customer_ID string, default_probability float, risk_category string, scoring_job string")
    scored = scored.withColumn("scored_at", F.current_timestamp())
    assert writers.write_predictions(scored, "t_predictions").rows == 1
    assert writers.write_predictions(scored, "t_predictions").rows == 1  # replaced, not added
    assert dict(spark.table("t_predictions").dtypes)["default_probability"] == "double"
    report = spark.createDataFrame([("f", 0.1)], "feature_name string, psi double")
    for _ in range(2):
        writers.append_drift(report, "t_drift", str(tmp_path / "d"))
    assert spark.table("t_drift").count() == 2
    assert spark.read.csv(str(tmp_path / "d"), header=True).count() == 1
    writers.write_oof(scored, str(tmp_path / "oof"))
    writers.write_holdout(scored, str(tmp_path / "hold"))
    assert spark.read.parquet(str(tmp_path / "oof")).count() == 1


def test_published_tables(spark, features, tmp_path):
    from tallyspan.sources.store import Store

    scored = spark.createDataFrame([(7, 0.2, "low", "j"), (8, 0.9, "high", "j")], "user bigint, default_probability float, risk_category string, scoring_job string")
    scored = scored.withColumn("scored_at", F.current_timestamp())
    store = Store(spark, str(tmp_path / "p"), "user")
    assert writers.publish_predictions(scored, store.root, "user") == 1
    before = store.read()
    assert writers.publish_predictions(scored.where("user = 7"), store.root, "user") == 2
    assert before.count() == 2 and store.read().count() == 1
    assert store.read().dtypes == [("user", "string"), *writers.PREDICTION_COLUMNS]
    assert writers.write_predictions(scored, "t_user_predictions", "user").columns == 5
    assert writers.publish_features(features, str(tmp_path / "f"), "id", ["q"]) == 1
    assert Store(spark, str(tmp_path / "f"), "id").read().columns == ["id", "q"]
    with pytest.raises(ValueError):
        writers.publish_features(features, str(tmp_path / "f"), "id", [])


def test_serving(spark, features):
    again = features.withColumn("at", F.lit(1)).unionByName(
        spark.createDataFrame([("a", 8.0, 8.0, 2), (None, 1.0, 1.0, 1)], "id string, p double, q double, at int")
    )
    got = writers.serving_snapshot(again, "id", ["p"], order=("at",))
    assert {tuple(r) for r in got.collect()} == {("a", 8.0), ("b", 3.0)}
    assert writers.publish_serving(features, "t_serving", "id", ["q"]).columns == 2
    with pytest.raises(ValueError):
        writers.publish_serving(features, "t_serving", "id", [])
