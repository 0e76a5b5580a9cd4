"""Cleaning, names, sampling, importance, summaries, refresh and lookup."""

import datetime as dt
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspan.functions.names import all_features, parse_feature, raw_columns
from tallyspan.functions.scalar import fill_missing, hash_bucket, risk_band, statement_cycle
from tallyspan.operators import clean, importance, refresh, sampling, summary
from tallyspan.spec import Spec


# --- names ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name, raw, stat",
    [
        ("P_2_mean", "P_2", "mean"), ("P_2_last_3m", "P_2", "last_3m"), ("P_2_diff_std", "P_2", "diff_std"),
        ("P_2_std_diff", "P_2", "diff_std"), ("P_2_lag", "P_2", "last_minus_mean"),
        ("P_2_last_minus_mean", "P_2", "last_minus_mean"), ("B_30_count", "B_30", "count"),
        ("B_30_nunique", "B_30", "nunique"), ("x_mean_diff_mean", "x_mean", "diff_mean"), ("x_lag_mean", "x_lag", "mean"),
    ],
)
def test_parse(name, raw, stat):
    got = parse_feature(name)
    assert (got.raw, got.stat) == (raw, stat)


def test_parse_nothing():
    assert parse_feature("P_2") is None and parse_feature("_mean") is None and parse_feature("P_2_range") is None
    assert raw_columns(["b_mean", "a_last", "b_std_6m", "junk"], always=["id", "day"]) == ["id", "day", "b", "a"]
    assert raw_columns(["b_mean", "a_last"], exclude=["a"]) == ["b"]


@settings(max_examples=60, deadline=None)
@given(st.from_regex(r"[A-Z]_[0-9]{1,3}", fullmatch=True), st.sampled_from(["batch", "notebook"]))
def test_names_round_trip(column, dialect):
    for f in all_features([column], [], dialect):
        got = parse_feature(f.name)
        assert (got.raw, got.stat) == (column, f.stat)


# --- cleaning ------------------------------------------------------------------------


def test_sparse_columns(spark):
    rows = [(i, dt.date(2020, 1, 1), None if i else 1.0, float("nan") if i < 8 else 1.0, i) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, day date, rare double, edge double, full int")
    kept, dropped = clean.drop_sparse_columns(df, ["id", "day"], 80.0)
    assert dropped == ["rare"] and "edge" in kept.columns  # exactly at the threshold stays
    assert clean.sparse_columns(df, ["id", "day", "rare"], 80.0) == []
    with pytest.raises(ValueError, match="between"):
        clean.sparse_columns(df, ["id"], 101)
    with pytest.raises(ValueError, match="empty"):
        clean.sparse_columns(df.limit(0), ["id"], 80)
    with pytest.raises(ValueError, match="Missing"):
        clean.sparse_columns(df, ["nope"], 80)


def test_dates(spark):
    df = spark.createDataFrame([("2020-02-30",), ("2020-02-03",), (None,)], "d string")
    got = clean.clean_dates(df, "d", "day").collect()
    assert [(r["day"], r["day_rejected"]) for r in got] == [(None, True), (dt.date(2020, 2, 3), False), (None, False)]
    stamps = spark.sql("SELECT explode(array(timestamp_ntz'2020-01-31 23:59:59', timestamp_ntz'2020-02-01 00:00:00')) AS t")
    assert clean.filter_dates(stamps, "t", end="2020-01-31").count() == 1
    assert clean.filter_dates(stamps, "t", start="2020-02-01").count() == 1
    assert clean.filter_dates(stamps, "t").count() == 2


def test_date_filter_reaches_the_scan(spark):
    from conftest import DATA, plan_of

    plan = plan_of(clean.filter_dates(spark.read.parquet(f"{DATA}/orders.parquet"), "o_orderdate", "1996-01-01", "1996-12-31"))
    pushed = plan.split("PushedFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_small_cleaners(spark):
    df = spark.createDataFrame([("1.5", "a", 2.0), ("x", "z", float("nan"))], "n string, c string, f double")
    assert [r["n"] for r in clean.coerce_numbers(df, ["n", "gone"]).collect()] == [1.5, None]
    assert clean.coerce_numbers(df, ["gone"], missing="null").first()["gone"] is None
    aligned = clean.align_categories(df, {"c": ["a", "b"], "d": ["q"], "e": []}).collect()
    assert [r["c"] for r in aligned] == ["a", None] and aligned[0]["d"] == "q" and aligned[0]["e"] == ""
    assert clean.learn_categories(df, ["c"]) == {"c": ["a", "z"]}
    with pytest.raises(ValueError, match="Too many"):
        clean.learn_categories(df, ["c"], limit=1)
    assert dict(clean.downcast_floats(df).dtypes)["f"] == "float"
    assert clean.nan_as_null(df).where("f IS NULL").count() == 1
    assert dict(clean.cast_categoricals(df, ["f", "gone"]).dtypes)["f"] == "string"
    assert clean.duplicate_count(df.union(df).union(df)).first()["duplicates"] == 4
    assert [r["v"] for r in df.select(fill_missing(F.col("f")).alias("v")).collect()] == [2.0, 0.0]
    numeric, text, typed = clean.split_features_target(df.withColumn("id", F.lit(1)).withColumn("t", F.lit("1")), "id", "t")
    assert numeric == ["f"] and text == ["n", "c"] and dict(typed.dtypes)["t"] == "int"


def test_bands_and_cycles(spark):
    got = [r[0] for r in spark.createDataFrame([(0.2499,), (0.25,), (0.5999,), (0.6,), (None,)], "p double").select(risk_band(F.col("p"))).collect()]
    assert got == ["low", "medium", "medium", "high", None]
    rows = [("2024-05", "2020-01-01"), ("", "2020-01-01"), (None, "2020"), (None, None)]
    now = F.lit("2031-02-03 00:00:00").cast("timestamp")
    df = spark.createDataFrame(rows, "c string, d string").select(statement_cycle(F.col("c"), F.col("d"), now))
    assert [r[0] for r in df.collect()] == ["2024-05", "2020-01", "2031-02", "2031-02"]


def test_sorted_files(spark, tmp_path):
    from tallyspan.sources.writers import write_sorted

    df = spark.createDataFrame([(i % 5, 100 - i) for i in range(100)], "k int, d int").repartition(7)
    write_sorted(df, str(tmp_path / "s"), "k", ["d"])
    back = spark.read.parquet(str(tmp_path / "s")).withColumn("f", F.input_file_name()).toPandas()
    assert (back.groupby("k")["f"].nunique() == 1).all()


# --- sampling ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(503)], "id int, target int").repartition(3)


@pytest.mark.parametrize("ratio", [0.29, 0.5, 0.8])
def test_hash_split(labels, ratio):
    train, test = sampling.hash_split(labels, "id", ratio)
    a, b = ({r["id"] for r in s.collect()} for s in (train, test))
    assert a | b == set(range(503)) and not a & b
    want = {i for i in range(503) if int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 100 < round(ratio * 100)}
    assert a == want
    with pytest.raises(ValueError):
        sampling.hash_split(labels, "id", 1.0)


def test_hash_bucket_range(spark):
    got = spark.range(1000).select(hash_bucket("id").alias("b")).agg(F.min("b"), F.max("b")).first()
    assert got[0] >= 0 and got[1] <= 99


def test_samples(labels):
    assert sampling.balanced_sample(labels, "id", "target", 21).groupBy("target").count().toPandas().set_index("target")["count"].to_dict() == {1: 10, 0: 11}
    half = sampling.stratified_sample(labels, "id", "target", 0.5).groupBy("target").count().toPandas().set_index("target")["count"]
    assert half[1] in (25, 26) and half[0] == 226
    assert sampling.sample_n(labels, "id", 40).count() == 40 and sampling.sample_n(labels, "id", 9999).count() == 503
    assert sampling.limited_scan(labels, 7, ["id"]).count() == 7 and sampling.limited_scan(labels, None, []).count() == 503
    assert 0 < sampling.sample_rate(labels, 0.5).count() < 503 and sampling.sample_rate(labels, 1.0).count() == 503
    kept = sampling.bernoulli_stratified(labels, "target", {1: 1.0, 0: 0.0})
    assert kept.count() == 51
    for limit in (100, 503, 600):  # cut from slices
        first = sampling.limited_scan(labels.repartition(5), limit, ["id"], one_task_rows=10)
        assert sorted(r["id"] for r in first.collect()) == sorted(r["id"] for r in labels.collect())[:limit]
    for bad in (lambda: sampling.balanced_sample(labels, "id", "target", 1), lambda: sampling.limited_scan(labels, 1, ["id"])):
        with pytest.raises(ValueError):
            bad()


def test_folds(labels):
    folds = sampling.stratified_folds(labels, "id", "target", 5).toPandas()
    assert len(folds) == 503 and set(folds["fold"]) == {1, 2, 3, 4, 5}
    for _, g in folds.groupby("target"):
        sizes = g["fold"].value_counts()
        assert sizes.max() - sizes.min() <= 1
    again = sampling.stratified_folds(labels.repartition(9), "id", "target", 5).toPandas()
    assert dict(zip(folds["id"], folds["fold"])) == dict(zip(again["id"], again["fold"]))
    with pytest.raises(ValueError):
        sampling.stratified_folds(labels, "id", "target", 1)


# --- importance ----------------------------------------------------------------------


def ranked(spark, values):
    return spark.createDataFrame([(f"f{i}", float(v)) for i, v in enumerate(values)], "feature string, importance double")


@pytest.mark.parametrize(
    "values, threshold, low, high, want",
    [
        ([50, 30, 15, 5], 0.5, 1, 9, 2),  # exactly at the threshold: that one, plus one more
        ([50, 30, 15, 5], 0.6, 1, 9, 2),
        ([50, 30, 15, 5], 1.0, 1, 9, 4),
        ([50, 30, 15, 5], 0.1, 3, 9, 3),
        ([50, 30, 15, 5], 1.0, 1, 2, 2),
        ([50, 30, 15, 5], 0.1, 9, 9, 4),
        ([0, 0, 0], 0.5, 1, 9, 3),
    ],
)
def test_selection(spark, values, threshold, low, high, want):
    got = importance.select_features(ranked(spark, values), threshold, low, high)
    chosen = [r["feature"] for r in got.where("selected").orderBy("rank").collect()]
    order = sorted(range(len(values)), key=lambda i: (-values[i], i))
    assert chosen == [f"f{i}" for i in order][:want]


def test_selection_errors(spark):
    table = ranked(spark, [1, 2])
    for bad in ((0.0, 1, 2), (1.1, 1, 2), (0.5, 0, 2), (0.5, 3, 2)):
        with pytest.raises(ValueError):
            importance.select_features(table, *bad)
    with pytest.raises(ValueError, match="empty"):
        importance.select_features(table.limit(0), 0.5, 1, 2)


def test_fold_importance(spark):
    rows = [("a", 1, 2.0), ("a", 2, 4.0), ("b", 1, 6.0)]
    df = spark.createDataFrame(rows, "feature string, fold int, importance double")
    got = {r["feature"]: r for r in importance.mean_fold_importance(df, 2).collect()}
    assert (got["a"]["importance_mean"], got["b"]["importance_mean"]) == (3.0, 3.0)
    assert got["a"]["importance_std"] == pytest.approx(np.std([2, 4], ddof=1))
    assert got["b"]["importance_std"] == pytest.approx(np.std([6, 0], ddof=1))
    single = importance.mean_fold_importance(df.where("fold = 1"), 1)
    assert {r["importance_std"] for r in single.collect()} == {0.0}
    assert importance.top_importance(importance.mean_fold_importance(df, 2), 1).first()["feature"] == "a"


# --- summaries -----------------------------------------------------------------------


def test_summaries(spark):
    rows = [("a", 1.0, "p"), ("a", 2.0, None), ("b", 3.0, "p"), ("b", None, "q"), ("b", 10.0, "q")]
    df = spark.createDataFrame(rows, "id string, v double, c string")
    assert {(r["n_statements"], r["n_keys"]) for r in summary.statement_counts(df, "id").collect()} == {(2, 1), (3, 1)}
    got = summary.statement_describe(df, "id").first()
    assert (got["count"], got["mean"], got["p50"], got["min"], got["max"]) == (2, 2.5, 2.5, 2.0, 3.0)
    assert got["std"] == pytest.approx(np.std([2, 3], ddof=1))
    bars = summary.histogram(df, "v", 3).orderBy("bin").collect()
    assert [r["n"] for r in bars] == [3, 0, 1] and bars[0]["lower"] == 1.0 and bars[-1]["upper"] == 10.0
    flat = summary.histogram(df.where("v = 1"), "v", 2).orderBy("bin").collect()
    assert [(r["lower"], r["n"]) for r in flat] == [(0.5, 0), (1.0, 1)]
    assert sum(r["n"] for r in summary.histogram(df.limit(0), "v", 2).collect()) == 0
    cats = summary.categorical_summary(df, ["c"]).first()
    assert cats["n_unique"] == 3 and cats["missing_pct"] == 20.0
    none = summary.scale_pos_weight(spark.createDataFrame([(0,)], "t int"), "t").first()
    assert none["scale_pos_weight"] is None
    with pytest.raises(ValueError, match="No positive"):
        summary.positive_weight(spark.createDataFrame([(0,)], "t int"), "t")


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_box_stats(spark, hot_rows):
    vs = [*np.random.default_rng(0).normal(size=60).tolist(), 50.0]
    df = spark.createDataFrame([(1, v) for v in vs] + [(0, 3.0), (None, 4.0)], "t int, v double")
    got = {r["t"]: r for r in summary.box_stats(df, ["v"], "t", hot_rows).collect()}
    q1, q2, q3 = np.quantile(vs, [0.25, 0.5, 0.75])
    inside = [v for v in vs if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert got[1]["median"] == pytest.approx(q2) and got[1]["whisker_high"] == max(inside) and got[1]["max"] == 50.0
    assert got[0]["whisker_low"] == 3.0 and got[None]["n"] == 1


# --- refresh, upsert, lookup ---------------------------------------------------------

SPEC = Spec("id", "day", ("seq",), continuous=("x",), categorical=("c",), unique_order=True)


@pytest.fixture(scope="module")
def history(spark):
    rows = [(k, dt.date(2020, 1, 1 + i), i, float(i * (len(k) + 1)), "pq"[i % 2]) for k in ("a", "bb", "ccc") for i in range(9)]
    return spark.createDataFrame(rows, "id string, day date, seq int, x double, c string")


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_refresh_is_full_rebuild_of_changed(spark, history, hot_rows):
    from tallyspan.operators.features import build_features

    log = spark.createDataFrame([("a", "1"), ("a", "1"), ("ccc", "1"), ("bb", "0"), (None, "1")], "id string, statement_cycle string")
    keys = refresh.changed_keys(log, "id", "1")
    assert sorted(r["id"] for r in keys.collect()) == ["a", "ccc"]
    wanted = ["x_mean", "x_diff_max", "c_count", "c_nunique", "gone_mean"]
    spec = Spec("id", "day", ("seq",), categorical=("c",), unique_order=True)
    rows = history.withColumn("gone", F.lit(None).cast("double"))
    got = {r["id"]: r for r in refresh.refresh_features(rows, keys, spec, wanted, hot_rows).collect()}
    full = {r["id"]: r for r in build_features(rows, spec).collect()}
    assert set(got) == {"a", "ccc"}
    for k, r in got.items():
        assert all(r[w] == full[k][w] for w in wanted)
    assert got["a"]["c_count"] == 9  # a categorical wanted only by its count is still read
    with pytest.raises(ValueError, match="Missing"):
        refresh.refresh_features(history, keys, spec, wanted, hot_rows)
    with pytest.raises(ValueError, match="Cycle column"):
        refresh.changed_keys(log.drop("statement_cycle"), "id", "1")


def test_restrict_hot_not_asked_for(spark, history):
    keys = spark.createDataFrame([("a",), ("a",)], "id string")
    assert refresh.restrict_to_keys(history, keys, "id", hot_rows=5).count() == 9
    assert refresh.restrict_to_keys(history, keys.limit(0), "id", hot_rows=5).count() == 0


@pytest.mark.parametrize("small_rows", [0, 100])
def test_upsert(spark, small_rows):
    target = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "id string, p double, q double")
    fresh = spark.createDataFrame([("b", None, 9.0), ("c", 7.0, 8.0)], "id string, p double, r double")
    once = refresh.upsert(target, fresh, "id", small_rows=small_rows)
    want = {("a", 1.0, 2.0, None), ("b", None, 4.0, 9.0), ("c", 7.0, None, 8.0)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in refresh.upsert(once, fresh, "id", small_rows=small_rows).collect()} == want


def test_lookup(spark):
    cache = spark.createDataFrame([("a", {"p": 1.0}), ("b", None), ("e", {})], "id string, features map<string,double>")
    table = spark.createDataFrame([("a", 5.0), ("b", 6.0)], "id string, p double")
    asked = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("e",)], "id string")
    got = {r["id"]: (r["features"], r["tier_used"]) for r in refresh.tiered_lookup(asked, cache, table, "id", ["p", "q"]).collect()}
    assert got == {
        "a": ({"p": 1.0, "q": 0.0}, "realtime"),
        "b": ({"p": 6.0, "q": 0.0}, "fallback"),
        "c": (None, "INSUFFICIENT_DATA"),
        "e": ({"p": 0.0, "q": 0.0}, "realtime"),
    }


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "y"), ("b", 3, None)], "id string, o int, v string")
    assert {tuple(r) for r in refresh.latest_per_key(df, "id", ["o"]).collect()} == {("a", 2, "y"), ("b", 3, None)}
