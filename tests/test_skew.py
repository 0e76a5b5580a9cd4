"""Running sums, hash ranks, quantiles and copies against plain Python."""

import hashlib

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tallyspan.operators import quantiles
from tallyspan.operators.quantiles import distributed_quantiles, grouped_quantiles
from tallyspan.operators.sequence import number_copies
from tallyspan.operators.skew import hash_rank, hot_keys, null_safe, running_sums, split_hot


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(1)
    rows = [("big" if i % 3 == 0 else f"k{i % 7}", i, int(rng.integers(0, 50))) for i in range(900)]
    return spark.createDataFrame(rows, "g string, i int, w long").repartition(6)


def test_running_sums(numbers):
    got = running_sums(numbers, ["g"], [F.col("i").desc()], ["w"]).toPandas()
    for _, g in got.groupby("g"):
        g = g.sort_values("i", ascending=False)
        assert list(g["w_cum"]) == list(g["w"].cumsum())
        assert set(g["w_total"]) == {g["w"].sum()}
    whole = running_sums(numbers, [], [F.col("i").asc()], ["w"]).toPandas().sort_values("i")
    assert list(whole["w_cum"]) == list(whole["w"].cumsum())


def test_running_sums_spread_one_group(numbers):
    """No window over the rows sits in a single partition."""
    plan = plan_of(running_sums(numbers, [], [F.col("i").asc()], ["w"]))
    rows_windows = [line for line in plan.splitlines() if "Window [" in line and "w_cum" in line]
    assert rows_windows and all("_cell" in line for line in rows_windows)


def test_join_after_window_moves_nothing(spark, numbers):
    """Even as a sort-merge join: one exchange of the rows, one of the small totals."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (running_sums(numbers, ["g"], [F.col("i").asc()], ["w"]), hash_rank(numbers, ["g"], ["i"], 1)):
            assert plan_of(df).count("Exchange hashpartitioning(_cell") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_running_sums_null_group(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 7)], "g string, i int, w long")
    got = {(r["g"], r["i"]): r["w_cum"] for r in running_sums(df, ["g"], [F.col("i").asc()], ["w"]).collect()}
    assert got == {(None, 1): 5, (None, 2): 11, ("a", 1): 7}


def test_hash_rank(numbers):
    got = hash_rank(numbers, ["g"], ["i"], 42).toPandas()
    for _, g in got.groupby("g"):
        order = sorted(g["i"], key=lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest())
        assert list(g.sort_values("rank")["i"]) == order
        assert set(g["rank_of"]) == {len(g)}
    limited = hash_rank(numbers, ["g"], ["i"], 42, limit=F.lit(4)).toPandas()
    want = got[got["rank"] <= 4]
    assert sorted(limited["i"]) == sorted(want["i"])


def test_hot_keys(numbers):
    assert hot_keys(numbers, ["g"], None) is None
    assert hot_keys(numbers, ["g"], 1000) is None
    assert hot_keys(numbers, ["g"], 400) is None
    assert [r["g"] for r in hot_keys(numbers, ["g"], 200).collect()] == ["big"]
    usual, hot = split_hot(numbers, ["g"], 200)
    assert hot.count() == 300 and usual.count() == 600


def test_null_key_is_kept_when_split(spark):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [("a", 1)], "g string, i int")
    usual, hot = split_hot(df, ["g"], 10)
    assert usual.count() == 1 and hot.count() == 20


def test_null_safe_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "g string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "g string, y int")
    got = {r["g"]: r["y"] for r in null_safe(left, right, ["g"], "left").collect()}
    assert got == {None: 10, "a": 20, "b": None}


PROBS = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]


@pytest.mark.parametrize("hot_rows", [None, 100, 10])
def test_quantiles(spark, hot_rows):
    rng = np.random.default_rng(2)
    groups = {"big": rng.integers(0, 40, 500), "one": np.array([3]), "two": np.array([1, 2]), "flat": np.full(60, 7)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("big", None), ("void", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r["quantiles"] for r in grouped_quantiles(df, ["g"], "v", PROBS, hot_rows).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        np.testing.assert_allclose(got[k], np.quantile(vs, PROBS), rtol=1e-12)


def test_distributed_quantiles_whole_table(spark):
    rng = np.random.default_rng(3)
    vs = rng.normal(size=2000)
    df = spark.createDataFrame([("g", float(v)) for v in vs], "g string, v double")
    got = distributed_quantiles(df, ["g"], "v", PROBS).first()["quantiles"]
    np.testing.assert_allclose(got, np.quantile(vs, PROBS), rtol=1e-12)


@pytest.mark.parametrize("missing", [False, True])
def test_bracketed_quantiles(spark, monkeypatch, missing):
    """Only values near the wanted ranks are kept; a bracket that misses is made good."""
    monkeypatch.setattr(quantiles, "SKETCH", 100)
    if missing:  # brackets around other ranks
        kept = quantiles.bracketed
        monkeypatch.setattr(quantiles, "bracketed", lambda df, by, probs: kept(df, by, [p / 2 + 0.2 for p in probs]))
    rng = np.random.default_rng(5)
    groups = {
        "wide": rng.normal(size=5000), "lumpy": rng.integers(0, 4, 3000).astype(float), "few": np.array([1.0, 2.0, 4.0]),
        None: np.concatenate([np.full(400, -np.inf), rng.normal(size=400), np.full(701, np.inf)]),
    }
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "g string, v double").repartition(4)
    got = {r["g"]: r["quantiles"] for r in distributed_quantiles(df, ["g"], "v", [0.5, 0.1, 0.9]).collect()}
    for k, vs in groups.items():
        np.testing.assert_allclose(got[k], [np.quantile(vs, p) if k else np.sort(vs)[round(p * 1500)] for p in (0.5, 0.1, 0.9)], rtol=1e-12)
    if not missing:
        histogram = quantiles.bracketed(df.select("g", F.col("v").alias("_v")), ["g"], [0.5])
        assert histogram.where("g = 'wide'").count() < 1000
        assert histogram.agg(F.sum("_n")).first()[0] == df.count()


def test_number_copies(spark, monkeypatch):
    monkeypatch.setattr("tallyspan.operators.sequence.COPY_BLOCK", 4)
    df = spark.createDataFrame([("a", 1)] * 11 + [("b", 2)], "k string, v int")
    got = sorted((r["k"], r["_copy"]) for r in number_copies(df).collect())
    assert got == [("a", i) for i in range(11)] + [("b", 0)]
