"""Bounded encoding of text columns, and categories kept as a table."""

import numpy as np
from pyspark.sql import functions as F

from tallyspan.operators import clean
from tallyspan.operators import model as m
from tallyspan.operators.encode import BUCKETS, FREQUENT, bins_for, encoder, learn_levels


def test_few_values_keep_their_own_category(spark):
    df = spark.createDataFrame([("a",)] * 30 + [("b",)] * 20 + [("",)] * 5 + [(None,)] * 9, "_x_c string")
    levels = learn_levels(df, ["_x_c"])["_x_c"]
    assert len(levels.frequent) == 3 and levels.buckets == 0
    stages = encoder([], {"c": levels}, "f")
    odd = df.union(spark.createDataFrame([("unseen",)], "_x_c string"))
    got = {(r["_x_c"], r["_i_c"]) for r in stages.transform(odd).collect()}
    own = {v: i for v, i in got}
    assert sorted(own[v] for v in ("a", "b", "")) == [0, 1, 2] and own[None] == own["unseen"] == 3


def test_a_million_values_stay_bounded(spark):
    df = spark.range(1_000_000).select(
        F.when(F.col("id") % 10 < 3, F.lit("hot")).when(F.col("id") % 10 < 5, F.concat(F.lit("w"), F.col("id") % 20)).otherwise(
            F.concat(F.lit("user "), "id")).alias("_x_who"),
        F.lit(None).cast("string").alias("_x_none"),
    )
    levels = learn_levels(df, ["_x_who", "_x_none"])
    who = levels["_x_who"]
    assert 5 <= len(who.frequent) <= FREQUENT and who.buckets == BUCKETS and levels["_x_none"].frequent == ()
    hashes = {r[0]: r[1] for r in spark.createDataFrame([("hot",), ("w3",), ("w4",), ("w13",)], "v string").select("v", F.xxhash64("v")).collect()}
    assert who.frequent[0] == hashes["hot"] and set(hashes.values()) <= set(who.frequent[:5])
    stages = encoder([], {"who": who, "none": levels["_x_none"]}, "f")
    assert bins_for(stages) <= FREQUENT + BUCKETS + 1
    coded = stages.transform(df.limit(50_000))
    row = coded.agg(F.max("_i_who"), F.countDistinct("_i_who"), F.countDistinct("_i_none")).first()
    assert row[0] <= FREQUENT + BUCKETS and row[1] > BUCKETS and row[2] == 1


def test_an_identifier_column_trains_and_reloads(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, float(x), f"user {i}", "pq"[int(x > 0.3)], int(x > 0)) for i, x in enumerate(rng.normal(size=1500))]
    df = spark.createDataFrame(rows, "id int, x double, who string, kind string, target int")
    model = m.fit_model(df, "id", "target", ["x"], ["who", "kind"], 2, maxDepth=2)
    model.save(spark, str(tmp_path / "model"))
    again = m.RiskModel.load(spark, str(tmp_path / "model"))
    a, b = (x.probability(df).orderBy("id").toPandas()["prediction"] for x in (model, again))
    assert np.allclose(a, b) and a.between(0, 1).all()
    assert len(model.stages.stages[1].labelsArray[0]) <= FREQUENT + BUCKETS


def test_categories_as_a_table(spark):
    known = spark.createDataFrame([("a", "x"), ("z", None), (None, "y")], "c string, d string")
    table = clean.category_table(known, ["c", "d"])
    assert {tuple(r) for r in table.collect()} == {("c", "a"), ("c", "z"), ("d", "x"), ("d", "y")}
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "new"), (3, None)], "k int, c string")
    got = sorted((r.k, r.c or "", r.d, r.e) for r in clean.align_to_table(df, table, ["c", "d", "e"]).collect())
    assert got == [(1, "a", "x", ""), (1, "a", "x", ""), (2, "", "x", ""), (3, "", "x", "")]
    lists = clean.align_categories(df, {"c": ["a", "z"], "d": ["x", "y"], "e": []})
    assert sorted((r.k, r.c or "", r.d, r.e) for r in lists.collect()) == got
