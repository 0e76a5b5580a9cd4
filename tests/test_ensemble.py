"""Ensembles as node tables beside the models they come from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.operators import model as m
from tallyspan.operators.ensemble import NODES, NodeModel, node_table


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    data = []
    for i in range(500):
        x, y = float(rng.normal()), float(rng.normal())
        kind = "pqrst"[i % 5]
        t = int(x + (kind in "pr") - y * (kind == "s") + 0.3 * rng.normal() > 0.5)
        data.append((i, x if i % 19 else None, float("nan") if i % 23 == 0 else y, kind if i % 17 else None, t))
    return spark.createDataFrame(data, "id int, x double, y double, kind string, target int")


@pytest.mark.parametrize("family,rounds,depth", [("boosted_trees", 3, 3), ("boosted_trees", 20, 4), ("random_forest", 12, 4)])
def test_compiled_score_equals_the_model(spark, rows, family, rounds, depth):
    fitted = m.fit_model(rows, "id", "target", ["x", "y"], ["kind"], rounds, family=family, maxDepth=depth)
    compiled = NodeModel.of_model(fitted)
    odd = rows.unionByName(rows.limit(20).withColumns({"id": F.col("id") + 1000, "kind": F.lit("unseen")}))
    for df in (odd, odd.drop("y"), odd.drop("kind")):
        want, got = (x.probability(df).orderBy("id").toPandas()["prediction"] for x in (fitted, compiled))
        assert np.allclose(want, got, rtol=0, atol=1e-12) and want.nunique() > 4
    assert any(n[2] is not None for tree in compiled.trees.values() for n in tree.values())  # a split by category


def test_node_table_survives_storage(spark, rows, tmp_path):
    fitted = m.fit_model(rows, "id", "target", ["x", "y"], [], 4, maxDepth=3)
    nodes, link = node_table(fitted)
    nodes.write.parquet(str(tmp_path / "nodes"))
    again = NodeModel.of_table(spark.read.parquet(str(tmp_path / "nodes")), link, ["x", "y"])
    a, b = (m.batch_score(x, rows, "id", "j").orderBy("id").toPandas()["default_probability"] for x in (fitted, again))
    assert np.allclose(a, b, rtol=0, atol=1e-12)


def test_tables_that_are_no_ensembles(spark):
    frame = lambda *r: spark.createDataFrame(list(r), NODES)
    leaf = (0, 1, None, None, None, None, None, 0.5)
    for bad in (
        (0, 0, "z", 1.0, None, 1, 1, None),  # unknown feature
        (0, 0, "x", 1.0, None, 1, 9, None),  # no such node
        (0, 0, "x", None, None, 1, 1, None),  # neither threshold nor categories
        (0, 0, None, None, None, None, None, None),  # leaf without value
    ):
        with pytest.raises(ValueError):
            NodeModel.of_table(frame(bad, leaf), "logistic", ["x"])
    with pytest.raises(ValueError, match="link"):
        NodeModel.of_table(frame(leaf), "probit", ["x"])
    empty = NodeModel.of_table(frame(), "logistic", ["x"])
    assert empty.probability(spark.createDataFrame([(1.0,)], "x double")).first()["prediction"] == 0.5
