"""Tree ensembles as a table of nodes, scored by Spark expressions compiled from it.

A row of the table is a node: (tree, node, feature, threshold, categories, low, high, value).  An
inner node sends a row to ``low`` if its feature is at most the threshold, or one of the categories, else to
``high``; a leaf has a value.  The values of the leaves that a row reaches are added up; link
``logistic`` makes a probability of a boosted sum, ``identity`` takes a forest's sum as it is.

The table is what any engine can score by, so scores have an oracle, and a model can be reviewed, stored
and diffed as rows.  Its size is that of the model, not of the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.scalar import quoted
from tallyspan.session import ensure_checkpoint_dir

NODES = (
    "tree int, node int, feature string, threshold double, categories array<double>, low int, high int, value double"
)
LINKS = ("logistic", "identity")
# Trees whose sum is one column: expressions beyond that are too large to compile.
TREES_PER_COLUMN = 8


def node_table(model) -> tuple[DataFrame, str]:
    """The nodes of a fitted ``RiskModel`` and its link.

    Spark writes a model's nodes as Parquet anyway; this reads them back, names the features
    and turns a tree's weight, or a forest's class counts, into leaf values.
    """
    spark = SparkSession.active()
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/nodes/{uuid.uuid4().hex}"
    model.classifier.write().overwrite().save(path)
    names = F.array(*[F.lit(n) for n in model.features])
    weights = F.array(*[F.lit(float(w)) for w in model.classifier.treeWeights])
    boosted = isinstance(model.classifier, GBTClassificationModel)
    n = F.col("nodeData")
    leaf = n["leftChild"] < 0
    counts = n["impurityStats"]
    share = F.get(counts, F.lit(1)) / (F.get(counts, F.lit(0)) + F.get(counts, F.lit(1))) / F.lit(len(model.classifier.treeWeights))
    value = n["prediction"] * F.get(weights, F.col("treeID")) if boosted else share
    split = n["split"]
    inner = lambda c: F.when(~leaf, c)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), inner(F.get(names, split["featureIndex"])).alias("feature"),
        inner(F.when(split["numCategories"] < 0, F.get(split["leftCategoriesOrThreshold"], F.lit(0)))).alias("threshold"),
        inner(F.when(split["numCategories"] >= 0, split["leftCategoriesOrThreshold"])).alias("categories"),
        inner(n["leftChild"]).alias("low"), inner(n["rightChild"]).alias("high"), F.when(leaf, value).alias("value"),
    )
    return nodes, LINKS[0] if boosted else LINKS[1]


@dataclass(frozen=True)
class NodeModel:
    """An ensemble compiled from its node table; scores like a ``RiskModel``."""

    trees: dict[int, dict[int, tuple]]
    link: str
    numeric: list[str]
    text: list[str] = field(default_factory=list)
    labels: PipelineModel | None = None

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.text]

    @staticmethod
    def of_table(nodes: DataFrame, link: str, numeric: Sequence[str], text: Sequence[str] = (), labels=None) -> NodeModel:
        """From rows of a node table; ``labels`` are the stages that number text categories."""
        if link not in LINKS:
            raise ValueError(f"The link is one of {LINKS}.")
        trees: dict[int, dict[int, tuple]] = {}
        for r in nodes.collect():
            trees.setdefault(r["tree"], {})[r["node"]] = tuple(r[2:])
        known = {*numeric, *text}
        for tree, own in trees.items():
            for node, (feature, threshold, categories, low, high, value) in own.items():
                inner = feature is not None
                if inner and (feature not in known or (threshold is None) == (categories is None) or not {low, high} <= own.keys()):
                    raise ValueError(f"Node {node} of tree {tree} is no split of a known feature into nodes of its tree.")
                if not inner and value is None:
                    raise ValueError(f"Node {node} of tree {tree} has neither a feature nor a value.")
        return NodeModel(trees, link, list(numeric), list(text), labels)

    @staticmethod
    def of_model(model) -> NodeModel:
        """Compiled from a fitted ``RiskModel``."""
        nodes, link = node_table(model)
        labels = PipelineModel(model.stages.stages[:-2]) if model.text else None
        return NodeModel.of_table(nodes, link, model.numeric, model.text, labels)

    def column(self, feature: str) -> str:
        return quoted(f"_i_{feature}" if feature in self.text else f"_x_{feature}")

    def tree_sql(self, tree: int, node: int = 0) -> str:
        """A tree as nested conditions."""
        feature, threshold, categories, low, high, value = self.trees[tree][node]
        if feature is None:
            return f"{value!r}D"
        column = self.column(feature)
        goes_low = f"{column} <= {threshold!r}D" if categories is None else f"{column} IN ({', '.join(f'{c!r}D' for c in categories) or 'NULL'})"
        return f"CASE WHEN {goes_low} THEN {self.tree_sql(tree, low)} ELSE {self.tree_sql(tree, high)} END"

    def probability(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """All columns of ``df`` plus the probability of the positive class."""
        from tallyspan.operators.model import with_inputs

        keep = df.columns
        shaped = with_inputs(df, self.numeric, self.text)
        if self.labels is not None:
            shaped = self.labels.transform(shaped)
        order = sorted(self.trees)
        lots = [order[i : i + TREES_PER_COLUMN] for i in range(0, len(order), TREES_PER_COLUMN)]
        sums = {f"_sum_{i}": F.expr(" + ".join(self.tree_sql(t) for t in lot)) for i, lot in enumerate(lots)}
        total = " + ".join(sums) or "0.0D"
        score = f"1.0D / (1.0D + exp(-2.0D * ({total})))" if self.link == "logistic" else total
        return shaped.withColumns(sums).select(*keep, F.expr(score).alias(name))
