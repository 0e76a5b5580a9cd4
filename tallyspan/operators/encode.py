"""Text columns as categories of bounded number, whatever the columns hold.

A mergeable sketch of value hashes (one pass, combined before the shuffle) names the candidates for a
column's most frequent values, and a second pass counts these exactly.  The driver receives at
most ``CANDIDATES`` 64-bit hashes a column, never the values.  Frequent values are categories
of their own; the rest of a column that has more fall into hashed buckets; values unseen in a
column that had no rest count as missing.  So trees need the same number of bins for a million
different values as for a few hundred.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.scalar import quoted

# Categories a column may have: values of their own, and buckets for the others.
FREQUENT = 200
BUCKETS = 50
# Hashes a column's sketch returns, and tracks.
CANDIDATES = 800
TRACKED = 4096


@dataclass(frozen=True)
class Levels:
    """Hashes of a column's frequent values, most frequent first, and the number of buckets for
    others (0 if it has none)."""

    frequent: tuple[int, ...]
    buckets: int

    @property
    def labels(self) -> list[str]:
        own = sorted(f"{h & (1 << 64) - 1:016X}" for h in self.frequent)
        return [*own, *[f"#{b}" for b in range(self.buckets)]] or ["#"]

    def code(self, value: str) -> str:
        """SQL of a value's label; NULL for missing and for values that have none."""
        digest = f"xxhash64({value})"
        known = ", ".join(f"{h}L" if h != -(1 << 63) else "(-9223372036854775807L - 1L)" for h in self.frequent)
        rest = f"concat('#', pmod({digest}, {self.buckets}L))" if self.buckets else "CAST(NULL AS STRING)"
        own = f"WHEN array_contains(array({known}), {digest}) THEN lpad(hex({digest}), 16, '0') " if known else ""
        return f"CASE WHEN {value} IS NULL THEN NULL {own}ELSE {rest} END"


def learn_levels(
    df: DataFrame, columns: Sequence[str], frequent: int = FREQUENT, buckets: int = BUCKETS
) -> dict[str, Levels]:
    """The levels of each text column of ``df``.

    Values that fill more than about 1 / 1000 of a column are always among its candidates; in a
    column with fewer than about 3,000 different values all counts are exact.  Equally frequent
    values are taken in the order of their hashes.  A table of a few rows gets fewer levels,
    as a category needs rows to be learnt from.
    """
    if not columns:
        return {}
    hashed = df.select(*[F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(f"h{i}") for i, c in enumerate(columns)])
    found = hashed.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(f"h{i}").alias(f"n{i}") for i in range(len(columns))],
        *[F.expr(f"approx_top_k(h{i}, {CANDIDATES}, {TRACKED})").alias(f"t{i}") for i in range(len(columns))],
    ).first()
    frequent, buckets = max(1, min(frequent, found["n"] // 4)), max(1, min(buckets, found["n"] // 8))
    rows = [(i, r["item"]) for i in range(len(columns)) for r in found[f"t{i}"] or [] if r["item"] is not None]
    spark = df.sparkSession
    candidates = F.broadcast(spark.createDataFrame(rows, "c int, h bigint"))  # at most CANDIDATES a column
    pairs = F.inline(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"h{i}").alias("h")) for i in range(len(columns))]))
    counts: dict[int, list[tuple[int, int]]] = {i: [] for i in range(len(columns))}
    for r in hashed.select(pairs).join(candidates, ["c", "h"]).groupBy("c", "h").count().collect():
        counts[r["c"]].append((-r["count"], r["h"]))
    levels = {}
    for i, name in enumerate(columns):
        best = sorted(counts[i])[:frequent]
        rest = found[f"n{i}"] + sum(n for n, _ in best)
        levels[name] = Levels(tuple(h for _, h in best), buckets if rest else 0)
    return levels


def encoder(numeric: Sequence[str], levels: Mapping[str, Levels], output: str) -> PipelineModel:
    """Stages that turn ``_x_`` inputs into one vector: text columns to labels, labels to categories
    (missing shares one with what has no label), then all inputs to a vector."""
    stages: list = []
    if levels:
        codes = ", ".join(f"{v.code(quoted(f'_x_{c}'))} AS {quoted(f'_c_{c}')}" for c, v in levels.items())
        stages.append(SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__"))
        stages.append(
            StringIndexerModel.from_arrays_of_labels(
                [v.labels for v in levels.values()], inputCols=[f"_c_{c}" for c in levels],
                outputCols=[f"_i_{c}" for c in levels], handleInvalid="keep",
            )
        )
    inputs = [f"_x_{c}" for c in numeric] + [f"_i_{c}" for c in levels]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return PipelineModel(stages)


def bins_for(encoded: PipelineModel) -> int:
    """Trees need as many bins as the largest category list, missing included."""
    sizes = [len(labels) + 1 for s in encoded.stages if hasattr(s, "labelsArray") for labels in s.labelsArray]
    return max([32, *sizes])
