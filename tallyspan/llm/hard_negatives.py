"""Operator 12, hard negatives by pruned inner-product search (LEMP).

Rows are dealt by (label, length) into buckets of about ``BUCKET`` rows.  A task cuts its bucket
into length buckets, from long to short, and keeps for each a sorted list of every coordinate of
the unit vectors.  For an anchor and a wanted score, a length bucket

* is skipped if even its longest vector cannot reach the score;
* else gives, for the anchor's largest (focus) coordinates, the range of values a unit vector
  must have there to reach it.  The rows in all those ranges are the candidates, and only
  their exact integer products are computed.

The wanted score rises as better rows are found.  First every anchor looks for positives in the
buckets of its own label.  Then a sixteenth of all buckets gives each (anchor, positive) a score
that its negatives must reach, and with it the rest is searched; an anchor is only sent to
buckets whose longest vector can reach it.  Anchors go in blocks to buckets, so a task holds
one bucket and one block, whatever the size of a label.  No row is sampled or dropped.

Components become floor(256 x).  Sums are exact in 53 bits where the bound of a bucket allows it, and
computed with Python's integers elsewhere; a score beyond 64 bits counts as the end of that range.

Defined results: rows with a NULL label, vector or component, or one that is not finite, take no
part; missing components of shorter vectors are 0; repeated rows take part each; rows without
vec_id are no anchors and come last among equals; an empty table gives no rows; other columns are
ignored.  A positive with a score below 0 has no negatives, as no score satisfies both bounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import kept, query, row_keys, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
EVERY = 100
BUCKET = 16384
BLOCK = 8192
LENGTHS = 2048
FIRST = 16
FOCUS = 4
# Ranges are widened by this much for rounding; candidates are verified exactly.
SLACK = 1e-9
LEAST, MOST = -(1 << 63), (1 << 63) - 1
NO_ID = MOST

FIELDS = "key bigint, vec_id bigint, label bigint, v binary, wide boolean, norm double"


def vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows that take part: key, vec_id, label, packed components (16-bit integers, or the
    raw doubles of a wide row) and length."""
    whole = F.expr(f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    label, vec_id = F.col("label").cast("long"), F.col("vec_id").cast("long")
    rows = row_keys(df, "_key").where(F.col("label").isNotNull() & F.col(vector).isNotNull()).where(whole).select(
        F.col("_key").alias("key"), vec_id.alias("vec_id"),
        F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col(vector).cast("array<double>").alias("x"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, wide, norms = [], [], []
            with np.errstate(over="ignore"):
                for x in batch.column("x"):
                    raw = np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64)
                    whole = np.floor(raw * SCALE)
                    wide.append(bool(len(whole) and np.abs(whole).max() > 32767))
                    packed.append((raw.astype("<f8") if wide[-1] else whole.astype("<i2")).tobytes())
                    norms.append(float(np.sqrt(whole @ whole)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "vec_id", "label")), pa.array(packed, pa.binary()), pa.array(wide, pa.bool_()), pa.array(norms, pa.float64())],
                ["key", "vec_id", "label", "v", "wide", "norm"],
            )

    return rows.mapInArrow(run, FIELDS)


def integers(raw: bytes) -> list[int]:
    """Exact components of a wide row."""
    return [math.floor(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE for x in np.frombuffer(raw, "<f8").tolist()]


def matrix(packed: list[bytes], wide: list[bool], width: int, exact: bool) -> np.ndarray:
    """Components as rows, padded with zeros: doubles that hold integers, or Python's integers."""
    out = np.zeros((len(packed), width), object if exact else np.float64)
    for row, p, w in zip(out, packed, wide):
        c = integers(p) if w else np.frombuffer(p, "<i2")
        row[: len(c)] = c if w or not exact else c.tolist()
    return out


def products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    out = rows @ q
    if out.dtype == object:
        return np.array([min(max(int(s), LEAST), MOST) for s in out], np.int64)
    return out.astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, smaller ids first among equals."""
    at = np.arange(len(scores))
    if len(scores) > 4 * k:
        at = np.nonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])[0]
    return at[np.lexsort((ids[at], ~scores[at]))[:k]]


class LengthBucket:
    """Rows of similar length with a sorted list of each coordinate of their unit vectors."""

    def __init__(self, rows: np.ndarray, norms: np.ndarray, places: np.ndarray):
        self.rows, self.places = rows, places
        self.longest, self.shortest = float(norms[0]), float(norms[-1])
        self.indexed = rows.dtype != object and 0 < self.shortest and math.isfinite(self.longest)
        if self.indexed:
            unit = (rows / norms[:, None]).T
            self.order = np.argsort(unit, axis=1, kind="stable")
            self.values = np.take_along_axis(unit, self.order, axis=1)

    def candidates(self, unit: np.ndarray, norm: float, wanted: int) -> np.ndarray | None:
        """Rows that may reach the wanted score; None for all."""
        if not self.indexed or not 0 < norm < math.inf:
            return None
        share = wanted / (norm * (self.longest if wanted > 0 else self.shortest)) - SLACK
        if share > 1:
            return np.zeros(0, np.int64)
        reach = math.acos(max(share, -1.0))
        n, hits, lists = len(self.places), None, 0
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            angle = math.acos(min(1.0, max(-1.0, float(unit[f]))))
            low, high = math.cos(min(math.pi, angle + reach)) - SLACK, math.cos(max(0.0, angle - reach)) + SLACK
            a, b = np.searchsorted(self.values[f], low, "left"), np.searchsorted(self.values[f], high, "right")
            if b - a < n:
                hits = np.zeros(n, np.int8) if hits is None else hits
                hits[self.order[f, a:b]] += 1
                lists += 1
        return None if hits is None else np.nonzero(hits == lists)[0]


class Rows:
    """Columns of a group as arrays."""

    def __init__(self, group: pa.Table, width: int, exact: bool):
        self.key, self.label = (group[c].to_numpy().astype(np.int64) for c in ("key", "label"))
        self.id = np.array([NO_ID if i is None else i for i in group["vec_id"].to_pylist()], np.int64)
        self.norm = group["norm"].to_numpy()
        self.rows = matrix(group["v"].to_pylist(), group["wide"].to_pylist(), width, exact)
        self.unit = np.zeros((len(self.key), width))
        usable = np.isfinite(self.norm) & (self.norm > 0)
        if not exact:
            self.unit[usable] = self.rows[usable] / self.norm[usable, None]

    def length_buckets(self, places: np.ndarray) -> list[LengthBucket]:
        places = places[np.argsort(-self.norm[places], kind="stable")]
        cut = (places[i : i + LENGTHS] for i in range(0, len(places), LENGTHS))
        return [LengthBucket(self.rows[p], self.norm[p], p) for p in cut]


def pair_of(group: pa.Table, probes: pa.Table) -> tuple[Rows, Rows]:
    """Both sides with components of one width and kind."""
    sides = [list(zip(t["v"].to_pylist(), t["wide"].to_pylist())) for t in (group, probes)]
    width = max((len(v) // (8 if w else 2) for side in sides for v, w in side), default=0)
    exact = any(w for side in sides for _, w in side) or width > 1 << 22
    return Rows(group, width, exact), Rows(probes, width, exact)


def merge(top: tuple | None, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if top is not None:
        scores, ids = np.concatenate([top[0], scores]), np.concatenate([top[1], ids])
    at = best(scores, ids, k)
    return scores[at], ids[at]


def find_positives(group: pa.Table, probes: pa.Table) -> pa.Table:
    """The best rows of the anchors' own labels in one bucket."""
    out: list[tuple] = []
    if len(group) and len(probes):
        rows, anchors = pair_of(group, probes)
        for label in np.unique(anchors.label).tolist():
            buckets = rows.length_buckets(np.nonzero(rows.label == label)[0])
            for a in np.nonzero(anchors.label == label)[0].tolist():
                top, wanted = None, LEAST
                for bucket in buckets:
                    some = bucket.candidates(anchors.unit[a], anchors.norm[a], wanted)
                    places = bucket.places if some is None else bucket.places[some]
                    other = rows.key[places] != anchors.key[a]
                    scores = products(bucket.rows if some is None else bucket.rows[some], anchors.rows[a])[other]
                    top = merge(top, scores, rows.id[places[other]], POSITIVES)
                    wanted = int(top[0][-1]) if len(top[0]) == POSITIVES else LEAST
                out += [(int(anchors.key[a]), int(i), int(s)) for s, i in zip(*top)] if top else []
    columns = list(zip(*out)) or [[], [], []]
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor", "positive", "score"])


def find_negatives(group: pa.Table, probes: pa.Table) -> pa.Table:
    """Per anchor and positive the best rows of other labels within its bounds in one bucket.  ``low`` and
    ``high`` of a probe hold the least score still wanted and the highest allowed."""
    out: list[tuple] = []
    if len(group) and len(probes):
        rows, anchors = pair_of(group, probes)
        buckets = rows.length_buckets(np.arange(len(rows.key)))
        lows, highs = probes["low"].to_pylist(), probes["high"].to_pylist()
        for a in range(len(anchors.key)):
            low, high = list(lows[a]), highs[a]
            tops: list = [None] * len(low)
            for bucket in buckets:
                wanted = min(low)
                some = bucket.candidates(anchors.unit[a], anchors.norm[a], wanted)
                if some is not None and not len(some):
                    continue
                scores = products(bucket.rows if some is None else bucket.rows[some], anchors.rows[a])
                places = bucket.places if some is None else bucket.places[some]
                may = (scores >= wanted) & (rows.label[places] != anchors.label[a])
                scores, ids = scores[may], rows.id[places[may]]
                for k, (least, most) in enumerate(zip(low, high)):
                    fits = (scores >= least) & (scores <= most)
                    if fits.any():
                        tops[k] = merge(tops[k], scores[fits], ids[fits], NEGATIVES)
                        if len(tops[k][0]) == NEGATIVES:
                            low[k] = max(least, int(tops[k][0][-1]))
            key = int(anchors.key[a])
            out += [(key, k, int(i), int(s)) for k, top in enumerate(tops) if top for s, i in zip(*top)]
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor", "place", "negative", "score"])


def searched(rows: DataFrame, probes: DataFrame, blocks: int, find, schema: str) -> DataFrame:
    """Run ``find`` on every bucket with every block of the probes sent to it."""
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    left = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = probes.withColumn("block", block)
    right = right.toDF(*right.columns)  # both sides may stem from the same table
    return left.groupBy("bucket", "block").cogroup(right.groupBy("bucket", "block")).applyInArrow(find, schema)


def hard_negatives(df: DataFrame, vector: str = "embedding", bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    plain = kept(vectors(df, vector))
    n = plain.count()
    parts = max(1, math.ceil(n / bucket))
    rows = kept(
        plain.repartitionByRange(parts, "label", F.desc("norm"), "key").withColumn("bucket", F.spark_partition_id())
    )
    anchors = rows.where(F.col("vec_id") % EVERY == 0).drop("bucket")
    blocks = max(1, math.ceil(anchors.count() / block))

    own = rows.select("label", "bucket").distinct()
    found = searched(rows, anchors.join(own, "label"), blocks, find_positives, "anchor bigint, positive bigint, score bigint")
    by_score = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive")
    positives = kept(found.withColumn("place", F.row_number().over(by_score) - 1).where(F.col("place") < POSITIVES))

    reach = kept(rows.groupBy("bucket").agg(F.max("norm").alias("longest")))
    last = reach.agg(F.max("bucket")).first()[0]
    of_each = positives.groupBy(F.col("anchor").alias("key")).agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("p"))
    least = f"cast(ceil({LOW} * cast(x.score as decimal(20,0)) / 100) as bigint)"
    most = f"cast(floor({HIGH} * cast(x.score as decimal(20,0)) / 100) as bigint)"
    probes = anchors.join(of_each, "key").select("*", F.expr(f"transform(p, x -> {least})").alias("low"), F.expr(f"transform(p, x -> {most})").alias("high")).drop("p")

    def pass_over(probes: DataFrame, first: bool) -> DataFrame:
        """Send probes to the first part of the buckets or to the rest, where the longest vector can reach."""
        chosen = reach.where((F.col("bucket") % FIRST == 0) if first else (F.col("bucket") % FIRST != 0))
        every = F.expr(f"sequence(0, {last or 0})")
        sent = probes.withColumn("bucket", F.explode(every)).join(chosen, "bucket")
        may = F.col("norm") * F.col("longest") * (1 + SLACK) + 1 >= F.array_min("low")
        return searched(rows.join(chosen.select("bucket"), "bucket", "left_semi"), sent.where(may).drop("longest"), blocks, find_negatives, "anchor bigint, place bigint, negative bigint, score bigint")

    best_of = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "negative")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best_of)).where(F.col("rank") <= NEGATIVES)
    one = kept(ranked(pass_over(probes, True)))
    bars = one.where(F.col("rank") == NEGATIVES).groupBy(F.col("anchor").alias("key")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("place").cast("int"), "score"))).alias("bar")
    )
    raised = F.expr("transform(low, (x, i) -> greatest(x, coalesce(bar[i], x)))")
    two = pass_over(probes.join(bars, "key", "left").withColumn("low", raised).drop("bar"), False)
    negatives = ranked(one.drop("rank").unionByName(two))

    ids = anchors.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    pairs = positives.select("anchor", "place", real("positive").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(pairs, ["anchor", "place"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", real("negative").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


SQL = f"""WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, e.vec_id, e.label,
    list_sum(list_transform(list_zip(a.v, e.v), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))) AS score
  FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE label <> own AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, CAST(positive_score AS BIGINT) AS positive_score,
  CAST(negative_score AS BIGINT) AS negative_score FROM n WHERE rank <= {NEGATIVES}"""


@query("op12_hard_negatives", SQL)
def mine_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))
