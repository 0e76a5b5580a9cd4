"""Texts whose five-word shingles have Jaccard similarity 0.8 or more, a wider rule than operator 8's.

The pipeline does not use it: its stage is operator 8.  Where very many texts are alike but not similar enough,
the exact result compares each with each.

Similar texts are found by banded MinHash over the set of five-word shingles of the lower-case
text, and each pair found is verified by the exact similarity of the two sets.  A pair at 0.8
shares one band at least with probability 1 - (1 - 0.8^5)^25 = 0.99995, closer pairs more surely.

Texts with equal sets are settled by one aggregation, and only the first of them goes on.  Every text is
first compared with one center that it shares a band with, which ties groups of copies in as many pairs as
texts.  In a band that few texts share all pairs that are left are compared.  Crowded bands are settled
without a bound, by the rarest shingles of the texts of crowded bands: of two sets with similarity
0.8 each has one of the rarest n - ceil(0.8 n) + 1 of its n shingles in common with those of the other, whatever
the order, as long as both have the same.  So texts that share only frequent shingles, such as a template,
never meet, and texts that share rare ones are compared unless they are of one group already; where
very many share one, some after the other become centers until each has been one or is tied.

Groups are what verified pairs connect.  Of each group the row with the smallest key stays (see
``repeats.keyed``), so missing and repeated doc_ids lose and keep rows like any other.  Texts
with fewer than five words are one shingle; those without words equal each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.anchors import mix
from tallyspan.llm.common import forget, kept, small_batches
from tallyspan.llm.components import components
from tallyspan.llm.decontaminate import SHINGLE, STEP, WORDS, shingles
from tallyspan.llm.repeats import blocks, coded, free_name, keyed

BANDS, ROWS = 25, 5
CROWDED = 64
CENTERS = 64


def shingle_sets(texts: list) -> Iterator[tuple[int, np.ndarray]]:
    """(place, sorted different shingle hashes) of each text."""
    for lot in blocks([(i, (t or "").lower().encode()) for i, t in enumerate(texts)]):
        codes, sizes = coded([t for _, t in lot], WORDS)
        for (i, _), n, end in zip(lot, sizes.tolist(), np.cumsum(sizes).tolist()):
            yield i, np.unique(shingles(codes[end - n : end], min(SHINGLE, n))) if n else np.zeros(0, np.uint64)


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """Band keys of sets that are not empty, a row each."""
    pick = np.random.default_rng(42)
    flips = pick.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
    factors = pick.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(sets), BANDS), np.uint64)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    every = np.concatenate(sets)
    for band in range(BANDS):
        key = np.full(len(sets), band, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = mix(key * np.uint64(STEP) + np.minimum.reduceat((every ^ flips[k]) * factors[k], starts))
        out[:, band] = key
    return out


def sketches(texts: DataFrame) -> DataFrame:
    """From (key, text): key, two hashes and the size of the shingle set, and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for _, s in shingle_sets(batch.column(1).to_pylist())]
            found: list = [[] for _ in sets]
            lot, size = [], 0
            for i, s in enumerate(sets):
                if len(s):
                    lot.append(i)
                    size += len(s)
                if lot and (size >= 1 << 17 or i == len(sets) - 1):
                    for k, row in zip(lot, bands([sets[k] for k in lot]).view(np.int64).tolist()):
                        found[k] = row
                    lot, size = [], 0
            sums = np.array([int(s.sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)
            mixed = np.array([int(np.bitwise_xor.reduce(mix(s + np.uint64(1)))) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sums), pa.array(mixed), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                ["key", "sums", "mixed", "size", "bands"],
            )

    return texts.mapInArrow(run, "key bigint, sums bigint, mixed bigint, size bigint, bands array<bigint>")


def with_sets(texts: DataFrame) -> DataFrame:
    """From (key, text): key and the shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for _, s in shingle_sets(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["key", "hashes"])

    return texts.mapInArrow(run, "key bigint, hashes array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts have similarity 0.8 or more."""
    pairs = kept(pairs.distinct())
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    sets = kept(with_sets(texts.join(wanted, "key", "left_semi")))
    side = lambda name: sets.select(F.col("key").alias(name), F.col("hashes").alias(f"of_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", F.size(F.array_intersect("of_a", "of_b")).alias("common"), (F.size("of_a") + F.size("of_b")).alias("total")
    )
    links = kept(both.where("5 * common >= 4 * (total - common)").select("a", "b"))
    forget(pairs)
    forget(sets)
    return links


MAY = "5 * least(x.size, y.size) >= 4 * greatest(x.size, y.size)"


def rarest_shingles(crowd: DataFrame, texts: DataFrame) -> DataFrame:
    """(h, first, size) of the shingles by which texts of ``crowd`` (first, size) can be similar: those among a
    text's n - ceil(0.8 n) + 1 rarest, by the number of texts in ``crowd`` and then by hash, that another has."""
    sets = kept(with_sets(texts.join(crowd.select(F.col("first").alias("key")), "key", "left_semi")))
    places = sets.select(F.col("key").alias("first"), F.size("hashes").alias("size"), F.explode("hashes").alias("h"))
    shared = places.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    own = Window.partitionBy("first")
    ranked = places.join(shared, "h").select(
        "h", "first", "size", F.row_number().over(own.orderBy("c", "h")).alias("place"), F.count(F.lit(1)).over(own).alias("n_shared")
    )
    # shingles of one text alone are rarer than all others
    keys = kept(ranked.where("size - n_shared + place <= size - ceil(0.8 * size) + 1").select("h", "first", "size"))
    forget(sets)
    return keys


def similar_links(distinct: DataFrame, texts: DataFrame, crowded: int = CROWDED, centers: int = CENTERS) -> DataFrame:
    """Verified links (a, b) between texts of different sets: (first, size, bands) of each."""
    may = F.expr(MAY)
    star = (F.least("x.first", "y.first").alias("a"), F.greatest("x.first", "y.first").alias("b"))
    open_bands = distinct.select("first", "size", F.explode("bands").alias("band"))
    sizes = open_bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = kept(open_bands.join(sizes, "band"))
    few, many = shared.where(F.col("n") <= crowded), shared.where(F.col("n") > crowded)
    # the same order in all bands, so that a group has few centers; of the centers it meets a text takes the first
    order = F.xxhash64("first")
    center = shared.groupBy("band").agg(F.min(F.struct(order.alias("o"), "first", "size")).alias("c"))
    met = shared.join(center, "band").where("5 * least(size, c.size) >= 4 * greatest(size, c.size)")
    chosen = met.groupBy("first").agg(F.min("c").alias("c")).where("first <> c.first")
    stars = verified(chosen.select(F.least("first", "c.first").alias("a"), F.greatest("first", "c.first").alias("b")), texts)
    # what the centers tied needs no more pairs
    tied = kept(components(stars).select(F.col("node").alias("first"), "root"))
    ends = few.join(tied, "first", "left").withColumn("root", F.coalesce("root", "first"))
    pairs = ends.alias("x").join(ends.alias("y"), "band").where("x.first < y.first AND x.root <> y.root").where(may).select(*star)
    links = stars.union(verified(pairs, texts))
    forget(tied)
    crowd = kept(many.select("first", "size").distinct())
    forget(shared)
    if crowd.isEmpty():
        forget(crowd)
        return links
    keys = rarest_shingles(crowd, texts)
    forget(crowd)
    found, used = [links], None
    while True:
        every = reduce(DataFrame.union, found)
        roots = kept(components(every).select(F.col("node").alias("first"), "root"))
        rooted = keys.join(roots, "first", "left").withColumn("root", F.coalesce("root", "first"))
        groups = rooted.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        open_ = kept(rooted.join(groups.where("low <> high").select("h", "n"), "h"))
        forget(roots)
        large = open_.where(F.col("n") > crowded)
        waiting = large if used is None else large.join(used, ["h", "first"], "left_anti")
        nth = F.row_number().over(Window.partitionBy("h").orderBy(F.xxhash64("first")))
        fresh = kept(waiting.withColumn("nth", nth).where(F.col("nth") <= centers).drop("nth", "n"))
        side = fresh
        if used is None:  # small groups are compared whole, and once
            side = fresh.unionByName(open_.where(F.col("n") <= crowded).drop("n"))
        apart = open_.alias("x").join(side.alias("y"), "h").where("x.root <> y.root").where(may)
        if fresh.isEmpty() and used is not None:
            forget(open_)
            forget(fresh)
            break
        found.append(verified(apart.select(*star), texts))
        forget(open_)
        done = fresh.select("h", "first")
        used = done if used is None else used.union(done)
    forget(keys)
    return every


def drop_near_copies(docs: DataFrame, crowded: int = CROWDED, centers: int = CENTERS) -> DataFrame:
    """One row of each group of similar texts stays, the one with the smallest key."""
    small_batches(docs.sparkSession)
    key = free_name(docs)
    rows = keyed(docs, key)
    texts = rows.select(F.col(key).alias("key"), "text")
    distinct = kept(
        sketches(texts).groupBy("sums", "mixed", "size").agg(F.min("key").alias("first"), F.min_by("bands", "key").alias("bands"))
        .select("first", "size", "bands")
    )
    roots = components(similar_links(distinct, texts, crowded, centers))
    tied = roots.where("node <> root").select(F.col("node").alias(key))
    stays = kept(distinct.select(F.col("first").alias(key)).join(tied, key, "left_anti"))
    forget(distinct)
    return rows.join(stays, key, "left_semi").select(*docs.columns)
