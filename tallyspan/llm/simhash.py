"""Operator 8, near-duplicates by SimHash, found with Golay-code fuzzy keys.

A fingerprint of 64 bits is cut into three segments.  Two fingerprints that differ in at
most two bits agree exactly in one segment at least, and differ in at most two bits in the
one after it.  So each fingerprint gets keys made of one exact segment and one codeword
index near the next segment.  The (23, 12) Golay code is perfect with radius three: a
segment and all words one bit away decode to at most six codewords, and two segments two
bits apart have a word between them, so they share one.  Fingerprints that share a key are
compared exactly; nothing within the radius is missed.

Crowded keys are not paired.  Their fingerprints are listed with every two bits outside the
exact segment blanked: equal lists are within the radius by construction, and each is tied to the
smallest of its list, so a group of any size gives links in proportion to its size.

Joins of keys and lists are told to shuffle: the planner takes what a Python function makes to be
as large as what it reads, here 16 and up to 903 times too small, and would collect it in the driver.

Defined results: NULL and empty texts and texts without words have fingerprint zero and
link like any other; fewer words than a shingle make one shingle; a NULL doc_id keeps its
row and never names a component that has another; repeated rows keep their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm.common import kept, query, small_batches, table
from tallyspan.llm.components import components
from tallyspan.llm.repeats import free_name, keyed

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (lowest bit, bits)
RADIUS = 2
CROWDED = 64
# Fixed value: generator polynomial of the (23, 12) Golay code.
GOLAY = 0b101011100011


def simhash(words: list[bytes], shingle: int = 3, seed: int = 42) -> int:
    """64-bit fingerprint of a word sequence: each bit by majority over its shingles."""
    import xxhash

    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], seed) for a, b in zip(starts[:n], last)), np.uint64, n)
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > n
    return int.from_bytes(np.packbits(ones).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed 64-bit integer."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [simhash((t or "").encode().lower().split(), shingle) for t in texts]
            signed = np.array(found, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


@cache
def golay_tables() -> tuple[list[np.ndarray], np.ndarray]:
    """Syndromes by byte of a 23-bit word, and the error pattern of each syndrome."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GOLAY << (bit - 11)
        return word

    by_byte = [np.array([remainder(x << s) if s < 16 or x < 128 else 0 for x in range(256)], np.int64) for s in (0, 8, 16)]
    errors = np.zeros(2048, np.int64)
    for weight in (1, 2, 3):
        for places in combinations(range(23), weight):
            pattern = sum(1 << p for p in places)
            errors[remainder(pattern)] = pattern
    return by_byte, errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword within three bits of each 23-bit word."""
    (low, mid, high), errors = golay_tables()
    syndrome = low[words & 255] ^ mid[words >> 8 & 255] ^ high[words >> 16 & 127]
    return (words ^ errors[syndrome]) >> 11


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the fingerprint, key) of every key of every fingerprint."""
    at, keys = [], []
    for k, (low, bits) in enumerate(SEGMENTS):
        exact = (fps >> np.uint64(low)) & np.uint64((1 << bits) - 1)
        low_next, bits_next = SEGMENTS[(k + 1) % 3]
        near = ((fps >> np.uint64(low_next)) & np.uint64((1 << bits_next) - 1)).astype(np.int64)
        flips = np.array([0, *(1 << b for b in range(bits_next))], np.int64)
        found = np.sort(codeword_index(near[:, None] ^ flips[None, :]), axis=1)
        new = np.ones(found.shape, bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        row, column = np.nonzero(new)
        at.append(row)
        keys.append((k << 40) | (exact.astype(np.int64)[row] << 12) | found[row, column])
    return np.concatenate(at), np.concatenate(keys)


def blanked(fps: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, which two bits, value without them) for every two bits outside the exact segment."""
    at, pair, value = [], [], []
    for k, (low, bits) in enumerate(SEGMENTS):
        rows = np.nonzero(segment == k)[0]
        free = [b for b in range(64) if not low <= b < low + bits]
        masks = np.array([(1 << a) | (1 << b) for a, b in combinations(free, 2)], np.uint64)
        names = np.array([a * 64 + b for a, b in combinations(free, 2)], np.int32)
        at.append(np.repeat(rows, len(masks)))
        pair.append(np.tile(names, len(rows)))
        value.append((fps[rows][:, None] & ~masks[None, :]).ravel())
    return np.concatenate(at), np.concatenate(pair), np.concatenate(value)


def near_links(distinct: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) between distinct fingerprints, at least a spanning set of all pairs
    within the radius: no pair within it lies in two components."""
    small_batches(distinct.sparkSession)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            at, key = fuzzy_keys(fps.astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(fps[at]), pa.array(key)], ["fp", "key"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            at, pair, value = blanked(fps.astype(np.uint64), batch.column(1).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [pa.array(fps[at]), pa.array(pair), pa.array(value.astype(np.int64))], ["fp", "pair", "value"]
            )

    keyed = distinct.select("fp").mapInArrow(keys, "fp bigint, key bigint")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = kept(keyed.join(sizes.hint("merge"), "key"))
    few = shared.where(F.col("n") <= crowded)
    pairs = few.alias("x").join(few.alias("y"), "key").where("x.fp < y.fp").select(
        F.col("x.fp").alias("a"), F.col("y.fp").alias("b")
    ).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
    many = shared.where(F.col("n") > crowded).select(
        "fp", F.shiftright("key", 40).cast("int").alias("segment")
    ).distinct()
    listed = many.mapInArrow(lists, "fp bigint, pair int, value bigint")
    first = listed.groupBy("pair", "value").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    tied = listed.join(first.hint("merge"), ["pair", "value"]).where("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.union(tied).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable over fingerprints that
    differ in at most two bits."""
    marked = kept(fingerprints(docs, shingle))
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(near_links(distinct))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    names = kept(rooted.join(named, "root").select("fp", "component_id"))
    return marked.join(names, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id (of rows that
    repeat it, one); documents without a doc_id stay."""
    key = free_name(docs)
    rows = keyed(docs, key)
    groups = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"))
    loses = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(key))
    return rows.join(loses, key, "left_anti").union(rows.where("doc_id IS NULL").join(loses, key, "left_semi")).select(*docs.columns)


@query("op8_simhash")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
