"""Operator 10, benchmark decontamination by fingerprints of item-sized windows.

A window of a document has as many words as a benchmark item.  Windows and items have
64-bit SimHash fingerprints over five-word shingles of the lower-case text.  An item's
fingerprint is listed under each of its eight bytes and all bytes up to two bits away; two
fingerprints within the radius of 23 bits have a byte that differs in at most two, so the
lists hold every item in reach.  Candidates are verified by the exact weighted similarity of
the shingles (sum of smaller counts over sum of larger counts), 0.8 or more.

Only windows that share a shingle with some item are fingerprinted; others have similarity 0.
Items are used in blocks of bounded size, each against all documents, so what is broadcast
does not grow with the benchmark.  An item shorter than a shingle is one shingle.

Defined results: NULL and empty texts and items match nothing; repeated items and rows each
give their rows; a window is at most the whole document, so a document shorter than an item
is compared whole; an empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm.anchors import mix
from tallyspan.llm.common import forget, kept, query, small_batches, table
from tallyspan.llm.repeats import blocks, coded, Unit

SHINGLE = 5
SIMILAR = 0.8
RADIUS = 23
BLOCK_CHARS = 8 << 20
# Fixed value: odd multiplier that makes a shingle's hash depend on the order of words.
STEP = 0x9E3779B97F4A7C15
WORDS = Unit(words=True, width=1, gram=1)
NEAR_BYTES = [[v for v in range(256) if (v ^ x).bit_count() <= RADIUS // 8] for x in range(256)]


def shingles(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word codes."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(STEP) + codes[k : k + n]
    return mix(out)


def votes(hashes: np.ndarray) -> np.ndarray:
    """Bits of each hash as rows of 64."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def majority(ones: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints from counts of ones (a row each) among ``n`` hashes."""
    return np.packbits(ones * 2 > n, axis=1).view(">u8").ravel().astype(np.uint64)


def similarity(a: Counter, b: Counter) -> float:
    smaller = sum((a & b).values())
    return smaller / (sum(a.values()) + sum(b.values()) - smaller)


class Items:
    """A block of benchmark items, indexed."""

    def __init__(self, ids: list, texts: list[str]) -> None:
        self.ids, self.sizes, self.counts, self.fps = [], [], [], []
        self.by_shingle: dict[int, dict[int, set]] = {}
        self.by_byte: dict[tuple[int, int, int], list[int]] = {}
        codes, sizes = coded([t.lower().encode() for t in texts], WORDS)
        ends = np.cumsum(sizes)
        for item, n, end in zip(ids, sizes.tolist(), ends.tolist()):
            if not n:
                continue
            size = min(SHINGLE, n)
            own = shingles(codes[end - n : end], size)
            fp = int(majority(votes(own).sum(axis=0, dtype=np.int64)[None, :], len(own))[0])
            k = len(self.ids)
            self.ids.append(item)
            self.sizes.append(n)
            self.counts.append(Counter(own.tolist()))
            self.fps.append(fp)
            for h in own.tolist():
                self.by_shingle.setdefault(size, {}).setdefault(h, set()).add(n)
            for byte in range(8):
                for near in NEAR_BYTES[fp >> 8 * byte & 255]:
                    self.by_byte.setdefault((n, byte, near), []).append(k)
        self.sorted = {size: np.sort(np.array(list(known), np.uint64)) for size, known in self.by_shingle.items()}

    def within_reach(self, n: int, fp: int) -> set[int]:
        found: set[int] = set()
        for byte in range(8):
            found.update(self.by_byte.get((n, byte, fp >> 8 * byte & 255), ()))
        return {k for k in found if (self.fps[k] ^ fp).bit_count() <= RADIUS}

    def matches(self, codes: np.ndarray) -> dict[int, tuple[float, int]]:
        """For each matching item the best similarity and where its window starts."""
        best: dict[int, tuple[float, int]] = {}
        for size, known in self.sorted.items():
            hashes = shingles(codes, size)
            if not len(hashes):
                continue
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hits = np.nonzero(known[at] == hashes)[0]
            if not len(hits):
                continue
            starts: dict[int, set[int]] = {}
            for p in hits.tolist():
                for n in self.by_shingle[size][int(hashes[p])]:
                    last = max(0, len(codes) - n)
                    starts.setdefault(n, set()).update(range(min(last, max(0, p - n + size)), min(p, last) + 1))
            for n, places in starts.items():
                self._compare(hashes, size, min(n, len(codes)) - size + 1, n, sorted(places), best)
        return best

    def _compare(self, hashes, size: int, width: int, n: int, places: list[int], best: dict) -> None:
        low, high = places[0], places[-1] + width
        for begin in range(low, high, 4096):  # counts of ones for windows that start in this stretch
            mine = [p for p in places if begin <= p < begin + 4096]
            if not mine:
                continue
            part = hashes[begin : mine[-1] + width]
            sums = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(votes(part), axis=0, dtype=np.int64)])
            at = np.array(mine) - begin
            for p, fp in zip(mine, majority(sums[at + width] - sums[at], width).tolist()):
                near = self.within_reach(n, fp)
                if near:
                    window = Counter(hashes[p : p + width].tolist())
                    for k in near:
                        s = similarity(window, self.counts[k])
                        if s >= SIMILAR and s > best.get(k, (0.0, 0))[0]:
                            best[k] = (s, p)


def item_blocks(benchmark: DataFrame) -> Iterator[pa.Table]:
    """The items with a text (item_id, text) in blocks of about ``BLOCK_CHARS``."""
    items = benchmark.where("text IS NOT NULL").select("item_id", "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(chars / BLOCK_CHARS))
    numbered = items.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    for part in range(parts):
        yield numbered.where(F.col("_part") == part).select("item_id", "text").toArrow()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity of the best window, start_word and n_words of that window."""
    small_batches(docs.sparkSession)
    id_type, item_type = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {id_type}, item_id {item_type}, similarity double, start_word bigint, n_words bigint"
    found = (docs.select("doc_id", "text").mapInArrow(_finder(block), schema) for block in item_blocks(benchmark))
    return reduce(DataFrame.union, found)


def coded_texts(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(place, word codes) of the texts that are not empty."""
    rows = [(i, t.lower().encode()) for i, t in enumerate(texts) if t]
    for lot in blocks(rows):
        codes, sizes = coded([t for _, t in lot], WORDS)
        for (i, _), n, end in zip(lot, sizes.tolist(), np.cumsum(sizes).tolist()):
            yield i, codes[end - n : end]


def _finder(block: pa.Table):
    ids, texts = block["item_id"].combine_chunks(), block["text"].to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(list(range(len(texts))), texts)
        for batch in batches:
            keys, out = batch.column(0), []
            for i, codes in coded_texts(batch.column(1).to_pylist()):
                for k, (s, start) in items.matches(codes).items():
                    out.append((i, items.ids[k], s, start, min(len(codes), items.sizes[k])))
            i, item, s, start, n = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(i, pa.int64())), ids.take(pa.array(item, pa.int64())), pa.array(s, pa.float64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                ],
                ["doc_id", "item_id", "similarity", "start_word", "n_words"],
            )

    return run


def _leaks(block: pa.Table):
    """Whether a text holds a window similar to an item of the block."""
    texts = block["text"].to_pylist()

    @F.arrow_udf("boolean")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = Items(list(range(len(texts))), texts)
        for column in columns:
            found = np.zeros(len(column), bool)
            for i, codes in coded_texts(column.to_pylist()):
                found[i] = bool(items.matches(codes))
            yield pa.array(found)

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window similar to an item, row by row: rows that share
    a doc_id, or have none, are judged each by its own text.

    Only texts go to Python and no row moves.  With several blocks of items the rows that one
    leaves are written before the next reads them, so a task needs one Python worker with one block.
    """
    small_batches(docs.sparkSession)
    left, written = docs, None
    for block in item_blocks(benchmark):
        if left is not docs:
            left, before = kept(left), written
            if before is not None:
                forget(before)
            written = left
        left = left.where(~_leaks(block)("text"))
    return left


@query("op10_decontaminate")
def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
