"""Repeated windows of a corpus: what both substring operators share.

1. Every text is cut into segments (see ``anchors``): one row for a run of windows that pick
   the same anchor, with a hash of the anchor and one of the whole segment.
2. Segments whose anchor occurs once hold no repeated window and are dropped.
3. Equal segments repeat window for window.  They are settled by one aggregation.
4. A segment is cut in two pieces: the windows with at least half of their room on the left of
   the anchor, and the others.  All windows of a piece hold its core, the anchor with half a window's
   room on that side, and equal windows lie in pieces with equal cores.  Pieces whose core
   occurs once among different segments hold no other repeat and are dropped before any byte is fetched.
5. The bytes of the pieces left are compared: shards of them, dealt by core, go to the operator's own index.
   Pieces that share a core with very many are cut again by the same rule, which makes the core longer,
   until few share one or the core is the window itself.
6. The repeated spans of each text are joined back to it.

Texts travel compressed, once to cut out the bytes of step 5 and once for step 6.  Hashes:
anchor and segment have 64 bits each and must both agree; equal cores only bring pieces together.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tallyspan.llm.anchors import BASES, byte_codes, mix, rolling, segments
from tallyspan.llm.common import forget, kept, small_batches

SHARD_PIECES = 4096
# Pieces of one core that a task compares; above, they are cut again.
CORE_PIECES = 8192
# Bytes whose hashes are made at once; a worker holds some forty times as much.
BLOCK = 1 << 18


@dataclass(frozen=True)
class Unit:
    """What windows are made of: bytes, or words."""

    words: bool
    width: int
    gram: int


def word_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end in UTF-8 bytes; white space is space and 9 to 13."""
    solid = np.zeros(len(raw) + 2, np.int8)
    solid[1:-1] = (raw != 32) & ((raw < 9) | (raw > 13))
    edges = np.diff(solid)
    return np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]


def word_codes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each word."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        at = starts[i]
        sums, down = rolling(byte_codes()[raw[at : ends[j - 1]]], BASES[0])
        a, b = starts[i:j] - at, ends[i:j] - at
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def coded(texts: list[bytes], unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    """Unit codes of texts one after another, and how many each has."""
    if not unit.words:
        raw = np.frombuffer(b"".join(texts), np.uint8)
        return byte_codes()[raw], np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    starts, ends = word_places(raw)
    limits = np.cumsum([len(t) + 1 for t in texts])
    per_text = np.diff(np.searchsorted(starts, limits), prepend=0)
    return word_codes(raw, starts, ends), per_text


def blocks(rows: list[tuple[int, bytes]]) -> Iterator[list[tuple[int, bytes]]]:
    """Rows in lots of about ``BLOCK`` bytes."""
    lot, size = [], 0
    for row in rows:
        lot.append(row)
        size += len(row[1])
        if size >= BLOCK:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def free_name(df: DataFrame) -> str:
    """A column name that the frame does not have."""
    name = "_row"
    while name in df.columns:
        name += "_"
    return name


def keyed(docs: DataFrame, name: str = "_key") -> DataFrame:
    """Adds a key, unique and ordered as doc_id.

    That is doc_id itself unless it is missing or repeats somewhere; then the rows are
    sorted by (doc_id, text), missing ids last, and numbered in that order.
    """
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    whole = dict(docs.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint")
    if whole and odd.isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long"))
    ordered = docs.orderBy(F.col("doc_id").asc_nulls_last(), "text")
    return kept(ordered.withColumn(name, F.monotonically_increasing_id()))


def occurrences(texts: DataFrame, unit: Unit, whole: bool = True) -> DataFrame:
    """All segments of (key, text), or only their anchors.  ``shape`` holds the number of windows in its
    low 16 bits and the anchor's place in the segment above them; ``cores`` the left core's hash above the right one's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), (t.encode() if t else b"" for t in batch.column(1).to_pylist())))
            for lot in blocks(rows):
                codes, sizes = coded([t for _, t in lot], unit)
                ends = np.cumsum(sizes)
                found = segments(codes, np.repeat(np.arange(len(lot)), sizes), ends, unit.width, unit.gram, whole)
                long = lambda name: pa.array(found[name].astype(np.uint64).view(np.int64))  # noqa: B023, E731
                if not whole:
                    yield pa.RecordBatch.from_arrays([long("anchor")], ["anchor"])
                    continue
                text = found["text"].astype(np.int64)
                first = found["first"].astype(np.int64) - (ends - sizes)[text] if len(text) else found["first"]
                keys = np.array([k for k, _ in lot], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[text], pa.int64()), pa.array(first, pa.int64()), pa.array((found["place"] * 65536 + found["n"]).astype(np.int32)),
                        long("anchor"), long("content"), long("cores"),
                    ],
                    ["key", "first", "shape", "anchor", "content", "cores"],
                )

    columns = "key bigint, first bigint, shape int, anchor bigint, content bigint, cores bigint"
    return texts.mapInArrow(run, columns if whole else "anchor bigint")


def packed(docs: DataFrame, text: str) -> DataFrame:
    """The text column as compressed UTF-8, for the shuffles."""
    names, at = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            small = [press.compress(t.encode() if t else b"") for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, names[at], pa.array(small, pa.binary()))

    schema = StructType([StructField(f.name, BinaryType()) if f.name == text else f for f in docs.schema.fields])
    return docs.mapInArrow(run, schema)


def unpack(value: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(value)


def cut_out(body: bytes, places: list[dict], unit: Unit) -> list[bytes]:
    """The bytes of pieces; words are joined by one space."""
    if not unit.words:
        return [body[p["first"] : p["first"] + p["n"] - 1 + unit.width] for p in places]
    words = body.split()
    return [b" ".join(words[p["first"] : p["first"] + p["n"] - 1 + unit.width]) for p in places]


def repeated_spans(
    docs: DataFrame, unit: Unit, later_only: bool, shard_repeats: Callable[[pa.Table, Unit], pa.Table]
) -> DataFrame:
    """(key, first, n): runs of windows that repeat, from docs (key, text).

    ``later_only``: a window repeats if an equal one starts earlier; else if one starts anywhere else.
    ``shard_repeats`` finds them among the pieces (key, first, n, body) of one shard.
    """
    small_batches(docs.sparkSession)
    anchors = occurrences(docs, unit, whole=False)
    shared = kept(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor"))
    found = kept(occurrences(docs, unit).join(shared.hint("shuffle_hash"), "anchor"))
    forget(shared)
    groups = kept(
        found.groupBy("anchor", "content").agg(
            F.min(F.struct("key", "first")).alias("head"), F.max("shape").alias("shape"), F.max("cores").alias("cores"),
            F.count(F.lit(1)).alias("c"),
        )
    )
    twice = groups.where("c > 1").select("anchor", "content", "head")
    same = found.join(twice, ["anchor", "content"])
    if later_only:
        same = same.where(F.struct("key", "first") != F.col("head"))
    windows_in = F.col("shape").bitwiseAND(65535).cast("long").alias("n")
    settled = same.select("key", "first", windows_in)

    pieces = side_pieces(groups, unit)
    few, crowd = by_core(pieces)
    lots = [segment_bytes(docs, few, unit)]
    spans = [settled]
    crowd = None if crowd is None else kept(segment_bytes(docs, crowd, unit))
    while crowd is not None:
        cut = kept(cut_again(crowd, unit))
        forget(crowd)
        # the core of a single window is the window
        single = cut.where("high - low = 1")
        heads = single.groupBy("body").agg(F.min(F.struct("key", "first")).alias("head"), F.count(F.lit(1)).alias("c"))
        equal = single.join(heads.where("c > 1"), "body")
        if later_only:
            equal = equal.where(F.struct("key", "first") != F.col("head"))
        spans.append(equal.select("key", "first", "n"))
        few, crowd = by_core(cut.where("high - low > 1"))
        lots.append(few)
        crowd = None if crowd is None else kept(crowd)
    to_compare = reduce(DataFrame.union, (lot.select("core", "key", "first", "n", "body") for lot in lots))
    to_compare = kept(to_compare)
    shards = max(1, math.ceil(to_compare.count() / SHARD_PIECES))
    compared = kept(
        to_compare.withColumn("shard", F.pmod(F.xxhash64("core"), F.lit(shards)))
        .groupBy("shard").applyInArrow(lambda group: shard_repeats(group, unit), "key bigint, first bigint, n bigint")
    )
    forget(to_compare)
    return reduce(DataFrame.union, [*spans, compared])


def side_pieces(groups: DataFrame, unit: Unit) -> DataFrame:
    """Two pieces of each different segment: core, key, first, n, room (the units left of the anchor in the
    first window) and the range low <= room < high that the windows of such pieces have."""
    split, most = (unit.width - unit.gram) // 2, unit.width - unit.gram + 1
    n, room = F.col("shape").bitwiseAND(65535), F.shiftright("shape", 16)
    on_left = F.least(n, F.greatest(F.lit(0), room - split + 1))
    rows = groups.select(
        F.col("head.key").alias("key"), "anchor", "cores", F.col("head.first").alias("start"), n.alias("all"), room.alias("place"), on_left.alias("skip")
    )
    core = lambda side, half: F.xxhash64("anchor", F.lit(side), half).alias("core")
    left = F.struct(
        core(0, F.shiftright("cores", 32)), F.col("start").alias("first"), F.col("skip").cast("long").alias("n"),
        F.col("place").alias("room"), F.lit(split).alias("low"), F.lit(most).alias("high"),
    )
    right = F.struct(
        core(1, F.col("cores").bitwiseAND(0xFFFFFFFF)), (F.col("start") + F.col("skip")).alias("first"), (F.col("all") - F.col("skip")).cast("long").alias("n"),
        (F.col("place") - F.col("skip")).alias("room"), F.lit(0).alias("low"), F.lit(split).alias("high"),
    )
    return rows.select("key", F.inline(F.array(left, right))).where("n > 0")


def by_core(pieces: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The pieces whose core some others have, and those whose core very many have, if any."""
    cores = kept(pieces.groupBy("core").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    crowded = cores.where(F.col("c") > CORE_PIECES).select("core")
    few = pieces.join(cores.where(F.col("c") <= CORE_PIECES).select("core"), "core")
    return few, None if crowded.isEmpty() else pieces.join(crowded, "core")


def cut_again(pieces: DataFrame, unit: Unit) -> DataFrame:
    """Each piece in two: the range of rooms is halved, the core of each half is longer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for core, key, first, n, room, low, high, body in zip(*(c.to_pylist() for c in batch.columns)):
                units, middle = body.split() if unit.words else body, (low + high) // 2
                skip = min(n, max(0, room - middle + 1))
                for lo, hi, at, count in ((middle, high, 0, skip), (low, middle, skip, n - skip)):
                    if count:
                        anchor = room
                        inner = units[anchor - lo : anchor + unit.width - hi + 1]
                        cut = units[at : at + count - 1 + unit.width]
                        inner, cut = (b" ".join(inner), b" ".join(cut)) if unit.words else (inner, cut)
                        out.append((core_of(core, lo, inner), key, first + at, count, room - at, lo, hi, cut))
            columns = zip(*out) if out else [[]] * len(batch.columns)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, batch.schema)], batch.schema.names)

    return pieces.select(*PIECE).mapInArrow(run, PIECE_SCHEMA)


PIECE = ("core", "key", "first", "n", "room", "low", "high", "body")
PIECE_SCHEMA = "core bigint, key bigint, first bigint, n bigint, room int, low int, high int, body binary"


def core_of(outer: int, low: int, inner: bytes) -> int:
    digest = hashlib.blake2b(inner, digest_size=8, key=outer.to_bytes(8, "big", signed=True) + bytes([low])).digest()
    return int.from_bytes(digest, "big", signed=True)


def segment_bytes(docs: DataFrame, wanted: DataFrame, unit: Unit) -> DataFrame:
    """Adds the bytes of pieces.  A text's list is bounded by the text's own length."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("core", "first", "n", "room", "low", "high")).alias("places"))
    joined = packed(docs, "text").join(lists, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), batch.column("places").to_pylist())
            out = []
            for key, text, places in rows:
                bodies = cut_out(unpack(text), places, unit)
                out += [(p["core"], key, p["first"], p["n"], p["room"], p["low"], p["high"], b) for p, b in zip(places, bodies)]
            kinds = (*[pa.int64()] * 4, *[pa.int32()] * 3, pa.binary())
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(PIECE))

    return joined.select("key", "text", "places").mapInArrow(run, PIECE_SCHEMA)


def runs_of(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and length of each run of consecutive numbers in a sorted array."""
    at = np.nonzero(np.diff(windows, prepend=-2) != 1)[0]
    return windows[at], np.diff(at, append=len(windows))


def covered(spans: list[dict] | None, total: int, unit: Unit) -> np.ndarray:
    """Which units of a text lie in a repeated window."""
    edge = np.zeros(total + 1, np.int64)
    for s in spans or ():
        edge[s["first"]] += 1
        edge[min(total, s["first"] + s["n"] - 1 + unit.width)] -= 1
    return np.cumsum(edge[:-1]) > 0


def with_spans(docs: DataFrame, spans: DataFrame, text: str, key: str, apply: Callable, outputs: list[StructField]) -> DataFrame:
    """Joins each text with its spans and calls ``apply(bytes, spans)`` for the output
    columns, which come after the columns of docs other than the text and the key."""
    lists = spans.groupBy("key").agg(F.collect_list(F.struct("first", "n")).alias("_spans"))
    joined = packed(docs, text).join(lists.withColumnRenamed("key", key), key, "left")
    rest = [f for f in docs.schema.fields if f.name not in (text, key)]
    names = [f.name for f in rest] + [f.name for f in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [apply(unpack(t), s) for t, s in zip(batch.column(text).to_pylist(), batch.column("_spans").to_pylist())]
            kinds = [pa.int64() if isinstance(f.dataType, LongType) else pa.string() for f in outputs]
            columns = zip(*made) if made else [[]] * len(outputs)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in rest], *[pa.array(c, k) for c, k in zip(columns, kinds)]], names
            )

    return joined.mapInArrow(run, StructType([*rest, *outputs]))
