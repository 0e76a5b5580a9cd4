"""Operator 13, phrase collocations by partitioned (SON) mining.

Texts are dealt into ``SHARDS`` shards by a hash of the text.  A phrase that occurs ``SUPPORT``
times in a language reaches, in some shard, the same share of the support as the shard has of
the language's words.  So each shard is mined completely at that lowered support, level by level:
words, then phrases of two to four words both of whose shorter parts are frequent in the shard.
What is frequent in any shard is a candidate, and one more pass counts all candidates exactly.

A shard is not a task: any number of tasks count it together, under hashes that carry language
and shard, summed in each lot of text before they are shuffled.  What one level found reaches
the next as a bitmap of fixed size (``2 ** SLOT_BITS`` bits) of those hashes.  Phrases that share
a hash or a bit only make more candidates; the last pass counts the words themselves, so
counts are exact.  No phrase is lost, and the bitmaps do not grow with the input.

Phrases are scored by the cut that explains them worst, phrases that a longer one mostly
covers are dropped, and the best of each language stay.

Defined results: NULL text is empty, NULL language is ``und``; pieces end at sentence signs and line
ends; repeated rows count each; an empty table gives no rows; other columns are ignored.  Long
texts are cut at the end of a piece, or with the last words repeated where a piece is too long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.llm.anchors import mix
from tallyspan.llm.common import forget, kept, query, small_batches, table

SUPPORT = 30
LONGEST = 4
SHARDS = 8
TOP = 2000
COVERED = 80
SLOT_BITS = 27
LOT_BYTES = 4 << 20
# A phrase counts as frequent in a shard from this share of the shard's support; the rest is rounding.
ENOUGH = 1 - 1e-6

# Signs that end a piece, and an odd multiplier that makes hashes depend on the order of words.
PIECE_END = b".,;:!?\n\x0b\f\r"
STEP = np.uint64(0x9E3779B97F4A7C15)
FOLD = bytes(10 if b in PIECE_END else 32 if b in b"\t " else b + 32 if 65 <= b <= 90 else b for b in range(256))
SHARD_BITS = np.uint64(SHARDS - 1)


def chunks(body: bytes, limit: int) -> Iterator[tuple[bytes, int]]:
    """A folded text in parts of about ``limit`` bytes, each with the number of its last words that
    begin no phrase there, since the next part begins with them again."""
    at = 0
    while len(body) - at > limit:
        end = body.rfind(b"\n", at, at + limit)
        if end >= at:
            yield body[at:end], 0
            at = end + 1
            continue
        width, last = limit, []
        while len(last) < LONGEST and at + width < len(body):
            end = body.rfind(b" ", at, at + width)
            last = body[at:end].rsplit(None, LONGEST - 1) if end > at else []
            width *= 2
        if len(last) < LONGEST:
            break
        yield body[at:end], LONGEST - 1
        at += len(last[0])
    yield body[at:], 0


class Lot:
    """The words of some texts: a number for each different word, its piece and its row."""

    def __init__(self, rows: list[tuple[int, bytes, int]]):
        """rows: (number of the row's group, folded text, last words that begin no phrase)."""
        raw = np.frombuffer(b"".join(body + b"\n" for _, body, _ in rows), np.uint8)
        solid = np.zeros(len(raw) + 1, np.int8)
        solid[1:] = (raw != 32) & (raw != 10)
        edges = np.diff(solid)
        starts, ends = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
        del edges
        limits = np.cumsum([len(body) + 1 for _, body, _ in rows])
        row = np.searchsorted(limits, starts, "right")
        self.piece = np.searchsorted(np.nonzero(raw == 10)[0], starts)
        self.group = np.array([g for g, _, _ in rows], np.int64)[row]
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        letters = raw[solid[1:] == 1].tobytes()
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.counted = np.ones(len(starts), bool)
        for r, (_, _, last) in enumerate(rows):
            if last:
                end = int(np.searchsorted(row, r, "right"))
                self.counted[end - last : end] = False

    def hashes(self, salts: np.ndarray) -> np.ndarray:
        """A hash of each word and its group's language."""
        own = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words.to_pylist()], np.uint64)
        return mix(own[self.ids] ^ salts[self.group])

    def runs(self, n: int) -> np.ndarray:
        """Whether a phrase of n words begins at each word."""
        out = np.zeros(len(self.ids), bool)
        if len(out) >= n:
            out[: len(out) - n + 1] = self.piece[n - 1 :] == self.piece[: len(out) - n + 1]
        return out


def longer(hashes: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of phrases of n words from those of n - 1 that begin at the same words."""
    out = np.zeros_like(hashes)
    if len(out) >= n:
        out[: len(out) - n + 1] = mix(hashes[: len(out) - n + 1] * STEP + words[n - 1 :])
    return out


def both_ends(flags: np.ndarray) -> np.ndarray:
    """Where a flag is set and the next one too."""
    out = np.zeros_like(flags)
    out[:-1] = flags[:-1] & flags[1:]
    return out


def marked(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1


def shard_slots(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(67 - SLOT_BITS) << np.uint64(3) | hashes & SHARD_BITS


def slots(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - SLOT_BITS)


# The same two slots of a column of hashes.
SHARD_SLOT = f"shiftleft(shiftrightunsigned(h, {67 - SLOT_BITS}), 3) | (h & {SHARDS - 1})"
SLOT = f"shiftrightunsigned(h, {64 - SLOT_BITS})"


def bitmap(found: DataFrame, slot: str):
    """A broadcast bitmap of fixed size of the slots of hashes ``h``."""
    at = F.expr(f"({slot}) + 1")
    parts = found.select(F.bitmap_bucket_number(at).alias("b"), F.bitmap_bit_position(at).alias("p"))
    bits = np.zeros(1 << SLOT_BITS - 3, np.uint8)
    for r in parts.groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect():
        bits[(r.b - 1) * len(r.bits) : r.b * len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    return found.sparkSession.sparkContext.broadcast(bits)


def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Lot, list[tuple]]]:
    """Lots of the texts in the last column, and the other columns' values of each group."""
    groups: dict[tuple, int] = {}
    rows: list[tuple[int, bytes, int]] = []
    size = 0
    for batch in batches:
        values = zip(*(c.to_pylist() for c in batch.columns[:-1]))
        for own, text in zip(values, batch.columns[-1]):
            for body, last in chunks((text.as_py() or "").encode().translate(FOLD), LOT_BYTES):
                rows.append((groups.setdefault(own, len(groups)), body, last))
                size += len(body)
                if size >= LOT_BYTES:
                    yield Lot(rows), list(groups)
                    groups, rows, size = {own: 0}, [], 0
    if rows:
        yield Lot(rows), list(groups)


def language_salts(groups: list[tuple]) -> np.ndarray:
    """A salt for each group; groups begin with their language."""
    return np.array([xxhash.xxh3_64_intdigest(g[0].encode()) for g in groups], np.uint64)


def shard_words(rows: DataFrame) -> DataFrame:
    """From (lang, shard, text): lang, shard, word, its hash and its count in the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot, groups in lots(batches):
            base = len(lot.words)
            key = (lot.group * base + lot.ids)[lot.counted]
            _, at, counts = np.unique(key, return_index=True, return_counts=True)
            at = np.nonzero(lot.counted)[0][at]
            own = lot.group[at]
            hashes = lot.hashes(language_salts(groups))[at] & ~SHARD_BITS | np.array([g[1] for g in groups], np.uint64)[own]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([g[0] for g in groups], pa.string()).take(pa.array(own)), pa.array([g[1] for g in groups], pa.int32()).take(pa.array(own)),
                    lot.words.take(pa.array(lot.ids[at])).cast(pa.string()), pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64)),
                ],
                ["lang", "shard", "word", "h", "c"],
            )

    found = rows.mapInArrow(run, "lang string, shard int, word string, h bigint, c bigint")
    return found.groupBy("lang", "shard", "word").agg(F.min("h").alias("h"), F.sum("c").alias("c"))


def mined(rows: DataFrame, n: int, shorter) -> DataFrame:
    """From (lang, shard, t, text): hashes of the phrases of n words that occur t times in their
    shard.  ``shorter``: the bitmap of those of n - 1 words.  Each occurrence weighs 1 / t."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot, groups in lots(batches):
            shard = np.array([g[1] for g in groups], np.uint64)[lot.group]
            words = lot.hashes(language_salts(groups))
            hashes = words
            for k in range(2, n):
                hashes = longer(hashes, words, k)
            frequent = lot.runs(n - 1) & marked(shorter.value, shard_slots(hashes & ~SHARD_BITS | shard))
            at = np.nonzero(both_ends(frequent) & lot.runs(n) & lot.counted)[0]
            found = longer(hashes, words, n)[at] & ~SHARD_BITS | shard[at]
            found, first, counts = np.unique(found, return_index=True, return_counts=True)
            least = np.array([g[2] for g in groups], np.float64)[lot.group[at[first]]]
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts / least)], ["h", "share"])

    found = rows.mapInArrow(run, "h bigint, share double")
    return found.groupBy("h").agg(F.sum("share").alias("share")).where(F.col("share") >= ENOUGH).select("h")


def counted(rows: DataFrame, candidates: list) -> DataFrame:
    """From (lang, text): lang, phrase, words and exact count of every phrase in the bitmaps, one
    for each number of words from 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot, groups in lots(batches):
            base = np.int64(max(1, len(lot.words)))
            words = lot.hashes(language_salts(groups))
            hashes, flags = words, np.ones(len(words), bool)
            number = lot.group * base + lot.ids  # a number for each different phrase of k words, language included
            for n, bits in enumerate(candidates, 2):
                hashes = longer(hashes, words, n)
                flags = both_ends(flags) & lot.runs(n) & marked(bits.value, slots(hashes))
                every = np.nonzero(flags)[0]
                key, place = np.unique(number[every] * base + lot.ids[every + n - 1], return_inverse=True)
                number = np.zeros_like(number)
                number[every] = place
                own = place[lot.counted[every]]
                counts = np.bincount(own, minlength=len(key))
                first = np.zeros(len(key), np.int64)
                first[place] = every
                first, counts = first[counts > 0], counts[counts > 0]
                parts = [lot.words.take(pa.array(lot.ids[first + k])) for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([g[0] for g in groups], pa.string()).take(pa.array(lot.group[first])),
                        pc.binary_join_element_wise(*parts, b" ").cast(pa.string()),
                        pa.array(np.full(len(first), n, np.int32)), pa.array(counts.astype(np.int64)),
                    ],
                    ["lang", "phrase", "size", "c"],
                )

    found = rows.mapInArrow(run, "lang string, phrase string, size int, c bigint")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("c").alias("f"))


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of up to four words that occur ``support`` times, and
    (lang, n), the number of words of each language."""
    small_batches(docs.sparkSession)
    rows = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.pmod(F.xxhash64(text), F.lit(SHARDS)).cast("int").alias("shard"),
        F.col(text).alias("text"),
    )
    words = kept(shard_words(rows))
    shares = words.groupBy("lang", "shard").agg(F.sum("c").alias("own"))
    totals = shares.groupBy("lang").agg(F.sum("own").alias("n"))
    lowered = kept(shares.join(totals, "lang").select("lang", "shard", "n", F.expr(f"cast(ceil({support} * cast(own as decimal(20,0)) / n) as long)").alias("t")))
    in_shards = rows.join(lowered, ["lang", "shard"]).select("lang", "shard", "t", "text")
    shorter = bitmap(words.join(lowered, ["lang", "shard"]).where("c >= t").select("h"), SHARD_SLOT)
    candidates = []
    for n in range(2, LONGEST + 1):
        found = kept(mined(in_shards, n, shorter))
        shorter.destroy()
        shorter = bitmap(found, SHARD_SLOT)
        candidates.append(bitmap(found, SLOT))
        forget(found)
    shorter.destroy()
    phrases = kept(counted(rows.select("lang", "text"), candidates).where(F.col("f") >= support))
    for bits in candidates:
        bits.destroy()
    single = words.groupBy("lang", F.col("word").alias("phrase")).agg(F.sum("c").alias("f")).where(F.col("f") >= support)
    single = single.select("lang", "phrase", F.lit(1).alias("size"), "f")
    frequent = kept(phrases.unionByName(single))
    forget(words)
    forget(phrases)
    return frequent, lowered.select("lang", "n").distinct()


def scored(frequent: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r and score of every frequent phrase of two words or more, by the cut
    with the lowest score.  The parts of a frequent phrase are frequent, so none is missing."""
    words = F.split("phrase", " ")
    part = lambda start, size: F.concat_ws(" ", F.slice(words, start, size))
    cuts = frequent.where("size > 1").select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", F.col("f").alias("a"), "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right")
    )
    parts = frequent.where(F.col("size") < LONGEST)
    side = lambda name, value: parts.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    both = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    exact = "(2000000 * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    worst = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "a").agg(worst).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def uncovered(phrases: DataFrame, frequent: DataFrame, covered: int = COVERED) -> DataFrame:
    """Phrases (lang, phrase, a) that no longer phrase with ``covered`` percent of their count holds."""
    words = F.split("phrase", " ")
    inner = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    held = frequent.where("size > 2").withColumn("w", words).select("lang", F.explode(inner).alias("phrase"), "f")
    most = held.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    share = F.expr(f"100 * cast(most as decimal(20,0)) >= {covered} * cast(a as decimal(20,0))")
    return phrases.join(most, ["lang", "phrase"], "left").where(F.col("most").isNull() | ~share).drop("most")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    frequent, totals = frequent_phrases(docs, text, lang, support)
    left = uncovered(scored(frequent), frequent)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = f"""WITH p AS (SELECT lang, list_filter(string_split_regex(p, '[\\x20\\x09]'), lambda x: x <> '') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM p, (VALUES (1), (2), (3), (4)) s(k) WHERE len(w) >= k),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {SUPPORT}),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.lang, c.size, c.phrase, c.a, x.f AS l, y.f AS r, c.cut,
    (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score FROM c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
h AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most FROM (
    SELECT lang, a, w, m, unnest(range(1, size - m + 2)) AS i FROM (SELECT lang, a, w, size, unnest(range(2, size)) AS m FROM c WHERE cut = 1))
  GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN h USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < {COVERED}::HUGEINT * a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM r JOIN n USING (lang) WHERE rank <= {TOP}"""


@query("op13_collocations", SQL)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
