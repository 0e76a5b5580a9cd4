"""Operator 11, token counts of a merge vocabulary with byte fallback.

A text becomes pre-tokens: each run of spaces with the word after it, since no piece of the
vocabulary holds a space behind another character.  Pre-tokens are cut again wherever no
piece holds the two neighbouring characters, because no merge can reach over such a place.

All sequences of a batch lie in one ragged array of symbols, with the rank of each symbol's
pair beside it.  In every round each sequence merges its lowest-rank pair, all sequences at
once: one segmented minimum, one look-up of the new pairs.  Within a sequence all places of
that pair are merged from left to right, up to the first where merging makes a pair of the
same or a lower rank, which then goes first; so the order is that of a queue by rank and
place.  A sequence without pairs left is done and leaves the array.  Symbols that survive
are counted, those outside the vocabulary as their UTF-8 bytes.

The counts of pre-tokens seen are remembered (``REMEMBERED`` at most, then forgotten), and
a batch counts only new ones.

Defined results: NULL text counts as empty; empty text has no tokens; strings of special
tokens are ordinary text; repeated rows each give their row; an empty table gives no rows;
other columns pass through, whatever their names.  A run of letters without any place to cut
takes as many rounds as different pairs are merged in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyspan.llm.common import query, small_batches, table

VOCABULARY = "piece_bpe_32k"
LIMIT = 4096
REMEMBERED = 1 << 19
# Code points merged in one ragged array, and of texts held as pre-tokens at once.
ROUND_CHARS = 1 << 18
LOT_CHARS = 1 << 21

# Fixed value: the character that stands for a space.
SPACE = "▁"
PRE_TOKEN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
LONE_SPACE = re.compile(f"(?<=[^ {SPACE}]) (?=[^ {SPACE}])")
NO_PAIR = np.int64(np.iinfo(np.int64).max)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.model")


class Vocabulary:
    """Symbols, their merges and ranks as arrays.

    Symbols are the pieces, then the single characters that only stand inside pieces.
    ``pairs`` holds (left symbol, right symbol) sorted, ``ranks`` and ``merged`` what each
    becomes; equal scores share a rank.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.check(path)
        size = model.get_piece_size()
        usable = [i for i in range(size) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in usable}
        order = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        symbols = [*pieces, *sorted({c for p in pieces for c in p} - pieces.keys())]
        place = {s: k for k, s in enumerate(symbols)}
        found = sorted(
            (place[p[:k]] * len(symbols) + place[p[k:]], order[score], place[p])
            for p, score in pieces.items() for k in range(1, len(p)) if p[:k] in place and p[k:] in place
        )
        self.size = len(symbols)
        self.pairs, self.ranks, self.merged = (np.array(c, np.int64) for c in zip(*found))
        self.of_char = np.full(0x110000, -1, np.int32)
        for s, k in place.items():
            if len(s) == 1:
                self.of_char[ord(s)] = k
        touching = {place[p[k]] * len(symbols) + place[p[k + 1]] for p in pieces for k in range(len(p) - 1)}
        self.touching = np.array(sorted(touching), np.int64)
        # tokens that a surviving symbol counts as
        self.weight = np.array([1 if s in pieces else len(s.encode()) for s in symbols], np.int64)
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("A piece holds a space behind another character.")

    @staticmethod
    def check(path: str) -> None:
        """The text must reach the merges unchanged but for a space in front."""
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        norm, trainer = spec.normalizer_spec, spec.trainer_spec
        plain = norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
        if not plain or trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError(f"{path} needs a normalizer, or is no merge vocabulary with byte fallback.")
        if any(p.type == p.USER_DEFINED for p in spec.pieces):
            raise ValueError(f"{path} has pieces that are never split.")

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; ``NO_PAIR`` where nothing is merged."""
        keys = left * self.size + right
        keys[(left < 0) | (right < 0)] = -1
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        hit = self.pairs[at] == keys
        return np.where(hit, self.ranks[at], NO_PAIR), np.where(hit, self.merged[at], -1)

    def touch(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.touching, keys), len(self.touching) - 1)
        return (self.touching[at] == keys) & (left >= 0) & (right >= 0)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def takes(at: np.ndarray) -> np.ndarray:
    """Which places are merged from left to right: where neighbouring places overlap, every other one."""
    fresh = np.diff(at, prepend=-9) != 1
    run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
    return (np.arange(len(at)) - run_start) % 2 == 0


def merge_counts(vocab: Vocabulary, words: list[str]) -> np.ndarray:
    """Tokens of each pre-token."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    symbol = vocab.of_char[codes].astype(np.int64)
    counts = np.zeros(len(words), np.int64)
    unknown = symbol < 0
    bytes_of = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    np.add.at(counts, word[unknown], bytes_of[unknown])
    # a sequence is what no cut divides
    first = np.ones(len(symbol), bool)
    first[1:] = (word[1:] != word[:-1]) | ~vocab.touch(symbol[:-1], symbol[1:])
    known = ~unknown
    sequence, symbol = np.cumsum(first)[known], symbol[known]
    word = word[known]

    def ranks_of(sequence: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, into = np.full(len(symbol), NO_PAIR), np.full(len(symbol), -1, np.int64)
        inside = np.nonzero(sequence[1:] == sequence[:-1])[0]
        rank[inside], into[inside] = vocab.look_up(symbol[inside], symbol[inside + 1])
        return rank, into

    rank, into = ranks_of(sequence, symbol)
    while len(symbol):
        starts = np.nonzero(np.diff(sequence, prepend=-1))[0]
        lowest = np.minimum.reduceat(rank, starts)
        lengths = np.diff(starts, append=len(symbol))
        over = np.repeat(lowest == NO_PAIR, lengths)
        if over.any():  # done: count and leave
            np.add.at(counts, word[over], vocab.weight[symbol[over]])
            on = ~over
            sequence, symbol, word, rank, into = (x[on] for x in (sequence, symbol, word, rank, into))
            lengths, lowest = lengths[lowest != NO_PAIR], lowest[lowest != NO_PAIR]
            if not len(symbol):
                break
        at = np.nonzero(rank == np.repeat(lowest, lengths))[0]
        at = at[takes(at)]
        at = at[in_order(vocab, sequence, symbol, rank, into, at)]
        symbol[at] = into[at]
        gone = np.zeros(len(symbol), bool)
        gone[at + 1] = True
        stale = np.zeros(len(symbol), bool)  # pairs that begin or end at a merged symbol
        stale[at] = True
        before = at - 1
        before = np.where((before >= 0) & gone[before], before - 1, before)
        stale[before[before >= 0]] = True
        on = ~gone
        sequence, symbol, word, rank, into, stale = (x[on] for x in (sequence, symbol, word, rank, into, stale))
        anew = np.nonzero(stale)[0]
        rank[anew], into[anew] = NO_PAIR, -1
        anew = anew[anew + 1 < len(symbol)]
        anew = anew[sequence[anew] == sequence[anew + 1]]
        rank[anew], into[anew] = vocab.look_up(symbol[anew], symbol[anew + 1])
    return counts


def in_order(vocab, sequence, symbol, rank, into, at) -> np.ndarray:
    """Of the places to merge, those up to the first in each sequence whose merge makes a pair
    of the same or a lower rank with a neighbour: on its left what is merged already,
    on its right what is not yet."""
    made = symbol.copy()
    made[at] = into[at]
    merged_away = np.zeros(len(symbol), bool)
    merged_away[at + 1] = True
    left = at - 1
    left = np.where((left >= 0) & merged_away[left], left - 1, left)
    right = at + 2
    bad = np.zeros(len(at), bool)
    for side, ok in ((left, left >= 0), (right, right < len(symbol))):
        some = np.nonzero(ok)[0]
        some = some[sequence[side[some]] == sequence[at[some]]]
        if side is left:
            new, _ = vocab.look_up(made[left[some]], into[at[some]])
        else:
            new, _ = vocab.look_up(into[at[some]], symbol[right[some]])
        bad[some] |= new <= rank[at[some]]
    if not bad.any():
        return np.ones(len(at), bool)
    # places behind the first bad one of their sequence wait
    own = sequence[at]
    fresh = np.diff(own, prepend=-1) != 0
    bad_before = np.cumsum(bad) - bad
    at_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
    return bad_before == bad_before[at_start]


def count_words(vocab: Vocabulary, words: list[str]) -> Iterator[tuple[str, int]]:
    """Tokens of different pre-tokens, in lots of bounded size."""
    lot, size = [], 0
    for k, w in enumerate(words):
        lot.append(w)
        size += len(w)
        if size >= ROUND_CHARS or k == len(words) - 1:
            yield from zip(lot, merge_counts(vocab, lot).tolist())
            lot, size = [], 0


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens, without the space in front where there is just one."""
    spaced = text.replace(" ", SPACE)
    if SPACE * 2 not in spaced and not spaced.startswith(SPACE) and not spaced.endswith(SPACE):
        return spaced.split(SPACE)
    return [w[1:] if w[:1] == SPACE and w[1:2] not in ("", SPACE) else w for w in PRE_TOKEN.findall(SPACE + spaced)]


def parts(text: str) -> Iterator[str]:
    """A long text cut at single spaces; each part begins, as the text does, behind a space."""
    at = 0
    while len(text) - at > LOT_CHARS and (cut := LONE_SPACE.search(text, at + LOT_CHARS // 2)):
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def text_counts(vocab: Vocabulary, texts: list, seen: dict) -> list[int]:
    """Tokens of each text; ``seen`` holds the counts of pre-tokens met before."""
    out, lot, size = [0] * len(texts), [], 0
    pieces = ((k, part) for k, t in enumerate(texts) if t for part in parts(t))
    for k, part in pieces:
        lot.append((k, part))
        size += len(part)
        if size >= LOT_CHARS:
            lot_counts(vocab, lot, seen, out)
            lot, size = [], 0
    lot_counts(vocab, lot, seen, out)
    return out


def lot_counts(vocab: Vocabulary, lot: list[tuple[int, str]], seen: dict, out: list[int]) -> None:
    words = [pre_tokens(part) for _, part in lot]
    new = set().union(*words).difference(seen)
    if len(seen) + len(new) > REMEMBERED:
        seen.clear()
        new = set().union(*words)
    new = list(new)
    spelt = [w if w[:1] == SPACE else SPACE + w for w in new]
    seen.update(zip(new, (n for _, n in count_words(vocab, spelt))))
    for (k, _), own in zip(lot, words):
        out[k] += sum(map(seen.__getitem__, own))


def token_counts(df: DataFrame, path: str | None = None, text: str = "text", tokens: str = "n_tokens") -> DataFrame:
    """Adds ``n_tokens``, the number of tokens of every whole text, without begin or end."""
    path = path or vocabulary_path()
    small_batches(df.sparkSession)
    fields = {f"c{i}": c for i, c in enumerate(df.columns)}
    body = next(k for k, c in fields.items() if c == text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, seen = vocabulary(path), {}
        for batch in batches:
            counts = text_counts(vocab, batch.column(body).to_pylist(), seen)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], [*fields, "n"])

    plain = df.toDF(*fields)
    return plain.mapInArrow(run, StructType([*plain.schema.fields, StructField("n", LongType())])).toDF(*df.columns, tokens)


@query("op11_token_counts")
def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    counted = token_counts(docs)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
