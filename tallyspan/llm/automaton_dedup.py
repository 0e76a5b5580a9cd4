"""Operator 4, substring dedup: words in a run of 35 that stands anywhere else go.

``repeats`` narrows the corpus to pieces of segments that share a core without being equal; these
make up the reference shards.  Each shard is indexed by a suffix automaton over its words,
and the pieces are streamed through it for matching statistics: the longest match that
ends at each word, and how often that match's last 35 words occur in the shard.

A shard goes to one task instead of all, as the shards together grow with the corpus: what
may match lies in one shard by construction, so no other has to be asked.

Defined results: NULL, empty and short texts keep all their words; every row counts as a
place, so of repeated rows none keeps its repeated windows; an empty table gives no rows;
other columns pass through ``dedup``, whatever their names.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tallyspan.llm.common import query, table
from tallyspan.llm.repeats import Unit, covered, keyed, repeated_spans, runs_of, with_spans

WORDS = Unit(words=True, width=35, gram=6)


class SuffixAutomaton:
    """All substrings of several sequences, with how often each occurs."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def add(self, sequence: list) -> None:
        last = 0
        for unit in sequence:
            last = self._extend(last, unit)
            self.count[last] += 1

    def _extend(self, last: int, unit) -> int:
        after, link, length = self.next, self.link, self.length
        known = after[last].get(unit)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._split(last, unit, known)
        new = len(length)
        after.append({})
        link.append(0)
        length.append(length[last] + 1)
        self.count.append(0)
        p = last
        while p >= 0 and unit not in after[p]:
            after[p][unit] = new
            p = link[p]
        if p >= 0:
            q = after[p][unit]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, unit, q)
        return new

    def _split(self, p: int, unit, q: int) -> int:
        after, link = self.next, self.link
        twin = len(link)
        after.append(after[q].copy())
        link.append(link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        link[q] = twin
        while p >= 0 and after[p].get(unit) == q:
            after[p][unit] = twin
            p = link[p]
        return twin

    def finish(self) -> None:
        """Counts of longer matches go to the shorter ones that end them."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def repeated_ends(self, sequence: list, width: int) -> list[int]:
        """Where runs of ``width`` units end that occur more than once."""
        after, link, length, count = self.next, self.link, self.length, self.count
        state, matched, out = 0, 0, []
        for i, unit in enumerate(sequence):
            while state and unit not in after[state]:
                state = link[state]
                matched = length[state]
            state = after[state].get(unit, 0)
            matched = matched + 1 if state else 0
            while length[link[state]] >= width:
                state = link[state]
                matched = length[state]
            if matched >= width and count[state] > 1:
                out.append(i)
        return out


def repeated_windows(group: pa.Table, unit: Unit) -> pa.Table:
    """Of the pieces of one shard, the windows that occur more than once."""
    numbers: dict[bytes, int] = {}
    sequences = [[numbers.setdefault(w, len(numbers)) for w in body.split()] for body in group["body"].to_pylist()]
    automaton = SuffixAutomaton()
    for sequence in sequences:
        automaton.add(sequence)
    automaton.finish()
    out: list[tuple[int, int, int]] = []
    for key, first, sequence in zip(group["key"].to_pylist(), group["first"].to_pylist(), sequences):
        ends = automaton.repeated_ends(sequence, unit.width)
        if ends:
            at, n = runs_of(np.array(ends) - unit.width + 1)
            out += [(key, first + a, b) for a, b in zip(at.tolist(), n.tolist())]
    columns = zip(*out) if out else [[]] * 3
    return pa.table({k: pa.array(c, pa.int64()) for k, c in zip(("key", "first", "n"), columns)})


def removed_words(docs: DataFrame, outputs: list[StructField], apply) -> DataFrame:
    """``docs`` (with _key and text) beside what ``apply(words, removed mask)`` makes of each text."""
    spans = repeated_spans(docs.select(F.col("_key").alias("key"), "text"), WORDS, False, repeated_windows)

    def on_text(body: bytes, found):
        words = body.split()
        return apply(words, covered(found, len(words), WORDS))

    return with_spans(docs, spans, "text", "_key", on_text, outputs)


def dedup(docs: DataFrame) -> DataFrame:
    """Documents without repeated runs, in the columns they came with; the words that stay
    are joined by one space."""
    kept_text = lambda words, gone: (b" ".join(compress(words, ~gone)).decode(),)
    names = {c: f"_in_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    out = removed_words(keyed(docs.withColumnsRenamed(names)), [StructField("text", StringType())], kept_text)
    return out.withColumnsRenamed({new: old for old, new in names.items()}).select(*docs.columns)


def summary(words: list[bytes], gone: np.ndarray) -> tuple[int, int, str]:
    return len(words), int(gone.sum()), hashlib.sha256(b" ".join(compress(words, ~gone))).hexdigest()


@query("op4_automaton_dedup")
def automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    outputs = [StructField(n, LongType()) for n in ("n_words", "n_removed")]
    return removed_words(docs, [*outputs, StructField("kept_sha256", StringType())], summary)
