"""Operator 3, suffix-array dedup: bytes that lie in a string of 100 bytes seen earlier go.

``repeats`` narrows the corpus to pieces of segments that share a core without being equal; shards
of these are ordered by induced sorting (``suffix_array``), and permuted common prefixes of
at least the window's width mark windows that repeat.  Of equal windows all but the
earliest are marked; earliest is the smaller doc_id, then the earlier start.

Defined results: NULL and empty texts have no bytes; a document shorter than the window
keeps all; ties of doc_id count in the order of text, missing doc_ids come last; an empty
table gives no rows; other columns pass through ``dedup``, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tallyspan.llm.common import query, table
from tallyspan.llm.repeats import Unit, covered, keyed, repeated_spans, runs_of, with_spans
from tallyspan.llm.suffix_array import common_prefixes, suffix_array

BYTES = Unit(words=False, width=100, gram=24)


def later_windows(group: pa.Table, unit: Unit) -> pa.Table:
    """Of the pieces of one shard, the windows that equal an earlier one."""
    empty = pa.table({k: pa.array([], pa.int64()) for k in ("key", "first", "n")})
    group = group.sort_by([("key", "ascending"), ("first", "ascending")])
    bodies = group["body"].to_pylist()
    size = np.array([len(b) for b in bodies])
    # 0 ends every piece; bytes are one higher
    text = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8).astype(np.int64) + 1
    first = np.cumsum(size + 1) - size - 1
    text[first + size] = 0
    order = suffix_array(text, 257)
    shared = common_prefixes(text, order, first, size - unit.width + 1, unit.width)
    piece_of = np.repeat(np.arange(len(size)), size + 1)
    is_window = np.arange(len(text)) - first[piece_of] <= size[piece_of] - unit.width
    # what lies between equal windows in suffix order begins like them, so it is an equal
    # window as well: a class begins where a window shares less with what stands before it
    ranks = np.nonzero(is_window[order])[0]
    windows = order[ranks]
    new = shared[windows] < unit.width
    new[0] = True
    # pieces stand in document order, so the smallest place of a class is the earliest
    starts = np.nonzero(new)[0]
    earliest = np.repeat(np.minimum.reduceat(windows, starts), np.diff(starts, append=len(windows)))
    later = np.sort(windows[windows != earliest])
    if not len(later):
        return empty
    at, n = runs_of(later)
    piece = piece_of[at]
    return pa.table({
        "key": pa.array(group["key"].to_numpy()[piece]),
        "first": pa.array(group["first"].to_numpy()[piece] + at - first[piece]),
        "n": pa.array(n.astype(np.int64)),
    })


def removed_bytes(docs: DataFrame, outputs: list[StructField], apply) -> DataFrame:
    """``docs`` (with _key and text) beside what ``apply(bytes, removed mask)`` makes of each text."""
    spans = repeated_spans(docs.select(F.col("_key").alias("key"), "text"), BYTES, True, later_windows)
    on_text = lambda body, found: apply(body, covered(found, len(body), BYTES))
    return with_spans(docs, spans, "text", "_key", on_text, outputs)


def dedup(docs: DataFrame) -> DataFrame:
    """Documents without repeated strings, in the columns they came with.  Where a cut falls
    inside a character, its remaining bytes go too, as they are no text."""
    kept_text = lambda body, gone: (
        np.frombuffer(body, np.uint8)[~gone].tobytes().decode("utf-8", "ignore") if gone.any() else body.decode(),
    )
    names = {c: f"_in_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    out = removed_bytes(keyed(docs.withColumnsRenamed(names)), [StructField("text", StringType())], kept_text)
    return out.withColumnsRenamed({new: old for old, new in names.items()}).select(*docs.columns)


def summary(body: bytes, gone: np.ndarray) -> tuple[int, int, int, str]:
    left = np.frombuffer(body, np.uint8)[~gone].tobytes()
    spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
    return len(body), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()


@query("op3_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    outputs = [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    return removed_bytes(docs, [*outputs, StructField("kept_sha256", StringType())], summary)
