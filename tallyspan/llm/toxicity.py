"""Operator 2, toxicity: a linear classifier that should not care which group is named.

Training adds to the logistic loss, for each labelled text that names an identity term, the
squared change of its score when the term is swapped for each other of its set.  A term
that merely keeps company with toxic texts so gets the weight of its whole set, which
neutral texts share, while insulting words keep theirs.

Features are hashed: the lower-case words of a text, and the first letters of longer words
(inflected forms share them), each present or not.  Only texts of labelled rows that are not
held out are learnt from, at most about ``MAX_TRAIN`` of them, picked by a hash of their
doc_id; that bounds what the driver trains on.  Everything is scored, whole.

Defined results: NULL and empty texts score the base rate; labels that are NULL, or that
contradict each other for one doc_id, are not learnt from; without any label of one class
every score is 0; repeated rows score alike; of texts that share a doc_id the smallest is
learnt from, so that repeated rows cannot raise the bound; a NULL doc_id is not held out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm.common import query, small_batches, table

MAX_TRAIN = 20_000
SPACE_BITS = 22
STEM = 5
MIN_TEXTS = 4
# Features whose share of toxic texts is no more standard errors than this from the overall
# share are left out: most words are rare, and would be learnt by heart.
EVIDENCE = 4.0
RIDGE = 1e-4
SWAP_PENALTY = 5.0
STEPS = 300
HELD_OUT = 5

# Sets of identity terms that stand for each other in counterfactual texts.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives", "locals"),
    ("old", "young", "elderly", "disabled", "blind", "deaf"),
)
SWAPS = {t: [o for o in terms if o != t] for terms in IDENTITY_TERMS for t in terms}
EDGES = ".,;:!?\"'()[]{}<>|*%&$#-_"


def word_set(text: str) -> set[str]:
    words = {w.strip(EDGES) for w in set(text.lower().split())}
    words.discard("")
    return words


def feature_ids(words: set[str]) -> list[int]:
    """Hashed words and word beginnings, each once, in order."""
    mask = (1 << SPACE_BITS) - 1
    stems = {w[:STEM] for w in words if len(w) > STEM}
    crc = zlib.crc32
    return sorted({crc(w.encode()) & mask for w in words} | {crc(b"^" + s.encode()) & mask for s in stems})


def swapped(words: set[str]) -> list[set[str]]:
    """The words of a text with one identity term replaced, for every term and replacement."""
    return [(words - {t}) | {o} for t in words if t in SWAPS for o in SWAPS[t]]


def swap_changes(words: set[str]) -> list[list[list[int]]]:
    """What each swap takes from the features of a text, and what it brings: all else cancels."""
    if not any(t in words for t in SWAPS):
        return []
    before = set(feature_ids(words))
    after = [set(feature_ids(s)) for s in swapped(words)]
    return [[sorted(before - a), sorted(a - before)] for a in after]


def train(texts: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Weights and intercept.  ``pairs``: features that a swapped term takes away, and brings."""
    size = 1 << SPACE_BITS
    weights = np.zeros(size, np.float32)
    positive = int(labels.sum()) if len(labels) else 0
    if positive == 0 or positive == len(labels):
        return weights, -np.inf if positive == 0 else np.inf
    share = positive / len(labels)
    holders = np.bincount(np.concatenate(texts), minlength=size)
    toxic = np.bincount(np.concatenate([t for t, y in zip(texts, labels) if y] or [texts[0][:0]]), minlength=size)
    error = np.sqrt(np.maximum(holders * share * (1 - share), 1e-9))
    told = (holders >= MIN_TEXTS) & (np.abs(toxic - holders * share) >= EVIDENCE * error)
    for a, b in pairs:  # what a swap puts in may carry weight as well
        told[a] = told[b] = True
    names = np.nonzero(told)[0]
    slot = np.full(size, -1, np.int64)
    slot[names] = np.arange(len(names))

    def matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        column = slot[np.concatenate(rows)] if rows else np.zeros(0, np.int64)
        return at[column >= 0], column[column >= 0]

    row, column = matrix(texts)
    left = matrix([a for a, _ in pairs])
    right = matrix([b for _, b in pairs])
    n, m = len(texts), len(names)
    y = labels.astype(np.float64)
    w, b = np.zeros(m), float(np.log(positive / (n - positive)))
    first, second, step = np.zeros(m), np.zeros(m), 0.1
    first_b = second_b = 0.0
    for t in range(1, STEPS + 1):
        z = np.bincount(row, w[column], n) + b
        error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / n
        grad = np.bincount(column, error[row], m) + RIDGE * w
        if pairs:
            change = np.bincount(left[0], w[left[1]], len(pairs)) - np.bincount(right[0], w[right[1]], len(pairs))
            pull = 2 * SWAP_PENALTY * change / len(pairs)
            grad += np.bincount(left[1], pull[left[0]], m) - np.bincount(right[1], pull[right[0]], m)
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        w -= step * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-6)
        grad_b = float(error.sum())
        first_b, second_b = 0.9 * first_b + 0.1 * grad_b, 0.99 * second_b + 0.01 * grad_b**2
        b -= step * (first_b / (1 - 0.9**t)) / (second_b / (1 - 0.99**t) + 1e-12) ** 0.5
    weights[names] = w
    return weights, b


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Texts and labels to learn from.  The picked ids number at most about ``max_train``,
    whatever the input, so they can be broadcast and the texts need not be shuffled."""
    usable = labels.where(
        (F.crc32(F.col("doc_id").cast("string")) % HELD_OUT != 0) & F.col("toxic").isNotNull()
    ).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_high")).where("toxic = _high")
    share = min(1.0, max_train / max(1, usable.count()))
    picked = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("doc_id", "toxic")
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = pa.list_(pa.int32())
        for batch in batches:
            words = [word_set(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([feature_ids(w) for w in words], ids),
                    pa.array([swap_changes(w) for w in words], pa.list_(pa.list_(ids))),
                    batch.column("toxic").cast(pa.int32()),
                ],
                ["ids", "swaps", "toxic"],
            )

    small_batches(docs.sparkSession)
    rows = training_rows(docs, labels, max_train).mapInArrow(featurize, "ids array<int>, swaps array<array<array<int>>>, toxic int").toArrow()
    if not rows.num_rows:
        return np.zeros(1 << SPACE_BITS, np.float32), -np.inf
    ids = rows["ids"].combine_chunks()
    texts = np.split(ids.flatten().to_numpy(), ids.offsets.to_numpy()[1:-1] - ids.offsets.to_numpy()[0])
    pairs = [
        (np.array(gone, np.int64), np.array(come, np.int64)) for swaps in rows["swaps"].to_pylist() for gone, come in swaps
    ]
    return train(texts, rows["toxic"].to_numpy(), pairs)


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id, score (0 to 1) and predicted of every whole text."""
    spark = docs.sparkSession
    small_batches(spark)
    weights, intercept = model
    used = np.nonzero(weights)[0]
    shared = spark.sparkContext.broadcast((dict(zip(used.tolist(), weights[used].astype(float).tolist())), float(intercept)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base = shared.value
        for batch in batches:
            z = np.array([
                base + sum(known.get(i, 0.0) for i in feature_ids(word_set(t or ""))) for t in batch.column("text").to_pylist()
            ], np.float64)
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            p[np.isneginf(z)] = 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


@query("op2_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % HELD_OUT == 0, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", "predicted")
