"""Phrase collocations beside a plain count of everything."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.llm import collocations as C
from tallyspan.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text):
    return [[w for w in re.split(r"[ \t]", p) if w] for p in re.split(r"[.,;:!?\n\x0b\f\r]", (text or "").translate(FOLD))]


def brute(rows, support, top):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in words_of(text):
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    f = {p: c for p, c in f.items() if c >= support}
    best = {}
    for (lang, p), a in f.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if len(p) < 2 or any(l == lang and len(q) > len(p) and 100 * c >= 80 * a and inside(q) for (l, q), c in f.items()):
            continue
        cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        best.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, rank, p.decode(), -a, l, r, n[lang], -s)
        for lang, found in best.items() for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    }


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def made_up(n, seed=5):
    pick = random.Random(seed)
    vocabulary = ["Ab", "cd", "É", "ÉÉ", "x.y", "zz", "\x1c", "ß", "a", "b"]
    mark = lambda: pick.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!\r", "; "])
    return [(pick.choice(["en", "en", "en", "de", None, "und", ""]), "".join(pick.choice(vocabulary) + mark() for _ in range(pick.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("support,top", [(30, 2000), (3, 40)])
def test_beside_brute_force(spark, support, top):
    rows = made_up(400) + [("en", "same old same old thing")] * 150 + [("en", None), ("fr", ""), (None, None)]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1))
    assert got(C.collocations(df, support=support, top=top)) == sorted(brute(rows, support, top))


def test_given_table(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert got(QUERIES["op13_collocations"](spark, DATA)) == sorted(brute(rows, 30, 2000))
    assert "op13_collocations" in ORACLE


def test_empty_tables(spark):
    df = spark.createDataFrame(made_up(3), "lang string, text string")
    assert C.collocations(df.limit(0)).count() == 0
    assert C.collocations(df).count() == 0


@pytest.mark.parametrize("limit", [1, 7, 40, 200])
def test_parts_of_long_texts_count_the_same(limit):
    text = "".join(t for _, t in made_up(12, seed=limit)) + "long " * 50 + "w" * 300 + " end"
    body = text.encode().translate(C.FOLD)

    def count(parts):
        lot = C.Lot([(0, part, last) for part, last in parts])
        out = Counter()
        words = lot.words.to_pylist()
        for n in range(1, 5):
            for i in np.nonzero(lot.runs(n) & lot.counted)[0]:
                out[tuple(words[lot.ids[k]] for k in range(i, i + n))] += 1
        return out

    assert count(C.chunks(body, limit)) == count([(body, 0)])


def test_bitmaps_hold_every_hash(spark):
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 4000, np.uint64) * np.uint64(2) + np.uint64(1)
    hashes = np.concatenate([hashes, np.array([0, (1 << 64) - 1, 7, 8, 15], np.uint64)])
    df = spark.createDataFrame([(h,) for h in hashes.view(np.int64).tolist()], "h bigint")
    for slot, place in ((C.SHARD_SLOT, C.shard_slots), (C.SLOT, C.slots)):
        bits = C.bitmap(df, slot)
        assert C.marked(bits.value, place(hashes)).all()
        assert np.unpackbits(bits.value).sum() == len(np.unique(place(hashes)))


def test_hashes_that_collide_only_make_candidates(spark, monkeypatch):
    """Bitmaps with every bit set prune nothing, and counts stay exact."""
    rows = made_up(200)
    full = spark.sparkContext.broadcast(np.full(1 << C.SLOT_BITS - 3, 255, np.uint8))
    monkeypatch.setattr(full, "destroy", lambda *a: None)
    monkeypatch.setattr(C, "bitmap", lambda found, slot: full)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert got(C.collocations(df, support=5)) == sorted(brute(rows, 5, 2000))
