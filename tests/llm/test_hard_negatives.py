"""Hard negatives beside a plain comparison of everything."""

import math
import random

import numpy as np
import pytest

from tallyspan.llm import hard_negatives as H
from tallyspan.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


def brute(rows):
    parts = []
    for vec_id, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        c = [math.floor(v * 256) if abs(v) < 1e300 else int(v) * 256 for v in map(float, x)]
        parts.append((vec_id, c, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label))
    low = lambda i: math.inf if i is None else i
    out = []
    for n, (a, q, own) in enumerate(parts):
        if a is None or a % 100:
            continue
        clip = lambda s: min(max(s, H.LEAST), H.MOST)
        scored = [(-clip(sum(x * y for x, y in zip(q, c))), low(i), i, l) for m, (i, c, l) in enumerate(parts) if m != n]
        for s, _, p, _ in sorted((r for r in scored if r[3] == own), key=lambda r: r[:2])[:5]:
            fits = [r for r in scored if r[3] != own and -30 * s <= -100 * r[0] <= -90 * s]
            out += [(a, p, k, r[2], -s, -r[0]) for k, r in enumerate(sorted(fits, key=lambda r: r[:2])[:10], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")


def vectors(n, width=6, seed=2):
    pick = random.Random(seed)
    centers = [[pick.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    return [(i, [c + pick.gauss(0, 0.4) for c in pick.choice(centers)], pick.choice([0, 0, 0, 1, 2, 9])) for i in range(n)]


@pytest.mark.parametrize("bucket,block", [(16384, 8192), (40, 3), (7, 1)])
def test_beside_brute_force(spark, bucket, block):
    rows = vectors(700)
    rows += [(100, rows[5][1], 0), (100, rows[5][1], 0), (None, rows[5][1], 1), (None, rows[5][1], 0), (-200, rows[9][1], -3)]
    rows += [(900 + i, rows[3][1], 2) for i in range(60)] + [(1000, [0.0] * 6, 0), (1001, [], 0), (1100, [], 1), (1002, [1.0], 2), (1200, [0.5] * 9, 2)]
    rows += [(1300, None, 1), (1301, [None] * 6, 1), (1302, [math.nan] * 6, 1), (1303, [math.inf] + [0.0] * 5, 1), (1400, rows[0][1], None)]
    assert got(H.hard_negatives(frame(spark, rows), bucket=bucket, block=block)) == brute(rows)


def test_large_components(spark):
    rows = vectors(300) + [(2000, [1e30, 1.0], 0), (2001, [1e30, 2.0], 0), (2002, [6e29, 0.0], 1), (2100, [1e308] * 3, 1), (2101, [200.5, -3.0], 1), (2103, [4e6, 4e6], 2)]
    assert got(H.hard_negatives(frame(spark, rows), bucket=50)) == brute(rows)


def test_given_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert got(QUERIES["op12_hard_negatives"](spark, DATA)) == brute(rows)
    assert "op12_hard_negatives" in ORACLE


def test_empty_tables_and_one_label(spark):
    rows = vectors(120)
    assert H.hard_negatives(frame(spark, rows).limit(0)).count() == 0
    assert H.hard_negatives(frame(spark, [(i, x, 3) for i, x, _ in rows if i % 7])).count() == 0
    assert H.hard_negatives(frame(spark, [r for r in rows if r[0] % 100])).count() == 0


def test_ranges_keep_every_row_that_reaches_the_score():
    random_rows = np.random.default_rng(0)
    rows = np.floor(256 * random_rows.normal(size=(3000, 8)) * random_rows.gamma(2, 1, (3000, 1)))
    norms = np.sqrt((rows**2).sum(axis=1))
    order = np.argsort(-norms)
    pruned = 0
    for at in np.array_split(order, 12):
        bucket = H.LengthBucket(rows[at], norms[at], at)
        for q in rows[:40]:
            norm = math.sqrt(q @ q)
            scores = rows[at] @ q
            for wanted in (-50000, 0, 1, int(np.quantile(scores, 0.9)), int(scores.max()), int(scores.max()) + 1):
                some = bucket.candidates(q / norm, norm, wanted)
                if some is not None:
                    assert set(np.nonzero(scores >= wanted)[0]) <= set(some.tolist())
                    pruned += len(at) - len(some)
    assert pruned > 100_000
