"""The pipeline's near-duplicate stage beside brute-force Jaccard similarity."""

import random
import sys
from itertools import combinations
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from tallyspan.llm import near_copies  # noqa: E402


def five(text):
    words = (text or "").lower().encode().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def kept_rows(rows):
    """Rows (doc_id, text) in order of (doc_id, text), ids missing last; those that stay."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    sets, root = [five(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a == b or 5 * len(a & b) >= 4 * len(a | b):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return [r for i, r in enumerate(rows) if find(i) == i]


def edited(pick, words, n):
    words = list(words)
    for at in pick.sample(range(len(words)), n):
        words[at] = f"new{pick.randrange(10**6)}"
    return " ".join(words)


def corpus():
    """Texts, copies with 0 to 8 words changed (most similarities lie near 0.8), and rows that are none."""
    pick, rows = random.Random(3), [(0, None), (1, ""), (2, "two words"), (3, "Two  Words"), (4, " \n")]
    for _ in range(40):
        words = [f"w{pick.randrange(5000)}" for _ in range(pick.randrange(60, 300))]
        rows += [(len(rows) + k, edited(pick, words, n)) for k, n in enumerate([0, *(pick.randrange(9) for _ in range(6))])]
    return rows


def key_of(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize(("crowded", "centers"), [(64, 64), (2, 1 << 20)])
def test_finds_what_brute_force_finds(spark, crowded, centers):
    rows = corpus()
    got = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string"), crowded, centers)
    assert key_of(map(tuple, got.collect())) == key_of(kept_rows(rows))


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = near_copies.drop_near_copies(docs)
    assert key_of(map(tuple, got.collect())) == key_of(kept_rows(map(tuple, docs.collect())))


def template_corpus(pairs):
    """Texts of one template, in pairs: partners have similarity above 0.8, all others below."""
    pick = random.Random(8)
    template, rows = [f"t{k}" for k in range(440)], []
    for k in range(pairs):
        shared = [f"p{k}w{i}" for i in range(25)]
        for side in range(2):
            own = [f"o{k}s{side}w{i}" for i in range(35)]
            rows.append((len(rows), " ".join([*own, *shared, *template])))
    pick.shuffle(rows)
    return rows


def test_crowded_bands_lose_nothing(spark):
    """Every text shares nearly all bands with every other, and is similar to one."""
    rows = template_corpus(400)
    a, b, c = (five(t) for t in (dict(rows)[0], dict(rows)[1], dict(rows)[2]))
    assert len(a & b) / len(a | b) > 0.8 > len(a & c) / len(a | c) > 0.75
    got = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in got.collect()) == list(range(0, 800, 2))


def test_rare_shingles_that_very_many_share(spark):
    """Texts alike in all but few words, in chains: some meet only as later centers."""
    pick, rows = random.Random(9), []
    base = [f"b{k}" for k in range(60)]
    for k in range(150):
        words = list(base)
        for at in pick.sample(range(60), pick.randrange(1, 4)):
            words[at] = f"n{pick.randrange(40)}"
        rows.append((k, " ".join(words)))
    got = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string"), 30, 60)
    assert key_of(map(tuple, got.collect())) == key_of(kept_rows(rows))


def test_very_long_texts(spark):
    words = [f"w{k % 997} {k}" for k in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:55_000])), (3, " ".join(words[:40_000])), (4, " ".join(reversed(words)))]
    got = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 4]
