"""Fences of the quality rules: exact rows beside SQL, weights of small groups, groups that are all alike."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from tallyspan.llm import quality_rules  # noqa: E402

SCHEMA = "doc_id bigint, lang string, source string, text string, n_words int, kept string, total int"


def prose(k, n=80):
    return " ".join(f"w{(k * 7919 + i * 31) % 9973}" for i in range(n))


def rows():
    texts = [prose(k, 60 + k % 50) for k in range(400)]
    texts += [prose(k) + " $ % & # * <" * 40 for k in range(6)] + [prose(k) + "\nsame line here\nsame line here" for k in range(6)]
    texts += [None, "", " \n\t ", "x" * 50_000, "one two three " * 40, prose(1, 30_000), prose(2), prose(2), "Ünïcode ☃ " * 30]
    texts += [" ".join("z" * 40 + str(i) for i in range(70)), " ".join("abcdefgh"[i % 8] + "ijklmnop"[i // 8 % 8] for i in range(64))]
    langs, sources = ["en", "en", "en", "de", None], ["a", "b", None]
    return [(k, langs[k % 5], sources[k % 3] if k % 50 else "rare", t, 1, "clash", 2) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def test_filter_equals_sql(docs):
    base = duckdb.connect()
    base.execute("CREATE TABLE documents (doc_id BIGINT, lang VARCHAR, source VARCHAR, text VARCHAR)")
    base.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [r[:4] for r in rows()])
    wanted = {r[0] for r in base.execute(f"SELECT doc_id FROM ({quality_rules.SQL_KEPT}) WHERE kept").fetchall()}
    got = quality_rules.quality_filter(docs)
    assert got.columns == docs.columns
    found = sorted(tuple(r) for r in got.collect())
    assert found == sorted(r for r in rows() if r[0] in wanted)
    assert {*range(406, 412)} <= wanted and wanted.isdisjoint({*range(400, 406), *range(412, 417)})


def test_repeated_rows_are_judged_alike(docs):
    twice = quality_rules.quality_filter(docs.union(docs))
    assert all(r["count"] % 2 == 0 for r in twice.groupBy("doc_id").count().collect())


def test_small_groups_lean_on_their_language(docs):
    measured = quality_rules.kept(quality_rules.text_features(docs.select("lang", "source", "text")).drop("text"))
    fences = {(r.lang, r.source): r for r in quality_rules.fences(measured).collect()}
    assert len({r.word_length_hi for r in fences.values()}) > 3
    own = [r for key, r in fences.items() if key[1] == "rare"]
    rest = [r for key, r in fences.items() if key[1] != "rare"]
    spread = lambda some: max(r.word_length_hi for r in some) - min(r.word_length_hi for r in some)
    assert spread(own + rest) < 60  # five documents alone would not agree so closely


def test_documents_all_alike_leave_room(spark):
    alike = [(k, "en", "a", prose(3), 1, "c", 2) for k in range(300)] + [(900, "en", "a", prose(4, 90) + " $ $", 1, "c", 2)]
    assert quality_rules.quality_filter(spark.createDataFrame(alike, SCHEMA)).count() == 301
