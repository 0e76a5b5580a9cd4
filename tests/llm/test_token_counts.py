"""Token counts beside the library that owns the vocabulary."""

import random

import pytest
import sentencepiece

from tallyspan.llm import token_counts as T
from tallyspan.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=T.vocabulary_path())


def counted(library, texts):
    return [len(ids) for ids in library.encode(texts, num_threads=1)]


def odd_texts(library, n):
    pick = random.Random(7)
    pieces = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    kinds = (
        lambda: pick.choice(pieces),
        lambda: pick.choice([" ", "  ", "\n", "\t", T.SPACE, "    " * pick.randint(1, 6)]),
        lambda: pick.choice("abcdethinrs0123456789.,<>/") * pick.randint(1, 5),
        lambda: chr(pick.choice([pick.randint(0x20, 0x7FF), pick.randint(0x800, 0xD7FF), pick.randint(0x10000, 0x10FFFF)])),
        lambda: pick.choice(["<s>", "</s>", "<unk>", "<0x0A>", "\x00", "é", "中文", "😀🦄"]),
    )
    return ["".join(pick.choice(kinds)() for _ in range(pick.randint(0, 30))) for _ in range(n)]


def test_odd_texts(library):
    texts = odd_texts(library, 5000)
    assert T.text_counts(T.vocabulary(T.vocabulary_path()), texts, {}) == counted(library, texts)


def test_long_runs(library, monkeypatch):
    pick = random.Random(3)
    texts = ["".join(pick.choice("abcdefgeeettt") for _ in range(pick.randint(50, 3000))) for _ in range(40)]
    texts += ["a" * 1001, " " * 777, "ab" * 500, "\n" * 50, "aaa" * 99 + " " + "    x" * 20, "e" * 20000, " x", "x ", " "]
    vocab = T.vocabulary(T.vocabulary_path())
    assert T.text_counts(vocab, texts, {}) == counted(library, texts)
    # parts, lots and a memory that is forgotten again and again
    monkeypatch.setattr(T, "LOT_CHARS", 40)
    monkeypatch.setattr(T, "ROUND_CHARS", 16)
    monkeypatch.setattr(T, "REMEMBERED", 20)
    texts = odd_texts(library, 300) + ["two words " * 30, "  a  b   c " * 20]
    assert T.text_counts(vocab, texts, {}) == counted(library, texts)


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    sizes = counted(library, [r.text or "" for r in docs])
    wanted = {r.doc_id: (len((r.text or "").encode()), n, n > 4096) for r, n in zip(docs, sizes)}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op11_token_counts"](spark, DATA).collect()}
    assert got == wanted


def test_awkward_tables(spark, library):
    long = "word and " * 200_000
    rows = [(1, None, 5), (1, "", 6), (2, "same", 7), (2, "same", 7), (None, long, None)]
    df = spark.createDataFrame(rows, "c0 int, text string, n long")
    got = sorted((r.c0 or 0, r.text or "", r.n_tokens) for r in T.token_counts(df).collect())
    n = counted(library, ["same", long])
    assert got == [(0, long, n[1]), (1, "", 0), (1, "", 0), (2, "same", n[0]), (2, "same", n[0])]
    assert T.token_counts(df).columns == ["c0", "text", "n", "n_tokens"]
    assert T.token_counts(df.limit(0)).count() == 0


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(Exception):
        T.Vocabulary(str(tmp_path / "none.model"))
