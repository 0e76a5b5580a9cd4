"""Every text operator beside brute force, and on awkward tables."""

import itertools
import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402
from conftest import plan_of  # noqa: E402

from tallyspan.llm import automaton_dedup, bpe, chat_format, decontaminate, html_text, quality_rules  # noqa: E402
from tallyspan.llm import simhash, suffix_dedup, toxicity, warc  # noqa: E402
from tallyspan.llm.queries import QUERIES  # noqa: E402

DATA = "/root/testdata/sf0.001"
FIELDS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, key string, n int, ids string, "
    "fp bigint, first bigint, kept boolean, n_words bigint, shape int, _key bigint"
)


def rows_of(*texts):
    """Documents with clashing extra columns."""
    return [(i, t, "en", "s", 0, 1, "k", 2, "x", 3, 4, True, 5, 6, 7) for i, t in texts]


LONG = " ".join(f"word{k % 977} and {k}" for k in range(30_000))
AWKWARD = rows_of(
    (1, "one two three " * 40), (2, None), (3, ""), (None, "one two three " * 40), (1, "one two three " * 40),
    (4, LONG), (5, LONG), (6, " \n\t "), (7, "x" * 50_000), (None, None), (8, "Ünïcode ☃ " * 30),
)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.orderBy("doc_id").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, FIELDS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], FIELDS)


def test_quality_filter(awkward, empty):
    kept = quality_rules.quality_filter(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} <= {4, 5, 8, 1, None}
    assert quality_rules.quality_filter(empty).count() == 0


def test_quality_features(spark):
    text = "a b c a b c\na b c a b c\n\n* $ end"
    row = quality_rules.text_features(spark.createDataFrame([(1, text, "en", "s")], "doc_id int, text string, lang string, source string")).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (15, 17, 2, 1, 12)


def test_buckets_are_ordered(spark):
    df = spark.range(5000).select("id", quality_rules.bucket_of(quality_rules.F.col("id")).alias("b"))
    rows = df.select("id", "b", quality_rules.bucket_top(quality_rules.F.col("b")).alias("top")).orderBy("id").collect()
    assert all(a.b <= b.b <= a.b + 1 for a, b in zip(rows, rows[1:]))
    assert all(r.id <= r.top <= r.id * 17 / 16 + 1 for r in rows)


def test_suffix_dedup(spark, texts):
    wanted = brute.removed_bytes(texts)
    got = {r.doc_id: r for r in QUERIES["op3_suffix_dedup"](spark, DATA).collect()}
    assert len(got) == len(wanted)
    for doc, (body, gone) in wanted.items():
        left = np.frombuffer(body, np.uint8)[~gone].tobytes()
        assert (got[doc].n_bytes, got[doc].n_removed, got[doc].kept_sha256) == (len(body), gone.sum(), brute.sha(left))
        assert got[doc].n_spans == (np.diff(gone.astype(int), prepend=0) == 1).sum()


def test_automaton_dedup(spark, texts):
    wanted = brute.removed_words([t for _, t in texts])
    got = {r.doc_id: r for r in QUERIES["op4_automaton_dedup"](spark, DATA).collect()}
    for (doc, _), (words, gone) in zip(texts, wanted):
        left = b" ".join(w for w, g in zip(words, gone) if not g)
        assert (got[doc].n_words, got[doc].n_removed, got[doc].kept_sha256) == (len(words), gone.sum(), brute.sha(left))


@pytest.mark.parametrize("crowded", [1, 4, 8192])
@pytest.mark.parametrize("operator", [suffix_dedup, automaton_dedup])
def test_crowded_cores_are_cut_again(spark, operator, crowded, monkeypatch):
    """Forces the path for cores that very many different pieces share."""
    from tallyspan.llm import repeats

    monkeypatch.setattr(repeats, "CORE_PIECES", crowded)
    monkeypatch.setattr(repeats, "SHARD_PIECES", 2)
    pick = random.Random(3)
    passage = " ".join(f"common{k}" for k in range(60))
    tails = [" ".join(pick.choice("abcde") for _ in range(8)) for _ in range(12)]
    texts = [(k, f"{pick.random()} start {passage} {pick.choice(tails)} {pick.choice(tails)} end {pick.random()}") for k in range(80)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r.text for r in operator.dedup(docs).collect()}
    if operator is suffix_dedup:
        wanted = {i: np.frombuffer(b, np.uint8)[~g].tobytes().decode("utf-8", "ignore") for i, (b, g) in brute.removed_bytes(texts).items()}
    else:
        found = brute.removed_words([t for _, t in texts])
        wanted = {i: b" ".join(w for w, g in zip(ws, gone) if not g).decode() for (i, _), (ws, gone) in zip(texts, found)}
    assert got == wanted


@pytest.mark.parametrize("operator", [suffix_dedup, automaton_dedup])
def test_dedup_awkward(awkward, empty, operator):
    out = operator.dedup(awkward)
    assert out.columns == awkward.columns
    at, text = awkward.columns.index("doc_id"), awkward.columns.index("text")
    order = sorted(AWKWARD, key=lambda r: (r[at] is None, r[at] or 0, r[text] is not None, (r[text] or "").encode()))
    if operator is suffix_dedup:
        found = brute.removed_bytes([(k, r[text]) for k, r in enumerate(order)])
        left = [np.frombuffer(b, np.uint8)[~g].tobytes().decode("utf-8", "ignore") for b, g in found.values()]
    else:
        left = []
        for r, (words, gone) in zip(order, brute.removed_words([r[text] for r in order])):
            left.append(b" ".join(w for w, g in zip(words, gone) if not g).decode())
    wanted = sorted((str(r[at]), t) for r, t in zip(order, left))
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == wanted
    assert operator.dedup(empty).count() == 0


@pytest.mark.parametrize("operator", [suffix_dedup, automaton_dedup])
def test_cut_again_on_periodic_texts(spark, operator, monkeypatch):
    """Texts that overlap themselves, with every shared core cut down to single windows."""
    from tallyspan.llm import repeats

    monkeypatch.setattr(repeats, "CORE_PIECES", 1)
    texts = [(1, "é ab " * 120), (2, "x" * 300 + " é ab" * 60), (3, None), (4, "x y " * 50 + "z " + "x y " * 70), (5, "x" * 99), (6, "x" * 100)]
    got = {r.doc_id: r.text for r in operator.dedup(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    if operator is suffix_dedup:
        wanted = {i: np.frombuffer(b, np.uint8)[~g].tobytes().decode("utf-8", "ignore") for i, (b, g) in brute.removed_bytes(texts).items()}
    else:
        found = brute.removed_words([t for _, t in texts])
        wanted = {}
        for (i, _), (words, gone) in zip(texts, found):
            wanted[i] = b" ".join(w for w, g in zip(words, gone) if not g).decode()
    assert got == wanted


def test_tree_concatenation():
    coder, lengths = bpe.encoding(bpe.vocabulary_path())
    pick = random.Random(5)
    for _ in range(800):
        letters = pick.choice(["ab", "abc '", "a1!", "  \n\tx", "'restv ll", "<|endoftext|>ab", "éèaß漢字", "abcdefghij", "012", "!?.", " \n"])
        text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 300)))
        parts = [(p, bpe.encode_piece(coder, p)) for p in bpe.leaves(text, pick.choice([5, 20, 90]))]
        assert bpe.join_all(coder, lengths, parts).tolist() == coder.encode(text, allowed_special="all")


def test_encode_equals_library(awkward, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = bpe.decode(bpe.encode(awkward, ids="tokens", leaf=2000), ids="tokens")
    assert out.columns == [*awkward.columns, "tokens", "decoded"]
    rows = out.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert np.frombuffer(r.tokens, "<u4").tolist() == plain.encode(r.text, add_special_tokens=False).ids
        assert r.decoded == r.text
    assert bpe.encode(empty).count() == 0


def test_encode_with_decoded_text(awkward):
    """Decoding in the encoder's own worker gives what ``decode`` gives; no Python feeds another within a stage."""
    out = bpe.encode(awkward, ids="tokens", leaf=2000, decoded="back")
    assert out.columns == [*awkward.columns, "tokens", "back"]
    want = bpe.decode(bpe.encode(awkward, ids="tokens", leaf=2000), ids="tokens", text="back")
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect()))
    plan = bpe.encoded_digests(awkward)._jdf.queryExecution().executedPlan().toString()
    steps = [line.strip(" :+-") for line in plan.splitlines() if "Project" not in line]
    python = ("MapInArrow", "FlatMapGroupsInArrow")
    assert any(x.startswith(python) for x in steps)
    assert not any(a.startswith(python) and b.startswith(python) for a, b in zip(steps, steps[1:]))


def test_golay_keys_meet():
    """Any two fingerprints two bits apart share a key."""
    pick = random.Random(7)
    fps = np.array([pick.getrandbits(64) for _ in range(400)], np.uint64)
    near = fps ^ np.array([(1 << pick.randrange(64)) | (1 << pick.randrange(64)) for _ in fps], np.uint64)
    keys = []
    for some in (fps, near):
        at, key = simhash.fuzzy_keys(some)
        keys.append([set(key[at == k].tolist()) for k in range(len(some))])
    assert all(a & b for a, b in zip(*keys))
    assert max(len(k) for k in keys[0]) <= 18


@pytest.mark.parametrize("crowded", [64, 1])
def test_near_links(spark, crowded):
    pick = random.Random(9)
    seeds = [pick.getrandbits(64) for _ in range(20)]
    fps = {s ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)) for s in seeds for _ in range(15)} | {0, (1 << 64) - 1, 3}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed.values()], "fp bigint"), crowded)
    from tallyspan.llm.components import components

    root = {r.node: r.root for r in components(links).collect()}
    wanted = brute.groups({v: f for f, v in signed.items()})
    assert all(root.get(v, v) == wanted[v] for v in wanted)


def test_near_links_broadcast_nothing_that_python_makes(spark, monkeypatch):
    """Keys and lists are many times what the planner takes them for: the driver must not collect them."""
    frames, kept = [], simhash.kept
    monkeypatch.setattr(simhash, "kept", lambda df: frames.append(df) or kept(df))
    links = simhash.near_links(spark.range(200).withColumnRenamed("id", "fp"))
    assert {r.b for r in links.collect()} == set(range(1, 200))
    for frame in (*frames, links):
        steps = [(len(s) - len(s.lstrip(" :+-*")), s) for s in plan_of(frame).splitlines()]
        assert any("MapInArrow" in s for _, s in steps) and any("SortMergeJoin" in s for _, s in steps)
        for k, (depth, step) in enumerate(steps):
            below = itertools.takewhile(lambda x: x[0] > depth, steps[k + 1 :])
            assert "BroadcastExchange" not in step or not any("MapInArrow" in s for _, s in below)


def test_simhash_groups(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op8_simhash"](spark, DATA).collect()}
    fps = {i: brute.fingerprint(t) for i, t in texts}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fps
    assert {i: r.component_id for i, r in got.items()} == brute.groups(fps)


def test_simhash_awkward(awkward, empty):
    out = simhash.near_duplicates(awkward).collect()
    assert len(out) == len(AWKWARD)
    assert {r.component_id for r in out if r.doc_id is None} == {1, 2}
    left = simhash.drop_near_duplicates(awkward)
    assert left.columns == awkward.columns
    assert {r.doc_id for r in left.collect()} == {1, 2, 4, 7, 8, None}
    assert simhash.near_duplicates(empty).count() == 0


def test_decontaminate(spark, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in QUERIES["op10_decontaminate"](spark, DATA).collect()}
    assert got and got == pytest.approx(brute.leaks(texts, items))


def test_decontaminate_awkward(spark, awkward, empty):
    items = spark.createDataFrame([(1, "one two three one two three"), (2, None), (3, ""), (4, "ünïcode"), (1, "one two three one two three")], "item_id int, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(awkward, items).collect()}
    assert found == {(1, 1), (None, 1), (8, 4)}
    assert {r.doc_id for r in decontaminate.decontaminate(awkward, items).collect()} == {2, 3, 4, 5, 6, 7, None}
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(awkward, items.where("false")).count() == 0


def test_decontaminate_blocks(spark, texts, monkeypatch):
    """Many blocks of items find what one finds."""
    want = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontaminate"](spark, DATA).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2000)
    assert {(r.doc_id, r.item_id) for r in QUERIES["op10_decontaminate"](spark, DATA).collect()} == want


def test_toxicity_held_out(spark):
    scores = QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = scores.merge(labels, on="doc_id")
    unseen = both[both.held_out]
    assert len(scores) == 1000 and scores.score.between(0, 1).all()
    assert ((unseen.predicted == 1) == (unseen.toxic == 1)).mean() > 0.9


def test_toxicity_is_fair():
    """A group named mostly in toxic texts does not make a neutral mention toxic."""
    pick = random.Random(2)
    filler = [f"w{k}" for k in range(60)]
    say = lambda *extra: {*pick.sample(filler, 8), *extra}
    toxic = [say("idiot", "muslim") for _ in range(80)] + [say("scum") for _ in range(40)]
    fine = [say("christian") for _ in range(60)] + [say() for _ in range(140)]
    words = toxic + fine
    labels = np.array([1] * len(toxic) + [0] * len(fine))
    ids = [np.array(toxicity.feature_ids(w)) for w in words]
    pairs = [(i, np.array(toxicity.feature_ids(s))) for i, w in zip(ids, words) for s in toxicity.swapped(w)]
    of = lambda model, w: 1 / (1 + np.exp(-(sum(model[0][i] for i in toxicity.feature_ids(w)) + model[1])))
    plain, even = toxicity.train(ids, labels, []), toxicity.train(ids, labels, pairs)
    neutral = {"w1", "w2", "muslim"}
    assert of(even, neutral) < 0.5 and of(even, neutral) < of(plain, neutral)
    assert of(even, {"w1", "idiot"}) > 0.5 and of(even, {"w1", "scum"}) > 0.5


def test_toxicity_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None)], "doc_id bigint, toxic int")
    rows = toxicity.score(awkward, toxicity.fit(awkward, labels)).collect()
    assert len(rows) == len(AWKWARD) and all(r.score == 0.0 and r.predicted == 0 for r in rows)
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0


def test_chat_round_trip(spark):
    nasty = "\\### a: </turn>\n</next> \\h \\\\b < #"
    rows = [
        (1, 2, "assistant", nasty, 0), (1, 0, "user", None, 0), (1, 1, "assistant", "first", 0), (1, 3, "odd: #role", nasty, 0),
        (None, 0, None, "x", 0), (2, None, "user", "same", 0), (2, None, "user", "same", 0),
    ]
    out = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, segments int"))
    read = out.select("conv_id", chat_format.read_turns(out.formatted).alias("turns"), chat_format.read_loss(out.segments).alias("loss"), "formatted")
    got = {r.conv_id: ([tuple(t) for t in r.turns], r.loss, r.formatted) for r in read.collect()}
    assert got[1][0] == [("user", ""), ("assistant", "first"), ("assistant", nasty), ("odd: #role", nasty)]
    assert got[1][1] == "first" + nasty
    assert got[1][2].count("### assistant: ") == 1 and got[1][2].count("</next>") == 1
    assert got[None][0] == [("", "x")] and got[2][0] == [("user", "same")] * 2
    assert chat_format.format_conversations(spark.createDataFrame([], "conv_id int, turn int, role string, text string")).count() == 0


def test_warc_files_and_archive(spark, tmp_path):
    big = "é" * 700
    rows = [(1, "http://a/1", big, 0), (2, "http://a/2\r\nX: y", big, 0), (3, None, None, 0), (4, "http://a/4", "tiny\r\n\r\n", 0), (5, "http://a/5", "tiny\r\n\r\n", 0)]
    records = warc.records_of(spark.createDataFrame(rows, "page_id bigint, url string, html string, payload int"))
    warc.write_warc(records, str(tmp_path / "files"))
    read = warc.read_warc(spark, str(tmp_path / "files"))
    key = lambda r: r["head"]
    same = lambda r: (r["head"], None if r["payload"] is None else bytes(r["payload"]))
    before, after = sorted(map(same, records.collect())), sorted(map(same, read.collect()))
    assert before == after and sum(p is None for _, p in after) == 1
    warc.store(read, str(tmp_path / "archive"))
    assert spark.read.parquet(str(tmp_path / "archive" / "payloads")).count() == 3
    back = warc.restore(spark, str(tmp_path / "archive"))
    assert sorted(r["head"] for r in back.collect()) == sorted(map(key, records.collect()))
    assert all(r.verified and (bytes(r.payload).decode() == big) == (r.n == 1400) for r in back.collect())


def test_html_marks_and_differences(spark):
    site = "<div class='x'>All rights here</div><p>{}</p><div>Contact the desk</div>"
    pages = [(k, f"http://h/{k // 2}/{k}", site.format(f"own text {k} &amp; more words to weigh it " * 3), 0) for k in range(6)]
    pages += [
        (10, "http://copy/a", "<p>same text</p><p>again</p>", 0), (11, "http://copy/b", "<p>same text</p><p>again</p>", 0),
        (12, None, None, 0), (13, "http://one/", "<nav>menu</nav><article><h1>T</h1><p>a&nbsp;\n b<p>c</article><div id=comments>no</div>", 0),
        (14, "http://one/x", "<body><p>cut <b>off<script>var a = '<p>'", 0), (13, "http://one/", "<nav>menu</nav><article>d</article>", 0),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, drop int")
    got = [(r.page_id, r.text) for r in html_text.extract(df).collect()]
    assert len(got) == len(pages)
    for k in range(6):
        assert dict(got)[k] == " ".join((f"own text {k} & more words to weigh it " * 3).split())
    assert dict(got)[10] == dict(got)[11] == "same text\n\nagain"
    assert dict(got)[12] == "" and dict(got)[14] == "cut off"
    assert {t for i, t in got if i == 13} == {"T\n\na b\n\nc", "d"}
    assert html_text.extract(df.where("false")).count() == 0


def test_common_subsequence():
    pick = random.Random(4)
    for _ in range(300):
        a = [pick.choice("abc") for _ in range(pick.randint(0, 12))]
        b = [pick.choice("abc") for _ in range(pick.randint(0, 12))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        places = html_text.common_subsequence(a, b)
        assert len(places) == best[-1][-1] and places == sorted(set(places))
