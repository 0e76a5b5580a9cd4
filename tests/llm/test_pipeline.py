"""The pipeline beside its stages in plain Python."""

import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from tallyspan.llm import bpe  # noqa: E402
from tallyspan.llm.queries import QUERIES  # noqa: E402

DATA = "/root/testdata/sf0.001"


def test_stages_and_result(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    passed = {r.doc_id for r in QUERIES["op1_quality_rules"](spark, DATA).where("kept").collect()}
    docs = {i: t for i, t in docs.items() if i in passed}
    group = brute.groups({i: brute.fingerprint(t) for i, t in docs.items()})
    docs = {i: t for i, t in docs.items() if group[i] == i}
    found = brute.removed_bytes(sorted(docs.items()))
    docs = {i: np.frombuffer(b, np.uint8)[~g].tobytes().decode("utf-8", "ignore") for i, (b, g) in found.items()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute.leaks(docs.items(), items)}
    docs = {i: t for i, t in docs.items() if i not in leaked}
    coder, _ = bpe.encoding(bpe.vocabulary_path())
    wanted = {i: (len(k := coder.encode(t, allowed_special="all")), brute.sha(np.array(k, "<u4").tobytes()), brute.sha(t.encode())) for i, t in docs.items()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == wanted


def test_near_duplicates_are_those_of_the_fingerprints(spark):
    """Texts within two bits go, whatever their shingles share; of texts further apart all stay."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    near = [" ".join(f"w{k}" for k in range(n)) for n in (400, 401)]
    far = " ".join([f"w{k}" for k in range(360)] + [f"x{k}" for k in range(40)])
    rows = docs.limit(0).union(spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate([*near, far])], docs.schema))
    marks = [brute.fingerprint(t) for t in (*near, far)]
    assert (marks[0] ^ marks[1]).bit_count() <= 2 < min((m ^ marks[2]).bit_count() for m in marks[:2])
    wide = docs.union(rows.withColumn("doc_id", rows.doc_id + 10**6))
    group = brute.groups({r.doc_id: brute.fingerprint(r.text) for r in wide.collect()})
    got = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, wide, DATA)
    assert {r.doc_id for r in got.collect()} == {i for i, root in group.items() if i == root}


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, DATA)
        assert out.dtypes == docs.dtypes


def test_stages_take_empty_and_missing(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    gaps = docs.limit(0).union(spark.createDataFrame([(None,) * 5, (1, None, None, None, None), (1, "", None, "s", 0)], docs.schema))
    for start in (docs.limit(0), gaps):
        out = start
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, DATA)
        assert out.count() == 0
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, gaps, DATA).count() >= 1
