"""Rows whose doc_ids repeat or are missing are judged one by one."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from conftest import plan_of  # noqa: E402
from tallyspan.llm import decontaminate, near_copies, simhash  # noqa: E402

ONE = " ".join(f"word{k}" for k in range(60))
OTHER = " ".join(f"thing{k}" for k in range(60))
OWN = " ".join(f"own{k}" for k in range(60))
ROWS = [(2, ONE), (5, ONE), (5, OTHER), (7, OWN), (7, OWN), (None, OWN), (None, "alone as no other text " * 9)]


def left(spark, drop, rows=ROWS):
    out = drop(spark.createDataFrame(rows, "doc_id bigint, text string"))
    return sorted(map(tuple, out.collect()), key=repr)


def test_near_copies_by_row(spark):
    assert left(spark, near_copies.drop_near_copies) == sorted([ROWS[0], ROWS[2], ROWS[3], ROWS[6]], key=repr)


def test_simhash_by_row(spark):
    """This one keeps rows without a doc_id."""
    assert left(spark, simhash.drop_near_duplicates) == sorted([ROWS[0], ROWS[2], ROWS[3], ROWS[5], ROWS[6]], key=repr)


def test_decontaminate_by_row(spark):
    items = spark.createDataFrame([(1, ONE), (2, OWN)], "item_id int, text string")
    assert left(spark, lambda d: decontaminate.decontaminate(d, items)) == sorted([ROWS[2], ROWS[6]], key=repr)


def test_decontaminate_moves_no_rows(spark, monkeypatch):
    """Texts are judged where they are read, in one Python worker a task; with many blocks of items too."""
    words = [f"w{i}" for i in range(40)]
    items = spark.createDataFrame([(i, " ".join(words[i : i + 12])) for i in range(8)], "item_id int, text string")
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (1, "other words altogether"), (None, None), (2, " ".join(words[3:15])), (2, ""), (2, "")], "doc_id bigint, text string"
    )
    want = [(1, "other words altogether"), (2, ""), (2, ""), (None, None)]
    for size in (decontaminate.BLOCK_CHARS, 200):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", size)
        out = decontaminate.decontaminate(docs, items)
        plan = plan_of(out)
        assert "Exchange" not in plan and "Join" not in plan and plan.count("ArrowEvalPython") == 1
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)
