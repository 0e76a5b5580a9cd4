"""Streams against the batch answer "the last 13 by arrival"."""

import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from tallyspan.operators.features import align_features, build_features
from tallyspan.spec import Spec
from tallyspan.streaming.ingest import decode, read_messages, start_ingest
from tallyspan.streaming.rolling import compact_vectors, read_vectors, start_features

MESSAGE = "body string, arrival timestamp, place bigint"
STATEMENT = StructType().add("id", StringType()).add("day", StringType()).add("x", DoubleType()).add("c", StringType())
SPEC = Spec("id", "day", continuous=("x",), categorical=("c",))
WANTED = ["x_mean", "x_last", "x_diff_mean", "x_std_3m", "c_count", "c_nunique", "gone_mean"]


def message(place, record, raw=False):
    text = record if raw else json.dumps(record)
    body = base64.b64encode(text.encode()).decode()
    return (body, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=place // 3), place)


def statement(key, day, x, **extra):
    return {"id": key, "day": f"2024-01-{day:02d}", "x": x, "c": "pqr"[day % 3], **extra}


def land(spark, rows, folder):
    spark.createDataFrame(rows, MESSAGE).repartition(3).write.mode("append").parquet(folder)


def expected(spark, rows, limit=13):
    """Latest arrivals per entity, features by statement date then arrival, in batch."""
    last = {}
    for body, arrival, place in sorted(rows, key=lambda r: (r[1], r[2])):
        record = json.loads(base64.b64decode(body))
        last.setdefault(record["id"], []).append((*[record.get(c) for c in ("id", "day", "x", "c")], place))
    kept = [r for v in last.values() for r in v[-limit:]]
    df = spark.createDataFrame(kept, "id string, day string, x double, c string, place bigint")
    spec = Spec("id", "day", ("place",), continuous=("x",), categorical=("c",))
    built = align_features(build_features(df, spec, WANTED), "id", WANTED, 0.0, 0.0)
    return {r["id"]: [r[w] for w in WANTED] for r in built.collect()}


def found(spark, root):
    return {r["id"]: [r["features"][w] for w in WANTED] for r in read_vectors(spark, root, "id").collect()}


def same(a, b):
    assert set(a) == set(b)
    for k in a:
        assert a[k] == pytest.approx(b[k]), k


def run_features(spark, folder, root, **options):
    stream = read_messages(spark, folder, MESSAGE, maxFilesPerTrigger="1")
    q = start_features(stream, STATEMENT, SPEC, WANTED, root, f"{root}/_checkpoint", **options)
    q.awaitTermination()
    assert q.exception() is None


def test_rolling_features_over_restarts(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [message(i, statement("a" if i % 2 else f"k{i % 3}", 1 + i % 28, float(i % 11))) for i in range(60)]
    land(spark, rows[:25], folder)
    run_features(spark, folder, root)
    same(found(spark, root), expected(spark, rows[:25]))
    # the rest arrives later: a restart from the checkpoint, an old statement, a redelivery
    more = rows[25:] + [message(60, statement("a", 1, 99.0)), message(61, statement("k0", 2, 5.0)), message(62, statement("k0", 2, 5.0))]
    land(spark, more, folder)
    run_features(spark, folder, root)
    same(found(spark, root), expected(spark, rows[:25] + more))
    compact_vectors(spark, root, "id", str(tmp_path / "compact"))
    same(found(spark, str(tmp_path / "compact")), found(spark, root))


def test_more_than_the_limit_in_one_batch(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [message(i, statement("a", 1 + i % 28, float(i))) for i in range(40)]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.parquet(folder)
    run_features(spark, folder, root)
    same(found(spark, root), expected(spark, rows))
    entry = read_vectors(spark, root, "id").first()
    assert entry["selected_feature_count"] == len(WANTED) and entry["statement_cycle"] == "2024-01"


def test_dedupe_switch(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [message(0, statement("a", 1, 1.0)), message(1, statement("a", 1, 1.0)), message(2, statement("a", 2, 7.0, statement_cycle="x"))]
    land(spark, rows, folder)
    run_features(spark, folder, root, dedupe_within="1 hour")
    assert found(spark, root)["a"][WANTED.index("c_count")] == 2.0


BAD = [
    ("", "message is missing data"), ("%%%", "message is not base64"),
    (base64.b64encode(b"not json").decode(), "message is not a JSON object"),
    (base64.b64encode(b"[1, 2]").decode(), "message is not a JSON object"),
    (base64.b64encode(b'{"day": "2024-01-01"}').decode(), "message is missing id"),
    (base64.b64encode(b'{"id": "", "day": "2024-01-01"}').decode(), "message is missing id"),
]


def test_decode_reasons(spark):
    rows = [(b, None, i) for i, (b, _) in enumerate(BAD)] + [message(9, statement("a", 3, 1.0))]
    got = decode(spark.createDataFrame(rows, MESSAGE), STATEMENT, "id", "day").orderBy("place").collect()
    assert [r["reject"] for r in got] == [why for _, why in BAD] + [None]
    assert got[-1]["statement_cycle"] == "2024-01"
    short = [message(0, {"id": "a", "day": "2024"})]
    now = F.lit("2031-02-03").cast("timestamp")
    assert decode(spark.createDataFrame(short, MESSAGE), STATEMENT, "id", "day", now=now).first()["statement_cycle"] == "2031-02"


def test_ingest_fan_out(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    good = [message(i, statement(f"k{i % 4}", 1 + i, float(i))) for i in range(12)]
    good.append(message(12, statement("k0", 5, 1.0, statement_cycle="2023-07")))
    land(spark, good + [(b, None, 50) for b, _ in BAD], folder)
    for _ in range(2):  # the second run finds nothing new
        q = start_ingest(read_messages(spark, folder, MESSAGE), STATEMENT, root, f"{root}/_checkpoint", "id", "day")
        q.awaitTermination()
    history = spark.read.parquet(f"{root}/history")
    assert history.count() == 13 and {"id", "day", "x", "c", "statement_cycle"} <= set(history.columns)
    changes = spark.read.parquet(f"{root}/changes")
    assert changes.count() == 13 and changes.where("statement_cycle = '2023-07'").count() == 1
    assert {"id", "statement_cycle", "source_table", "updated_at"} <= set(changes.columns)
    assert spark.read.parquet(f"{root}/rejects").count() == len(BAD)


def test_replayed_batch_leaves_one_copy(spark, tmp_path):
    from tallyspan.streaming.ingest import write_batch

    decoded = decode(spark.createDataFrame([message(0, statement("a", 1, 1.0))], MESSAGE), STATEMENT, "id", "day")
    for _ in range(2):
        write_batch(decoded, 7, str(tmp_path), "id", "history")
    assert spark.read.parquet(f"{tmp_path}/history").count() == 1


def test_incremental_refresh(spark, tmp_path):
    """Refreshing the changed entities gives what a full rebuild gives them; repeating changes nothing."""
    from tallyspan.plans.refresh import refresh
    from tallyspan.sources.writers import read_latest

    rows = [(k, dt.date(2024, 1, d), float(d * len(k)), "pq"[d % 2]) for k in ("a", "bb", "ccc") for d in range(1, 9)]
    history = spark.createDataFrame(rows, "id string, day date, x double, c string")
    log = spark.createDataFrame([("a", "1"), ("bb", "1"), ("ccc", "2")], "id string, statement_cycle string")
    wanted, root = ["x_mean", "x_last", "c_nunique"], str(tmp_path / "serving")
    assert refresh(spark, history, log, SPEC, wanted, root, "1") == 1
    assert refresh(spark, history, log, SPEC, wanted, root, "2") == 2
    assert refresh(spark, history, log, SPEC, wanted, root, "2") == 3
    full = {tuple(r) for r in build_features(history, SPEC, wanted).select("id", *wanted).collect()}
    assert {tuple(r) for r in read_latest(spark, root).select("id", *wanted).collect()} == full
    with pytest.raises(ValueError):
        refresh(spark, history, log, SPEC, [], root)
