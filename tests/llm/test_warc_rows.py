"""One row for each page, whatever the page ids, through files and archive."""

import pytest

from tallyspan.llm import warc

FIELDS = "page_id bigint, url string, html string"


def through_files(spark, folder, rows):
    files, archive = str(folder / "files"), str(folder / "archive")
    warc.write_warc(warc.records_of(spark.createDataFrame(rows, FIELDS).repartition(3)), files)
    warc.store(warc.read_warc(spark, files), archive)
    return archive


def test_repeated_and_missing_ids(spark, tmp_path):
    big, other = "x" * 1500, "é" * 500 + "y" * 3_000_000
    rows = [(5, "u", big), (5, "u", big), (3, "u", big), (1, "v", big), (None, "w", big), (None, None, big), (7, "u", other), (2, "u", other)]
    rows += [(9, "u", "small"), (9, "u", "small"), (8, None, None), (8, None, "")]
    got = [tuple(r) for r in warc.read_back(spark, through_files(spark, tmp_path, rows)).collect()]
    assert sorted((r[0] or 0, r[1]) for r in got) == sorted((i or 0, len((h or "").encode())) for i, _, h in rows)
    kinds = sorted((r[0] or 0, r[3], r[4] or 0) for r in got if r[1] == 1500)
    assert kinds == [(0, "response", 0), (0, "response", 0), (1, "revisit", 5), (3, "revisit", 5), (5, "response", 0), (5, "revisit", 5)]
    assert {(r[0], r[3], r[4]) for r in got if r[1] > 1500} == {(7, "response", None), (2, "revisit", 7)}
    assert all(r[3] == "response" and r[4] is None for r in got if r[1] < 1000)


def test_damaged_payloads_are_an_error(spark, tmp_path):
    archive = through_files(spark, tmp_path, [(1, "u", "z" * 2000), (2, "u", "z" * 2000), (3, "u", "good")])
    payloads = spark.read.parquet(f"{archive}/payloads").selectExpr("sha256", "unhex(hex(payload) || '00') AS payload").collect()
    spark.createDataFrame(payloads, "sha256 string, payload binary").write.mode("overwrite").parquet(f"{archive}/payloads")
    with pytest.raises(Exception, match="digest it is stored under"):
        warc.read_back(spark, archive).collect()


def test_empty_table(spark, tmp_path):
    files = str(tmp_path / "files")
    records = warc.records_of(spark.createDataFrame([(1, "u", "z")], FIELDS).limit(0))
    assert records.count() == 0
    warc.write_warc(records, files)
    assert warc.read_warc(spark, files).count() == 0
