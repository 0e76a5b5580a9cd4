"""Operator 6, WARC: a content-addressed archive of web records.

``records_of`` turns pages into WARC 1.1 records: of equal payloads of at least
``MIN_SHARED`` bytes the one with the largest page_id is a response, the others are revisits
that refer to it.  ``write_warc`` writes records to compressed WARC files, ``read_warc`` reads
such files.  ``store`` keeps each payload once, under its SHA-256, and the exact header of
every record beside that digest; ``restore`` makes the original records again by joining
headers with payloads.

Payloads are compared by (SHA-256, SHA-1, length) and every digest is computed again from
what was read.  Only page ids and digests are shuffled to find equal payloads.

Defined results: NULL html is an empty payload; a NULL url gives a record without target;
line ends in a url are written as %0D and %0A; repeated page_ids give a record each, with a
name of its own, and of equal large payloads exactly one is the response; pages without
page_id are responses; a payload that does not have the digest it is stored under ends the
reading with an error; an empty table writes no record; other columns are ignored.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm.common import query, row_keys, shared_folder, small_batches, table

MIN_SHARED = 1000
RECORDS_PER_FILE = 4000
# The most bytes of small join sides that are broadcast; counted before.
BROADCAST_BYTES = 8 << 20

# WARC 1.1 field names and the profile of revisit records.
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def record_id(page: Column, row: Column) -> Column:
    """A record's name: one for each row, also where page ids repeat or are missing."""
    digest = F.md5(F.concat(F.lit("page "), F.coalesce(page.cast("string"), F.lit("")), F.lit(" row "), row.cast("string")))
    cut = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def bounded_broadcast(small: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast a join side if its counted rows prove it small; else Spark joins by shuffling."""
    return F.broadcast(small) if small.count() * row_bytes <= BROADCAST_BYTES else small


def records_of(pages: DataFrame) -> DataFrame:
    """page_id, head (exact WARC and HTTP header) and payload (NULL for revisits).

    Only payloads that occur more than once need a join; their rows are few unless the
    corpus is made of copies, and then they are shuffled.
    """
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    made = row_keys(pages.select("page_id", "url", body.alias("payload")), "row").select(
        "*", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("n"),
    )
    same = made.where((F.col("n") >= MIN_SHARED) & F.col("page_id").isNotNull())
    leads = same.groupBy("sha256", "sha1", "n").agg(F.max(F.struct("page_id", "row")).alias("lead"), F.count(F.lit(1)).alias("c"))
    leads = leads.where("c > 1").select("sha256", "lead")
    joined = made.join(bounded_broadcast(leads, 128), "sha256", "left")
    revisit = F.col("lead").isNotNull() & F.col("page_id").isNotNull() & (F.col("row") != F.col("lead.row"))
    http = F.concat(F.lit(HTTP), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("row"))),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(
            revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_id(F.col("lead.page_id"), F.col("lead.row"))))
        ).otherwise(F.lit("")),
        line("X-Payload-Digest", F.concat(F.lit("sha256:"), "sha256")),
        line("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        http,
    )
    return joined.select("page_id", head.alias("head"), F.when(~revisit, F.col("payload")).alias("payload"))


def write_warc(records: DataFrame, path: str) -> None:
    """Compressed WARC files.  A record ends in two line ends, the last of which the text
    writer adds."""
    payload = F.decode(F.coalesce("payload", F.encode(F.lit(""), "UTF-8")), "UTF-8")
    lines = records.select(F.concat("head", payload, F.lit("\r\n\r")).alias("value"))
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_records(data: bytes) -> Iterator[tuple[str, bytes | None]]:
    """Header and payload of each record of a WARC file; the header includes the HTTP one."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        fields = data[at:end]
        length = int(fields.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n", 1)[0])
        block = data[end : end + length]
        split = block.index(b"\r\n\r\n") + 4
        revisit = b"\r\nWARC-Type: revisit\r\n" in fields
        yield (fields + block[:split]).decode(), None if revisit else block[split:]
        at = end + length + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """head and payload of all records in WARC files, a file at a time, in small batches."""
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                heads, payloads, size = [], [], 0
                for head, payload in parse_records(gzip.decompress(content.as_py())):
                    heads.append(head)
                    payloads.append(payload)
                    size += len(payload or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array(payloads, pa.binary())], ["head", "payload"])
                        heads, payloads, size = [], [], 0
                yield pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array(payloads, pa.binary())], ["head", "payload"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, "head string, payload binary")


def field(name: str) -> Column:
    """A field of a record header, NULL if it has none."""
    found = F.regexp_extract("head", f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def store(records: DataFrame, path: str) -> None:
    """Headers as they are beside the payload's digest, and every payload once."""
    digest = F.substring_index(field("X-Payload-Digest"), ":", -1)
    named = records.withColumn("sha256", digest)
    named.select("head", "sha256").write.parquet(f"{path}/headers")
    payloads = named.where("payload IS NOT NULL").groupBy("sha256").agg(F.first("payload").alias("payload"))
    payloads.write.option("compression", "zstd").parquet(f"{path}/payloads")


def restore(spark: SparkSession, path: str) -> DataFrame:
    """head, payload (the full one, also of revisits), sha256, and whether the payload has the
    digest it is stored under.  A record as it was is its head, its payload unless it is
    a revisit, and two line ends."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "sha256", "payload", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n"),
        (F.sha2("payload", 256) == F.col("sha256")).alias("verified"),
    )
    return headers.join(payloads, "sha256")


SQL = f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest, md5(b) AS m FROM p),
l AS (SELECT *, CASE WHEN payload_bytes >= {MIN_SHARED} THEN max(page_id) OVER (PARTITION BY payload_digest, m, payload_bytes) END AS lead FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN lead > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN lead > page_id THEN lead END AS refers_to FROM l"""


def read_back(spark: SparkSession, archive: str) -> DataFrame:
    """A row for each record of an archive: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    intact = F.assert_true(F.col("verified"), F.lit("A payload does not have the digest it is stored under."))
    back = restore(spark, archive).where(intact.isNull()).select(
        field("X-Page-ID").cast("long").alias("page_id"), F.col("n").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
        field("WARC-Type").alias("record_type"), field("WARC-Refers-To").alias("lead"),
    )
    names = spark.read.parquet(f"{archive}/headers").select(
        field("WARC-Record-ID").alias("lead"), field("X-Page-ID").cast("long").alias("refers_to"), field("WARC-Type").alias("t")
    ).where("t = 'response'").select("lead", "refers_to")
    revisits = back.where("lead IS NOT NULL").join(names, "lead")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    responses = back.where("lead IS NULL").withColumn("refers_to", F.lit(None).cast("long"))
    return responses.select(*columns).union(revisits.select(*columns))


@query("op6_warc", SQL)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, archive = shared_folder(spark), shared_folder(spark)
    write_warc(records_of(table(spark, sf_dir, "pages")), files)
    store(read_warc(spark, files), archive)
    return read_back(spark, archive)
