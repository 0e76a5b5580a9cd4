"""What the operators share: tables, kept intermediate results, words."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The white space that separates words.
SPACE = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``)."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables/{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it again: computed once, lineage cut,
    and a lost executor costs nothing that was finished."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df.write.parquet(path)
    again = spark.read.schema(df.schema).parquet(path)
    again._kept_at = path
    return again


def forget(df: DataFrame) -> None:
    """Delete what ``kept`` wrote, once nothing reads it any more."""
    spark, path = df.sparkSession, df._kept_at
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def words_of(text: Column) -> Column:
    """Array of the words of a text that is not NULL; empty for a text without words."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes handed to Python at once: texts may be very long, and the
    defaults could put thousands of them into one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def row_keys(df: DataFrame, name: str) -> DataFrame:
    """Adds a key that tells equal rows apart.  It depends on the input splits alone, so a
    recomputed task gives the same keys; use it on what comes straight from a scan."""
    return df.withColumn(name, F.monotonically_increasing_id())
