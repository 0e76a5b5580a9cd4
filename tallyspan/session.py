"""Session settings the jobs are meant to run with."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings recommended for every job of this package.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # windows of many entities are kept on local disk with changelog checkpoints
    # instead of on the executors' heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    name: str = "tallyspan",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make reliable checkpoints possible.

    The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a
    single-machine session that names none gets a temporary folder; on a cluster
    that would lose data with the machine, so it is an error there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyspan-checkpoint-"))
    else:
        raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and keep reliably, for a frame that several jobs read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
