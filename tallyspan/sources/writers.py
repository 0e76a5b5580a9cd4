"""Writing tables, predictions and reports."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators.refresh import latest_per_key, upsert
from tallyspan.session import materialise
from tallyspan.sources.store import Store

# Name and type of the prediction table's key, and its other columns.
PREDICTION_KEY = ("customer_ID", "string")
PREDICTION_COLUMNS = (
    ("default_probability", "double"), ("risk_category", "string"), ("scoring_job", "string"), ("scored_at", "timestamp"),
)


class LoadResult(NamedTuple):
    table: str
    rows: int
    columns: int


def write_parquet(df: DataFrame, path: str, overwrite: bool = False) -> None:
    mode = "overwrite" if overwrite else "errorifexists"
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_sorted(df: DataFrame, path: str, key: str, order: list[str], overwrite: bool = False) -> None:
    """Rows of a key together and in time order inside each file."""
    from tallyspan.operators.clean import sorted_within

    write_parquet(sorted_within(df, key, order), path, overwrite)


def write_bucketed(df: DataFrame, table: str, key: str, order: list[str], buckets: int) -> None:
    """A statement table bucketed on the entity and sorted in time.  Feature builds, key
    restrictions and label joins over it need no shuffle of the statements."""
    placed = df.repartition(buckets, key)  # one file per bucket instead of one per task and bucket
    placed.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order).saveAsTable(table)


def load_table(df: DataFrame, table: str, disposition: str = "truncate") -> LoadResult:
    """Load into a table: replace its rows, append, or only if it is absent or empty."""
    spark = df.sparkSession
    if disposition not in ("truncate", "append", "empty"):
        raise ValueError(f"Unknown disposition {disposition!r}.")
    exists = spark.catalog.tableExists(table)
    if disposition == "empty" and exists and not spark.table(table).isEmpty():
        raise ValueError(f"Table {table} is not empty.")
    mode = "append" if disposition == "append" else "overwrite"
    df.write.mode(mode).saveAsTable(table)
    loaded = spark.table(table)
    return LoadResult(table, loaded.count(), len(loaded.columns))


def write_staging(df: DataFrame, table: str) -> DataFrame:
    """Overwrite the staging table and read it back, so that later steps do not recompute."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def create_table_as(df: DataFrame, table: str) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def upsert_versioned(
    spark: SparkSession, staging: DataFrame, root: str, key: str, columns: list[str] | None = None
) -> int:
    """Merge staging rows into the newest version under ``root`` and write the next one.

    A version is never written over while it is read: the merge goes to a new folder,
    and readers take the highest one that finished (Spark leaves ``_SUCCESS``).
    """
    current = latest_version(spark, root)
    if current is None:
        staging.write.mode("overwrite").parquet(f"{root}/version=1")
        return 1
    target = spark.read.parquet(f"{root}/version={current}")
    upsert(target, staging, key, columns).write.mode("overwrite").parquet(f"{root}/version={current + 1}")
    return current + 1


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The newest finished version under ``root``; file names only, no data."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/version=*/_SUCCESS")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    found = [int(f.getPath().getParent().getName().split("=")[1]) for f in (files or [])]
    return max(found, default=None)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    version = latest_version(spark, root)
    if version is None:
        raise ValueError(f"No finished version under {root}.")
    return spark.read.parquet(f"{root}/version={version}")


def write_metrics(report: DataFrame, path: str, folds: DataFrame | None = None) -> None:
    """One model's report as nested JSON (with ``fold_metrics``) and as flat CSV (without)."""
    flat = report.coalesce(1)
    nested = report
    if folds is not None:
        packed = folds.groupBy("model").agg(
            F.array_sort(F.collect_list(F.struct("fold", *[c for c in folds.columns if c not in ("model", "fold")]))).alias(
                "fold_metrics"
            )
        )
        nested = report.join(packed, "model", "left")
    nested.coalesce(1).write.mode("overwrite").json(f"{path}/json")
    flat.write.mode("overwrite").csv(f"{path}/csv", header=True)


def write_oof(oof: DataFrame, path: str) -> None:
    write_parquet(oof, path, overwrite=True)


def write_holdout(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").csv(path, header=True)


def prediction_rows(scored: DataFrame, key: str = PREDICTION_KEY[0]) -> DataFrame:
    """Scores in the fixed schema of a prediction table, whatever the entity is called."""
    columns = [(key, PREDICTION_KEY[1]), *PREDICTION_COLUMNS]
    return scored.select(*[F.col(n).cast(t).alias(n) for n, t in columns])


def write_predictions(scored: DataFrame, table: str, key: str = PREDICTION_KEY[0]) -> LoadResult:
    """Replace the prediction table; its columns and types are fixed."""
    return load_table(prediction_rows(scored, key), table, "truncate")


def publish_predictions(scored: DataFrame, root: str, key: str) -> int:
    """Publish scores as the next version of a store: readers see the old table or the new one."""
    return Store(scored.sparkSession, root, key).replace(prediction_rows(scored, key))


def append_drift(report: DataFrame, table: str, csv_path: str) -> None:
    """Append to the drift history and leave a CSV copy of this report, computed once."""
    report = materialise(report)
    report.write.mode("append").saveAsTable(table)
    report.coalesce(1).write.mode("overwrite").csv(csv_path, header=True)


def write_run(report: DataFrame, root: str, run: str) -> DataFrame:
    """One run's report in the history under ``root``, and the same rows as CSV; read back.

    The folder is named after the run, so a run that is repeated replaces its report.
    """
    report.write.mode("overwrite").parquet(f"{root}/history/run={run}")
    written = report.sparkSession.read.parquet(f"{root}/history/run={run}")
    written.coalesce(1).write.mode("overwrite").csv(f"{root}/csv/run={run}", header=True)
    return written


def serving_snapshot(
    features: DataFrame, key: str, names: list[str], order: tuple[str, ...] = ()
) -> DataFrame:
    """One row of the named features per key: the newest along ``order`` where keys repeat."""
    kept = features.where(F.col(key).isNotNull())
    if order:
        kept = latest_per_key(kept, key, order)
    return kept.select(key, *names)


def publish_serving(
    features: DataFrame, table: str, key: str, names: list[str], order: tuple[str, ...] = ()
) -> LoadResult:
    if not names:
        raise ValueError("The feature list must not be empty.")
    return load_table(serving_snapshot(features, key, names, order), table, "truncate")


def publish_features(
    features: DataFrame, root: str, key: str, names: list[str], order: tuple[str, ...] = ()
) -> int:
    """The serving snapshot as the next version of a store, without a moment in which it is missing."""
    if not names:
        raise ValueError("The feature list must not be empty.")
    return Store(features.sparkSession, root, key).replace(serving_snapshot(features, key, names, order))


def write_feature_list(spark: SparkSession, names: list[str], path: str) -> None:
    """The names as one JSON array in a one-file text folder."""
    write_document(spark, names, path)


def write_document(spark: SparkSession, body: dict | list, path: str) -> None:
    """A small JSON document in a one-file text folder."""
    spark.createDataFrame([(json.dumps(body),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> dict | list:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])
