"""Reading statements, labels, feature tables and feature lists."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyspan.operators.sampling import limited_scan


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header and a stated schema: nothing is inferred, so the file is read once
    and columns keep their types from run to run.  Malformed fields become NULL."""
    return spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE", enforceSchema=False)


def read_statements_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return read_csv(spark, path, schema)


def read_labels_csv(spark: SparkSession, path: str, key: str, target: str, key_type: str = "string") -> DataFrame:
    return read_csv(spark, path, f"`{key}` {key_type}, `{target}` int")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, table: str, max_rows: int | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """A table, or its first rows along ``order``."""
    return limited_scan(spark.table(table), max_rows, order)


def read_feature_list(spark: SparkSession, path: str, missing_ok: bool = False) -> list[str]:
    """A non-empty JSON list of feature names.  With ``missing_ok`` an absent file is []."""
    try:
        rows = spark.read.text(path, wholetext=True).head(1)
    except Exception as error:
        if missing_ok and "PATH_NOT_FOUND" in str(error):
            return []
        raise
    names = json.loads(rows[0]["value"]) if rows else None
    if not isinstance(names, list) or not names:
        raise ValueError("The feature list must be a non-empty JSON list.")
    return [str(n) for n in names]
