"""Scheduled incremental refresh of the serving features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyspan.operators.refresh import changed_keys, refresh_features
from tallyspan.session import materialise
from tallyspan.sources.writers import upsert_versioned
from tallyspan.spec import HOT_ROWS, Spec


def refresh(
    spark: SparkSession,
    history: DataFrame,
    log: DataFrame,
    spec: Spec,
    wanted: Sequence[str],
    serving_root: str,
    cycle: str | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> int:
    """Recompute the changed entities of a cycle and merge them into the serving table.

    Returns the version written.  Running it again for the same cycle gives the same table.
    """
    if not wanted:
        raise ValueError("The feature list must not be empty.")
    keys = materialise(changed_keys(log, spec.id, cycle))
    fresh = materialise(refresh_features(history, keys, spec, wanted, hot_rows))
    return upsert_versioned(spark, fresh, serving_root, spec.id, list(wanted))
