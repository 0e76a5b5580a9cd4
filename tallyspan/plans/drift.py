"""Drift between two periods of the same statements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallyspan.operators.clean import filter_dates
from tallyspan.operators.drift import BINS, PSI_THRESHOLD, drift_report
from tallyspan.operators.features import build_features
from tallyspan.session import materialise
from tallyspan.spec import HOT_ROWS, Spec


def compare_windows(
    statements: DataFrame,
    spec: Spec,
    baseline_dates: tuple[str | None, str | None],
    current_dates: tuple[str | None, str | None],
    wanted: Sequence[str] | None = None,
    bins: int = BINS,
    threshold: float = PSI_THRESHOLD,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Build features from each date window, then report their drift.

    The report reads the features several times, so each window's are computed once
    and kept.
    """
    sides = [
        materialise(build_features(filter_dates(statements, spec.date, *dates), spec, wanted, hot_rows=hot_rows))
        for dates in (baseline_dates, current_dates)
    ]
    exclude = [spec.id] + ([spec.target] if spec.target else [])
    return drift_report(
        *sides, exclude, bins=bins, threshold=threshold,
        baseline_dates=baseline_dates, current_dates=current_dates, hot_rows=hot_rows,
    )
