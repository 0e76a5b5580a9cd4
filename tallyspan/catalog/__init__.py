"""Every registered query: the Spark job and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from tallyspan.catalog import (
    cleaning,
    ensembles,
    evaluation,
    features,
    modelling,
    monitoring,
    refreshing,
    sampling,
    summaries,
)
from tallyspan.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
