"""The batch sequence: clean, build features, split, train, score, report drift."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.scalar import as_date
from tallyspan.operators.clean import cast_categoricals, drop_sparse_columns, filter_dates, nan_as_null
from tallyspan.operators.drift import drift_report
from tallyspan.operators.features import attach_labels, build_features
from tallyspan.operators.model import FINAL_ROUNDS, SELECTOR_ROUNDS, FinalModel, batch_score, holdout_report, train_final
from tallyspan.operators.sampling import hash_split
from tallyspan.sources.writers import create_table_as, load_table, write_parquet, write_predictions, write_run
from tallyspan.spec import HOT_ROWS, Spec, require_columns


def preprocess(statements: DataFrame, spec: Spec, threshold: float = 80.0) -> tuple[DataFrame, list[str]]:
    """Dates parsed, NaN as NULL, columns too sparse to use dropped, categoricals as text."""
    require_columns(statements, [spec.id, *spec.order_columns])
    types = {f.name: f.dataType for f in statements.schema.fields}
    dated = statements.withColumn(spec.date, as_date(spec.date, types[spec.date]))
    kept, dropped = drop_sparse_columns(nan_as_null(dated), [spec.id, *spec.order_columns], threshold)
    return cast_categoricals(kept, spec.categorical), dropped


def features_with_labels(
    statements: DataFrame, spec: Spec, labels: DataFrame | None = None, start: str | None = None,
    end: str | None = None, how: str = "left", hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Features of the statements within the dates.  A target carried by the statements is
    used only when no labels are given, so it never appears twice."""
    rows = filter_dates(statements, spec.date, start, end)
    if labels is None:
        return build_features(rows, spec, hot_rows=hot_rows)
    bare = Spec(
        spec.id, spec.date, spec.tiebreak, None, spec.continuous, spec.categorical, spec.unique_order
    )
    if spec.target is not None:
        rows = rows.drop(spec.target)
    return attach_labels(build_features(rows, bare, hot_rows=hot_rows), labels, spec.id, how)


@dataclass(frozen=True)
class BatchResult:
    dropped: list[str]
    final: FinalModel
    holdout: DataFrame
    predictions: str
    drift: DataFrame


def run(
    spark: SparkSession,
    statements: DataFrame,
    labels: DataFrame,
    spec: Spec,
    target: str,
    root: str,
    tables: str = "risk",
    *,
    train_ratio: float = 0.8,
    selector_rounds: int = SELECTOR_ROUNDS,
    final_rounds: int = FINAL_ROUNDS,
    min_features: int = 300,
    max_features: int = 1000,
    job: str = "batch",
    **params,
) -> BatchResult:
    """Every step reads what the step before wrote, so a rerun can start at any of them.  The drift
    report belongs to ``job``: running the same job again replaces it."""
    cleaned, dropped = preprocess(statements, spec)
    write_parquet(cleaned, f"{root}/preprocessed", overwrite=True)
    built = features_with_labels(spark.read.parquet(f"{root}/preprocessed"), spec, labels)
    write_parquet(built, f"{root}/features", overwrite=True)
    features = spark.read.parquet(f"{root}/features")
    load_table(features, f"{tables}_features")
    train_rows, test_rows = hash_split(spark.table(f"{tables}_features"), spec.id, train_ratio)
    train = create_table_as(train_rows, f"{tables}_train")
    test = create_table_as(test_rows, f"{tables}_test")
    labelled = train.where(F.col(target).isNotNull())
    final = train_final(
        labelled, spec.id, target, selector_rounds=selector_rounds, final_rounds=final_rounds,
        min_features=min_features, max_features=max_features, **params,
    )
    holdout = holdout_report(final.model, test.where(F.col(target).isNotNull()), target)
    scores = batch_score(final.model, features.drop(target), spec.id, job)
    write_predictions(scores, f"{tables}_predictions", spec.id)
    drift = write_run(drift_report(train, test, [spec.id, target]), f"{root}/drift", job)
    return BatchResult(dropped, final, holdout, f"{tables}_predictions", drift)
