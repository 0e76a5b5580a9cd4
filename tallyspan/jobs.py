"""The steps as jobs for spark-submit: ``spark-submit jobs.py STEP --id ... --date ... [options]``.

Paths are Parquet folders unless said otherwise; statements may also be CSV with ``--schema``.
"""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspan.operators.drift import BINS, PSI_THRESHOLD, drift_alerts, drift_report
from tallyspan.operators.evaluate import compare_models, evaluate, fold_metrics
from tallyspan.operators.importance import mean_fold_importance
from tallyspan.operators.model import (
    RiskModel, batch_score, cross_validate, holdout_report, score_statements, search, search_result, train_final,
    training_report,
)
from tallyspan.operators.sampling import balanced_sample, hash_split, limited_scan
from tallyspan.plans.batch import features_with_labels, preprocess
from tallyspan.plans.refresh import refresh
from tallyspan.session import build_session, materialise
from tallyspan.sources.readers import read_feature_list, read_labels_csv, read_statements_csv
from tallyspan.sources.writers import (
    publish_predictions, read_document, write_document, write_feature_list, write_holdout, write_metrics, write_oof,
    write_parquet, write_run,
)
from tallyspan.spec import Spec
from tallyspan.streaming.ingest import read_broker, read_messages, start_ingest
from tallyspan.streaming.rolling import start_features

# Columns of a message as it arrives.
MESSAGE = "body string, arrival timestamp, place bigint"


def parser() -> argparse.ArgumentParser:
    names = lambda text: tuple(n for n in text.split(",") if n)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--id", required=True)
    common.add_argument("--date", default="date")
    common.add_argument("--tiebreak", type=names, default=())
    common.add_argument("--categorical", type=names, default=())
    common.add_argument("--target", default="target")
    common.add_argument("--overwrite", action="store_true")
    root = argparse.ArgumentParser(description=__doc__)
    steps = root.add_subparsers(dest="step", required=True)

    def step(name: str, *paths: str) -> argparse.ArgumentParser:
        p = steps.add_parser(name, parents=[common])
        for path in paths:
            p.add_argument(f"--{path}", required=True)
        return p

    p = step("preprocess", "input", "output")
    p.add_argument("--schema")
    p.add_argument("--missing-threshold", type=float, default=80.0)
    p = step("features", "input", "output")
    p.add_argument("--labels")
    p.add_argument("--start-date")
    p.add_argument("--end-date")
    p = step("split", "input", "train", "test")
    p.add_argument("--train-ratio", type=float, default=0.8)
    for name in ("train", "tune"):
        p = step(name, "input", "output")
        p.add_argument("--max-rows", type=int)
        p.add_argument("--balanced-sample", action="store_true")
        p.add_argument("--rounds", type=int, default=300 if name == "train" else 700)
        if name == "train":
            p.add_argument("--params", default="{}", help="learner parameters as JSON")
            p.add_argument("--tuned", help="output folder of a tune step; --params wins over it")
            p.add_argument("--holdout")
            p.add_argument("--selector-rounds", type=int, default=100)
            p.add_argument("--threshold", type=float, default=0.95)
            p.add_argument("--min-features", type=int, default=300)
            p.add_argument("--max-features", type=int, default=1000)
        else:
            p.add_argument("--trials", type=int, default=25)
            p.add_argument("--folds", type=int, default=3)
            p.add_argument("--metric", choices=["roc_auc", "pr_auc"], default="roc_auc")
    p = step("cross-validate", "input", "output")
    p.add_argument("--folds", type=int, default=5)
    p.add_argument("--rounds", type=int, default=1000)
    p.add_argument("--params", default="{}", help="learner parameters of each model family as JSON")
    p = step("evaluate", "output")
    p.add_argument("--input", required=True, nargs="+", help="scores of one run or of several to compare")
    p.add_argument("--names", type=names, default=(), help="a name for each run, in front of its models' names")
    p.add_argument("--rank-by", default="roc_auc")
    p = step("score", "model", "input", "output")
    p.add_argument("--job", default="score")
    p.add_argument("--publish", help="store whose readers get the scores as a whole, in the fixed schema")
    step("score-statements", "model", "input", "output")
    p = step("drift", "baseline", "current", "output")
    p.add_argument("--bins", type=int, default=BINS)
    p.add_argument("--psi-threshold", type=float, default=PSI_THRESHOLD)
    p.add_argument("--alerts", default="{}", help="alert thresholds of single features as JSON")
    p.add_argument("--run", required=True, help="name of this run; running it again replaces its report")
    for side in ("baseline", "current"):
        p.add_argument(f"--{side}-start-date")
        p.add_argument(f"--{side}-end-date")
    p = step("refresh", "history", "changes", "features", "serving")
    p.add_argument("--cycle")
    for name in ("ingest", "stream-features"):
        p = step(name, "output", "checkpoint", "schema")
        source = p.add_mutually_exclusive_group(required=True)
        source.add_argument("--input", help="folder where message files land")
        source.add_argument("--topic", help="topic of the broker")
        p.add_argument("--servers", help="addresses of the broker")
        p.add_argument("--every", help="processing interval; without it, what is there is taken and the job ends")
        if name == "stream-features":
            p.add_argument("--features", required=True)
    return root


def _messages(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return read_messages(spark, a.input, MESSAGE) if a.input else read_broker(spark, a.servers, a.topic)


def _sampled(df: DataFrame, a: argparse.Namespace) -> DataFrame:
    if a.max_rows is None:
        return df
    if a.balanced_sample:
        return balanced_sample(df, a.id, a.target, a.max_rows)
    return limited_scan(df, a.max_rows, [a.id])


def run(spark: SparkSession, arguments: Sequence[str]) -> None:
    a = parser().parse_args(arguments)
    spec = Spec(a.id, a.date, a.tiebreak, a.target, None, a.categorical)
    read = spark.read.parquet
    if a.step == "preprocess":
        raw = read_statements_csv(spark, a.input, a.schema) if a.schema else read(a.input)
        write_parquet(preprocess(raw, spec, a.missing_threshold)[0], a.output, a.overwrite)
    elif a.step == "features":
        statements = read(a.input)
        key_type = dict(statements.dtypes)[a.id]
        labels = read_labels_csv(spark, a.labels, a.id, a.target, key_type) if a.labels else None
        built = features_with_labels(statements, spec, labels, a.start_date, a.end_date)
        write_parquet(built, a.output, a.overwrite)
    elif a.step == "split":
        for side, path in zip(hash_split(read(a.input), a.id, a.train_ratio), (a.train, a.test)):
            write_parquet(side, path, a.overwrite)
    elif a.step == "tune":
        trials = search(
            _sampled(read(a.input), a), a.id, a.target, trials=a.trials, folds=a.folds, rounds=a.rounds, metric=a.metric
        )
        write_parquet(trials, f"{a.output}/trials", a.overwrite)
        done = search_result(read(f"{a.output}/trials"), a.metric)
        write_document(spark, done, f"{a.output}/result")
        write_document(spark, done["best_params"], f"{a.output}/best_params")
    elif a.step == "train":
        tuned = read_document(spark, f"{a.tuned}/result") if a.tuned else {}
        params = {**tuned.get("best_params", {}), **json.loads(a.params)}
        rows, began = _sampled(read(a.input), a), time.perf_counter()
        final = train_final(
            rows, a.id, a.target, selector_rounds=a.selector_rounds, final_rounds=a.rounds,
            threshold=a.threshold, min_features=a.min_features, max_features=a.max_features, **params,
        )
        settings = {
            "selector_rounds": a.selector_rounds, "final_rounds": a.rounds, "importance_threshold": a.threshold,
            "min_features": a.min_features, "max_features": a.max_features, "params": params,
            "tuned_metric": tuned.get("metric"), "tuned_score": tuned.get("best_score"),
            "training_time_seconds": time.perf_counter() - began,
        }
        write_metrics(training_report(rows, a.target, final, settings=settings), f"{a.output}/report")
        final.model.save(spark, f"{a.output}/model")
        write_parquet(final.importance, f"{a.output}/importance", overwrite=True)
        write_feature_list(spark, final.selected, f"{a.output}/selected_features")
        if a.holdout:
            held = read(a.holdout)
            write_metrics(holdout_report(final.model, held, a.target), f"{a.output}/holdout_metrics")
            scored = final.model.probability(held.select(a.id, a.target, *[c for c in final.model.features if c in held.columns]))
            write_holdout(scored.select(a.id, a.target, "prediction"), f"{a.output}/holdout_predictions")
    elif a.step == "cross-validate":
        done = cross_validate(
            read(a.input), a.id, a.target, folds=a.folds, rounds=a.rounds, params=json.loads(a.params)
        )
        write_oof(done.oof, f"{a.output}/oof")
        oof = read(f"{a.output}/oof")
        write_metrics(evaluate(oof, a.target, "prediction"), f"{a.output}/metrics", fold_metrics(oof, a.target, "prediction"))
        write_parquet(done.importance, f"{a.output}/fold_importance", overwrite=True)
        write_parquet(mean_fold_importance(done.importance, a.folds, ("model", "feature")), f"{a.output}/importance", overwrite=True)
        for (family, fold), model in done.models.items():
            model.save(spark, f"{a.output}/models/{family}/fold_{fold}")
    elif a.step == "evaluate":
        if a.names and len(a.names) != len(a.input):
            raise ValueError("Give a name for each input, or none.")
        runs = [read(path) for path in a.input]
        if a.names:
            runs = [run.withColumn("model", F.concat(F.lit(f"{n}/"), "model")) for n, run in zip(a.names, runs)]
        reports = [materialise(evaluate(run, a.target, "prediction")) for run in runs]
        folds = [fold_metrics(run, a.target, "prediction") for run in runs]
        write_metrics(reduce(DataFrame.unionByName, reports), f"{a.output}/metrics", reduce(DataFrame.unionByName, folds))
        write_holdout(compare_models(reports, a.rank_by).coalesce(1), f"{a.output}/comparison")
    elif a.step == "score":
        model = RiskModel.load(spark, a.model)
        write_parquet(batch_score(model, read(a.input), a.id, a.job), a.output, a.overwrite)
        if a.publish:
            publish_predictions(read(a.output), a.publish, a.id)
    elif a.step == "score-statements":
        write_parquet(score_statements(RiskModel.load(spark, a.model), read(a.input), spec), a.output, a.overwrite)
    elif a.step == "drift":
        report = drift_report(
            read(a.baseline), read(a.current), [a.id, a.target], bins=a.bins, threshold=a.psi_threshold,
            baseline_dates=(a.baseline_start_date, a.baseline_end_date),
            current_dates=(a.current_start_date, a.current_end_date),
        )
        written = write_run(report, f"{a.output}/report", a.run)
        write_run(drift_alerts(written, json.loads(a.alerts), a.psi_threshold), f"{a.output}/alerts", a.run)
    elif a.step == "refresh":
        wanted = read_feature_list(spark, a.features)
        refresh(spark, read(a.history), read(a.changes), spec, wanted, a.serving, a.cycle)
    else:
        schema = StructType.fromDDL(a.schema)
        trigger = {"processingTime": a.every} if a.every else {"availableNow": True}
        if a.step == "ingest":
            stream = start_ingest(_messages(spark, a), schema, a.output, a.checkpoint, a.id, a.date, **trigger)
        else:
            wanted = read_feature_list(spark, a.features)
            stream = start_features(_messages(spark, a), schema, spec, wanted, a.output, a.checkpoint, **trigger)
        stream.awaitTermination()


def main() -> None:
    import sys

    spark = build_session("tallyspan-job")
    try:
        run(spark, sys.argv[1:])
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
