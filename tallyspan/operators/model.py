"""Training, scoring and explaining binary risk models with Spark ML."""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tallyspan.functions.scalar import coerce_numeric, risk_band
from tallyspan.operators.clean import split_features_target
from tallyspan.operators.encode import bins_for, encoder, learn_levels
from tallyspan.operators.evaluate import FOLD_METRICS, best_fold, evaluate, fold_metrics, ranking_metrics
from tallyspan.operators.features import align_features, build_features
from tallyspan.operators.importance import select_features
from tallyspan.operators.refresh import tiered_values
from tallyspan.operators.sampling import FOLDS, SEED, sample_n, stratified_folds
from tallyspan.operators.skew import hash_rank
from tallyspan.operators.summary import scale_pos_weight
from tallyspan.session import ensure_checkpoint_dir, materialise
from tallyspan.spec import HOT_ROWS, Spec, require_columns

FEATURES = "_features"
WEIGHT = "_weight"
# Trees without improvement after which boosting stops.
PATIENCE = 50

# Rounds of the selector, of the final model and of cross-validation.
SELECTOR_ROUNDS = 100
FINAL_ROUNDS = 300
CV_ROUNDS = 1000

# Rows a training task should hold.
ROWS_PER_TASK = 10_000

# The search space, as (low, high, kind); "log" is log-uniform.
SEARCH_SPACE = {
    "stepSize": (0.005, 0.3, "log"),
    "maxDepth": (3, 12, "int"),
    "minInstancesPerNode": (50, 2000, "int"),
    "minInfoGain": (0.0, 10.0, "float"),
    "subsamplingRate": (0.55, 1.0, "float"),
    "featureSubsetStrategy": (0.55, 1.0, "float"),
}


def gbt(rounds: int, **params) -> GBTClassifier:
    return GBTClassifier(
        labelCol="_label", featuresCol=FEATURES, weightCol=WEIGHT, maxIter=rounds,
        **{"stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8, "seed": SEED, **params},
    )


def forest(rounds: int, **params) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="_label", featuresCol=FEATURES, weightCol=WEIGHT, numTrees=rounds,
        **{"maxDepth": 6, "subsamplingRate": 0.8, "seed": SEED, **params},
    )


FAMILIES = {"boosted_trees": gbt, "random_forest": forest}


@dataclass(frozen=True)
class RiskModel:
    """A fitted encoder and classifier, and the feature columns they expect in order."""

    stages: PipelineModel
    numeric: list[str]
    text: list[str] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.text]

    @property
    def classifier(self):
        return self.stages.stages[-1]

    def save(self, spark: SparkSession, path: str) -> None:
        self.stages.write().overwrite().save(f"{path}/stages")
        body = json.dumps({"numeric": self.numeric, "text": self.text})
        spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/columns")

    @staticmethod
    def load(spark: SparkSession, path: str) -> RiskModel:
        columns = json.loads(spark.read.text(f"{path}/columns", wholetext=True).head()["value"])
        return RiskModel(PipelineModel.load(f"{path}/stages"), columns["numeric"], columns["text"])

    def probability(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """All columns of ``df`` plus the probability of the positive class."""
        keep = df.columns
        shaped = with_inputs(df, self.numeric, self.text)
        scored = self.stages.transform(shaped)
        return scored.select(*keep, vector_to_array("probability")[1].alias(name))


def with_inputs(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """Model inputs: numbers with missing as 0.0 (absent columns too), text as it is."""
    have = set(df.columns)
    zero = F.lit(0.0)
    inputs = {f"_x_{c}": F.coalesce(coerce_numeric(c), zero) if c in have else zero for c in numeric}
    inputs |= {f"_x_{c}": F.col(c).cast("string") if c in have else F.lit(None).cast("string") for c in text}
    return df.withColumns(inputs)


def prepare(
    df: DataFrame, key: str, target: str, numeric: Sequence[str], text: Sequence[str], keep: Sequence[str] = ()
) -> tuple[PipelineModel, DataFrame]:
    """Learn the encoder and give (key, target, *keep, label, weight, vector) rows.

    Positives weigh as much as negatives in total.  Training reads the rows many times,
    so they are dealt evenly over as many tasks as their number deserves, whatever the
    partitioning they came with.
    """
    sizes = scale_pos_weight(df, target).first()
    weight = sizes["scale_pos_weight"]
    if weight is None:
        raise ValueError("No positive examples in target.")
    shaped = with_inputs(df, numeric, text)
    levels = learn_levels(shaped, [f"_x_{c}" for c in text])
    encoded = encoder(numeric, {c: levels[f"_x_{c}"] for c in text}, FEATURES)
    rows = encoded.transform(shaped).select(
        key, target, *keep,
        F.col(target).cast("double").alias("_label"),
        F.when(F.col(target) == 1, F.lit(float(weight))).otherwise(1.0).alias(WEIGHT),
        FEATURES,
    )
    tasks = math.ceil((sizes["positives"] + sizes["negatives"]) / ROWS_PER_TASK)
    return encoded, rows.repartition(max(1, tasks), key)


def importance_rows(spark, classifier, names: Sequence[str], **tags) -> DataFrame:
    """(*tags, feature, importance): one row per model input, as many as the schema has."""
    values = classifier.featureImportances.toArray()
    rows = [(*tags.values(), n, float(v)) for n, v in zip(names, values, strict=True)]
    kinds = ["int" if isinstance(v, int) else "string" for v in tags.values()]
    schema = ", ".join([f"{t} {k}" for t, k in zip(tags, kinds)] + ["feature string", "importance double"])
    return spark.createDataFrame(rows, schema)


@dataclass(frozen=True)
class CrossValidation:
    oof: DataFrame
    importance: DataFrame
    models: dict[tuple[str, int], RiskModel]
    training_seconds: float

    def fold_metrics(self, target: str) -> DataFrame:
        return fold_metrics(self.oof, target, "prediction")

    def best(self, family: str, target: str) -> tuple[int, RiskModel]:
        """The family's best fold by ROC-AUC, and the model that never saw it."""
        mine = self.fold_metrics(target).where(F.col("model") == family)
        fold = best_fold(mine).first()["best_fold"]
        return fold, self.models[family, fold]


def fit_with_patience(learner: GBTClassifier, train: DataFrame, watched: DataFrame, rounds: int) -> GBTClassificationModel:
    """Boosting with as many trees as the watched rows are predicted best with.

    Trees are added, twice as many each time, until the loss has not improved for
    ``PATIENCE`` trees or the rounds are used up.  The seed is fixed, so a shorter fit
    gives the first trees of a longer one.
    """
    trees = min(rounds, 2 * PATIENCE)
    while True:
        model = learner.setMaxIter(trees).fit(train)
        losses = model.evaluateEachIteration(watched)
        best = 1 + min(range(len(losses)), key=losses.__getitem__)
        if trees >= rounds or best + PATIENCE <= trees:
            return model if best == len(losses) else learner.setMaxIter(best).fit(train)
        trees = min(rounds, 2 * trees)


@dataclass(frozen=True)
class FoldData:
    """Encoded training rows with their fold, prepared once for any number of fits."""

    key: str
    target: str
    numeric: list[str]
    text: list[str]
    folds: int
    encoded: PipelineModel
    rows: DataFrame

    @staticmethod
    def of(df: DataFrame, key: str, target: str, folds: int, seed: int) -> FoldData:
        ensure_checkpoint_dir(df.sparkSession)  # boosting cuts its lineage there
        numeric, text, typed = split_features_target(df, key, target)
        placed = materialise(stratified_folds(typed, key, target, folds, seed))
        encoded, rows = prepare(placed, key, target, numeric, text, keep=["fold"])
        return FoldData(key, target, numeric, text, folds, encoded, rows.persist(StorageLevel.MEMORY_AND_DISK))

    def fit(self, family: str, fold: int, rounds: int, params: Mapping):
        """(model, held-out scores, importance, seconds) of one family without one fold."""
        start = time.perf_counter()
        learner = FAMILIES[family](rounds, **{"maxBins": bins_for(self.encoded), **params})
        held_out = F.col("fold") == fold
        if isinstance(learner, GBTClassifier):
            model = fit_with_patience(learner, self.rows.where(~held_out), self.rows.where(held_out), rounds)
        else:
            model = learner.fit(self.rows.where(~held_out))
        spent = time.perf_counter() - start
        scored = model.transform(self.rows.where(held_out)).select(
            self.key, self.target, vector_to_array("probability")[1].alias("prediction"), "fold",
            F.lit(family).alias("model"),
        )
        names = [*self.numeric, *self.text]
        weights = importance_rows(self.rows.sparkSession, model, names, model=family, fold=fold)
        return RiskModel(PipelineModel([*self.encoded.stages, model]), self.numeric, self.text), scored, weights, spent

    def run(
        self, families: Sequence[str], rounds: int, params: Mapping[str, Mapping], parallelism: int
    ) -> CrossValidation:
        jobs = [(family, fold) for family in families for fold in range(1, self.folds + 1)]
        one = lambda job: self.fit(*job, rounds, params.get(job[0], {}))
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            done = list(pool.map(inheritable_thread_target(self.rows.sparkSession)(one), jobs))
        models, scored, weights, seconds = zip(*done)
        return CrossValidation(
            oof=materialise(reduce(DataFrame.unionByName, scored)),
            importance=reduce(DataFrame.unionByName, weights),
            models=dict(zip(jobs, models)),
            training_seconds=sum(seconds),
        )


def cross_validate(
    df: DataFrame,
    key: str,
    target: str,
    *,
    families: Sequence[str] = tuple(FAMILIES),
    folds: int = FOLDS,
    rounds: int = CV_ROUNDS,
    params: Mapping[str, Mapping] | None = None,
    seed: int = SEED,
    parallelism: int = 4,
) -> CrossValidation:
    """Out-of-fold scores of every row for every model family.

    Boosting watches the held-out fold and stops when it no longer improves.  The
    driver only loops over folds and families; every fit and transform is a Spark job
    over the same cached vectors, ``parallelism`` of them at a time.
    """
    data = FoldData.of(df, key, target, folds, seed)
    try:
        return data.run(families, rounds, params or {}, parallelism)
    finally:
        data.rows.unpersist()


def fit_model(
    df: DataFrame, key: str, target: str, numeric: Sequence[str], text: Sequence[str], rounds: int,
    family: str = "boosted_trees", **params,
) -> RiskModel:
    ensure_checkpoint_dir(df.sparkSession)
    encoded, rows = prepare(df, key, target, numeric, text)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = FAMILIES[family](rounds, **{"maxBins": bins_for(encoded), **params}).fit(rows)
    finally:
        rows.unpersist()
    return RiskModel(PipelineModel([*encoded.stages, model]), list(numeric), list(text))


@dataclass(frozen=True)
class FinalModel:
    model: RiskModel
    importance: DataFrame
    selected: list[str]


def train_final(
    df: DataFrame,
    key: str,
    target: str,
    *,
    selector_rounds: int = SELECTOR_ROUNDS,
    final_rounds: int = FINAL_ROUNDS,
    threshold: float = 0.95,
    min_features: int = 300,
    max_features: int = 1000,
    **params,
) -> FinalModel:
    """Rank all features with a short fit, keep those that carry the importance, fit on them."""
    if selector_rounds <= 0:
        raise ValueError("selector_rounds must be positive.")
    numeric, text, typed = split_features_target(df, key, target)
    ranking = fit_model(typed, key, target, numeric, text, selector_rounds, **params)
    rows = importance_rows(df.sparkSession, ranking.classifier, ranking.features)
    chosen = select_features(rows, threshold, min_features, max_features)
    # at most max_features names
    selected = [r["feature"] for r in chosen.where("selected").orderBy("rank").collect()]
    keep = set(selected)
    final = fit_model(
        typed, key, target, [c for c in numeric if c in keep], [c for c in text if c in keep],
        final_rounds, **params,
    )
    return FinalModel(final, chosen, selected)


def training_report(
    df: DataFrame, target: str, final: FinalModel, name: str = "final", settings: Mapping | None = None
) -> DataFrame:
    """One row on a final model: rows and classes it was trained on, the weight of positives, features
    offered and kept and the importance these carry, trees, and the settings of the run."""
    sizes = scale_pos_weight(df, target)
    kept = final.importance.agg(
        F.count(F.lit(1)).alias("n_features"), F.count_if("selected").alias("n_selected"),
        F.max(F.when(F.col("selected"), F.col("cumulative_importance"))).alias("selected_importance"),
    )
    values = [F.lit(json.dumps(v) if isinstance(v, (dict, list)) else v).alias(k) for k, v in (settings or {}).items() if v is not None]
    return sizes.crossJoin(kept).select(  # one row each
        F.lit(name).alias("model"), (F.col("positives") + F.col("negatives")).alias("n_rows"), "positives", "negatives",
        "scale_pos_weight", "n_features", "n_selected", "selected_importance",
        F.lit(final.model.classifier.getNumTrees).alias("n_trees"), *values,
    )


def holdout_report(model: RiskModel, df: DataFrame, target: str, name: str = "final") -> DataFrame:
    """All metrics on rows the model did not see; absent features count as 0.0."""
    scored = model.probability(df).withColumn("model", F.lit(name))
    return evaluate(scored, target, "prediction")


def batch_score(
    model: RiskModel, features: DataFrame, key: str, job: str, scored_at: Column | None = None
) -> DataFrame:
    """(key, default_probability, risk_category, scoring_job, scored_at) for every row."""
    require_columns(features, [key])
    if features.isEmpty():
        raise ValueError("There are no rows to score.")
    scored = model.probability(features, "default_probability")
    return scored.select(
        key,
        "default_probability",
        risk_band(F.col("default_probability")).alias("risk_category"),
        F.lit(job).alias("scoring_job"),
        (F.current_timestamp() if scored_at is None else scored_at).alias("scored_at"),
    )


def score_statements(
    model: RiskModel, statements: DataFrame, spec: Spec, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Raw statements of any number of entities to scores, with how many statements each had."""
    require_columns(statements, [spec.id])
    built = build_features(statements, spec, model.features, hot_rows=hot_rows)
    counts = statements.groupBy(spec.id).agg(F.count(F.lit(1)).alias("n_statements"))
    scored = model.probability(built, "default_probability").select(spec.id, "default_probability")
    return scored.join(counts, spec.id).select(
        spec.id,
        "default_probability",
        risk_band(F.col("default_probability")).alias("risk_category"),
        "n_statements",
        F.lit(len(set(built.columns) - {spec.id, spec.target})).alias("n_engineered_features"),
    )


def tiered_score(
    model: RiskModel, requests: DataFrame, cache: DataFrame, table: DataFrame, key: str
) -> DataFrame:
    """Score each requested key from the cache, else the table; without data the score is NULL."""
    found = tiered_values(requests, cache, table, key, model.features)
    known = F.col("tier_used") != "INSUFFICIENT_DATA"
    wide = found.select(key, "tier_used", *[F.get("values", F.lit(i)).alias(n) for i, n in enumerate(model.features)])
    scored = model.probability(wide, "_p")
    score = F.when(known, F.col("_p"))
    return scored.select(
        key, score.alias("risk_score"), risk_band(score).alias("risk_category"), "tier_used"
    )


def draw_params(trial: int, seed: int = SEED, space: Mapping = SEARCH_SPACE) -> dict:
    """Parameters of one trial, the same for the same seed whatever runs before it."""
    rng = random.Random(f"{seed}/{trial}")
    drawn = {}
    for name, (low, high, kind) in space.items():
        if kind == "int":
            drawn[name] = rng.randint(int(low), int(high))
        elif kind == "log":
            drawn[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            drawn[name] = rng.uniform(low, high)
    if "featureSubsetStrategy" in drawn:
        drawn["featureSubsetStrategy"] = str(round(drawn["featureSubsetStrategy"], 4))
    return drawn


def search(
    df: DataFrame,
    key: str,
    target: str,
    *,
    trials: int = 25,
    folds: int = 3,
    rounds: int = 700,
    metric: str = "roc_auc",
    space: Mapping = SEARCH_SPACE,
    seed: int = SEED,
    parallelism: int = 4,
) -> DataFrame:
    """Random search: (trial, params, mean metrics over folds, score, best) for every trial."""
    if metric not in ("roc_auc", "pr_auc"):
        raise ValueError("The search metric is roc_auc or pr_auc.")
    data = FoldData.of(df, key, target, folds, seed)
    results = []
    try:
        for trial in range(trials):
            params = draw_params(trial, seed, space)
            run = data.run(["boosted_trees"], rounds, {"boosted_trees": params}, parallelism)
            means = run.fold_metrics(target).agg(*[F.avg(m).alias(m) for m in FOLD_METRICS]).first()
            results.append((trial, json.dumps(params), *[means[m] for m in FOLD_METRICS]))
    finally:
        data.rows.unpersist()
    schema = "trial int, params string, " + ", ".join(f"mean_{m} double" for m in FOLD_METRICS)
    table = df.sparkSession.createDataFrame(results, schema).withColumn("score", F.col(f"mean_{metric}"))
    values = [r[2 + FOLD_METRICS.index(metric)] for r in results]
    best = max(range(len(values)), key=lambda i: -math.inf if values[i] is None else values[i])
    return table.withColumn("best", F.col("trial") == best)


def best_params(trials: DataFrame) -> dict:
    return json.loads(trials.where("best").first()["params"])


def search_result(trials: DataFrame, metric: str) -> dict:
    """What a search found, as a document: metric, number of trials, best trial, its score, its mean metrics
    over folds and its parameters."""
    best = trials.where("best").first()
    means = {f"mean_{m}": best[f"mean_{m}"] for m in FOLD_METRICS}
    return {
        "metric": metric, "n_trials": trials.count(), "best_trial": best["trial"], "best_score": best["score"], **means,
        "best_params": json.loads(best["params"]),
    }


def explained_rows(
    df: DataFrame, oof: DataFrame, key: str, model: str, fold: int, n: int | None = None
) -> DataFrame:
    """Rows to explain a model on: those it was not fitted on, or ``n`` of them in hash order."""
    held_out = oof.where((F.col("model") == model) & (F.col("fold") == fold)).select(key)
    rows = df.join(held_out, key, "left_semi")
    return rows if n is None else sample_n(rows, key, n)


def permutation_importance(
    model: RiskModel, df: DataFrame, key: str, target: str, top: int = 20, seed: int = SEED
) -> DataFrame:
    """How much ROC-AUC falls when one feature's values are shuffled between rows.

    Every row gets a donor: the row with the same rank in a second seeded hash order.
    A row then appears once per feature the trees split on, with that one entry of its vector
    taken from the donor, so these features are scored in one transform and ranked in
    one job.  No score depends on the others: their importance is 0 and costs nothing.
    """
    used = [i for i, w in enumerate(model.classifier.featureImportances.toArray()) if w > 0]
    idle = [n for i, n in enumerate(model.features) if i not in set(used)]
    encode = PipelineModel(model.stages.stages[:-1])
    shaped = encode.transform(with_inputs(df, model.numeric, model.text)).select(
        key, target, vector_to_array(FEATURES).alias("_own")
    )
    receivers = hash_rank(shaped, [], [key], f"{seed}/a", rank="_rank").drop("_rank_of")
    donors = hash_rank(shaped, [], [key], f"{seed}/b", rank="_rank").select("_rank", F.col("_own").alias("_other"))
    paired = receivers.join(donors, "_rank")
    # place -1 is the row as it is
    places = paired.withColumn("_at", F.explode(F.array(*[F.lit(i) for i in (-1, *used)])))
    swapped = F.transform("_own", lambda v, i: F.when(i == F.col("_at"), F.get("_other", i)).otherwise(v))
    rows = places.select(target, "_at", array_to_vector(swapped).alias(FEATURES))
    scored = model.classifier.transform(rows).select(
        target, "_at", vector_to_array("probability")[1].alias("prediction")
    )
    auc = ranking_metrics(scored, target, "prediction", ["_at"])
    # one row per feature: the intact score rides along as a one-row aggregate
    packed = auc.agg(
        F.max(F.when(F.col("_at") == -1, F.col("roc_auc"))).alias("intact"),
        F.collect_list(F.struct("_at", "roc_auc")).alias("rows"),
    )
    names = F.array(*[F.lit(n) for n in model.features])
    drop = lambda r: F.struct(
        F.get(names, r["_at"]).alias("feature"), (F.col("intact") - r["roc_auc"]).alias("importance")
    )
    drops = F.transform(F.filter("rows", lambda r: r["_at"] >= 0), drop)
    zeros = [F.struct(F.lit(n).alias("feature"), (F.col("intact") * 0).alias("importance")) for n in idle]
    return (
        packed.select(F.inline(F.concat(drops, F.array(*zeros)) if zeros else drops))
        .orderBy(F.col("importance").desc(), "feature")
        .limit(top)
    )
