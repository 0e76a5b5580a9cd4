"""Keeping a feature table current: changed keys, key-restricted history, upsert, lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.names import raw_columns
from tallyspan.operators.features import align_features, build_features
from tallyspan.operators.skew import MAX_HOT_KEYS, split_hot
from tallyspan.session import materialise
from tallyspan.spec import HOT_ROWS, Spec, require_columns

# Where a looked-up feature vector came from.
TIER_CACHE = "realtime"
TIER_TABLE = "fallback"
TIER_NONE = "INSUFFICIENT_DATA"


def changed_keys(
    log: DataFrame, key: str, cycle: str | None = None, cycle_column: str = "statement_cycle"
) -> DataFrame:
    """Distinct non-NULL keys of the change log, of one cycle if given."""
    if cycle is not None:
        if cycle_column not in log.columns:
            raise ValueError(f"Cycle column {cycle_column!r} is missing from the change log.")
        log = log.where(F.col(cycle_column) == cycle)
    return log.select(key).where(F.col(key).isNotNull()).distinct()


def restrict_to_keys(
    history: DataFrame, keys: DataFrame, key: str, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """History rows of the given keys (semi-join; repeated keys repeat nothing).

    Rows of hot keys are matched against the few hot keys that were asked for, by
    broadcast, so they never gather in one join task.
    """
    # few keys: one pass over the history, no shuffle of it and no search for hot keys
    keys = materialise(keys.select(key).distinct())
    if keys.count() <= MAX_HOT_KEYS:
        return history.join(F.broadcast(keys), key, "left_semi")
    usual, hot = split_hot(history, [key], hot_rows)
    kept = usual.join(keys, key, "left_semi")
    if hot is None:
        return kept
    wanted_hot = hot.select(key).distinct().join(keys, key, "left_semi")
    return kept.unionByName(hot.join(F.broadcast(wanted_hot), key, "left_semi"))


def refresh_features(
    history: DataFrame, keys: DataFrame, spec: Spec, wanted: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Recompute the wanted features for the changed keys only, reading only the raw
    columns those features need.  Features no column can give are 0.0."""
    columns = raw_columns(wanted, always=[spec.id, *spec.order_columns])
    require_columns(history, columns)
    statements = restrict_to_keys(history.select(*columns), keys, spec.id, hot_rows)
    categorical = tuple(c for c in spec.categorical if c in columns)
    narrow = Spec(
        spec.id, spec.date, spec.tiebreak, None, None, categorical, spec.unique_order
    )
    return align_features(build_features(statements, narrow, wanted, hot_rows=hot_rows), spec.id, wanted)


def upsert(
    target: DataFrame, staging: DataFrame, key: str, columns: Sequence[str] | None = None,
    small_rows: int = MAX_HOT_KEYS,
) -> DataFrame:
    """The target with the staging rows merged in.

    Matched keys take the staging values of ``columns`` (NULLs too) and keep all else;
    new keys are added with the other columns NULL.  Both sides hold a key once, so no
    key can be hot.  A staging table of at most ``small_rows`` rows (counted) is
    broadcast and the target is not shuffled at all; a larger one is merged by a full
    outer join.
    """
    columns = [c for c in staging.columns if c != key] if columns is None else list(columns)
    require_columns(staging, [key, *columns])
    fresh = staging.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
    k = F.col(key)

    def merged(joined: DataFrame) -> DataFrame:
        matched = F.col("_new").isNotNull()

        def one(name: str):
            if name == key:
                return F.coalesce(k, F.col("_key")).alias(key)
            if name not in columns:
                return F.col(name)
            new = F.when(matched, F.col("_new")[name])
            return (new.otherwise(F.col(name)) if name in target.columns else new).alias(name)

        added = [c for c in columns if c not in target.columns]
        return joined.select(*[one(c) for c in [*target.columns, *added]])

    if staging.count() > small_rows:
        return merged(target.join(fresh, k == F.col("_key"), "full_outer"))
    small = F.broadcast(fresh)
    updated = merged(target.join(small, k == F.col("_key"), "left"))
    known = target.select(key).join(F.broadcast(staging.select(key)), key, "left_semi")
    new_rows = staging.join(known, key, "left_anti").select(key, *columns)
    return updated.unionByName(new_rows, allowMissingColumns=True)


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row per key along ``order``; combines before the shuffle."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def tiered_lookup(
    requests: DataFrame, cache: DataFrame, table: DataFrame, key: str, names: Sequence[str]
) -> DataFrame:
    """(key, features, tier_used) per distinct requested key.

    ``cache`` holds (key, features map) and wins when its map is not NULL, even empty;
    then the columns of ``table``; else NULL.  Names absent from a cached map are 0.0.
    Requests are made distinct first, so a key asked for many times is joined once.
    """
    found = tiered_values(requests, cache, table, key, names)
    features = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.col("values"))
    return found.select(key, features.alias("features"), "tier_used")


def tiered_values(
    requests: DataFrame, cache: DataFrame, table: DataFrame, key: str, names: Sequence[str]
) -> DataFrame:
    """As ``tiered_lookup``, with ``values``: an array in the order of ``names``, so that
    who wants columns reads each by its place."""
    asked = requests.select(key).distinct()
    cached = F.array(*[F.coalesce(F.col("features")[n], F.lit(0.0)) for n in names])
    hits = cache.where(F.col("features").isNotNull()).select(key, cached.alias("_cached"))
    have = set(table.columns)
    stored = table.select(
        key, F.array(*[F.col(n).cast("double") if n in have else F.lit(0.0) for n in names]).alias("_stored")
    )
    joined = asked.join(hits, key, "left").join(stored, key, "left")
    tier = (
        F.when(F.col("_cached").isNotNull(), TIER_CACHE)
        .when(F.col("_stored").isNotNull(), TIER_TABLE)
        .otherwise(TIER_NONE)
    )
    return joined.select(key, F.coalesce("_cached", "_stored").alias("values"), tier.alias("tier_used"))
