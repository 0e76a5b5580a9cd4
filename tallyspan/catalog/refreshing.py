"""Incremental refresh, upsert and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.catalog.base import EV_SPEC, EV_SQL, events, query, r, rounded, table
from tallyspan.catalog.features import DIGITS, sequence_sql
from tallyspan.operators.features import build_features
from tallyspan.operators.refresh import changed_keys, refresh_features, restrict_to_keys, tiered_lookup, upsert
from tallyspan.session import materialise
from tallyspan.sources.writers import serving_snapshot

# users with an error on the last day count as changed in that cycle; the days before
# belong to an older cycle of the log
LOG_SQL = """log AS (SELECT user_id, CASE WHEN ts >= TIMESTAMP '2024-01-30' THEN '2024-02' ELSE '2024-01' END AS statement_cycle
  FROM events WHERE event_type = 'error'),
changed AS (SELECT DISTINCT user_id FROM log WHERE statement_cycle = '2024-02')"""
WANTED = ["value_mean", "value_last", "value_mean_3m", "k_diff_max", "event_type_nunique", "balance_mean"]


def log(spark, sf_dir):
    late = F.col("ts") >= F.lit("2024-01-30").cast("timestamp_ntz")
    cycle = F.when(late, "2024-02").otherwise("2024-01").alias("statement_cycle")
    return events(spark, sf_dir).where("event_type = 'error'").select("user_id", cycle)


def changed(spark, sf_dir):
    return changed_keys(log(spark, sf_dir), "user_id", "2024-02")


def history(spark, sf_dir):
    """Statements with a column that never came."""
    return events(spark, sf_dir).withColumn("balance", F.lit(None).cast("double"))


@query("changed_keys", f"WITH {LOG_SQL} SELECT user_id FROM changed")
def changed_keys_query(spark, sf_dir):
    return changed(spark, sf_dir)


@query(
    "changed_history",
    f"WITH {LOG_SQL} SELECT event_id, user_id, event_type, value FROM events WHERE user_id IN (SELECT user_id FROM changed)",
)
def changed_history(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return restrict_to_keys(rows, changed(spark, sf_dir), "user_id").select(
        "event_id", "user_id", "event_type", "value"
    )


REFRESHED_COLUMNS_SQL = f"""{r("avg(value)", "value_mean", DIGITS)}, {r("max(value) FILTER (WHERE rd = 1)", "value_last", DIGITS)},
  {r("avg(value) FILTER (WHERE rd <= 3)", "value_mean_3m", DIGITS)}, {r("max(d_k)", "k_diff_max", DIGITS)},
  count(DISTINCT event_type) AS event_type_nunique, CAST(NULL AS DOUBLE) AS balance_mean"""
REFRESHED_SQL = f"""{LOG_SQL}, {EV_SQL}, mine AS (SELECT * FROM ev WHERE user_id IN (SELECT user_id FROM changed)),
{sequence_sql("mine", EV_SPEC)}, refreshed AS (SELECT user_id, {REFRESHED_COLUMNS_SQL} FROM seq GROUP BY user_id)"""


@query("refreshed_features", f"WITH {REFRESHED_SQL} SELECT * FROM refreshed")
def refreshed_features(spark, sf_dir):
    return rounded(refresh_features(history(spark, sf_dir), changed(spark, sf_dir), EV_SPEC, WANTED), DIGITS)


@query("refreshed_features_hot", f"WITH {REFRESHED_SQL} SELECT * FROM refreshed")
def refreshed_features_hot(spark, sf_dir):
    """The same where the larger of the changed users are cut into slices."""
    built = refresh_features(history(spark, sf_dir), changed(spark, sf_dir), EV_SPEC, WANTED, hot_rows=200)
    return rounded(built, DIGITS)


# the table to merge into: features of the users known before, one column the refresh does not touch
OLD_SQL = f"""{REFRESHED_SQL}, old AS (SELECT user_id, max(value) AS value_max, min(value) AS value_mean FROM events
  WHERE ts < TIMESTAMP '2024-01-02' GROUP BY user_id)"""


def _old(spark, sf_dir):
    early = F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")
    return events(spark, sf_dir).where(early).groupBy("user_id").agg(
        F.max("value").alias("value_max"), F.min("value").alias("value_mean")
    )


@query(
    "upsert_features",
    f"""WITH {OLD_SQL} SELECT coalesce(o.user_id, n.user_id) AS user_id, o.value_max,
  CASE WHEN n.user_id IS NOT NULL THEN n.value_mean ELSE o.value_mean END AS value_mean, n.value_last
FROM old o FULL JOIN refreshed n ON o.user_id = n.user_id""",
)
def upsert_features(spark, sf_dir):
    fresh = materialise(refreshed_features(spark, sf_dir))
    return upsert(_old(spark, sf_dir), fresh, "user_id", ["value_mean", "value_last"])


@query(
    "tiered_lookup",
    f"""WITH {OLD_SQL}, asked AS (SELECT DISTINCT c_custkey AS user_id FROM customer),
hit AS (SELECT user_id, value_mean, value_last FROM refreshed WHERE user_id % 3 <> 0)
SELECT a.user_id, CASE WHEN h.user_id IS NOT NULL THEN h.value_mean WHEN o.user_id IS NOT NULL THEN o.value_mean END AS value_mean,
  CASE WHEN h.user_id IS NOT NULL THEN h.value_last WHEN o.user_id IS NOT NULL THEN 0.0 END AS value_last,
  CASE WHEN h.user_id IS NOT NULL THEN 'realtime' WHEN o.user_id IS NOT NULL THEN 'fallback' ELSE 'INSUFFICIENT_DATA' END AS tier_used
FROM asked a LEFT JOIN hit h ON h.user_id = a.user_id LEFT JOIN old o ON o.user_id = a.user_id""",
)
def tiered_lookup_query(spark, sf_dir):
    """Cached vectors for the refreshed users, but an entry without features for every third."""
    names = ["value_mean", "value_last"]
    vector = F.create_map(F.lit(names[0]), F.col(names[0]), F.lit(names[1]), F.col(names[1]))
    cache = refreshed_features(spark, sf_dir).select(
        "user_id", F.when(F.col("user_id") % 3 != 0, vector).alias("features")
    )
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    found = tiered_lookup(asked, cache, _old(spark, sf_dir), "user_id", names)
    return found.select("user_id", *[F.col("features")[n].alias(n) for n in names], "tier_used")


@query(
    "serving_snapshot",
    f"""SELECT user_id, {r("avg(value)", "value_mean", DIGITS)}, {r("max(value)", "value_max", DIGITS)} FROM events GROUP BY user_id""",
)
def serving_snapshot_query(spark, sf_dir):
    built = build_features(events(spark, sf_dir), EV_SPEC, ["value_mean", "value_max", "value_min"])
    return rounded(serving_snapshot(built, "user_id", ["value_mean", "value_max"]), DIGITS)
