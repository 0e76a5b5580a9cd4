"""Drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.catalog.base import EV_SPEC, EV_SQL, events, query, r, rounded
from tallyspan.catalog.features import numeric_sql, sequence_sql
from tallyspan.functions.names import NUMERIC_STATS, feature_name
from tallyspan.operators.drift import (
    drift_alerts, drift_report, long_values, psi, psi_bins, quantile_edges,
)
from tallyspan.plans.drift import compare_windows

# Per-feature alert thresholds of this catalogue.
ALERTS = {"value": 0.3, "k": 0.05}

# the first twenty days against the rest, with every value of the rest scaled up
SIDES_SQL = f"""{EV_SQL}, base AS (SELECT user_id, value, k FROM ev WHERE ts < TIMESTAMP '2024-01-21'),
curr AS (SELECT user_id, value * 1.5 AS value, k FROM ev WHERE ts >= TIMESTAMP '2024-01-21')"""


def sides(spark, sf_dir):
    rows = events(spark, sf_dir)
    edge = F.lit("2024-01-21").cast("timestamp_ntz")
    base = rows.where(F.col("ts") < edge).select("user_id", "value", "k")
    current = rows.where(F.col("ts") >= edge).select("user_id", (F.col("value") * 1.5).alias("value"), "k")
    return base, current


def psi_sql(base: str, current: str, columns: list[str], bins: int = 10) -> str:
    probs = ", ".join(f"{i / bins}" for i in range(bins + 1))
    longs = lambda t: " UNION ALL ".join(
        f"SELECT '{c}' AS feature_name, CAST({c} AS DOUBLE) AS v FROM {t} WHERE {c} IS NOT NULL" for c in columns
    )
    names = ", ".join(f"('{c}')" for c in columns)
    return f"""bl AS ({longs(base)}), cl AS ({longs(current)}),
edges AS (SELECT feature_name, list_sort(list_distinct(quantile_cont(v, [{probs}]))) AS e FROM bl GROUP BY feature_name),
grid AS (SELECT feature_name, e, unnest(range(len(e) - 1)) AS bin FROM edges WHERE len(e) >= 2),
spans AS (SELECT feature_name, bin, e[bin + 1] AS lower, e[bin + 2] AS upper, bin = len(e) - 2 AS closed FROM grid),
bn AS (SELECT s.feature_name, bin, count(v) AS n FROM spans s LEFT JOIN bl ON bl.feature_name = s.feature_name
  AND v >= lower AND (v < upper OR (closed AND v = upper)) GROUP BY ALL),
cn AS (SELECT s.feature_name, bin, count(v) AS n FROM spans s LEFT JOIN cl ON cl.feature_name = s.feature_name
  AND v >= lower AND (v < upper OR (closed AND v = upper)) GROUP BY ALL),
bins AS (SELECT s.feature_name, s.bin, lower, upper, bn.n AS baseline_n, cn.n AS current_n FROM spans s
  JOIN bn ON bn.feature_name = s.feature_name AND bn.bin = s.bin JOIN cn ON cn.feature_name = s.feature_name AND cn.bin = s.bin),
shares AS (SELECT feature_name,
    CASE WHEN baseline_n = 0 THEN 0.0001 ELSE baseline_n / greatest(sum(baseline_n) OVER w, 1) END AS b,
    CASE WHEN current_n = 0 THEN 0.0001 ELSE current_n / greatest(sum(current_n) OVER w, 1) END AS c
  FROM bins WINDOW w AS (PARTITION BY feature_name)),
idx AS (SELECT feature_name, sum((c - b) * ln(c / b)) AS psi FROM shares GROUP BY feature_name),
psi AS (SELECT f.feature_name, coalesce(idx.psi, 0.0) AS psi,
    (SELECT count(*) FROM bl WHERE bl.feature_name = f.feature_name) AS baseline_rows,
    (SELECT count(*) FROM cl WHERE cl.feature_name = f.feature_name) AS current_rows
  FROM (VALUES {names}) AS f(feature_name) LEFT JOIN idx ON idx.feature_name = f.feature_name)"""


TWO_SIDES_SQL = f"{SIDES_SQL}, {psi_sql('base', 'curr', ['value', 'k'])}"
REPORT_TAIL = """CAST(0.2 AS DOUBLE) AS threshold, baseline_rows, current_rows"""


EDGES_SQL = f"""WITH {TWO_SIDES_SQL} SELECT feature_name, CAST(i - 1 AS BIGINT) AS place, {r("e[i]", "edge")}
FROM (SELECT feature_name, e, unnest(range(1, len(e) + 1)) AS i FROM edges)"""


def _edges(spark, sf_dir, **options):
    edges = quantile_edges(long_values(sides(spark, sf_dir)[0], ["value", "k"]), **options)
    rows = edges.select("feature_name", F.posexplode("edges").alias("place", "edge"))
    return rounded(rows.withColumn("place", F.col("place").cast("bigint")))


@query("quantile_edges", EDGES_SQL)
def quantile_edges_query(spark, sf_dir):
    return _edges(spark, sf_dir)


@query("quantile_edges_hot", EDGES_SQL)
def quantile_edges_hot(spark, sf_dir):
    """Every feature counts as large: running counts along range slices."""
    return _edges(spark, sf_dir, hot_rows=100)


@query(
    "psi_bins",
    f"""WITH {TWO_SIDES_SQL} SELECT feature_name, CAST(bin AS INTEGER) AS bin, {r("lower", "lower")}, {r("upper", "upper")},
  baseline_n, current_n FROM bins""",
)
def psi_bins_query(spark, sf_dir):
    return rounded(psi_bins(*sides(spark, sf_dir), ["value", "k"]))


@query("psi", f"WITH {TWO_SIDES_SQL} SELECT feature_name, {r('psi', 'psi')}, baseline_rows, current_rows FROM psi")
def psi_query(spark, sf_dir):
    return rounded(psi(*sides(spark, sf_dir), ["value", "k"]))


@query(
    "drift_report",
    f"""WITH {TWO_SIDES_SQL} SELECT feature_name, {r('psi', 'psi')}, psi.psi > 0.2 AS drifted, {REPORT_TAIL},
  '2024-01-01' AS baseline_start_date, '2024-01-20' AS baseline_end_date,
  '2024-01-21' AS current_start_date, '2024-01-30' AS current_end_date FROM psi""",
)
def drift_report_query(spark, sf_dir):
    report = drift_report(
        *sides(spark, sf_dir), ["user_id"],
        baseline_dates=("2024-01-01", "2024-01-20"), current_dates=("2024-01-21", "2024-01-30"),
    )
    return rounded(report.drop("computed_at"))


@query(
    "drift_alerts",
    f"""WITH {TWO_SIDES_SQL} SELECT feature_name, {r('psi', 'psi')},
  CAST(CASE feature_name WHEN 'value' THEN 0.3 WHEN 'k' THEN 0.05 ELSE 0.2 END AS DOUBLE) AS alert_threshold,
  psi.psi > CASE feature_name WHEN 'value' THEN 0.3 WHEN 'k' THEN 0.05 ELSE 0.2 END AS alert FROM psi""",
)
def drift_alerts_query(spark, sf_dir):
    report = drift_report(*sides(spark, sf_dir), ["user_id"])
    return rounded(drift_alerts(report, ALERTS))


# drift of features rebuilt from two date windows
WINDOWED = {feature_name(c, s): numeric_sql(c)[s] for c in EV_SPEC.continuous for s in NUMERIC_STATS} | {
    "event_type_count": "count(event_type)", "event_type_nunique": "count(DISTINCT event_type)"
}


def _window_sql(name: str, condition: str) -> str:
    return f"""{name}_ev AS (SELECT * FROM ev WHERE {condition}),
{sequence_sql(f"{name}_ev", EV_SPEC, f"{name}_seq")},
{name} AS (SELECT user_id, {", ".join(f"{sql} AS {feature}" for feature, sql in WINDOWED.items())}
  FROM {name}_seq GROUP BY user_id)"""


@query(
    "windowed_drift",
    f"""WITH {EV_SQL}, {_window_sql("early", "CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-15'")},
{_window_sql("late", "CAST(ts AS DATE) BETWEEN DATE '2024-01-16' AND DATE '2024-01-30'")},
{psi_sql("early", "late", list(WINDOWED))}
SELECT feature_name, {r('psi', 'psi')}, psi.psi > 0.2 AS drifted, {REPORT_TAIL} FROM psi""",
)
def windowed_drift(spark, sf_dir):
    rows = events(spark, sf_dir)
    report = compare_windows(
        rows, EV_SPEC, ("2024-01-01", "2024-01-15"), ("2024-01-16", "2024-01-30"), list(WINDOWED)
    )
    return rounded(report.select("feature_name", "psi", "drifted", "threshold", "baseline_rows", "current_rows"))
