"""PSI against numpy, and its edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.operators.drift import drift_alerts, drift_report, psi, psi_bins


def numpy_psi(base, current, bins=10):
    edges = np.unique(np.quantile(base, np.linspace(0, 1, bins + 1)))
    if len(edges) < 2:
        return 0.0
    shares = []
    for side in (base, current):
        counts, _ = np.histogram(side, edges)
        part = counts / max(counts.sum(), 1)
        shares.append(np.where(part == 0, 0.0001, part))
    return float(np.sum((shares[1] - shares[0]) * np.log(shares[1] / shares[0])))


@pytest.fixture(scope="module")
def sides():
    rng = np.random.default_rng(8)
    base = {
        "same": rng.normal(size=500), "moved": rng.normal(size=500), "flat": np.full(500, 2.0),
        "lumpy": rng.integers(0, 3, 500).astype(float), "gone": rng.normal(size=500), "void": np.full(500, np.nan),
    }
    current = {
        "same": rng.normal(size=300), "moved": rng.normal(loc=2, size=300), "flat": rng.normal(size=300),
        "lumpy": rng.integers(0, 3, 300).astype(float), "gone": np.full(300, np.nan), "void": rng.normal(size=300),
    }
    return base, current


def frame(spark, side):
    names = list(side)
    rows = [(i, *[float(side[n][i]) for n in names]) for i in range(len(side["same"]))]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in names))


@pytest.mark.parametrize("hot_rows", [None, 100])
def test_psi(spark, sides, hot_rows):
    base, current = sides
    got = {
        r["feature_name"]: r
        for r in psi(frame(spark, base), frame(spark, current), list(base), hot_rows=hot_rows).collect()
    }
    for name in ("same", "moved", "flat", "lumpy"):
        assert got[name]["psi"] == pytest.approx(numpy_psi(base[name], current[name]), abs=1e-12), name
        assert (got[name]["baseline_rows"], got[name]["current_rows"]) == (500, 300)
    assert math.isnan(got["gone"]["psi"]) and math.isnan(got["void"]["psi"])
    assert got["gone"]["current_rows"] == 0 and got["void"]["baseline_rows"] == 0


def test_bins(spark, sides):
    base, current = sides
    got = psi_bins(frame(spark, base), frame(spark, current), ["moved", "flat", "lumpy"]).toPandas()
    assert set(got["feature_name"]) == {"moved", "lumpy"}
    for name in ("moved", "lumpy"):
        edges = np.unique(np.quantile(base[name], np.linspace(0, 1, 11)))
        mine = got[got.feature_name == name].sort_values("bin")
        assert list(mine["baseline_n"]) == list(np.histogram(base[name], edges)[0])
        assert list(mine["current_n"]) == list(np.histogram(current[name], edges)[0])
    outside = (current["moved"] > base["moved"].max()).sum()
    assert outside > 0 and got[got.feature_name == "moved"]["current_n"].sum() == 300 - outside


def test_report_and_alerts(spark, sides):
    base, current = (frame(spark, s) for s in sides)
    stamp = F.lit("2024-05-01 00:00:00").cast("timestamp")
    report = drift_report(
        base.withColumn("extra", F.lit(1.0)), current, ["id"], baseline_dates=("2024-01-01", None), computed_at=stamp
    )
    rows = report.collect()
    assert [r["feature_name"] for r in rows][0] == "moved"
    assert {r["feature_name"] for r in rows if r["drifted"]} == {"moved"}
    assert "extra" not in {r["feature_name"] for r in rows}
    assert rows[0]["baseline_start_date"] == "2024-01-01" and rows[0]["current_end_date"] is None
    alerts = {r["feature_name"]: r for r in drift_alerts(report, {"moved": 1e9, "same": 0.0}).collect()}
    assert not alerts["moved"]["alert"] and alerts["same"]["alert"] and alerts["lumpy"]["alert_threshold"] == 0.2
    assert not alerts["gone"]["alert"]
    assert drift_alerts(report, {}).count() == 6
