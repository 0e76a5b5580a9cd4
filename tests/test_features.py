"""The feature engine against a naive pandas computation, in every layout and path."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import DATA, plan_of
from pyspark.sql import functions as F

from tallyspan.catalog.base import EV_SPEC, gappy_events
from tallyspan.functions.names import NUMERIC_STATS
from tallyspan.operators.features import align_features, attach_labels, build_features
from tallyspan.operators.sequence import FROM_END, FROM_START, PREVIOUS, latest_rows, with_sequence
from tallyspan.spec import Spec

PATHS = [
    {"layout": "wide"},
    {"layout": "long"},
    {"layout": "wide", "hot_rows": 40},
    {"layout": "long", "hot_rows": 40},
]
SPEC = Spec("id", "day", ("seq",), continuous=("x", "y"), categorical=("c",))


def naive(pdf: pd.DataFrame, skip: bool) -> pd.DataFrame:
    """One entity at a time, straight from the definitions."""
    out = []
    for key, g in pdf.sort_values(["day", "seq"], na_position="first").groupby("id"):
        row = {"id": key}
        for c in ("x", "y"):
            v, present = g[c], g[c].dropna()
            row |= {f"{c}_{s}": getattr(v, s)() for s in ("mean", "std", "min", "max", "median")}
            pick = present if skip else v
            row[f"{c}_last"] = pick.iloc[-1] if len(pick) else np.nan
            row[f"{c}_first"] = pick.iloc[0] if len(pick) else np.nan
            for n in (3, 6):
                tail = v.tail(n)
                row |= {f"{c}_{s}_{n}m": getattr(tail, s)() for s in ("mean", "std", "min", "max")}
                pick = tail.dropna() if skip else tail
                row[f"{c}_last_{n}m"] = pick.iloc[-1] if len(pick) else np.nan
            d = v.diff()
            row |= {f"{c}_diff_{s}": getattr(d, s)() for s in ("mean", "std", "min", "max")}
            row[f"{c}_last_minus_mean"] = row[f"{c}_last"] - row[f"{c}_mean"]
        c = g["c"]
        row |= {"c_count": c.count(), "c_nunique": c.nunique()}
        pick = c.dropna() if skip else c
        row["c_last"] = pick.iloc[-1] if len(pick) else None
        out.append(row)
    return pd.DataFrame(out)


@pytest.fixture(scope="module")
def statements(spark):
    rng = np.random.default_rng(5)
    rows = []
    # entity "a" owns a third of the rows; "one" has a single row; "void" only missing values
    for key, n in [("a", 90), ("b", 41), ("c", 30), ("d", 13), ("one", 1), ("void", 5)]:
        for i in range(n):
            day = None if i == 3 else dt.date(2020, 1, 1) + dt.timedelta(days=int(rng.integers(0, 25)))
            x = None if key == "void" or rng.random() < 0.2 else round(float(rng.normal()), 3)
            y = None if key == "void" else float("nan") if rng.random() < 0.1 else float(rng.integers(0, 9))
            c = None if key == "void" or rng.random() < 0.3 else "pqrs"[int(rng.integers(0, 4))]
            rows.append((key, day, i, x, y, c))
    return spark.createDataFrame(rows, "id string, day date, seq int, x double, y double, c string").repartition(5)


def compared(result, expected):
    got = result.toPandas().sort_values("id").reset_index(drop=True)
    want = expected.sort_values("id").reset_index(drop=True)
    assert set(got.columns) == set(want.columns)
    for c in want.columns:
        if c in ("id", "c_last"):
            assert [None if pd.isna(v) else v for v in got[c]] == [None if pd.isna(v) else v for v in want[c]], c
        else:
            np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


@pytest.mark.parametrize("path", PATHS, ids=str)
@pytest.mark.parametrize("policy", ["row", "skip"])
def test_matches_naive(statements, path, policy):
    result = build_features(statements, SPEC, null_policy=policy, **path)
    compared(result, naive(statements.toPandas(), policy == "skip"))


def test_hot_path_on_copies(spark):
    """Identical rows of a hot entity are told apart, never merged or gathered."""
    rows = [("a", dt.date(2020, 1, 1 + i // 40), 0, float(i // 40), 1.0, "p") for i in range(200)]
    rows += [("b", dt.date(2020, 1, 1), 0, 2.0, 3.0, "q")]
    df = spark.createDataFrame(rows, "id string, day date, seq int, x double, y double, c string")
    compared(build_features(df, SPEC, hot_rows=50), naive(df.toPandas(), False))


def test_one_exchange(statements):
    for layout in ("wide", "long"):
        plan = plan_of(build_features(statements, SPEC, layout=layout, hot_rows=None))
        assert plan.count("Exchange hashpartitioning") == 1, plan
        assert "SinglePartition" not in plan


@pytest.mark.parametrize("layout", ["wide", "long"])
def test_tasks_follow_the_values_to_sort(statements, monkeypatch, layout):
    """Rows become one per column after the shuffle: 180 rows of three columns, ten values a task."""
    monkeypatch.setattr("tallyspan.operators.features.TASK_VALUES", 10)
    result = build_features(statements, SPEC, layout=layout)
    plan = plan_of(result)
    assert plan.count("Exchange hashpartitioning") == 1
    assert ", 54), REPARTITION_BY_NUM" in plan, plan
    compared(result, naive(statements.toPandas(), False))


def test_reads_only_needed_columns(spark):
    df = spark.read.parquet(f"{DATA}/lineitem.parquet")
    wanted = ["l_tax_mean", "l_tax_last"]
    spec = Spec("l_orderkey", "l_shipdate", ("l_linenumber",), categorical=("l_returnflag",), unique_order=True)
    plan = plan_of(build_features(df, spec, wanted, hot_rows=None))
    schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "l_tax" in schema and "l_quantity" not in schema and "l_returnflag" not in schema
    # an order that may repeat needs every value column to break ties
    tied = Spec("l_orderkey", "l_shipdate", ("l_linenumber",), categorical=("l_returnflag",))
    assert "l_quantity" in plan_of(build_features(df, tied, wanted, hot_rows=None)).split("ReadSchema:")[1].split("\n")[0]


def test_wanted_and_dialects(statements):
    some = build_features(statements, SPEC, ["x_mean", "c_nunique", "zz_mean", "nonsense"])
    assert some.columns == ["id", "x_mean", "c_nunique"]
    book = build_features(statements, SPEC, dialect="notebook")
    assert {"x_lag", "y_std_diff"} <= set(book.columns) and "x_last_minus_mean" not in book.columns
    assert set(build_features(statements, SPEC, ["x_lag", "y_std_diff"]).columns) == {"id", "x_lag", "y_std_diff"}


def test_approx(statements):
    for path in PATHS:
        got = build_features(statements, SPEC, ["y_median", "c_nunique"], approx=True, **path).toPandas()
        rows = statements.toPandas()
        for _, r in got.iterrows():
            ys = rows.loc[rows.id == r["id"], "y"].dropna()
            assert (len(ys) == 0 and pd.isna(r["y_median"])) or r["y_median"] in set(ys)
            assert r["c_nunique"] == rows.loc[rows.id == r["id"], "c"].nunique()


def test_no_columns_gives_ids(statements):
    bare = Spec("id", "day", ("seq",), continuous=(), categorical=())
    assert build_features(statements, bare).count() == 6


def test_absent_column_policy(statements):
    spec = Spec("id", "day", ("seq",), continuous=("x", "gone"), categorical=())
    assert "gone_mean" not in build_features(statements, spec).columns
    filled = build_features(statements, spec, missing="null")
    assert filled.where(F.col("gone_mean").isNotNull()).count() == 0


def test_text_dates_and_numbers(spark):
    rows = [("a", "2020-01-02", 0, "1.5"), ("a", "oops", 1, "7"), ("a", "2020-01-03", 2, "n/a")]
    df = spark.createDataFrame(rows, "id string, day string, seq int, x string")
    got = build_features(df, Spec("id", "day", ("seq",), continuous=("x",))).first()
    assert got["x_first"] == 7.0 and got["x_last"] is None and got["x_mean"] == 4.25


def test_target_carried(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2020, 1, 1), 1.0, 1), ("a", dt.date(2020, 1, 2), 2.0, 1)], "id string, day date, x double, t int"
    )
    got = build_features(df, Spec("id", "day", target="t"))
    assert got.first()["t"] == 1 and "t_mean" not in got.columns


def test_labels(spark):
    features = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, f double")
    labels = spark.createDataFrame([("a", 1), ("z", 0)], "id string, target int")
    assert attach_labels(features, labels, "id").count() == 2
    assert attach_labels(features, labels, "id", "inner").count() == 1
    with pytest.raises(ValueError, match="repeat"):
        attach_labels(features, labels.union(labels), "id")
    with pytest.raises(ValueError, match="Missing"):
        build_features(features, Spec("id", "day"))


def test_align(spark):
    df = spark.createDataFrame([("a", None, float("nan"))], "id string, p double, q double")
    kept = align_features(df, "id", ["q", "p", "r"]).first()
    assert kept["p"] is None and kept["r"] == 0.0
    assert list(align_features(df, "id", ["q", "p", "r"], null_as=0.0).first()) == ["a", 0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        align_features(df, "id", [])


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_sequence(statements, hot_rows):
    rows = with_sequence(statements, SPEC, F.col("x"), hot_rows).toPandas()
    for _, g in rows.groupby("id"):
        g = g.sort_values(["day", "seq"], na_position="first")
        assert list(g[FROM_START]) == list(range(1, len(g) + 1))
        assert list(g[FROM_END]) == list(range(len(g), 0, -1))
        np.testing.assert_allclose(g[PREVIOUS].astype(float), g["x"].shift().astype(float))


def test_latest_rows_limits_before_shuffle(statements):
    assert "WindowGroupLimit" in plan_of(latest_rows(statements, SPEC, 3))
    counts = latest_rows(statements, SPEC, 3).groupBy("id").count().toPandas()
    assert set(counts["count"]) == {1, 3}


def test_wide_table(spark):
    """Enough columns to choose the long layout; both layouts and the hot path agree."""
    base = gappy_events(spark, DATA)
    many = base.select("user_id", "ts", "event_id", "event_type", *[(F.col("value") * (i + 1)).alias(f"v{i}") for i in range(12)])
    spec = Spec("user_id", "ts", ("event_id",), categorical=("event_type",), unique_order=True)
    auto = build_features(many, spec)
    assert len(auto.columns) == 1 + 12 * len(NUMERIC_STATS) + 3
    frames = [
        build_features(many, spec, **p).toPandas().sort_values("user_id").reset_index(drop=True)
        for p in ({}, {"layout": "wide"}, {"hot_rows": 60})
    ]
    for other in frames[1:]:
        pd.testing.assert_frame_equal(frames[0], other[frames[0].columns], check_dtype=False, rtol=1e-9)


def test_events_hot_equals_usual(spark):
    rows = gappy_events(spark, DATA)
    a, b = (
        build_features(rows, EV_SPEC, hot_rows=h).toPandas().sort_values("user_id").reset_index(drop=True)
        for h in (None, 65)
    )
    pd.testing.assert_frame_equal(a, b[a.columns], check_dtype=False, rtol=1e-9)


def test_bucketed_statements_are_not_shuffled(spark, statements):
    from tallyspan.sources.writers import write_bucketed

    write_bucketed(statements, "t_bucketed", "id", ["day", "seq"], 4)
    built = build_features(spark.table("t_bucketed"), SPEC, hot_rows=None)
    assert "Exchange" not in plan_of(built)
    compared(built, naive(statements.toPandas(), False))


def test_ties_have_one_answer(spark):
    """The same features whatever the partitioning, the layout and the path for large entities."""
    import math

    from pyspark.sql import functions as F

    rows = [(k % 2, f"2024-01-{1 + k // 10:02d}", float(k * 7919 % 23) if k % 9 else math.inf, f"c{k % 3}") for k in range(60)]
    df = spark.createDataFrame(rows, "id int, d string, x double, c string").withColumn("d", F.to_date("d"))
    spec = Spec("id", "d", continuous=("x",), categorical=("c",))
    results = []
    for parts in (1, 3, 7):
        for layout in ("wide", "long"):
            for hot in (None, 5):
                built = build_features(df.repartition(parts), spec, layout=layout, hot_rows=hot)
                # sums of infinities are NaN on either path; the order shows in the others
                picked = [c for c in built.columns if c.endswith(("_first", "_last", "_median", "_count", "_nunique"))]
                results.append(sorted(map(tuple, built.select("id", *picked).collect())))
    assert all(r == results[0] for r in results)
