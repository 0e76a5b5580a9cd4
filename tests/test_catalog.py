"""Every registered query beside its SQL on the smallest data set."""

import importlib.util
from pathlib import Path

import duckdb
import pytest
from conftest import DATA

ROOT = Path(__file__).resolve().parents[1]


def module(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    loaded = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(loaded)
    return loaded


entry = module("__spark_entry__", ROOT / "__spark_entry__.py")
check = module("check", ROOT / "tools" / "check.py")
SLOW = {"oof_predictions", "final_model_importance", "permutation_importance", "search_trials"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    cursor = con.execute(entry.oracle_sql()[name])
    theirs, columns = cursor.fetchall(), [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    mine = check.rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert mine == check.rows_of(columns, theirs)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_rows_only(spark, name):
    assert entry.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
