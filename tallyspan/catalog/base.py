"""Registration, the shared fixtures over the given tables, and rounding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallyspan.spec import Spec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def nudge(digits: int) -> float:
    """Averages of cents over 32 rows end exactly on a rounding boundary, where the last
    bit of a sum decides.  Both sides add this before rounding to stay clear of it."""
    return float(f"3e-{digits + 2}")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, and -0.0 made 0.0, for comparison with another engine."""

    add = f"{nudge(digits):.{digits + 2}f}D"
    return df.selectExpr(
        *[
            f"round(`{f.name}` + {add}, {digits}) + 0.0D AS `{f.name}`"
            if isinstance(f.dataType, DoubleType)
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def r(expression: str, name: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"{rs(expression, digits)} AS {name}"


def rs(expression: str, digits: int = 6) -> str:
    return f"round({expression} + {nudge(digits):.{digits + 2}f}, {digits}) + 0.0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- events as statements -----------------------------------------------------------

EV_SPEC = Spec(
    "user_id", "ts", ("event_id",), continuous=("value", "k"), categorical=("event_type",), unique_order=True
)

EV_SQL = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events)"""

# every seventh value, and every fifth type, missing
EVN_SQL = f"""{EV_SQL}, evn AS (
  SELECT event_id, ts, user_id, k,
         CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type,
         CASE WHEN event_id % 7 <> 0 THEN value END AS value
  FROM ev)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))


def gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumns(
        {
            "event_type": F.when(F.col("event_id") % 5 != 0, F.col("event_type")),
            "value": F.when(F.col("event_id") % 7 != 0, F.col("value")),
        }
    )


# --- orders as statements -----------------------------------------------------------

OD_SPEC = Spec(
    "o_custkey", "o_orderdate", ("o_orderkey",), continuous=("o_totalprice",),
    categorical=("o_orderstatus", "o_orderpriority"), unique_order=True,
)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


# --- order lines as wide statements -------------------------------------------------

OL_SPEC = Spec(
    "o_custkey", "o_orderdate",
    ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
    continuous=("l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"),
    categorical=("l_returnflag", "l_linestatus"), unique_order=True,
)
OL_SQL = "ol AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, heads = table(spark, sf_dir, "lineitem"), orders(spark, sf_dir)
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))


# --- entities with labels -----------------------------------------------------------

LABEL_SQL = "lab AS (SELECT c_custkey, CAST(c_acctbal < 0 AS INTEGER) AS target FROM customer)"


def entity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = (F.col("c_acctbal") < 0).cast("int").alias("target")
    return table(spark, sf_dir, "customer").select("c_custkey", target)


# --- scored rows: two models with tied scores ---------------------------------------

SCORED_SQL = """scored AS (
  SELECT d.doc_id, l.quality AS target, floor(200.0 * n_chars / (n_chars + 2000.0)) / 200.0 AS prediction,
         CAST(d.doc_id % 5 + 1 AS INTEGER) AS fold, 'length' AS model
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  UNION ALL
  SELECT d.doc_id, l.quality, floor(50.0 * (1.0 - l.toxic * 0.5) * n_chars / (n_chars + 500.0)) / 50.0,
         CAST(d.doc_id % 5 + 1 AS INTEGER), 'toxicity'
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(
        table(spark, sf_dir, "labels"), "doc_id"
    )
    n, toxic = F.col("n_chars"), F.col("toxic")
    length = F.floor(200.0 * n / (n + 2000.0)) / 200.0
    toxicity = F.floor(50.0 * (1.0 - toxic * 0.5) * n / (n + 500.0)) / 50.0
    both = F.array(
        F.struct(length.alias("prediction"), F.lit("length").alias("model")),
        F.struct(toxicity.alias("prediction"), F.lit("toxicity").alias("model")),
    )
    return rows.select(
        "doc_id", F.col("quality").alias("target"), (F.col("doc_id") % 5 + 1).cast("int").alias("fold"),
        F.inline(both),
    ).select("doc_id", "target", "prediction", "fold", "model")


# --- importance: what each supplier part brings in, counted in whole units ----------

IMPORTANCE_SQL = """imp AS (
  SELECT 'part_' || CAST(l_partkey AS VARCHAR) AS feature, sum(l_quantity) AS importance
  FROM lineitem GROUP BY l_partkey)"""


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("importance"))
        .select(F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("feature"), "importance")
    )
