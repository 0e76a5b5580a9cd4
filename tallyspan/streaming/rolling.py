"""Features kept fresh from a stream: the last statements of each entity as keyed state."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StringType, StructType

from tallyspan.operators.features import align_features, build_features
from tallyspan.sources.store import Store
from tallyspan.spec import Spec
from tallyspan.streaming.ingest import CYCLE, accepted, decode

# Fixed value: how many arrivals an entity's window holds.
HISTORY_LIMIT = 13

WINDOW_SCHEMA = "key string, place int, cycle string, text string"
STATE_SCHEMA = "arrivals array<bigint>, places array<bigint>, cycles array<string>, texts array<string>"


def newest_per_chunk(chunks: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    """Before the shuffle: of each Arrow chunk only an entity's newest rows can matter."""
    for chunk in chunks:
        ordered = chunk.sort_values(["arrival", "place"], kind="stable")
        yield ordered.groupby("key", sort=False).tail(limit)


def roll(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState, limit: int) -> Iterator[pd.DataFrame]:
    """Merge the new arrivals into the entity's window, oldest out, and emit the window.

    Memory holds one chunk and the window.  Files of a source may be read out of order,
    so the window is kept by arrival stamp, not by the order of micro-batches.
    """
    window: list[tuple] = list(zip(*state.get)) if state.exists else []
    heapq.heapify(window)
    for chunk in chunks:
        for row in chunk[["arrival", "place", "cycle", "text"]].itertuples(index=False):
            entry = (int(row.arrival), int(row.place), row.cycle, row.text)
            if len(window) < limit:
                heapq.heappush(window, entry)
            else:
                heapq.heappushpop(window, entry)
    window.sort()
    arrivals, places, cycles, texts = (list(column) for column in zip(*window))
    state.update((arrivals, places, cycles, texts))
    yield pd.DataFrame(
        {"key": key[0], "place": range(1, len(texts) + 1), "cycle": cycles, "text": texts}
    )


def rolling_windows(
    decoded: DataFrame, key: str, arrival: str, place: str, limit: int = HISTORY_LIMIT,
    dedupe_within: str | None = None,
) -> DataFrame:
    """(key, place, cycle, text): the last ``limit`` arrivals of every entity a micro-batch touched.

    A redelivered message counts twice, as arrivals are what is counted, unless
    ``dedupe_within`` (a watermark delay) asks to drop repeats of key and cycle.
    """
    rows = accepted(decoded)
    if dedupe_within is not None:
        rows = rows.withWatermark(arrival, dedupe_within).dropDuplicatesWithinWatermark([key, CYCLE])
    narrow = rows.select(
        F.col(key).cast("string").alias("key"),
        # a message without a stamp counts as the oldest, instead of stopping the stream
        F.coalesce(F.unix_micros(F.col(arrival).cast("timestamp")), F.lit(0)).alias("arrival"),
        F.coalesce(F.col(place).cast("bigint"), F.lit(0)).alias("place"), F.col(CYCLE).alias("cycle"), "text",
    )
    reduced = narrow.mapInPandas(lambda chunks: newest_per_chunk(chunks, limit), narrow.schema)
    return reduced.groupBy("key").applyInPandasWithState(
        lambda k, chunks, state: roll(k, chunks, state, limit),
        WINDOW_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout,
    )


def window_features(
    windows: DataFrame, schema: StructType, spec: Spec, wanted: Sequence[str], now: Column | None = None
) -> DataFrame:
    """(key, statement_cycle, features map, selected_feature_count, updated_at) per entity.

    The same feature code as in batch, over at most ``limit`` rows per entity; the order
    is the statement date, arrival only breaks ties.  Missing values become 0.0.
    """
    if not wanted:
        raise ValueError("The feature list must not be empty.")
    parsed = windows.withColumn("s", F.from_json("text", schema))
    statements = parsed.select(F.col("key").alias("_entity"), "place", "s.*").drop(spec.id)
    statements = statements.withColumnRenamed("_entity", spec.id)
    local = Spec(spec.id, spec.date, (*spec.tiebreak, "place"), None, spec.continuous, spec.categorical, True)
    built = align_features(
        build_features(statements, local, wanted, hot_rows=None), spec.id, wanted, 0.0, 0.0
    )
    pairs = [x for n in wanted for x in (F.lit(n), F.col(n).cast("double"))]
    newest = windows.groupBy(F.col("key").alias(spec.id)).agg(F.max_by("cycle", "place").alias(CYCLE))
    return built.join(newest, spec.id).select(
        spec.id, CYCLE, F.create_map(*pairs).alias("features"),
        F.lit(len(wanted)).alias("selected_feature_count"),
        (F.current_timestamp() if now is None else now).alias("updated_at"),
    )


def vector_store(spark: SparkSession, root: str, key: str) -> Store:
    """The newest vector of each entity: a bucketed base and the last few batches."""
    return Store(spark, f"{root}/vectors", key)


def write_vectors(windows: DataFrame, batch_id: int, root: str, schema, spec: Spec, wanted: Sequence[str]) -> None:
    """Vectors of the touched entities as one batch of the store; a replayed batch replaces itself."""
    kept = windows.persist()
    try:
        vectors = window_features(kept, schema, spec, wanted)
        vector_store(windows.sparkSession, root, spec.id).append(vectors, batch_id)
    finally:
        kept.unpersist()


def read_vectors(spark: SparkSession, root: str, key: str) -> DataFrame:
    """The newest vector of each entity.  What is read does not grow with the number of batches."""
    return vector_store(spark, root, key).read()


def compact_vectors(spark: SparkSession, root: str, key: str, target: str) -> None:
    """The newest vectors as the first version of a fresh root, to move or to copy a store."""
    vector_store(spark, target, key).replace(read_vectors(spark, root, key))


def start_features(
    messages: DataFrame, schema: StructType, spec: Spec, wanted: Sequence[str], root: str, checkpoint: str,
    arrival: str = "arrival", place: str = "place", limit: int = HISTORY_LIMIT,
    dedupe_within: str | None = None, encoded: bool = True, **trigger,
) -> StreamingQuery:
    """Keep the feature vectors of a stream of statement messages fresh."""
    wide = StructType([*schema.fields])
    if CYCLE not in wide.fieldNames():
        wide = wide.add(CYCLE, StringType())
    decoded = decode(messages, schema, spec.id, spec.date, encoded=encoded)
    windows = rolling_windows(decoded, spec.id, arrival, place, limit, dedupe_within)
    return (
        windows.writeStream.outputMode("update")
        .foreachBatch(lambda df, batch: write_vectors(df, batch, root, wide, spec, wanted))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
