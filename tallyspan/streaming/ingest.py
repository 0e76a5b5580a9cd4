"""Statement messages: decode, validate, and fan out to history, change log and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from tallyspan.functions.scalar import decode_message, json_object, statement_cycle

CYCLE = "statement_cycle"


def read_messages(spark: SparkSession, path: str, schema: StructType | str, **options: str) -> DataFrame:
    """Messages from a growing folder of Parquet files."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def read_broker(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages from Kafka as (body, arrival, place).  Needs the Kafka connector on the classpath."""
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic).options(**options).load()
    )
    return source.select(
        F.col("value").cast("string").alias("body"), F.col("timestamp").alias("arrival"),
        F.col("offset").alias("place"),
    )


def message_text(body: Column, encoded: bool = True) -> Column:
    """The JSON text of a message; NULL where the base64 is bad."""
    return F.try_to_binary(body, F.lit("base64")).cast("string") if encoded else body


def decode(
    messages: DataFrame, schema: StructType, key: str, date: str, body: str = "body", encoded: bool = True,
    now: Column | None = None,
) -> DataFrame:
    """Add ``text``, ``statement`` (the parsed object), the key, the cycle, and ``reject``,
    the reason a message is unusable or NULL."""
    with_cycle = schema if CYCLE in schema.fieldNames() else StructType([*schema.fields]).add(CYCLE, StringType())
    parsed = messages.withColumn("text", message_text(F.col(body), encoded)).withColumn(
        "statement", decode_message(F.col("text"), with_cycle, encoded=False)
    )
    identity = F.col(f"statement.{key}")
    reject = (
        F.when(F.col(body).isNull() | (F.col(body) == ""), "message is missing data")
        .when(F.col("text").isNull(), "message is not base64")
        .when(~json_object(F.col("text")), "message is not a JSON object")
        .when(identity.isNull() | (identity.cast("string") == ""), f"message is missing {key}")
    )
    cycle = statement_cycle(
        F.col(f"statement.{CYCLE}"), F.get_json_object("text", f"$.{date}"), now
    )
    return parsed.withColumns({key: identity, CYCLE: cycle, "reject": reject})


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject").isNull())


def write_batch(decoded: DataFrame, batch_id: int, root: str, key: str, source: str) -> None:
    """One micro-batch to history, change log and rejects.

    Each goes to a folder named after the batch and replaces it, so a batch that is
    run again after a failure leaves no second copy.
    """
    kept = decoded.persist()
    try:
        good = accepted(kept)
        statement = good.select("statement.*").drop(CYCLE)
        columns = [F.col(f"statement.{c}") for c in statement.columns]
        _replace(good.select(*columns, CYCLE), root, "history", batch_id)
        _replace(
            good.select(
                key, CYCLE, F.lit(source).alias("source_table"), F.current_timestamp().alias("updated_at")
            ),
            root, "changes", batch_id,
        )
        rejected = kept.where(F.col("reject").isNotNull())
        _replace(rejected.select("body", "reject"), root, "rejects", batch_id)
    finally:
        kept.unpersist()


def _replace(df: DataFrame, root: str, name: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")


def start_ingest(
    messages: DataFrame, schema: StructType, root: str, checkpoint: str, key: str, date: str,
    source: str = "statement_history", encoded: bool = True, **trigger,
) -> StreamingQuery:
    """Run the fan-out over a stream of messages with a ``body`` column."""
    decoded = decode(messages, schema, key, date, encoded=encoded)
    return (
        decoded.writeStream.foreachBatch(lambda df, batch: write_batch(df, batch, root, key, source))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
