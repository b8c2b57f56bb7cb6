"""Structured Streaming: micro-batch publishing, enrichment, joins of streams, decoding and repeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import event_messages


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_a_batch: int = 1, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).format(fmt).load(path)


def publish(stream: DataFrame, publisher: Callable[[DataFrame, int], None], checkpoint: str, *, once: bool = True) -> StreamingQuery:
    """Hand every micro-batch to ``publisher``.  A batch that fails is handed over again, whole and
    under its number, when the query is started again on the same checkpoint."""
    writer = stream.writeStream.foreachBatch(publisher).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def enrich(stream: DataFrame, lists: DataFrame, key: str) -> DataFrame:
    """Finished detail rows with their list row: a stream and static left join."""
    return stream.join(lists, key, "left")


def encode(stream: DataFrame) -> DataFrame:
    """Envelopes as topic messages."""
    return event_messages(stream)


def decode(messages: DataFrame, event_type: str, envelope: T.StructType, payload: T.StructType) -> DataFrame:
    """Typed payloads of one event type from topic messages; broken ones have a null payload."""
    events = messages.select(F.from_json(F.col("value").cast("string"), envelope).alias("e")).select("e.*")
    return events.where(F.col("event_type") == event_type).withColumn("data", F.from_json("payload", payload))


def split_dead_letters(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to keep, and rows whose payload cannot be read."""
    return decoded.where(F.col("data").isNotNull()), decoded.where(F.col("data").isNull())


def drop_repeats(stream: DataFrame, id_col: str, time_col: str, within: str = "1 hour") -> DataFrame:
    """Each event once; the watermark bounds the state."""
    return stream.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, within).dropDuplicatesWithinWatermark([id_col])


def join_details(domestic: DataFrame, abroad: DataFrame, key: str, time_col: str, within: str, late: str) -> DataFrame:
    """Details of a product from two sites as they arrive, each once: together if their times lie ``within`` each
    other, alone once no partner can come any more.

    Watermarks on both sides bound the state: a row waits no longer than ``late`` and ``within``.  Columns of the two
    sides but the key and the time have different names.
    """
    a = domestic.withColumnRenamed(time_col, "_a").withWatermark("_a", late)
    b = abroad.withColumnsRenamed({key: "_key", time_col: "_b"}).withWatermark("_b", late)
    near = F.expr(f"_key = `{key}` AND _b >= _a - INTERVAL {within} AND _b <= _a + INTERVAL {within}")
    both = a.join(b, near, "full_outer")
    rest = [c for c in both.columns if c not in (key, "_key", "_a", "_b")]
    return both.select(F.coalesce(key, "_key").alias(key), F.coalesce("_a", "_b").alias(time_col), *rest)
