"""Sinks: raw history, events, snapshots, keyword mart, publication marker and report bundle.

Tables are Parquet folders.  Rows of a refresh go to a folder of its version and attempt, which readers see only
through the numbered marker that is written last (``read_published``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

MART_ROWS_A_FILE = 1_000_000


def append_history(rows: DataFrame, path: str) -> None:
    """Raw rows, by provider and day of collection."""
    rows.withColumn("collected_date", F.substring("collected_at", 1, 10)).write.mode("append").partitionBy("provider", "collected_date").parquet(path)


def event_messages(events: DataFrame) -> DataFrame:
    """``key, value`` of a topic: the whole envelope as JSON under its event key."""
    from ..functions.text import event_key

    key = event_key(F.col("event_type"), F.col("url"), F.col("event_uuid"))
    return events.select(key.alias("key"), F.to_json(F.struct(*events.columns)).alias("value"))


def write_topic(events: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Messages to any batch sink with key and value columns."""
    event_messages(events).write.format(fmt).options(**options).mode("append").save()


def write_snapshots(rows: DataFrame, path: str) -> None:
    """Rows of one attempt of a refresh, which no other attempt shares."""
    rows.write.mode("append").partitionBy("version", "attempt").parquet(path)


def write_mart(rows: DataFrame, path: str, rows_a_file: int = MART_ROWS_A_FILE) -> None:
    rows.write.mode("append").partitionBy("version", "attempt").option("maxRecordsPerFile", rows_a_file).parquet(path)


class PublishConflict(RuntimeError):
    """Another refresh was published since this one began."""


def marker_head(spark: SparkSession, path: str) -> int:
    """The number of the last marker; 0 if there is none."""
    return max((int(n.partition(".")[0]) for n in files.names(spark, path) if n.endswith(".json") and n[0] != "."), default=0)


def write_marker(spark: SparkSession, marker: dict, path: str, head: int) -> int:
    """Publish by making the marker after ``head``, which the refresh saw when it began.

    The file is made whole and by one writer alone: of two refreshes that began at one marker, one is published,
    and the other one is told so.
    """
    number = head + 1
    text = json.dumps(marker | {"number": number}, ensure_ascii=False)
    if marker_head(spark, path) != head or not files.create_once(spark, f"{path}/{number:012d}.json", text):
        raise PublishConflict(f"marker {number} was made by another refresh")
    return number


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    fields = ("refresh_uuid", "attempt", "generated_at", "source_max_collected_at", "published_at")
    counts = ("number", "version", "source_product_count", "expected_scope_count", "snapshot_scope_count", "keyword_scope_count", "keyword_row_count")
    schema = ", ".join([*(f"{c} string" for c in fields), *(f"{c} long" for c in counts)])
    return spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", "[0-9]*.json").json(path)


def read_published(spark: SparkSession, table: str, markers: str) -> DataFrame:
    """The rows of the attempt that the latest marker names; no marker, no rows."""
    last = read_markers(spark, markers).groupBy().agg(F.max_by(F.struct("version", "attempt"), "number").alias("m")).select("m.*").where("version is not null")
    return spark.read.parquet(table).join(F.broadcast(last), ["version", "attempt"], "left_semi")  # one row


def write_report(path: str, **sheets: DataFrame) -> None:
    """Each sheet as a CSV folder of its name."""
    for name, rows in sheets.items():
        flat = [F.array_join(c, "|").alias(c) if t.startswith("array<string") else F.to_json(c).alias(c) if t.startswith(("map", "struct", "array")) else F.col(c) for c, t in rows.dtypes]
        rows.select(*flat).write.mode("overwrite").option("header", True).option("escape", "\"").csv(f"{path}/{name}")


def write_events(rows: DataFrame, *, mode: str, path: str, allow_empty: bool = False, **options: str) -> None:
    """``mode`` is ``table``, ``topic`` or ``report``; an empty result is an error unless allowed."""
    if not allow_empty and rows.isEmpty():
        raise ValueError("nothing was collected")
    if mode == "table":
        append_history(rows, path)
    elif mode == "topic":
        write_topic(rows, **{"fmt": "kafka"} | options)
    elif mode == "report":
        write_report(path, rows=rows)
    else:
        raise ValueError(f"unknown sink {mode!r}")
