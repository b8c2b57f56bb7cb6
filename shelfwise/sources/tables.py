"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_path(spark: SparkSession, tag: str) -> str:
    """A new path in ``spark.checkpoint.dir``.

    A session on one machine that names none (tests) gets a temporary folder; on a cluster, where
    executors would each write to their own disk, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-work-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Written once and read back, so that every later use sees the same rows."""
    path = work_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, key: str, rows_a_task: int) -> DataFrame:
    """Rows dealt out by their key, about ``rows_a_task`` to a task and at least one task for every core.

    A scan is split by bytes, so a narrow table comes in one task however much work each of its rows is.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // rows_a_task))
    return rows.repartition(tasks, key)
