"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import platform
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A session on one machine that names none (tests) gets a temporary folder; on a cluster, where
    executors would each write to their own disk, that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage like a checkpoint does, but the copy is compressed, columnar and
    outlives any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key() -> Column:
    """128 bits of a document row (doc_id and text), to tell rows with equal or no doc_ids apart."""
    row = (F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return F.struct(F.xxhash64(*row).alias("a"), F.xxhash64(F.lit(1), *row).alias("b"))


ROW_KEY = T.StructType([T.StructField(c, T.LongType(), False) for c in "ab"])

_worker_memo: dict = {}
_libc = ctypes.CDLL("libc.so.6") if platform.libc_ver()[0] == "glibc" else None


def worker_memo(key: tuple, make: Callable[[], object]) -> object:
    """A memo that later tasks of the same Python worker use again.

    A worker has one at a time: the memo of another operator is dropped, so memory does not add up
    over the operators of a session.
    """
    if key not in _worker_memo:
        _worker_memo.clear()
        _worker_memo[key] = make()
    return _worker_memo[key]


def give_back() -> None:
    """Free memory of Arrow and of the C library goes back to the system: a worker lives on, and it counts."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def arrow_rows(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict[str, list] | Iterator[dict[str, list]] | None]], schema: T.StructType
) -> DataFrame:
    """``mapInArrow`` with one state object per task.

    ``make()`` runs once in each task and returns a function from a batch to output columns, or to several
    of them that go out one after the other.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            out = work(batch)
            for part in () if out is None else (out,) if isinstance(out, dict) else out:
                yield pa.RecordBatch.from_arrays([pa.array(part[f.name], type=f.type) for f in target], schema=target)
                del part
            del batch, out
            give_back()

    return df.mapInArrow(run, schema)


def ranked(df: DataFrame, key: str, order: list, salts: int, rank: str = "rank") -> DataFrame:
    """Number the rows of each ``key`` from 0 without bringing a whole key into one task.

    Rows are numbered inside (key, salt); the counts of the salts of a key, summed in salt
    order, give where each salt starts.  A key that holds a third of all rows is spread over
    ``salts`` tasks.
    """
    from pyspark.sql import Window as W

    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    starts = (
        salted.groupBy(key, "_salt")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.sum("_n").over(W.partitionBy(key).orderBy("_salt")) - F.col("_n"))
        .drop("_n")
    )
    inside = F.row_number().over(W.partitionBy(key, "_salt").orderBy(*order)) - 1
    return (
        salted.withColumn("_in", inside)
        .join(starts, [key, "_salt"])
        .withColumn(rank, (F.col("_start") + F.col("_in")).cast("long"))
        .drop("_salt", "_in", "_start")
    )
