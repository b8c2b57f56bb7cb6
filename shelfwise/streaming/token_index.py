"""Idempotent appends: rows whose content token is in the table already are left out.

The table is a folder for each append, and a row's token is one of its columns, so rows and tokens become
visible together when Spark writes the folder's ``_SUCCESS``.  A batch that is handed over again finds its own tokens
and adds what is missing.

Reading every token for every batch would grow with the table, so an index beside it holds the tokens of all but
the last few appends, in buckets by the token's first digits, one sorted file a bucket.  A batch reads the buckets of
its own tokens and the appends since the index was brought up to date.  Every ``every`` appends their tokens are
merged into the buckets that they touch; when buckets hold ``bucket_tokens`` on average, tokens are dealt out anew by
one more digit, so a bucket stays small however large the table becomes.  The index can be deleted at any time: it
is made again from the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import batch_token
from ..sources import files

#: Appends between two merges, and tokens of a bucket beyond which there are more buckets.
EVERY, BUCKET_TOKENS = 8, 1_000_000
DIGITS = 1
TOKEN = T.StructType([T.StructField("token", T.StringType())])


def _numbers(found: list[str], name: str) -> list[int]:
    return sorted(int(n.partition("=")[2]) for n in found if n.startswith(f"{name}="))


def appends(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the appends that are whole; one that was interrupted has no ``_SUCCESS``."""
    return [n for n in _numbers(files.names(spark, path), "append") if files.exists(spark, f"{path}/append={n}/_SUCCESS")]


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the table, with the number of their append."""
    return spark.read.option("basePath", path).parquet(*(f"{path}/append={n}" for n in appends(spark, path)))


def _index(path: str) -> str:
    return f"{path.rstrip('/')}-tokens"


def covered(spark: SparkSession, path: str) -> tuple[int, int]:
    """The last append whose tokens the index has (-1: none), and digits of its buckets."""
    found = [tuple(map(int, n.split("-")[1:])) for n in files.names(spark, f"{_index(path)}/covers") if n.startswith("upto-")]
    return max(found, default=(-1, DIGITS))


def _buckets(spark: SparkSession, path: str, digits: int, upto: int, wanted: list[str] | None = None) -> list[str]:
    """Folders of the newest version of buckets, no newer than the index says."""
    base, out = f"{_index(path)}/digits={digits}", []
    for bucket in wanted if wanted is not None else [n.partition("=")[2] for n in files.names(spark, base) if n.startswith("bucket=")]:
        versions = [v for v in _numbers(files.names(spark, f"{base}/bucket={bucket}"), "upto") if v <= upto]
        out += [f"{base}/bucket={bucket}/upto={versions[-1]}"] if versions else []
    return out


def seen_tokens(spark: SparkSession, path: str, tokens: DataFrame) -> DataFrame:
    """Stored tokens among which those of a batch are, if they are stored at all."""
    upto, digits = covered(spark, path)
    own = [r[0] for r in tokens.select(F.substring("token", 1, digits)).distinct().collect()]  # no more than buckets, or rows of the batch
    recent = [f"{path}/append={n}" for n in appends(spark, path) if n > upto]
    at = [*_buckets(spark, path, digits, upto, own), *recent]
    return spark.read.schema(TOKEN).parquet(*at) if at else spark.createDataFrame([], TOKEN)


def merge_index(spark: SparkSession, path: str, bucket_tokens: int = BUCKET_TOKENS) -> None:
    """Bring the index up to the last append.  What it replaces goes after the new state is announced."""
    upto, digits = covered(spark, path)
    last = [n for n in appends(spark, path) if n > upto]
    if not last:
        return
    recent = spark.read.schema(TOKEN).parquet(*(f"{path}/append={n}" for n in last))
    every = _buckets(spark, path, digits, upto)
    total, more = (spark.read.schema(TOKEN).parquet(*every).count() if every else 0) + recent.count(), digits
    while total > bucket_tokens * 16**more:
        more += 1
    bucket = F.substring("token", 1, more)
    touched = [r[0] for r in recent.select(bucket).distinct().collect()]  # no more than there are buckets
    old = every if more != digits else _buckets(spark, path, digits, upto, touched)
    merged = recent.unionByName(spark.read.schema(TOKEN).parquet(*old)) if old else recent
    rows = merged.select("token", bucket.alias("bucket"), F.lit(last[-1]).alias("upto")).repartition("bucket").sortWithinPartitions("bucket", "token")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "upto").parquet(f"{_index(path)}/digits={more}")
    files.create_once(spark, f"{_index(path)}/covers/upto-{last[-1]}-{more}", "")
    for name in files.names(spark, f"{_index(path)}/covers"):
        if name.startswith("upto-") and name != f"upto-{last[-1]}-{more}":
            files.delete(spark, f"{_index(path)}/covers/{name}")
    for folder in old:
        files.delete(spark, folder)


def append_once(path: str, table: str, payload: str = "payload", *, every: int = EVERY, bucket_tokens: int = BUCKET_TOKENS) -> Callable[[DataFrame, int], None]:
    """A publisher of micro-batches that adds each content once.  The table has one writer at a time."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("token", batch_token(table, F.col(payload))).dropDuplicates(["token"]).withColumn("batch_id", F.lit(number))
        new = rows.join(seen_tokens(spark, path, rows), "token", "left_anti")
        there = appends(spark, path)
        new.write.mode("overwrite").parquet(f"{path}/append={there[-1] + 1 if there else 0}")
        if len(there) + 1 - len([n for n in there if n <= covered(spark, path)[0]]) >= every:
            merge_index(spark, path, bucket_tokens)

    return write
