"""Collected rows, end to end: union, dedupe, balance, shard, merge with details, payloads, raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import ingest as I
from ..operators import ranking as R


def select_list_rows(parts: list[DataFrame], *, total: int = 0, seed: int = 0, shards: int = 1, index: int | None = None) -> DataFrame:
    """List rows (``row``, ``seq``) of all jobs: each code once, balanced over categories, numbered, of one shard."""
    rows = I.union_all(parts).withColumn("code", I.value(F.col("row"), "상품코드")).withColumn("category", I.value(F.col("row"), "수집카테고리"))
    rows = R.keep_first(rows, "code", [F.asc("seq")])
    rows = R.balanced_limit(rows, F.col("category"), R.seeded_order(seed, "code"), total)
    return I.shard(R.sequence_numbers(rows, [F.col("seq"), F.col("code")]), "code", shards, index)


def build_raw_rows(lists: DataFrame, details: DataFrame, *, provider: str, run_uuid: str, at: Column, source: str) -> DataFrame:
    """History rows of list rows with their details laid over."""
    merged = I.merge_list_detail(lists, details, "seq")
    payloads = (I.payload_b if provider == "kurly" else I.payload_a)(merged, run_uuid, at)
    return I.raw_rows(payloads, source)
