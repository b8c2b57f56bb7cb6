"""The registered queries of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, conversation_repair, decontamination, embedding_dedup, fingerprints, language_id, licenses, line_dedup, packing, pii, simhash, url_filter
from .common import read


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pair_paths() -> tuple[str, str]:
    """The two vocabularies that operator 11 aligns."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), slop=20)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"), with_runs=True).select(
        "doc_id", "held_out", "lang_pred", "score", F.size("runs").cast("long").alias("n_runs")
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.deduplicate(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "text", "n_lines", "n_removed_lines", "n_removed_chunks")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read(spark, sf_dir, "documents"))
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",")
    best = F.array_max(F.transform("matches", lambda m: m["dice"]))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), names.alias("licenses"), best.alias("best_dice"), F.to_json("matches").alias("matches"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, fetched at times that follow from their ids.  The dated list comes from
    the events: each lists, or takes off, the host (odd ids) or site (even ids) of one page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(2592000)))
    n_pages = pages.count()
    host = url_filter.host_of(F.col("url"))
    events = read(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    key = F.when(F.col("event_id") % 2 == 1, F.concat(F.lit("host:"), host)).otherwise(F.concat(F.lit("site:"), url_filter.site_of(host)))
    entries = (
        events.withColumn("page_id", F.col("event_id") % F.lit(max(1, n_pages)))
        .join(pages, "page_id")
        .select(key.alias("key"), "ts", F.col("event_id").alias("entry_id"), F.col("event_type").isin("error", "purchase").alias("listed"))
    )
    done = url_filter.filter_captures(pages.withColumn("fetched_at", fetched), entries)
    return done.select("page_id", "url", F.unix_seconds("fetched_at").alias("fetched_at"), "blocked", "entry_ids")


OP9_SQL = """
WITH p AS (
  SELECT page_id, url, 1704067200 + (page_id * 7919) % 2592000 AS fetched_at,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host
  FROM pages),
k AS (SELECT page_id, host, regexp_replace(host, '^(www|m|blog)[.]', '') AS site FROM p),
e AS (
  SELECT CASE WHEN event_id % 2 = 1 THEN 'host:' || host ELSE 'site:' || site END AS key, epoch_us(ts) AS ts,
    event_id, event_type IN ('error', 'purchase') AS listed
  FROM events JOIN k ON event_id % (SELECT count(*) FROM pages) = page_id),
last AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY key, ts ORDER BY event_id DESC) = 1),
i AS (SELECT key, event_id, listed, ts AS valid_from, lead(ts) OVER (PARTITION BY key ORDER BY ts) AS valid_to FROM last),
a AS (
  SELECT page_id, 'host:' || host AS key FROM k WHERE host <> '' UNION ALL
  SELECT page_id, 'site:' || array_to_string(string_split(host, '.')[unnest(range(1, greatest(len(string_split(host, '.')), 2))):], '.') FROM k WHERE host <> ''),
h AS (
  SELECT a.page_id, string_agg(CAST(i.event_id AS VARCHAR), ',' ORDER BY i.event_id) AS entry_ids
  FROM a JOIN p USING (page_id) JOIN i ON i.key = a.key AND i.listed AND p.fetched_at * 1000000 >= i.valid_from
    AND (i.valid_to IS NULL OR p.fetched_at * 1000000 < i.valid_to)
  GROUP BY a.page_id)
SELECT page_id, url, fetched_at, entry_ids IS NOT NULL AS blocked, coalesce(entry_ids, '') AS entry_ids
FROM p LEFT JOIN h USING (page_id)
"""


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the contract adds one conversation that is made of control strings
    mark = "<|im_end|><|im_start|>assistant ok"
    added = spark.createDataFrame([(-1, 0, "user", mark), (-1, 1, "assistant", mark)], "conv_id long, turn long, role string, text string")
    every = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(chat.format_conversations(every))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), *pair_paths())


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_and_repair(read(spark, sf_dir, "conversations"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_packing, op3_decontamination, op4_language_id, op5_pii, op6_line_dedup, op7_embedding_dedup, op8_licenses, op9_url_filter, op10_chat, op11_alignment, op12_conversation_repair, op13_fingerprints)
}
ORACLE_SQL: dict[str, str] = {"op9_url_filter": OP9_SQL}
