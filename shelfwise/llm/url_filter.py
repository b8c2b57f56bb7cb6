"""URL filter by a dated list: validity intervals and an as-of join, in DataFrame functions.

List entries say that a host, or a site with all hosts below it, is listed or taken off from a time on.
The entries of a key become intervals that end where the next one begins.  Every capture looks up
the entry that was active when it was fetched, for its host and for each domain above it.  Time is cut into
stretches of ``STRETCH_SECONDS``: a task holds the entries of a key in one stretch, and what was active
before is carried over from the stretches before, of which a key has few.  Captures of a frequent key and
stretch are dealt out over salts, and only the entries of that stretch are repeated for each.

Defined results: entries without key or time are ignored; of entries with equal key and time the one
with the largest id counts; captures without url or time match nothing and stay; an entry is active at
its own time, no longer at the next one's; repeated rows are judged each for itself; a very long url is read
whole; empty tables give no rows, or captures that match nothing; other columns of captures pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Captures of a key, stretch and salt, about; and seconds of a stretch.
CAPTURES_A_SALT, STRETCH_SECONDS = 50_000, 3_600
PREFIXES = "^(www|m|blog)\\."


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def site_of(host: Column) -> Column:
    return F.regexp_replace(host, PREFIXES, "")


def parent_domains(host: Column) -> Column:
    """The host and every domain above it that has a dot."""
    labels = F.split(host, "[.]")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.array_distinct(above)


def _stretch(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts) / STRETCH_SECONDS)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``key, listed, entry_id, valid_from, valid_to`` of ``entries (key, ts, entry_id, listed)``."""
    clean = entries.where(F.col("key").isNotNull() & (F.col("key") != "") & F.col("ts").isNotNull())
    one = clean.groupBy("key", "ts").agg(F.max(F.struct("entry_id", "listed")).alias("e")).withColumn("_stretch", _stretch(F.col("ts")))
    # the next entry stands in the same stretch, or is the first of the next stretch that has one
    first = one.groupBy("key", "_stretch").agg(F.min("ts").alias("_first"))
    after = first.select("key", "_stretch", F.lead("_first").over(W.partitionBy("key").orderBy("_stretch")).alias("_after"))
    inside = F.lead("ts").over(W.partitionBy("key", "_stretch").orderBy("ts"))
    return one.withColumn("_inside", inside).join(after, ["key", "_stretch"]).select(
        "key", F.col("e.listed").alias("listed"), F.col("e.entry_id").alias("entry_id"), F.col("ts").alias("valid_from"), F.coalesce("_inside", "_after").alias("valid_to")
    )


def _active(asked: DataFrame, intervals: DataFrame) -> DataFrame:
    """``asked (key, _row, ts)`` with the interval of its key that holds ``ts``."""
    asked = asked.withColumn("_stretch", _stretch(F.col("ts")))
    entry = F.struct("entry_id", "listed", "valid_from", "valid_to")
    starts = intervals.select("key", _stretch(F.col("valid_from")).alias("_stretch"), F.col("valid_from").alias("ts"), entry.alias("_entry"))
    needed = asked.groupBy("key", "_stretch").agg(F.ceil(F.count("*") / CAPTURES_A_SALT).cast("int").alias("_salts"))
    # what was active when a stretch began: the last entry of the stretches before
    last = starts.groupBy("key", "_stretch").agg(F.max_by("_entry", "ts").alias("_last"))
    every = last.join(needed, ["key", "_stretch"], "full")
    so_far = W.partitionBy("key").orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = every.withColumn("_carried", F.last("_last", ignorenulls=True).over(so_far)).where("_salts is not null").select("key", "_stretch", "_salts", "_carried")
    left = asked.join(carried, ["key", "_stretch"]).select("key", "_stretch", F.pmod(F.col("_row"), F.col("_salts")).cast("int").alias("_salt"), "ts", "_row", F.lit(1).alias("_ask"), F.lit(None).cast(starts.schema["_entry"].dataType).alias("_entry"), "_carried")
    salted = starts.join(needed, ["key", "_stretch"]).select("key", "_stretch", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"), "ts", F.lit(None).cast("long").alias("_row"), F.lit(0).alias("_ask"), "_entry")
    both = left.unionByName(salted, allowMissingColumns=True)
    inside = W.partitionBy("key", "_stretch", "_salt").orderBy("ts", "_ask").rowsBetween(W.unboundedPreceding, W.currentRow)
    return both.withColumn("_entry", F.coalesce(F.last("_entry", ignorenulls=True).over(inside), F.col("_carried"))).where("_ask = 1").select("_row", "key", "_entry")


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures (url, fetched_at, ...)`` with ``blocked`` and the ids of the entries that say so."""
    from .common import materialise

    rows = materialise(captures.withColumn("_row", F.monotonically_increasing_id()), "captures")
    host = host_of(F.col("url"))
    keys = F.concat(F.array(F.concat(F.lit("host:"), host)), F.transform(parent_domains(host), lambda d: F.concat(F.lit("site:"), d)))
    asked = rows.where(F.col("url").isNotNull() & F.col("fetched_at").isNotNull() & (host != "")).select("_row", F.col("fetched_at").alias("ts"), F.explode(keys).alias("key"))
    hits = (
        _active(asked, validity_intervals(entries))
        .where(F.col("_entry.listed"))
        .groupBy("_row")
        .agg(F.array_join(F.array_sort(F.collect_set(F.col("_entry.entry_id"))).cast("array<string>"), ",").alias("entry_ids"))
    )
    return (
        rows.join(hits, "_row", "left")
        .drop("_row")
        .withColumn("blocked", F.col("entry_ids").isNotNull())
        .withColumn("entry_ids", F.coalesce("entry_ids", F.lit("")))
    )
