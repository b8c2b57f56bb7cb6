"""Gates of a refresh, as tables of checks and of verification figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import valid_json
from ..sources import files


class GateError(RuntimeError):
    """A refresh that must not be published."""


def membership_violations(products: DataFrame, categories: DataFrame, column: str = "source_category") -> DataFrame:
    """Products whose category is not among ``categories``."""
    return products.join(categories.select(F.col("category").alias(column)), column, "left_anti")


def coverage_gaps(products: DataFrame, categories: DataFrame, column: str = "source_category") -> DataFrame:
    """Categories without a product."""
    return categories.select("category").exceptAll(products.select(F.col(column).alias("category")).distinct())


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).count().where("count > 1")


def same_set(a: DataFrame, b: DataFrame) -> DataFrame:
    """Values that only one side has, with the side."""
    left = a.exceptAll(b).withColumn("side", F.lit("left"))
    return left.unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def _count(name: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")


def build_checks(products: DataFrame, snapshots: DataFrame, mart: DataFrame, categories: DataFrame, scopes: DataFrame, version: int) -> DataFrame:
    """``check, violations`` of everything that must hold before a write."""
    facts = products.agg(F.count("*").alias("n"), F.coalesce(F.max("collected_at"), F.lit("")).alias("latest"))

    def parity(rows: DataFrame) -> DataFrame:
        everything = rows.where("scope_slug = 'all'").select("source_product_count", "source_max_collected_at").distinct()
        return everything.join(F.broadcast(facts), (F.col("source_product_count") == F.col("n")) & (F.col("source_max_collected_at") == F.col("latest")), "left_anti")

    parts = [
        _count("source_is_empty", facts.where("n = 0")),
        _count("price_not_positive", products.where("price_krw is null or price_krw <= 0")),
        _count("category_outside_standard", membership_violations(products, categories)),
        _count("category_without_product", coverage_gaps(products, categories)),
        _count("snapshot_invalid", snapshots.where((F.col("version") != version) | (F.col("snapshot_uuid") == "") | ~valid_json(F.col("payload_json")))),
        _count("snapshot_scope_twice", duplicates(snapshots, "scope_slug")),
        _count("snapshot_scopes_differ", same_set(snapshots.select("scope_slug").distinct(), scopes)),
        _count("snapshot_source_differs", parity(snapshots)),
        _count("keyword_invalid", mart.where((F.col("version") != version) | (F.col("keyword_key") == "") | ~valid_json(F.col("categories_json")) | ~valid_json(F.col("products_json")))),
        _count("keyword_scopes_differ", same_set(mart.select("scope_slug").distinct(), scopes)),
        _count("keyword_source_differs", parity(mart)),
    ]
    return reduce(DataFrame.unionByName, parts)


def require(checks: DataFrame) -> None:
    """Raise if a check has violations; the table has a row for each check."""
    bad = {r["check"]: r["violations"] for r in checks.where("violations > 0").collect()}
    if bad:
        raise GateError(f"checks failed: {bad}")


def _verify(rows: DataFrame, prefix: str, version: int, json_cols: list[str], zone: Column) -> DataFrame:
    millis = F.unix_millis(F.to_timestamp("generated_at"))
    bad_json = reduce(lambda a, b: a | b, [~valid_json(F.col(c)) for c in json_cols])
    everything = F.col("scope_slug") == "all"
    return rows.where(F.col("version") == version).agg(
        F.count("*").alias(f"{prefix}_rows"),
        F.array_sort(F.collect_set("scope_slug")).alias(f"{prefix}_scopes"),
        F.count_if(bad_json).alias(f"{prefix}_invalid_payloads"),
        F.count_if(millis != F.col("version")).alias(f"{prefix}_version_mismatches"),
        F.max(F.when(everything, F.col("source_max_collected_at"))).alias(f"{prefix}_source_max_collected_at"),
        F.max(F.when(everything, F.col("source_product_count"))).alias(f"{prefix}_source_product_count"),
    )


def verification(snapshots: DataFrame, mart: DataFrame, version: int) -> DataFrame:
    """One row of what is found in storage: one scan and one aggregate per table."""
    a = _verify(snapshots, "snapshot", version, ["payload_json"], F.lit(None))
    b = _verify(mart, "keyword", version, ["categories_json", "products_json"], F.lit(None))
    return a.join(F.broadcast(b), F.lit(True))  # two rows of aggregates


def require_verified(found: DataFrame, *, scopes: list[str], keyword_rows: int, products: int, latest: str) -> None:
    r = found.first()
    wrong = [
        name
        for name, ok in {
            "snapshot rows": r["snapshot_rows"] == len(scopes),
            "snapshot scopes": r["snapshot_scopes"] == sorted(scopes),
            "keyword rows": r["keyword_rows"] == keyword_rows,
            "keyword scopes": r["keyword_scopes"] == sorted(scopes),
            "payloads": r["snapshot_invalid_payloads"] == r["keyword_invalid_payloads"] == 0,
            "versions": r["snapshot_version_mismatches"] == r["keyword_version_mismatches"] == 0,
            "source counts": r["snapshot_source_product_count"] == r["keyword_source_product_count"] == products,
            "source times": r["snapshot_source_max_collected_at"] == r["keyword_source_max_collected_at"] == latest,
        }.items()
        if not ok
    ]
    if wrong:
        raise GateError(f"storage differs from the build: {', '.join(wrong)}")


def marker_figures(markers: DataFrame, refresh_uuid: str, version: int) -> DataFrame:
    mine = markers.where((F.col("refresh_uuid") == refresh_uuid) & (F.col("version") == version))
    cols = ("attempt", "generated_at", "source_max_collected_at", "source_product_count", "expected_scope_count", "snapshot_scope_count", "keyword_scope_count", "keyword_row_count", "published_at")
    return mine.agg(F.count("*").alias("marker_rows"), *(F.max(c).alias(c) for c in cols), F.count_if(F.to_timestamp("published_at").isNull()).alias("invalid_published_at"))


def require_marker(markers: DataFrame, marker: dict) -> None:
    """Exactly one marker row that says what was written."""
    r = marker_figures(markers.where(F.col("attempt") == marker["attempt"]), marker["refresh_uuid"], marker["version"]).first()
    wrong = [c for c, v in marker.items() if c not in ("refresh_uuid", "version") and r[c] != v]
    if r["marker_rows"] != 1 or r["invalid_published_at"] or wrong:
        raise GateError(f"marker differs: {r['marker_rows']} rows, {wrong}")


def preflight(spark: SparkSession, *paths: str) -> None:
    """Targets must be readable, or new, and their folders writable, before the source is scanned."""
    for path in paths:
        found = [n for n in files.names(spark, path) if n[0] not in "._"]
        if found:
            (spark.read.json(path) if all(n.endswith(".json") for n in found) else spark.read.parquet(path)).limit(0).count()
        elif not files.make_folder(spark, path):
            raise GateError(f"{path} cannot be written")
