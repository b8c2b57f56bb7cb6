"""Sources of products: the two latest-product tables, NDJSON and tabular files, and the star-schema adapter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import first_non_empty, time_text


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Declared schema; blank lines are skipped and a broken line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_tabular(spark: SparkSession, path: str, aliases: dict[str, list[str]], code: Column | None = None) -> DataFrame:
    """A CSV catalogue whose headers may have other names; rows without a code are dropped.

    ``aliases`` maps a target column to the headers it may have, in order of preference.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    found = {name: [a for a in names if a in raw.columns] for name, names in aliases.items()}
    cols = [(first_non_empty(*(F.col(f"`{a}`") for a in names)) if names else F.lit("")).alias(name) for name, names in found.items()]
    rows = raw.select(*cols)
    rows = rows.withColumn("product_code", code) if code is not None else rows
    return rows.where(F.col("product_code") != "")


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def scan_latest(latest_a: DataFrame, latest_b: DataFrame) -> DataFrame:
    """One row per product of both providers: nulls filled, prices chosen, rows without code, name or
    price dropped.  The filters stand in each branch, so they reach both scans."""
    a_price = F.coalesce("domestic_price_krw", "list_price_krw", "global_price_krw")
    b_price = F.coalesce("detail_price_krw", "list_price_krw")
    a_url = F.coalesce(F.nullif(F.col("domestic_url"), F.lit("")), F.nullif(F.col("global_url"), F.lit("")), F.lit(""))
    b_url = F.coalesce(F.col("product_url"), F.lit(""))

    def branch(df: DataFrame, provider: str, price: Column, url: Column, orders: Column) -> DataFrame:
        keep = df.where((F.col("product_code") != "") & (F.col("product_name") != "") & (price > 0))
        return keep.select(
            F.lit(provider).alias("provider"),
            "product_code",
            "product_name",
            *(_text(c).alias(c) for c in ("source_category", "group_code", "search_keyword", "image_url")),
            url.alias("product_url"),
            F.round(price).cast("bigint").alias("price_krw"),
            F.round(F.coalesce("list_original_price_krw", F.lit(0))).cast("bigint").alias("original_price_krw"),
            *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("brand", "seller", "category_path")),
            F.coalesce("review_count", F.lit(0)).cast("bigint").alias("review_count"),
            orders.cast("bigint").alias("order_count"),
            time_text(F.col("collected_at")).alias("collected_at"),
            time_text(F.col("updated_at")).alias("updated_at"),
        )

    return branch(latest_a, "gmarket", a_price, a_url, F.coalesce("order_count", F.lit(0))).unionByName(
        branch(latest_b, "kurly", b_price, b_url, F.lit(0))
    )


def products_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products from order lines, parts and suppliers; only the needed columns are read."""
    line = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = line.join(part, line.l_partkey == part.p_partkey).join(supplier, line.l_suppkey == supplier.s_suppkey)
    return rows.select(
        F.when(F.col("l_suppkey") % 2 == 0, "gmarket").otherwise("kurly").alias("provider"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("source_category"),
        F.lit("").alias("search_keyword"),
        F.col("s_name").alias("seller"),
        F.col("p_brand").alias("brand"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint").alias("price_krw"),
        F.round("l_extendedprice").cast("bigint").alias("original_price_krw"),
        F.col("l_quantity").cast("bigint").alias("review_count"),
        F.col("l_linenumber").cast("bigint").alias("order_count"),
        time_text(F.col("l_shipdate")).alias("collected_at"),
        "l_partkey",
    )


def latest_tables(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables in the shape of the two providers' latest products, with gaps where the scan fills them."""
    at = F.to_timestamp("collected_at")
    common = [
        F.col("product_code"),
        F.when(F.col("order_count") != 6, F.col("product_name")).alias("product_name"),
        F.concat(F.lit(" "), F.col("source_category")).alias("source_category"),
        F.lit(None).cast("string").alias("group_code"),
        F.col("search_keyword"),
        F.lit(None).cast("string").alias("image_url"),
        F.when(F.col("review_count") % 2 == 0, F.col("brand")).alias("brand"),
        F.col("seller"),
        F.lit(None).cast("string").alias("category_path"),
        F.when(F.col("order_count") != 5, F.col("price_krw")).alias("list_price_krw"),
        F.col("original_price_krw").alias("list_original_price_krw"),
        F.when(F.col("review_count") > 5, F.col("review_count")).alias("review_count"),
        at.alias("collected_at"),
        at.alias("updated_at"),
    ]
    a = products.where("provider = 'gmarket'").select(
        *common,
        F.when(F.col("order_count") % 2 == 0, F.concat(F.lit("/d/"), F.col("product_code"))).otherwise("").alias("domestic_url"),
        F.concat(F.lit("/g/"), F.col("product_code")).alias("global_url"),
        F.when(F.col("order_count") % 3 == 0, F.col("price_krw") - 1).alias("domestic_price_krw"),
        (F.col("price_krw") + 7).alias("global_price_krw"),
        "order_count",
    )
    b = products.where("provider = 'kurly'").select(
        *common,
        F.concat(F.lit("/p/"), F.col("product_code")).alias("product_url"),
        F.when(F.col("order_count") % 3 == 0, F.col("price_krw") - 1).alias("detail_price_krw"),
    )
    return a, b
