"""Search responses: objects at any depth of a JSON text, found level by level.

A response is parsed once.  ``variant_explode`` opens one level of its values at a time, down to the deepest; every
level is written once, as variants, and read by the next, so a response spreads over rows instead of a recursive
function in one of them.  Keys of an object are in the order of their names.
"""

from __future__ import annotations

import html
import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import let, or_null
from ..sources.tables import materialise

# Keys of product objects, in order of preference.
NUMBER_KEYS = ("no", "productNo", "goodsNo", "goodsId", "productId", "contentNo")
NAME_KEYS = ("name", "productName", "goodsName", "title", "displayName")
PRICE_KEYS = ("discountedPrice", "salesPrice", "salePrice", "price", "sellingPrice", "originalPrice")
IMAGE_KEYS = ("thumbnail_image_url", "thumbnailImageUrl", "thumbnailUrl", "imageUrl", "listImageUrl", "mainImageUrl", "image")
SIGNAL_KEYS = (*PRICE_KEYS, *IMAGE_KEYS, "isSoldOut", "soldOut", "deliveryTypeNames", "deliveryTypes", "discountRate")
CATEGORY_NAME_KEYS = ("name", "title", "label", "displayName", "categoryName", "groupName", "mainCategoryName", "subCategoryName")
NESTED_NAME_KEYS = ("name", "title", "label", "text")
CATEGORY_BAD_WORDS = ("전체", "홈", "Home", "Market", "마켓", "컬리", "Kurly", "더보기", "추천", "베스트", "이벤트", "기획전")


def _is(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind).isNotNull()


def json_values(responses: DataFrame, id_col: str, json_col: str, scalars: bool = True) -> list[DataFrame]:
    """A table ``id, place, key, v`` for each level of nesting: every value there, with its key if it stands in an
    object; broken texts give none.  ``place`` sorts as the values stand.  Without ``scalars`` objects and lists alone,
    in which all others stand, are written."""
    tvf, found = responses.sparkSession.tvf, []
    level = responses.select(id_col, F.lit("").alias("place"), F.lit(None).cast("string").alias("key"), F.try_parse_json(json_col).alias("v")).where("v is not null")
    while True:
        level = materialise(level, "json-level")
        if found and level.isEmpty():
            return found
        found.append(level)
        inner = level.withColumnsRenamed({"key": "_key", "v": "_v"}).lateralJoin(tvf.variant_explode(F.col("_v").outer()))
        place = F.concat("place", F.lit("/"), F.lpad(F.col("pos").cast("string"), 6, "0"))
        level = inner.select(id_col, place.alias("place"), "key", F.col("value").alias("v"))
        if not scalars:
            level = level.where(_is(F.col("v"), "map<string,variant>") | _is(F.col("v"), "array<variant>"))


def json_objects(responses: DataFrame, id_col: str, json_col: str, having: tuple[tuple[str, ...], ...] = ()) -> DataFrame:
    """``id, level, place, object`` of all JSON objects at any depth that have one key at least of each of ``having``."""
    levels = enumerate(json_values(responses, id_col, json_col, scalars=False))
    keys = F.map_keys(F.try_variant_get("v", "$", "map<string,variant>"))
    fit = let(keys, lambda k: reduce(Column.__and__, (F.arrays_overlap(k, F.array(*map(F.lit, some))) for some in having), k.isNotNull()))
    objects = (rows.where(fit).select(id_col, F.lit(k).alias("level"), "place", F.to_json("v").alias("object")) for k, rows in levels)
    return reduce(DataFrame.unionByName, objects)


def text_of(j: Column) -> Column:
    """A JSON value as text: lists joined by bars, objects by their name or as JSON."""
    inner = lambda x: F.array_join(F.from_json(x, "array<string>"), " | ")
    name = lambda x: F.coalesce(*(F.get_json_object(x, f"$.{k}") for k in NAME_KEYS), x)
    return F.coalesce(let(j, lambda x: F.when(x.startswith("["), inner(x)).when(x.startswith("{"), name(x)).otherwise(x)), F.lit(""))


def first_key(obj: Column, keys: tuple[str, ...]) -> Column:
    """The first key with a value that is not null or empty."""
    return F.coalesce(*(or_null(text_of(F.get_json_object(obj, f"$.{k}"))) for k in keys), F.lit(""))


def digits_of(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), "^([0-9]+)", 1), "^0+(?=[0-9])", "")


def product_rows(responses: DataFrame, id_col: str, json_col: str, item_url: str = "/goods/") -> DataFrame:
    """One row for each product object (numeric id, a name, a signal key): the first of each id."""
    o = F.col("object")
    # keys are looked at first: texts are made of objects alone that have all kinds
    objects = json_objects(responses, id_col, json_col, (NUMBER_KEYS, NAME_KEYS, SIGNAL_KEYS)).withColumn("product_code", first_key(o, NUMBER_KEYS)).withColumn("product_name", first_key(o, NAME_KEYS))
    objects = objects.where(F.col("product_code").rlike("^[0-9]+$") & (F.col("product_name") != ""))
    one = objects.groupBy(id_col, "product_code").agg(F.min_by(F.struct("product_name", "object"), "place").alias("r"))
    o = F.col("r.object")
    reduced, full = digits_of(first_key(o, ("discountedPrice", "salePrice", "sellingPrice"))), digits_of(first_key(o, ("salesPrice", "originalPrice", "price")))
    image = first_key(o, IMAGE_KEYS)
    return one.select(
        id_col,
        "product_code",
        "r.product_name",
        first_key(o, ("brandName", "brand")).alias("brand"),
        F.coalesce(F.nullif(reduced, F.lit("")), full).alias("list_price_krw"),
        full.alias("original_price_krw"),
        first_key(o, ("discountRate", "discountPercent")).alias("discount_rate"),
        first_key(o, ("deliveryTypeNames", "deliveryTypes", "deliveryTypeName")).alias("delivery_type"),
        F.when(image.startswith("//"), F.concat(F.lit("https:"), image)).otherwise(image).alias("image_url"),
        F.concat(F.lit(item_url), "product_code").alias("product_url"),
    )


def _plain_text(v: object) -> str:
    """A value as text: lists joined by bars, an object by its name, else as JSON."""
    if v is None:
        return ""
    if isinstance(v, str):
        return " ".join(html.unescape(v).split())
    if isinstance(v, list):
        return " | ".join(filter(None, map(_plain_text, v)))
    if isinstance(v, dict):
        return _name_in(v) or json.dumps(v, ensure_ascii=False, separators=(",", ":"))
    return json.dumps(v)


def _name_in(v: dict) -> str:
    return next(filter(None, (_plain_text(v[k]) for k in NESTED_NAME_KEYS if k in v)), "")


@F.pandas_udf(T.StringType())
def nested_name(values: pd.Series) -> pd.Series:
    """Names under keys that hold names, from JSON: texts, and objects by the first of their own name keys that has
    one, at any depth; lists, numbers and others are no names."""
    found = (None if v is None else json.loads(v) for v in values)
    return pd.Series([" ".join(v.split()) if isinstance(v, str) else _name_in(v) if isinstance(v, dict) else "" for v in found], dtype=object)


def category_keywords(responses: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """``id, position, keyword``: usable category names of each response, once each, numbered as they stand: 2 to 20
    characters, no braces, square or angle brackets, no general words."""
    named = [rows.where(F.col("key").isin(*CATEGORY_NAME_KEYS)).select(id_col, "place", F.to_json("v").alias("j")) for rows in json_values(responses, id_col, json_col)]
    names = reduce(DataFrame.unionByName, named).select(id_col, "place", nested_name("j").alias("keyword"))
    usable = names.where(F.length("keyword").between(2, 20) & ~F.col("keyword").rlike("[{}\\[\\]<>]") & ~F.col("keyword").isin(*CATEGORY_BAD_WORDS))
    once = usable.groupBy(id_col, "keyword").agg(F.min("place").alias("place"))
    return once.select(id_col, F.row_number().over(W.partitionBy(id_col).orderBy("place")).alias("position"), "keyword")
