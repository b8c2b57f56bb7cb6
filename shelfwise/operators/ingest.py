"""Collected rows to events: merging, sharding, typed payloads, envelopes and raw history rows.

A collected row is a ``map<string,string>`` with a missing value as an empty text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.text import clean_text, first_non_empty, fnv1a_32, parse_float, parse_uint, piped_union, time_text, uuid_v7
from ..sources.tables import materialise
from .ranking import latest_version

# Fixed values: (payload column, kind, keys of the collected row in order of preference).
PAYLOAD_A: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("source_category", "text", ("수집카테고리",)),
    ("group_code", "text", ("groupCode",)),
    ("search_keyword", "text", ("검색어",)),
    ("search_page", "uint0", ("페이지",)),
    ("product_name", "text", ("국내_상품명", "글로벌_상품명", "상품명", "상품명_목록")),
    ("domestic_url", "text", ("국내_상세URL", "상품URL_국내")),
    ("global_url", "text", ("글로벌_상세URL", "상품URL_글로벌")),
    ("raw_url", "text", ("상품URL_raw",)),
    ("image_url", "text", ("목록_이미지URL",)),
    ("list_price_krw", "uint", ("목록_판매가_KRW",)),
    ("list_original_price_krw", "uint", ("목록_정가_KRW",)),
    ("domestic_price_krw", "uint", ("국내_가격_KRW",)),
    ("global_price_krw", "uint", ("글로벌_가격_KRW",)),
    ("global_price_usd", "float", ("글로벌_가격_USD",)),
    ("brand", "text", ("국내_브랜드", "글로벌_브랜드")),
    ("seller", "text", ("국내_판매자", "글로벌_판매자")),
    ("category_path", "text", ("국내_카테고리", "글로벌_카테고리", "수집카테고리")),
    ("review_count", "uint", ("국내_리뷰수", "글로벌_리뷰수")),
    ("order_count", "uint", ("국내_주문수", "글로벌_주문수")),
    ("description_text", "text", ("국내_상세설명_텍스트", "글로벌_상세설명_텍스트")),
    ("description_image_urls", "list", ("국내_상세설명_이미지URL목록", "글로벌_상세설명_이미지URL목록")),
    ("korean_collect_success", "flag", ("국내_수집성공",)),
    ("global_collect_success", "flag", ("글로벌_수집성공",)),
)
PAYLOAD_B: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("list_source_mode", "text", ("수집방식", "list_source_mode")),
    ("source_category", "text", ("수집카테고리", "수집검색어")),
    ("group_code", "text", ("groupCode", "사이트")),
    ("search_keyword", "text", ("수집검색어", "검색어")),
    ("search_page", "uint0", ("검색페이지", "페이지")),
    ("site", "raw", ("사이트",)),
    ("product_url", "text", ("상품URL", "상품URL_국내")),
    ("raw_url", "text", ("상품URL_raw", "상품URL")),
    ("image_url", "text", ("이미지URL_목록", "목록_이미지URL")),
    ("product_name", "text", ("상세_상품명", "상품명", "상품명_목록")),
    ("brand", "raw", ("브랜드_목록",)),
    ("short_description", "raw", ("짧은설명_목록",)),
    ("list_price_krw", "uint", ("할인가_목록", "목록_판매가_KRW", "판매가_목록")),
    ("list_original_price_krw", "uint", ("판매가_목록", "목록_정가_KRW")),
    ("discount_rate_text", "raw", ("할인율_목록",)),
    ("sold_out_text", "raw", ("품절여부_목록",)),
    ("delivery_type", "text", ("상세_배송", "배송유형_목록")),
    ("detail_price_krw", "uint", ("상세_가격_KRW", "목록_판매가_KRW")),
    ("seller", "raw", ("상세_판매자",)),
    ("category_path", "text", ("수집카테고리", "수집검색어")),
    ("review_count", "uint", ("상세_후기수",)),
    ("origin", "raw", ("상세_원산지",)),
    ("unit_price", "raw", ("상세_단위당가격",)),
    ("package_type", "raw", ("상세_포장타입",)),
    ("sales_unit", "raw", ("상세_판매단위",)),
    ("weight_volume", "raw", ("상세_중량용량",)),
    ("allergy_info", "raw", ("상세_알레르기정보",)),
    ("expiration_info", "raw", ("상세_소비기한_유통기한",)),
    ("description_text", "raw", ("상세설명_텍스트",)),
    ("notice_text", "raw", ("상품고시_텍스트",)),
    ("description_image_urls", "list", ("상세설명이미지_URL목록",)),
    ("detail_collect_success", "flag", ("상세_수집성공",)),
    ("detail_collect_error", "raw", ("상세_수집오류",)),
    ("detail_next_data_available", "flag", ("상세_NEXT_DATA_존재",)),
)
# Columns of the merged sheet that come first, in this order.
MERGED_COLUMNS = [
    *("순번", "수집카테고리", "groupCode", "검색어", "페이지", "상품코드", "상품명", "상품명_목록", "상품URL_국내", "상품URL_글로벌", "상품URL_raw"),
    *("목록_이미지URL", "목록_가격_raw", "목록_판매가_KRW", "목록_정가_KRW", "목록_할인율_계산"),
    *("국내_상품명", "국내_가격_KRW", "국내_브랜드", "국내_카테고리", "국내_판매자", "국내_모델명", "국내_제조국", "국내_원산지", "국내_배송비", "국내_리뷰수", "국내_주문수"),
    *("국내_상세설명_텍스트", "국내_상세설명_이미지개수", "국내_상세설명_이미지URL목록", "국내_수집방식", "국내_수집성공", "국내_수집오류", "국내_파싱오류"),
    *("글로벌_상품명", "글로벌_가격_KRW", "글로벌_가격_USD", "글로벌_브랜드", "글로벌_카테고리", "글로벌_판매자", "글로벌_모델명", "글로벌_제조국", "글로벌_배송비", "글로벌_상품중량", "글로벌_리뷰수", "글로벌_주문수"),
    *("글로벌_상세설명_텍스트", "글로벌_상세설명_이미지개수", "글로벌_상세설명_이미지URL목록", "글로벌_수집방식", "글로벌_수집성공", "글로벌_수집오류", "글로벌_파싱오류"),
]
CODE_KEYS = ("상품코드",)
NUMBERED_IMAGES = 10


def value(row: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(row, F.lit(key)), F.lit(""))


def _texts(row: Column, keys: tuple[str, ...]) -> Column:
    """``first_non_empty`` of the values of keys; a key that a row lacks costs no cleaning."""
    return first_non_empty(*(F.try_element_at(row, F.lit(k)) for k in keys))


def _typed(row: Column, kind: str, keys: tuple[str, ...]) -> Column:
    if kind == "raw":
        return value(row, keys[0])
    if kind == "list":
        return piped_union(*(F.try_element_at(row, F.lit(k)) for k in keys))
    if kind == "flag":
        return F.lower(value(row, keys[0])) == "true"
    text = _texts(row, keys)
    return {"text": text, "uint": parse_uint(text), "uint0": F.coalesce(parse_uint(text), F.lit(0)), "float": parse_float(text)}[kind]


def image_urls(row: Column, lists: list[str], numbered: list[str]) -> Column:
    """Union of image lists and of numbered image columns, in order."""
    keys = [*lists, *(f"{stem}_{i}" for i in range(1, NUMBERED_IMAGES + 1) for stem in numbered)]
    return piped_union(*(F.try_element_at(row, F.lit(k)) for k in keys))


def _stamps(provider: str, run_uuid: str, at: Column, log: str) -> list[Column]:
    text = time_text(at, millis=True)
    return [
        uuid_v7(at).alias("uuid"),
        F.lit(provider).alias("provider"),
        F.unix_millis(at).alias("version"),
        *(text.alias(c) for c in ("created_at", "updated_at", "collected_at")),
        *(F.lit(log).alias(c) for c in ("created_log", "updated_log")),
        F.lit(run_uuid).alias("collect_run_uuid"),
    ]


def _coded(rows: DataFrame, row: str) -> DataFrame:
    return rows.withColumn("product_code", _texts(F.col(row), CODE_KEYS)).where("product_code <> ''")


def payload_a(rows: DataFrame, run_uuid: str, at: Column, log: str = "collect", row: str = "row") -> DataFrame:
    """Typed payloads of provider A; rows without a product code are dropped."""
    r = F.col(row)
    source = _texts(r, ("수집URL",))
    return _coded(rows, row).select(
        *_stamps("gmarket", run_uuid, at, log),
        "product_code",
        source.alias("source_url"),
        *(_typed(r, kind, keys).alias(name) for name, kind, keys in PAYLOAD_A),
        image_urls(r, ["목록_이미지URL", "국내_상세설명_이미지URL목록", "글로벌_상세설명_이미지URL목록"], ["국내_상세이미지_URL", "글로벌_상세이미지_URL"]).alias("all_image_urls"),
        r.alias("raw_row"),
    )


def payload_b(rows: DataFrame, run_uuid: str, at: Column, log: str = "collect", row: str = "row") -> DataFrame:
    """Typed payloads of provider B; an original price equal to the list price is no original price."""
    r = F.col(row)
    out = _coded(rows, row).select(
        *_stamps("kurly", run_uuid, at, log),
        "product_code",
        _texts(r, ("수집URL", "상품URL")).alias("source_url"),
        *(_typed(r, kind, keys).alias(name) for name, kind, keys in PAYLOAD_B),
        image_urls(r, ["이미지URL_목록", "목록_이미지URL", "상세설명이미지_URL목록"], ["상세이미지_URL", "상세설명이미지_URL"]).alias("all_image_urls"),
        r.alias("raw_row"),
    )
    same = F.col("list_original_price_krw") == F.col("list_price_krw")
    return out.withColumn("list_original_price_krw", F.when(same, None).otherwise(F.col("list_original_price_krw")))


def best_source_url(provider: Column, cols: dict[str, Column]) -> Column:
    """A: domestic, global, collection, raw; B: detail, product, domestic, collection."""
    pick = lambda names: first_non_empty(*(cols[n] for n in names if n in cols))
    return F.when(provider == "kurly", pick(("detail_url", "product_url", "domestic_url", "source_url"))).otherwise(pick(("domestic_url", "global_url", "source_url", "raw_url")))


def envelope(payloads: DataFrame, event_type: str, source: str, host: str = "", ip: str = "") -> DataFrame:
    """Event envelopes: all texts, the payload as JSON."""
    url = best_source_url(F.col("provider"), {c: F.col(c) for c in payloads.columns if c.endswith("_url")})
    return payloads.select(
        F.coalesce(F.nullif(F.trim("uuid"), F.lit("")), uuid_v7(F.current_timestamp())).alias("event_uuid"),
        F.lit(source).alias("source"),
        F.lit(host).alias("host"),
        F.lit("").alias("uuid_user"),
        F.lit(ip).alias("ip"),
        url.alias("url"),
        F.lit(event_type).alias("event_type"),
        F.to_json(F.struct(*payloads.columns)).alias("payload"),
        F.coalesce(F.nullif(F.trim("created_at"), F.lit("")), time_text(F.current_timestamp(), True)).alias("created_at"),
    )


def raw_rows(payloads: DataFrame, source: str, topic: str = "", partition: int = 0, offset: int = 0) -> DataFrame:
    """History rows: the payload without its raw row, flags as 0 and 1, with lineage and the whole JSON."""
    cols = [F.col(c).cast("int").alias(c) if t == "boolean" else F.col(c) for c, t in payloads.dtypes if c != "raw_row"]
    return payloads.select(
        *cols,
        F.lit(source).alias("source"),
        uuid_v7(F.current_timestamp()).alias("event_uuid"),
        F.lit(topic).alias("kafka_topic"),
        F.lit(partition).alias("kafka_partition"),
        F.lit(offset).cast("bigint").alias("kafka_offset"),
        F.to_json(F.struct(*payloads.columns)).alias("payload"),
    )


def overlay(base: Column, top: Column) -> Column:
    """Keys of both maps; those of ``top`` win, empty texts too."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(top, k))
    return F.coalesce(F.map_concat(kept, top), base)


def merge_list_detail(lists: DataFrame, details: DataFrame, order: str, row: str = "row", key: str = "상품코드") -> DataFrame:
    """List rows with the values of the last detail row of their code laid over them."""
    code = lambda c: value(F.col(c), key)
    last = details.withColumn("_code", code(row)).where("_code <> ''").groupBy("_code").agg(F.max_by(row, order).alias("_detail"))
    both = lists.withColumn("_code", code(row)).join(last, "_code", "left")
    return both.withColumn(row, overlay(F.col(row), F.coalesce("_detail", F.create_map().cast("map<string,string>")))).drop("_code", "_detail")


def merge_details(domestic: DataFrame, foreign: DataFrame, key: str, row: str = "row") -> DataFrame:
    """Both details of a product as one, also if it has only one of them."""
    nothing = F.create_map().cast("map<string,string>")
    return domestic.select(key, F.col(row).alias("_d")).join(foreign.select(key, F.col(row).alias("_f")), key, "full").select(
        key, overlay(F.coalesce("_d", nothing), F.coalesce("_f", nothing)).alias(row)
    )


def add_discount_rate(rows: DataFrame, price: str, original: str, name: str = "discount_rate") -> DataFrame:
    return rows.withColumn(name, S.discount_rate(F.col(price), F.col(original)))


def retry_failed(rows: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], key: str, ok: str = "success") -> DataFrame:
    """Results of ``attempt(rows, 1)``; rows that failed get one more, ``attempt(rows, 2)``, whose result stands.

    The first results are written once, so that what failed is the same for both parts.
    """
    first = materialise(attempt(rows, 1), "attempt")
    failed = first.where(~F.coalesce(F.col(ok), F.lit(False))).select(key).distinct()
    again = attempt(rows.join(failed, key, "left_semi"), 2)
    return first.join(failed, key, "left_anti").unionByName(again)


def shard(rows: DataFrame, code: str, count: int, index: int | None = None) -> DataFrame:
    """Rows with their shard by FNV-1a of the code; of one shard alone if ``index`` is given."""
    out = rows.withColumn("shard_count", F.lit(count)).withColumn("shard_index", (fnv1a_32(F.col(code).cast("string")) % count).cast("int"))
    return out if index is None else out.where(F.col("shard_index") == index)


def sheet(rows: DataFrame, preferred: list[str] = (), row: str = "row") -> DataFrame:
    """Map rows as a table: a column for every key that any row has, preferred ones first, the others by name; a row
    without a key has an empty text there.

    Keys are found in one pass that keeps those of each task once; a sheet has no more columns than can be shown.
    """
    found = {r["name"] for r in rows.select(F.explode(F.map_keys(row)).alias("name")).distinct().collect()}
    names = [c for c in dict.fromkeys(preferred) if c in found]
    return rows.select(*(value(F.col(row), c).alias(c) for c in names + sorted(found - set(names))))


def latest_products(history: DataFrame) -> DataFrame:
    """The newest raw row of every (provider, product_code)."""
    return latest_version(history, ["provider", "product_code"], ["version", "uuid"])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
