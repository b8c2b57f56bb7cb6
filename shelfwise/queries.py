"""Registered queries of the catalogue operators.  Each reads whole tables; their SQL is in ``oracles``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import keywords as K
from .functions import scores as S
from .functions import text as X
from .functions.taxonomy import CATEGORIES
from .operators import aggregates as A
from .operators import checks as G
from .operators import ingest as I
from .operators import json_tree as J
from .operators import pages as P
from .operators import ranking as R
from .oracles import ORACLE_SQL as ORACLE_SQL
from .plans import collection as C
from .plans import refresh as RF
from .sources import catalog as src
from .sources import sinks
from .sources import topic as TP
from .sources.tables import materialise, spread, work_path
from .streaming import events as ST
from .streaming import latest as LS
from .streaming import token_index as TI

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
AT = datetime(2026, 8, 6, 2, 54, 24, 934000)
PAGES_A_TASK = 5_000


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.products_from_star(spark, sf_dir)


def _keyworded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(K.add_keywords(_products(spark, sf_dir), normalise=False, repeated=True), "keywords")  # the names are plain ASCII


@query
def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = src.scan_latest(*src.latest_tables(_products(spark, sf_dir)))
    return scanned.drop("group_code", "search_keyword", "image_url", "category_path", "updated_at")


@query
def category_benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.category_benchmarks(_products(spark, sf_dir)).withColumn("rank", F.col("rank").cast("long"))


@query
def fine_benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.category_benchmarks(_products(spark, sf_dir), by=["provider", "l_partkey"], limit=None).drop("rank")


@query
def scope_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.scope_summary(RF.in_scopes(_products(spark, sf_dir)), ["scope_slug"])


@query
def price_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.price_bands(RF.in_scopes(_products(spark, sf_dir)), ["scope_slug"]).drop("band")


@query
def price_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    scoped = RF.in_scopes(_products(spark, sf_dir))
    sliced = A.in_slices(scoped, A.price_slices(scoped, ["scope_slug"]), ["scope_slug"])
    return A.scope_summary(sliced, ["scope_slug", "range_key", "range_label"]).select("scope_slug", "range_key", "range_label", "product_count", "min_price_krw", "median_price_krw", "max_price_krw")


@query
def keyword_benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.keyword_benchmarks(_keyworded(spark, sf_dir)).drop("latest_collected_at").withColumn("rank", F.col("rank").cast("long"))


@query
def category_keyword_top40(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = A.category_keywords(_keyworded(spark, sf_dir))
    return best.select("source_category", "keyword", F.col("rank").cast("long").alias("rank"), "cluster_label", "product_count", "median_price_krw", "demand_score", "competition_score", "price_gap_score", "opportunity_score", "interpretation")


@query
def deal_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.deal_candidates(_products(spark, sf_dir), [])
    return found.select(F.col("position").cast("long").alias("position"), "provider", "product_code", "price_krw", *RF.DEAL_COLUMNS)


@query
def deal_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.score_deals(_products(spark, sf_dir), []).select("product_code", "radar_score", "discount_percent", "below_category_median_percent", "reason")


@query
def top_products_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = R.top_products(RF.in_scopes(_products(spark, sf_dir)), ["scope_slug"])
    return best.select("scope_slug", F.col("position").cast("long").alias("position"), "provider", "product_code", "price_krw")


@query
def seller_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = A.seller_insights(A.category_benchmarks(_products(spark, sf_dir), by=["seller"], limit=None))
    return found.select("seller", "product_count", "median_price_krw", "low_price_percent", "discounted_percent", "competition_level", "recommended_action")


@query
def price_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = A.nearest_rank(_products(spark, sf_dir), ["l_partkey"], "price_krw", {"median_price_krw": 0.5})
    return parts.groupBy(S.price_cluster(F.col("median_price_krw")).alias("cluster_label")).agg(F.count("*").alias("n_parts"))


@query
def balanced_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A balanced selection of 1,000 products; the limit is the operator's own."""
    return R.balanced_limit(_products(spark, sf_dir), F.col("source_category"), [F.asc("product_code")], 1000).select("source_category", "product_code")


@query
def balanced_third(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the products, balanced over sellers of very different sizes, some of them blank, in a seeded order."""
    p = _products(spark, sf_dir)
    seller = F.when(F.col("l_partkey") % 7 == 0, "").when(F.col("l_partkey") % 2 == 0, "large").otherwise(F.col("seller"))
    chosen = R.balanced_limit(p.withColumn("keyword", seller), F.col("keyword"), [F.col("price_krw"), F.col("product_code")], p.count() // 3)
    return chosen.groupBy("keyword").agg(F.count("*").alias("row_count"), F.max("price_krw").alias("dearest"))


@query
def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as jobs, the last one first, at most three products of each, until there are twice the target."""
    p = _products(spark, sf_dir)
    taken = R.until_enough(p, "l_partkey", [F.desc("l_partkey")], [F.asc("price_krw"), F.asc("product_code")], 3, p.count() // 7)
    return taken.select("l_partkey", "product_code")


@query
def report_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets of map rows, written and read back: where each column stands, how many rows fill it, its last value."""
    o, path = src.read_table(spark, sf_dir, "orders"), work_path(spark, "sheets")
    c, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    lists = o.select(text.alias("seq"), _mapped({"상품코드": text, "수집카테고리": F.col("o_orderpriority"), "z": F.lit("a,\"b\"")}).alias("row"))
    some = F.when(c % 5 == 0, _mapped({"국내_브랜드": F.concat(F.lit("b"), text)})).otherwise(_mapped({"국내_수집성공": F.lit("true"), "추가": text}))
    details = o.where(c % 3 == 0).select(text.alias("seq"), F.map_concat(_mapped({"상품코드": text}), some).alias("row"))
    merged = I.merge_list_detail(lists, details, "seq")
    sheets = {"merged": (merged, I.MERGED_COLUMNS), "list": (lists, []), "detail": (details, [])}
    sinks.write_report(path, **{name: I.sheet(rows, preferred) for name, (rows, preferred) in sheets.items()})
    out = []
    for name in sheets:
        read = spark.read.option("header", True).option("escape", '"').csv(f"{path}/{name}")
        cells = F.explode(F.array(*(F.struct(F.lit(k).cast("long").alias("place"), F.lit(h).alias("name"), F.col(f"`{h}`").alias("value")) for k, h in enumerate(read.columns)))).alias("cell")
        out.append(read.select(cells).select("cell.*").groupBy("place", "name").agg(F.count("value").alias("filled"), F.max("value").alias("last")).withColumn("sheet", F.lit(name)))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = src.read_table(spark, sf_dir, "lineitem").withColumn("code", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return R.keep_first(lines, "code", [F.asc("l_partkey"), F.asc("l_suppkey")]).select("code", "l_partkey", "l_suppkey")


@query
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = src.read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    return R.latest_version(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]).drop("l_shipdate")


@query
def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.shard(_products(spark, sf_dir), "product_code", 8).groupBy("shard_index").agg(F.count("*").alias("row_count"))


@query
def sequence_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = R.sequence_numbers(_products(spark, sf_dir).select("price_krw", "product_code"), [F.col("price_krw"), F.col("product_code")])
    return numbered.select("product_code", "no")


def _mapped(row: dict[str, Column]) -> Column:
    return F.create_map(*(x for k, v in row.items() for x in (F.lit(k), v.cast("string"))))


@query
def list_detail_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as list rows, their last line as the detail row that is laid over them."""
    orders = src.read_table(spark, sf_dir, "orders")
    lists = orders.select("o_orderkey", _mapped({"상품코드": F.col("o_orderkey"), "price": F.round("o_totalprice").cast("bigint"), "name": F.col("o_orderstatus")}).alias("row"))
    line = src.read_table(spark, sf_dir, "lineitem")
    detail = line.select(
        _mapped({"상품코드": F.col("l_orderkey"), "price": F.round("l_extendedprice").cast("bigint"), "flag": F.when(F.col("l_linenumber") > 3, "").otherwise(F.col("l_returnflag"))}).alias("row"),
        F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey").alias("seq"),
    )
    merged = I.merge_list_detail(lists, detail, "seq")
    return merged.select("o_orderkey", *(I.value(F.col("row"), k).alias(k) for k in ("price", "name", "flag")))


@query
def detail_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an order, suppliers' nations: two kinds of details as one row for each key."""
    a = src.read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), _mapped({"d": F.col("c_nationkey")}).alias("row"))
    b = src.read_table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 2).alias("key"), _mapped({"f": F.col("s_nationkey")}).alias("row"))
    return I.merge_details(a, b, "key").select("key", I.value(F.col("row"), "d").alias("d"), I.value(F.col("row"), "f").alias("f"))


@query
def discount_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = I.add_discount_rate(_products(spark, sf_dir), "price_krw", "original_price_krw")
    return rated.groupBy("discount_rate").agg(F.count("*").alias("row_count"))


@query
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = src.read_table(spark, sf_dir, "documents").select(F.when(F.col("lang") != "es", F.concat(F.lit(" "), "lang")).alias("source_category"))
    return A.category_counts(docs)


@query
def nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = src.read_table(spark, sf_dir, "orders").select("o_orderpriority", F.floor("o_totalprice").cast("bigint").alias("v"))
    return A.nearest_rank(orders, ["o_orderpriority"], "v", {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99})


@query
def set_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products outside a category set that lacks one and has another that no product is in."""
    products = _products(spark, sf_dir)
    wanted = products.select(F.col("source_category").alias("category")).distinct().where("category <> 'SMALL'").unionByName(spark.range(1).select(F.lit("NONE").alias("category")))
    outside = G.membership_violations(products, wanted).agg(F.count("*").alias("n")).select(F.lit("outside").alias("check"), "n")
    gaps = G.coverage_gaps(products, wanted).agg(F.count("*").alias("n")).select(F.lit("gaps").alias("check"), "n")
    sides = G.same_set(products.select(F.col("source_category").alias("category")).distinct(), wanted).groupBy(F.col("side").alias("check")).agg(F.count("*").alias("n"))
    twice = G.duplicates(products, "seller").agg(F.count("*").alias("n")).select(F.lit("twice").alias("check"), "n")
    return outside.unionByName(gaps).unionByName(sides).unionByName(twice)


@query
def payload_json_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = src.read_table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 7 == 0, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    return events.groupBy("event_type").agg(F.count_if(X.valid_json(text)).alias("valid"), F.count_if(~X.valid_json(text)).alias("invalid"))


@query
def page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = src.read_table(spark, sf_dir, "pages")
    any_page, b_page, g = (P.gate(F.col("html"), F.col("url"), k) for k in ("", "b", "global"))
    return pages.select("page_id", any_page["ok"].alias("ok"), any_page["reason"].alias("reason"), b_page["reason"].alias("b_reason"), g["reason"].alias("global_reason"), P.triage(g["reason"]).alias("triage"))


@query
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = P.link_table(src.read_table(spark, sf_dir, "pages"))
    return links.select("page_id", F.col("link_no").cast("long").alias("link_no"), "href", X.absolute_url(F.col("href"), F.col("url")).alias("target"))


@query
def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = P.line_table(src.read_table(spark, sf_dir, "pages"))
    return lines.select("page_id", F.col("line_no").cast("long").alias("line_no"), "line")


@query
def section_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = src.read_table(spark, sf_dir, "pages").select("page_id", P.lines(F.col("html"), True).alias("lines"))
    return pages.select("page_id", P.section_text(F.col("lines"), ("that", "dans"), ("with", "pour"), most=12_000).alias("section"))


@query
def page_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail records of all pages by the gate of provider B, which needs no product sign off its item pages."""
    found = P.detail_records(src.read_table(spark, sf_dir, "pages"), "b")
    return found.select("page_id", "success", "error", "product_name", "page_title")


@query
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = src.read_table(spark, sf_dir, "pages")
    return pages.select("page_id", P.element_text(F.col("html"), "title").alias("title"), F.size(P.key_values(F.col("html"))).cast("long").alias("n_pairs"), F.size(P.image_candidates(F.col("html"), F.col("url"), F.lit(""))["all"]).cast("long").alias("n_images"))


@query
def search_json_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search responses, one for each order with its lines under ``data``, and the products in them."""
    line = src.read_table(spark, sf_dir, "lineitem")
    item = F.struct(F.col("l_partkey").alias("no"), F.concat(F.lit("part "), "l_partkey").alias("name"), F.round("l_extendedprice").cast("bigint").alias("salesPrice"))
    other = F.struct(F.concat(F.lit("category-"), "l_suppkey").alias("no"), F.lit("group").alias("name"))
    responses = line.groupBy("l_orderkey").agg(F.collect_list(F.to_json(F.struct(item.alias("p"), other.alias("c")))).alias("x"))
    responses = responses.select("l_orderkey", F.concat(F.lit('{"data":['), F.array_join("x", ","), F.lit("]}")).alias("body"))
    found = J.product_rows(responses, "l_orderkey", "body")
    return found.groupBy("l_orderkey").agg(F.count("*").alias("n_products"), F.min(F.col("product_code").cast("bigint")).alias("first_code"))


@query
def category_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category names in menus of any shape, one menu for each part: names with parentheses, in objects of objects, in
    lists, repeated, too long or of no use."""
    p = spread(src.read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name"), "p_partkey", PAGES_A_TASK)
    text = lambda *cols: F.concat(*(c if isinstance(c, Column) else F.lit(c) for c in cols))
    names = [
        F.struct(F.struct(text(F.col("p_brand"), " (제철)").alias("title")).alias("name")),
        F.struct(F.struct(F.struct(text(" ", F.col("p_name"), "&amp;  co ").alias("text")).alias("label")).alias("displayName")),
        F.struct(F.struct(F.array(F.lit("쌀"), F.lit(""), text("n", F.col("p_partkey"))).alias("label")).alias("groupName")),
        F.struct(F.array(F.lit("no name")).alias("title"), F.col("p_partkey").alias("label")),
        F.struct(F.struct(F.struct(F.lit("x").alias("other")).alias("name")).alias("title")),
        F.struct(F.lit("더보기").alias("name"), F.lit("a<b>").alias("label"), F.lit("과").alias("title"), F.lit("a much longer name than fits").alias("categoryName")),
        F.struct(F.array(F.struct(text(F.col("p_brand"), " (제철)").alias("mainCategoryName"), text(" ", F.col("p_type"), "\n").alias("subCategoryName"))).alias("children")),
    ]
    menu = F.concat(F.lit('{"menu":['), F.concat_ws(",", *(F.to_json(n) for n in names)), F.lit("]}"))
    return J.category_keywords(p.select("p_partkey", menu.alias("body")), "p_partkey", "body").withColumn("position", F.col("position").cast("long"))


@query
def event_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = src.read_table(spark, sf_dir, "events")
    link = F.when(F.col("event_id") % 5 == 0, "  ").otherwise(F.concat(F.lit("/user/"), "user_id"))
    rows = events.select(F.col("event_id").cast("string").alias("event_uuid"), F.lit("web").alias("source"), link.alias("url"), "event_type", F.col("props").alias("payload"))
    messages = sinks.event_messages(rows)
    back = F.from_json("value", T.StructType([T.StructField(c, T.StringType()) for c in rows.columns]))
    return messages.select("key", back.alias("e")).select("key", F.col("e.event_uuid").alias("event_uuid"), F.col("e.payload").alias("payload"))


@query
def raw_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as collected rows of texts, through typed payloads to raw history rows."""
    p = _products(spark, sf_dir)
    row = _mapped(
        {
            "상품코드": F.col("product_code"),
            "상품명_목록": F.col("product_name"),
            "국내_상품명": F.when(F.col("order_count") % 2 == 0, F.concat(F.lit(" "), "product_name", F.lit(" x"))).otherwise(""),
            "목록_판매가_KRW": X.thousands(F.col("price_krw")),
            "목록_정가_KRW": F.when(F.col("review_count") > 40, "n/a").otherwise(F.col("original_price_krw").cast("string")),
            "국내_리뷰수": F.col("review_count"),
            "국내_수집성공": F.when(F.col("order_count") > 3, "True").otherwise("false"),
            "목록_이미지URL": F.concat_ws("|", F.lit("a.jpg"), F.col("brand"), F.lit("a.jpg")),
        }
    )
    raw = I.raw_rows(I.payload_a(p.select(row.alias("row")), "run", F.timestamp_seconds(F.lit(1785952464))), "collector")
    return raw.select("product_code", "product_name", "list_price_krw", "list_original_price_krw", "review_count", F.col("korean_collect_success").cast("long").alias("korean_collect_success"), F.size("all_image_urls").cast("long").alias("n_images"), F.get_json_object("payload", "$.provider").alias("provider"))


@query
def collected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two list sources unioned, each code once, balanced over categories, merged with details."""
    p = _products(spark, sf_dir).withColumn("code", F.substring_index("product_code", "-", 2)).withColumn("seq", F.concat_ws("|", "product_code", F.lpad(F.col("price_krw").cast("string"), 12, "0")))
    row = _mapped({"상품코드": F.col("code"), "수집카테고리": F.col("source_category"), "상품명": F.col("product_name"), "판매가_목록": F.col("original_price_krw")})
    lists = p.select(row.alias("row"), "seq")
    chosen = C.select_list_rows([lists.where("seq < '2'"), lists.where("seq >= '2'")], total=0, shards=4)
    detail = p.select(_mapped({"상품코드": F.col("code"), "상세_가격_KRW": F.col("price_krw"), "상세_판매자": F.col("seller")}).alias("row"), "seq")
    raw = C.build_raw_rows(chosen.select("row", "seq", "no", "shard_index"), detail, provider="kurly", run_uuid="run", at=F.timestamp_seconds(F.lit(1785952464)), source="collector")
    return raw.select("product_code", "source_category", "list_price_krw", "list_original_price_krw", "detail_price_krw", "seller")


@query
def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _products(spark, sf_dir).withColumn("text", F.concat_ws("  ", "product_name", "brand"))
    return A.keyword_search_text(rows, ["source_category"])


@query
def text_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = src.read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.size(X.tokens(F.lower("text"))).cast("long").alias("n_tokens"), F.length(X.slug(F.col("text"))).cast("long").alias("slug_chars"))


@query
def prices_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _products(spark, sf_dir)
    n = F.col("order_count")
    text = F.when(n == 1, F.concat(F.lit("쿠폰적용가 99 판매가 "), X.thousands(F.col("price_krw")), F.lit(" 원 krw 77"))).when(n == 2, F.concat(F.lit("US$ 12 / ₩"), F.col("price_krw"))).when(n == 3, F.concat(F.lit("from 1,234 to "), X.thousands(F.col("price_krw") + 1000000)))
    text = text.when(n == 4, F.concat(F.lit("krw "), F.col("price_krw"), F.lit(" (￦ 5)"))).when(n == 5, F.concat(F.lit("판매가 1,000 ￦"), X.thousands(F.col("price_krw")))).when(n == 6, F.concat(F.lit("쿠폰적용가"), F.col("price_krw"))).otherwise("sold out")
    return p.select("product_code", X.price_krw(text).alias("price"))


@query
def numbers_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dollar prices, first numbers, plain decimals and product codes of texts."""
    # a column of its own, so that it is computed once for the three texts that it is part of
    p = _products(spark, sf_dir).select("product_code", "order_count", "price_krw", "l_partkey", X.thousands(F.col("price_krw")).alias("shown"))
    n, price, shown = F.col("order_count"), F.col("price_krw"), F.col("shown")
    dollars = F.concat(F.lit("now US $ "), shown, F.when(n > 3, ".5").otherwise(""), F.lit(" only"))
    link = F.when(n == 1, F.concat(F.lit("x?GoodsCode="), "l_partkey")).when(n == 2, F.concat(F.lit("itemNo="), "l_partkey")).when(n == 3, F.concat(F.lit("Item No. : "), "l_partkey")).when(n == 4, F.concat(F.lit("/p/"), F.col("l_partkey") + 10000000)).otherwise("/p/1234567")
    return p.select(
        "product_code",
        X.price_usd(dollars).alias("usd"),
        X.first_number(F.concat(F.lit("of 12,34 and "), price)).alias("ungrouped"),
        X.first_number(F.concat(F.lit("about "), shown, F.lit(" pieces"))).alias("grouped"),
        X.parse_float(F.concat(shown, F.lit(".25"))).alias("decimal"),
        X.product_code(link).alias("code"),
        X.platform_of(F.when(n > 4, "https://Item.gmarket.co.kr/x").when(n > 2, X.GLOBAL_ITEM).otherwise("/")).alias("platform"),
    )


@query
def link_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and item pages of products from attributes and scripts of their links."""
    p = _products(spark, sf_dir)
    n, code = F.col("order_count"), F.col("l_partkey").cast("string")
    raw = (
        F.when(n == 1, F.concat(F.lit("javascript:SearchListPage.viewUrl('\\/item?goodscode="), code, F.lit("&amp;a=1')")))
        .when(n == 2, F.concat(F.lit("x http://item.gmarket.co.kr/Item?goodscode="), code, F.lit(" y")))
        .when(n == 3, F.concat(F.lit("go('http://global.gmarket.co.kr/item?goodscode="), code, F.lit("')")))
        .when(n == 4, F.concat(F.lit("%2Fn%3FgoodsNo%3D"), code))
        .otherwise("nothing")
    )
    found = X.url_triple(raw, F.when(n == 5, code).otherwise(""))
    return p.select("product_code", found["code"].alias("code"), found["domestic"].alias("domestic"), found["foreign"].alias("foreign_url"))


@query
def list_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages, one of each order, with a card of two links for each line, and the products in them."""
    line = src.read_table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", F.round("l_extendedprice").cast("bigint").alias("price")).alias("x"))

    def card(x: Column) -> Column:
        link = F.concat(F.lit('<a class="image" href="/n?goodscode='), x["l_partkey"].cast("string"), F.lit('"><img alt="'), F.when(x["l_linenumber"] % 2 == 0, "Cart").otherwise(""), F.lit('" src="/i/'), x["l_partkey"].cast("string"), F.lit('.jpg"></a>'))
        name = F.concat(F.lit("<a href='/n?goodscode="), x["l_partkey"].cast("string"), F.lit("'> Part <b>"), x["l_partkey"].cast("string"), F.lit("</b></a>"))
        price = F.concat(F.lit('<s class="o-price">'), X.thousands(x["price"] + 1000), F.lit('원</s><strong class="s-price">'), X.thousands(x["price"]), F.lit("원</strong>"))
        return F.concat(F.lit("<div>"), link, name, price, F.lit("</div>"))

    pages = line.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), card), "").alias("body"))  # of one order
    pages = pages.select(F.col("l_orderkey").alias("page_id"), F.lit("https://shop.example/list").alias("url"), F.concat(F.lit('<a href="/about">About</a>'), "body").alias("html"))
    return P.list_rows(pages).drop("link_no")


def _item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for every part, without what tells its kind."""
    part = spread(src.read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), "p_partkey", PAGES_A_TASK)
    return part.withColumn("page_id", F.col("p_partkey")).withColumn("n", F.col("p_partkey") % 5).withColumn("price", F.col("p_partkey") * 10 + 1000)


@query
def korean_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of provider A: every fifth shows no sign of a product where the second gate looks."""
    p = _item_pages(spark, sf_dir)
    title = F.when(F.col("n") == 1, "Access Denied").otherwise(F.col("p_name"))
    meta = F.when(F.col("n") == 0, "").otherwise(F.concat(F.lit('<meta property="og:title" content="'), "p_name", F.lit(' set">')))
    table = F.concat(F.lit("<table><tr><th>원산지</th><td>"), "p_brand", F.lit("</td></tr><tr><th>모델명</th><td>M"), "p_partkey", F.lit("</td></tr></table>"))
    text = F.concat(F.lit("<div>판매가 "), X.thousands(F.col("price")), F.lit("원</div><div>상품평 "), F.col("n"), F.lit("</div><h2>상품상세정보</h2><p>about "), "p_partkey", F.lit("</p><p>Quantity</p><h2>배송</h2><p>free</p>"))
    html = F.concat(F.lit("<html><head><title>"), title, F.lit("</title>"), meta, F.lit("</head><body><p>"), F.repeat(F.lit("xy "), 400), F.lit("</p>"), table, text, F.lit("</body></html>"))
    found = P.detail_records(p.select("page_id", F.concat(F.lit("https://item.gmarket.co.kr/Item?goodscode="), "p_partkey").alias("url"), html.alias("html")), "korean")
    return found.select("page_id", "product_code", "success", "error", "product_name", "origin", "model", "price_krw", "review_count", "description_text")


@query
def domestic_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled field of pages of provider A, and prices, brands, sellers and counts that stand in scripts alone;
    texts are longer than is kept."""
    p, key = _item_pages(spark, sf_dir), F.col("p_partkey").cast("string")
    scripted = F.col("n") < 2
    rows = [F.when(scripted & F.lit(f in ("brand", "seller")), "").otherwise(F.concat(F.lit(f"<tr><th>{names[0]}</th><td>{f}-"), key, F.lit("</td></tr>"))) for f, names in P.KOREAN_FIELDS.items()]
    script = F.concat(F.lit('<script>{"brandName": "B'), key, F.lit('", "shopName":"S'), key, F.lit('", "sellPrice": "'), F.col("price"), F.lit('", "reviewCount": 12, "orderCount":"1,203"}</script>'))
    links = F.concat(F.lit('<a href="/category/1">홈</a><a href="/Category/2">Tools</a><a href="/category/3">'), "p_brand", F.lit('</a><a href="/category/4">Tools</a><a href="/x">Other</a>'))
    text = F.concat(F.lit("<h2>상품상세정보</h2><p>"), F.repeat(F.lit("가나다라마 "), 1200), F.lit("</p><h2>배송</h2>"))
    shown = F.when(scripted, "<p>판매가 7,777원</p>").otherwise(F.concat(F.lit('<b class="box price-now">판매가 '), X.thousands(F.col("price")), F.lit("원</b>")))
    html = F.concat(F.lit("<html><head><title>T</title>"), F.when(scripted, script).otherwise(""), F.lit("</head><body><h1>"), "p_name", F.lit("</h1>"), shown, links, F.lit("<table>"), F.concat(*rows), F.lit("</table>"), text, F.lit("</body></html>"))
    found = P.detail_records(p.select("page_id", F.concat(F.lit("https://item.gmarket.co.kr/Item?goodscode="), key).alias("url"), html.alias("html")), "korean")
    sizes = [F.length(c).cast("long").alias(f"{c}_chars") for c in ("description_text", "body_text")]
    return found.select("page_id", "success", "product_name", "category_path", "price_raw", "price_krw", "review_count", "order_count", *P.KOREAN_FIELDS, *sizes)


@query
def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of every place they stand in, thumbnails with their larger forms, noise left out, scores, and limits."""
    p, key = _item_pages(spark, sf_dir), (F.col("p_partkey") + 90_000_000).cast("string")
    many = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit('<img src="/detail/'), k.cast("string"), F.lit('.png">'))), "")
    html = F.concat(
        F.lit('<head><meta property="og:image" content="//img.example/'), key, F.lit('.jpg"></head><body><img alt="x" data-src="/a/still/300/b" src="/a/logo.png"><p style="x:url( \'/bg.gif\' ); y:url(/desc/2.gif)"></p>'),
        F.lit('<script>"\\/\\/gdimg.example\\/'), key, F.lit('\\/still\\/80" "https:\\/\\/gi.esmplus.com\\/q"</script>'), F.when(F.col("n") == 0, many).otherwise(""), F.lit("</body>"),
    )
    url = F.concat(F.lit("https://item.example/p?goodscode="), key)
    found = p.select("page_id", P.image_candidates(html, url, key).alias("i"))
    return found.select("page_id", F.array_join("i.all", " ").alias("images"), F.array_join("i.description", " ").alias("described"))


@query
def global_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of provider A abroad: labels with values on the next lines, prices and options."""
    p = _item_pages(spark, sf_dir)
    rows = ["Item No. : 1", "Seller", "open", F.col("p_brand"), "Shipping fee", "Item Weight", "3 kg", F.concat(F.lit("$ "), F.col("n"), F.lit(".5 (₩"), X.thousands(F.col("price")), F.lit(")")), "Item 1 red", "Quantity", "5 left", "Item 2 blue", "Confirm", F.col("p_name"), "Review 12 of 3", "Order 7"]
    body = F.concat(*(F.concat(F.lit("<p>"), r if isinstance(r, Column) else F.lit(r), F.lit("</p>")) for r in rows))
    html = F.concat(F.lit("<html><head><title>t</title></head><body><h1>"), "p_name", F.lit("</h1>"), body, F.lit("<p>"), F.repeat(F.lit("xy "), 300), F.lit("</p></body></html>"))
    found = P.detail_records(p.select("page_id", F.lit("https://global.gmarket.co.kr/item").alias("url"), html.alias("html")), "global")
    return found.select("page_id", "success", "product_name", "seller", "shipping_fee", "weight", "price_usd", "price_krw", "options", "review_count", "order_count")


@query
def korean_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of Korean, mixed and full-width names: normal form, endings and particles."""
    names = F.array(*(F.lit(x) for x in ("무료배송 Fresh Apples 국산 사과를 500g", "강아지사료 전용", "ＡＰＰＬＥＳ 사과를", "")))
    p = _products(spark, sf_dir).withColumn("product_name", F.get(names, F.col("l_partkey") % 4)).withColumn("source_category", F.lit("식품")).withColumn("brand", F.lit("brand"))
    found = K.add_keywords(p, repeated=True).select(F.explode("keywords").alias("keyword"))
    return found.groupBy("keyword").agg(F.count("*").alias("row_count"))


@query
def capped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most five products of a category; the cap is the operator's own."""
    return R.capped_per_group(_products(spark, sf_dir), "source_category", [F.desc("price_krw"), F.asc("product_code")], 5).select("source_category", "product_code")


@query
def first_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers among the evidence of each scope."""
    return R.provider_counts(R.top_products(RF.in_scopes(_products(spark, sf_dir)), ["scope_slug"]), ["scope_slug"])


@query
def ndjson_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as lines of JSON and scanned with a declared schema."""
    events, path = src.read_table(spark, sf_dir, "events").select("event_id", "event_type", "value"), work_path(spark, "ndjson")
    events.write.json(path)
    return src.read_ndjson(spark, path, events.schema).groupBy("event_type").agg(F.count("*").alias("row_count"), F.max("event_id").alias("last_id"))


@query
def tabular_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as a sheet whose headers have other names; rows without a code go."""
    path = work_path(spark, "tabular")
    orders = src.read_table(spark, sf_dir, "orders")
    code = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey"))
    orders.select(code.alias("goods no"), F.concat(F.lit(" a,\"b\" "), "o_orderstatus").alias("Name"), F.round("o_totalprice").cast("bigint").alias("price")).write.option("header", True).option("escape", '"').csv(path)
    return src.read_tabular(spark, path, {"product_code": ["code", "goods no"], "product_name": ["name", "Name"], "price": ["price"], "brand": ["brand"]})


@query
def report_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets of a run, written and read back."""
    p, path = _products(spark, sf_dir), work_path(spark, "report")
    summary = A.run_summary(p, {"rows": F.count("*"), "codes": F.count_distinct("product_code"), "dearest": F.max("price_krw")})
    sinks.write_report(path, summary=summary, categories=A.category_counts(p), rows=p.select("product_code", F.array("brand", "seller").alias("names")))
    sheet = lambda name: spark.read.option("header", True).csv(f"{path}/{name}")
    rows = sheet("rows").agg(F.count("*").cast("string").alias("value"), F.max("names").alias("names"))
    out = sheet("summary").unionByName(sheet("categories").select(F.concat(F.lit("category "), "category").alias("fact"), F.col("row_count").alias("value")))
    return out.unionByName(rows.select(F.lit("sheet rows").alias("fact"), "value")).unionByName(rows.select(F.lit("last names").alias("fact"), F.col("names").alias("value")))


@query
def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to the history, and its newest rows."""
    p, path = _products(spark, sf_dir), work_path(spark, "history")
    for run in (1, 2):
        rows = p.where(F.col("order_count") >= run).select("provider", "product_code", (F.col("price_krw") + run).alias("price_krw"), F.concat(F.substring("collected_at", 1, 4), F.lit("-01-01 00:00:00")).alias("collected_at"), F.lit(run).alias("version"), F.lpad(F.col("price_krw").cast("string"), 12, "0").alias("uuid"))
        sinks.write_events(rows, mode="table", path=path)
    # an aggregate over whole rows reads, sorts and sends all their columns, so those that nothing asks for are left out
    newest = I.latest_products(spark.read.parquet(path).select("provider", "product_code", "version", "uuid", "price_krw"))
    return newest.groupBy("provider", "version").agg(F.count("*").alias("row_count"), F.sum("price_krw").alias("price_sum")).withColumn("version", F.col("version").cast("long"))


@query
def retried_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose payload cannot be read are tried a second time from their own text."""
    events = src.read_table(spark, sf_dir, "events").select("event_id", "event_type", "props")

    def attempt(rows: DataFrame, number: int) -> DataFrame:
        text = F.when((F.col("event_id") % 11 == 0) & (F.lit(number) == 1) | (F.col("event_id") % 33 == 0), "{broken").otherwise(F.col("props"))
        return rows.select("event_id", "event_type", X.valid_json(text).alias("success"), F.lit(number).cast("long").alias("attempt"))

    done = I.retry_failed(events, attempt, "event_id")
    return done.groupBy("attempt", "success").agg(F.count("*").alias("row_count"))


def _standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products over the ten standard categories, by part."""
    names = F.array(*(F.lit(c) for c in CATEGORIES))
    return _products(spark, sf_dir).withColumn("source_category", F.get(names, F.col("l_partkey") % len(CATEGORIES)))


@query
def classified_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _standard(spark, sf_dir).withColumn("source_category", F.when(F.col("order_count") == 1, "기타").otherwise(F.col("source_category")))
    return RF.classify(raw, normalise=False).groupBy("source_category").agg(F.count("*").alias("product_count"))


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RF.prepare_plain(_standard(spark, sf_dir), normalise=False, repeated=True)


@query
def radar_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and figures read back from the nested payload of every scope."""
    text = RF.radar(_prepared(spark, sf_dir), "2026-08-06 02:54:24.934").select("scope_slug", F.to_json("payload").alias("j"))
    j = lambda path: F.get_json_object("j", path)
    return text.select(
        "scope_slug",
        j("$.summary.product_count").cast("long").alias("product_count"),
        j("$.summary.median_price_krw").cast("long").alias("median_price_krw"),
        F.json_array_length(j("$.price_bands")).cast("long").alias("n_bands"),
        F.json_array_length(j("$.categories")).cast("long").alias("n_categories"),
        F.json_array_length(j("$.products")).cast("long").alias("n_products"),
        j("$.products[0].product_code").alias("first_product"),
    )


@query
def keyword_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = RF.keyword_mart(_prepared(spark, sf_dir), 1785952464934, "2026-08-06 02:54:24.934", normalise=False)
    return mart.select("scope_slug", "keyword", "keyword_key", "product_count", "category_count", "min_price_krw", "median_price_krw", "max_price_krw", "source_product_count", F.json_array_length("categories_json").cast("long").alias("n_categories"), F.json_array_length("products_json").cast("long").alias("n_evidence"))


@query
def refresh_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole refresh into new folders, then what a reader sees through the marker."""
    base = work_path(spark, "refresh")
    to = RF.Targets(f"{base}/snapshots", f"{base}/mart", f"{base}/markers")
    RF.refresh(spark, _standard(spark, sf_dir), to, AT, str(uuid.uuid4()), normalise=False, repeated=True)
    seen = sinks.read_published(spark, to.snapshots, to.markers)
    return seen.select("scope_slug", "scope_category", "source_product_count", "source_max_collected_at", X.valid_json(F.col("payload_json")).alias("valid"))


@query
def published_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh after another one's marker, and rows of an attempt that broke off beside it: figures of the last
    marker, rows that readers see, and rows that had no category."""
    base, rows = work_path(spark, "refresh"), _standard(spark, sf_dir)
    to = RF.Targets(f"{base}/snapshots", f"{base}/mart", f"{base}/markers")
    raw = rows.withColumn("source_category", F.when(F.col("order_count") == 1, "기타").otherwise(F.col("source_category")))
    sinks.write_marker(spark, {"refresh_uuid": "first", "attempt": "left over", "version": 1}, to.markers, 0)
    done = RF.refresh(spark, raw, to, AT, "second", normalise=False, repeated=True)
    sinks.write_mart(spark.read.parquet(to.mart).withColumn("attempt", F.lit("left over")), to.mart)
    found = G.marker_figures(sinks.read_markers(spark, to.markers), "second", done["version"])
    seen = sinks.read_published(spark, to.mart, to.markers).agg(F.count("*").alias("rows_seen"))
    return found.join(F.broadcast(seen), F.lit(True)).select(
        "marker_rows", "source_product_count", "expected_scope_count", "source_max_collected_at", (F.col("rows_seen") == F.col("keyword_row_count")).alias("whole"), F.lit(done["dropped_rows"]).alias("dropped_rows")
    )


@query
def decorated_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers in any spelling, products without a name."""
    p = _products(spark, sf_dir).withColumn("provider", F.when(F.col("l_partkey") % 3 == 0, F.upper(F.concat(F.lit(" "), "provider"))).when(F.col("l_partkey") % 3 == 1, "other").otherwise(F.col("provider")))
    p = p.withColumn("product_name", F.when(F.col("order_count") > 2, F.col("product_name")).otherwise(""))
    return RF.decorate(p).select("product_code", "provider", "provider_label", "product_label", "price_basis", "product_url")


@query
def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of payloads of both providers, with and without identifiers, times and addresses."""
    p, n = _products(spark, sf_dir), F.col("l_partkey") % 5
    link = lambda k: F.when(n == k, F.concat(F.lit(f" https://x/{k}/"), "product_code")).when(n == k + 1, "")
    payload = p.select("provider", "product_code", "collected_at", *(link(k).alias(c) for k, c in enumerate(("domestic_url", "global_url", "detail_url", "product_url", "source_url"))), F.when(n < 3, F.col("product_code")).otherwise(" ").alias("uuid"), F.when(n < 2, F.col("collected_at")).alias("created_at"))
    e = I.envelope(payload, "product", "crawler", "host-1", "10.0.0.1")
    e = e.select("*", F.json_tuple("payload", "product_code", "provider", "created_at").alias("product_code", "provider", "told_at"))  # parsed once
    made = F.col("event_uuid").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    stamp = F.col("created_at").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9:]{8}[.][0-9]{3}$")
    return e.select(
        "product_code", "provider", "url", "source", "host", "ip", "uuid_user", "event_type",
        F.when(made, "made").otherwise(F.col("event_uuid")).alias("event_uuid"), F.when(stamp & F.col("told_at").isNull(), "made").otherwise(F.col("created_at")).alias("created_at"),
    )


@query
def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published in two parts; messages of every partition, and whether its order is that of the parts."""
    TP.register(spark)
    path = work_path(spark, "topic")
    events = src.read_table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_uuid"), "event_type", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("https://x/사과-"), "user_id")).otherwise(" ").alias("url"), F.col("props").alias("payload"))
    for part in range(2):
        sinks.write_topic(events.where(F.col("event_uuid").cast("long") % 2 == part), TP.FORMAT, path=path, partitions="8")
    got = spark.read.format(TP.FORMAT).option("path", path).load().withColumn("odd", F.get_json_object("value", "$.event_uuid").cast("long") % 2)
    figures = got.groupBy("partition").agg(
        F.count("*").alias("row_count"), F.count_distinct("key").alias("key_count"), F.count_distinct("offset").alias("offsets"), F.max("offset").alias("last_offset"),
        F.max(F.when(F.col("odd") == 0, F.col("offset"))).alias("_even"), F.min(F.when(F.col("odd") == 1, F.col("offset"))).alias("_odd"),
    )
    return figures.select("partition", "row_count", "key_count", "offsets", "last_offset", F.coalesce(F.col("_even") < F.col("_odd"), F.lit(True)).alias("in_order"))


@query
def verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures that a refresh checks in storage, from tables with a broken payload and a wrong version."""
    p = RF.in_scopes(_standard(spark, sf_dir))
    n = p.groupBy("scope_slug").agg(F.count("*").alias("source_product_count"), F.max("collected_at").alias("source_max_collected_at"))
    rows = n.withColumn("version", F.lit(1785952464934)).withColumn("generated_at", F.lit("2026-08-06 02:54:24.934"))
    rows = rows.withColumn("version", F.lit(1)).withColumn("generated_at", F.when(F.col("scope_slug") == "all", "1970-01-01 00:00:00.001").otherwise("1970-01-01 00:00:01.000"))
    snaps = rows.withColumn("payload_json", F.when(F.col("scope_slug") == "all", "{").otherwise("{}"))
    mart = rows.withColumn("categories_json", F.lit("[]")).withColumn("products_json", F.lit("[]"))
    out = G.verification(snaps, mart, 1)
    return out.select("snapshot_rows", F.array_join("snapshot_scopes", ",").alias("snapshot_scopes"), "snapshot_invalid_payloads", "snapshot_source_product_count", "keyword_rows", "keyword_invalid_payloads")


def _stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files, in order of time, so that a watermark finds no row late."""
    table = src.read_table(spark, sf_dir, "events")
    path = work_path(spark, "stream-in")
    table.repartitionByRange(4, "ts").write.parquet(path)
    return ST.read_stream(spark, path, table.schema, files_a_batch=2)


@query
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches appended once by token; the stream is run twice over the same files."""
    stream = _stream_source(spark, sf_dir).withColumn("payload", F.to_json(F.struct("event_id", "props")))
    out = work_path(spark, "stream-out")
    for k in range(2):
        ST.publish(stream, TI.append_once(out, "events", every=2), f"{out}-checkpoint{k}").awaitTermination()
    return TI.read_appended(spark, out).groupBy("event_type").agg(F.count("*").alias("row_count"))


@query
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event twice in the stream, once in the result."""
    stream = _stream_source(spark, sf_dir)
    twice = ST.drop_repeats(stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))), "event_id", "ts", "40 days")
    out = work_path(spark, "stream-out")
    ST.publish(twice, lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"), f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("row_count"))


@query
def stream_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished lines with their order, a stream and static join, published in micro-batches."""
    line = src.read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber")
    orders = src.read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    path, out = work_path(spark, "stream-in"), work_path(spark, "stream-out")
    line.repartition(4).write.parquet(path)
    stream = ST.enrich(ST.read_stream(spark, path, line.schema, files_a_batch=2), orders, "key")
    ST.publish(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"), f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out).groupBy("o_orderstatus").agg(F.count("*").alias("row_count"))


@query
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the files in one run of the query, the others after a restart from its checkpoint."""
    table, path = src.read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value"), work_path(spark, "stream-in")
    for half in range(2):
        table.where(F.col("event_id") % 2 == half).repartition(2).write.mode("append").parquet(path)
        LS.keep_latest(ST.read_stream(spark, path, table.schema), ["user_id"], ["ts", "event_id"], f"{path}-checkpoint").awaitTermination()
    return LS.read_latest(spark, f"{path}-checkpoint").select("user_id", "event_id", "event_type", "value")


@query
def stream_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events 2n and 2n+1 as the two detail pages of product n: two streams, joined where their times lie within six
    hours.  A last row far in the future tells either stream that nothing older will come."""
    events = src.read_table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 2).alias("code"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    last = spark.range(1).select(F.lit(-1).cast("long").alias("code"), F.lit("2100-01-01").cast("timestamp").alias("ts"), F.lit(-1).cast("long").alias("event_id"), F.lit(0.0).alias("value"))
    streams = []
    for side, name in enumerate(("domestic", "abroad")):
        path = work_path(spark, name)
        rows = events.where(F.col("event_id") % 2 == side).unionByName(last).withColumnsRenamed({"event_id": f"{name}_id", "value": f"{name}_value"})
        rows.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(path)
        streams.append(ST.read_stream(spark, path, rows.schema, files_a_batch=2))
    out = work_path(spark, "details")
    both = ST.join_details(*streams, "code", "ts", "6 hours", "1 day")
    ST.publish(both, lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"), f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out).where("code >= 0").select("code", "domestic_id", "domestic_value", "abroad_id", "abroad_value")


@query
def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes encoded and decoded again by type, with unreadable payloads as dead letters."""
    events = src.read_table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 11 == 0, "{broken").otherwise(F.col("props"))
    rows = events.select(F.col("event_id").cast("string").alias("event_uuid"), F.lit("").alias("url"), "event_type", text.alias("payload"))
    envelope = T.StructType([T.StructField(c, T.StringType()) for c in rows.columns])
    decoded = ST.decode(ST.encode(rows), "click", envelope, T.StructType([T.StructField("k", T.LongType())]))
    keep = decoded.withColumn("ok", F.col("data.k").isNotNull())
    return keep.groupBy("ok").agg(F.count("*").alias("row_count"), F.sum("data.k").alias("k_sum"))
