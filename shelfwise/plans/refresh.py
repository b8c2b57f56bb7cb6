"""The refresh: scopes, snapshots, keyword mart, gates and publication.

Every scope and slice is a key, and each kind of result is one grouped job over all of them, not a loop.  What is
counted comes from ``operators.cube``; lists come from products that may be in one, found before scopes, slices and
keywords repeat them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import keywords as K
from ..functions import scores as S
from ..functions.taxonomy import CATEGORIES, CATEGORY_SLUGS, normalise_category
from ..functions.text import uuid_v7
from ..operators import aggregates as A
from ..operators import checks as G
from ..operators import cube as Q
from ..operators import ranking as R
from ..operators.cube import KIND, SCOPE, Cube, in_scopes, price_cube
from ..sources import files, sinks
from ..sources.tables import materialise

# Notes on how figures may be used.
POLICY_NOTES = (
    ("derived_only", "파생 지표만 노출", "active", "기본 화면은 카테고리, 키워드, 가격군, 기회점수 같은 집계·파생 지표를 중심으로 제공합니다."),
    ("affiliate_asset_boundary", "제휴 자산 경계", "active", "상품명, 썸네일, 가격, 링크는 제휴 또는 공식 API가 허용한 범위에서만 제한적으로 노출합니다."),
    ("price_basis", "가격 기준 고지", "partial", "현재 가격은 수집 시점 관측가이며 배송비와 옵션 총액은 별도 데이터 연결 후 확정합니다."),
    ("affiliate_notice", "외부 이동 고지", "active", "외부몰 이동 전 가격/판매 여부 확인과 파트너 링크 가능성을 가까운 위치에 고지합니다."),
)
PRICE_BASIS = "수집 시점 관측가"
ALL_LABEL, CATEGORY_LABEL = "수집 기준 파생 가격/카테고리 인텔리전스", " 집중 가격/키워드 인텔리전스"


def _provider() -> Column:
    return F.when(F.lower(F.trim("provider")) == "kurly", "kurly").otherwise("gmarket")


def decorate(products: DataFrame, out_path: str = "/out/") -> DataFrame:
    """Provider and its label, product label, price basis and outbound path."""
    part = lambda c: F.replace(F.url_encode(F.col(c)), F.lit("+"), F.lit("%20"))
    df = products.withColumn("provider", _provider())
    link = F.concat(F.lit(out_path), part("provider"), F.lit("/"), part("product_code"), F.lit("/"))
    return (
        df.withColumn("provider_label", F.initcap("provider"))
        .withColumn("product_label", F.coalesce(F.nullif(F.col("product_name"), F.lit("")), F.col("product_code")))
        .withColumn("price_basis", F.lit(PRICE_BASIS))
        .withColumn("product_url", F.when(F.col("product_code") != "", link).otherwise(""))
    )


def classify(rows: DataFrame, normalise: bool = True, dropped: Observation | None = None, count: str | None = None) -> DataFrame:
    """Rows with their standard category; those without one are dropped, and counted in ``dropped``, where a row
    stands for ``count`` of them."""
    col = lambda c: F.col(c) if c in rows.columns else F.lit("")
    category = normalise_category(F.col("source_category"), col("category_path"), col("search_keyword"), F.col("product_name"), normalise)
    rows = rows.withColumn("source_category", category)
    if dropped is not None:
        n = F.col(count) if count else F.lit(1)
        total = lambda c: F.coalesce(F.sum(c), F.lit(0))
        rows = rows.observe(dropped, total(n).alias("rows"), total(F.when(F.col("source_category") == "", n)).alias("dropped"))
    return rows.where("source_category <> ''")


def prepare(rows: DataFrame, normalise: bool = True, dropped: Observation | None = None, repeated: bool = False) -> DataFrame:
    """Classified and decorated products with keywords, written once: many grouped jobs read them.

    ``repeated``: many products share names; category and keywords of each distinct case are made once.
    """
    return decorate(prepare_plain(rows, normalise, dropped, repeated))


def prepare_plain(rows: DataFrame, normalise: bool = True, dropped: Observation | None = None, repeated: bool = False) -> DataFrame:
    """``prepare`` without decoration, which lists put on the few products they show."""
    rows = rows.withColumn("provider", _provider())
    if not repeated:
        found = K.add_keywords(classify(rows, normalise, dropped), normalise)
        return materialise(found.withColumn(KIND, F.xxhash64("source_category", "keywords")), "products")
    names = [c for c in K.SOURCES if c in rows.columns]
    rows = materialise(rows.withColumn("_case", F.xxhash64(*names)), "rows")
    # written, or Spark would look for rows without a category before it groups them
    cases = materialise(rows.groupBy("_case", *names).agg(F.count("*").alias("_rows")), "case-names")
    known = classify(cases.withColumn("_names", F.struct(*names)), normalise, dropped, "_rows")
    known = K.add_keywords(known, normalise).withColumn(KIND, F.xxhash64("source_category", "keywords"))
    known = Q.small(known.select(F.col("_case").alias("_of"), "_names", "source_category", "keywords", KIND), "cases")
    same = F.col("_case") == F.col("_of")
    if not known.groupBy("_of").count().where("count > 1").isEmpty():  # two cases with one hash
        same = same & F.col("_names").eqNullSafe(F.struct(*(rows[c] for c in names)))
    plain = rows.join(known.withColumnRenamed("source_category", "_category"), same).withColumn("source_category", F.col("_category"))
    plain = plain.drop("_case", "_of", "_names", "_category")
    return plain if known.count() <= Q.FEW else materialise(plain, "products")


def _nested(rows: DataFrame, keys: list[str], name: str, order: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows of each key as an ordered array of structs; lists are limited before they get here."""
    cols = [c for c in rows.columns if c not in (*keys, *drop, order)]
    packed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*cols).alias("v"))))
    return rows.groupBy(*keys).agg(F.transform(packed, lambda x: x["v"]).alias(name))


PRODUCT_COLUMNS = ("provider", "provider_label", "product_code", "product_label", "product_name", "source_category", "search_keyword", "price_basis", "product_url", "price_krw", "original_price_krw", "review_count", "order_count", "brand", "seller", "collected_at", "keywords")
DEAL_COLUMNS = ("discount_percent", "category_median_price_krw", "below_category_median_percent", "radar_score", "reason")


def _shown(rows: DataFrame) -> DataFrame:
    """Listed products as they are shown: those of ``prepare_plain`` are decorated now."""
    return decorate(rows) if KIND in rows.columns and "provider_label" not in rows.columns else rows


def _sections(cube: Cube, keys: list[str]) -> DataFrame:
    """All parts of a payload that whole scopes (slice 0) and price slices have in common, one row per key."""
    ranges = lambda of_all, of_own, *without: Q.in_ranges(of_all(cube), of_own(cube), cube, without)
    whole, words = Q.sums_in_ranges(cube, words=False), Q.sums_in_ranges(cube, words=True)
    whole, words = materialise(whole, "whole-sums"), materialise(words, "word-sums")
    ranks = materialise(ranges(Q.category_ranks, Q.category_ranks), "category-ranks")
    categories = A.seller_insights(A.category_benchmarks(whole, keys, known=A.Known(ranges(Q.category_values, Q.category_values), ranks)))
    categories = materialise(categories, "categories")
    of_keywords = A.Known(ranges(Q.keyword_values, Q.word_values, "source_category"), ranges(Q.keyword_ranks, Q.word_ranks, "source_category"))
    of_pairs = A.Known(ranges(Q.word_values, Q.word_values), ranges(Q.word_ranks, Q.word_ranks))
    level = ("competition_level", "recommended_action")
    sellers = categories.select(*keys, "rank", "source_category", "product_count", "median_price_krw", "low_price_percent", "discounted_percent", *level)
    medians = ranges(Q.all_ranks, Q.category_ranks, "source_category").select(*keys, "median_price_krw")
    summary = A.scope_summary(whole, keys, medians)
    # the first of a longer list are those of a shorter one
    listed = lambda few, of_slice: F.col("position") <= F.when(F.col("slice") == 0, few).otherwise(of_slice)
    evidence = R.top_products(_evidence_rows(cube), keys, max(R.EVIDENCE_LIMIT, R.SLICE_EVIDENCE_LIMIT)).where(listed(R.EVIDENCE_LIMIT, R.SLICE_EVIDENCE_LIMIT))
    deals = R.best_deals(_deal_rows(cube), keys, max(R.DEAL_LIMIT, R.SLICE_DEAL_LIMIT)).where(listed(R.DEAL_LIMIT, R.SLICE_DEAL_LIMIT))
    have = [c for c in PRODUCT_COLUMNS if c in evidence.columns]
    parts = [
        summary.select(*keys, F.struct(*(c for c in summary.columns if c not in keys)).alias("summary")),
        _nested(A.price_bands(whole, keys), keys, "price_bands", "band"),
        _nested(categories.drop(*level), keys, "categories", "rank"),
        _nested(A.keyword_benchmarks(words, keys, known=of_keywords), keys, "keywords", "rank"),
        _nested(A.category_keywords(words, keys, known=of_pairs), keys, "category_keywords", "rank", ("category_rank",)),
        _nested(evidence.select(*keys, "position", *have), keys, "products", "position"),
        _nested(deals.select(*keys, "position", *have, *DEAL_COLUMNS), keys, "deal_candidates", "position"),
        _nested(sellers, keys, "seller_insights", "rank"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, keys, "left")  # a row per key on either side
    return materialise(out, "sections")


#: What tells in which lists a product may be, whatever scope and slice: all of one place are in the same ones.
PLACE = ["source_category", Q.OF_ALL, Q.OF_OWN, "provider"]


def _evidence_rows(cube: Cube, limit: int = max(R.EVIDENCE_LIMIT, R.SLICE_EVIDENCE_LIMIT)) -> DataFrame:
    """Products that may be among the first of any scope or slice, in each of them: among the first of their place."""
    rows = Q.placed(cube.products.where("price_krw is not null"), cube.edges)
    lead = S.reaction(F.col("review_count"), F.col("order_count"))
    first = materialise(R.may_be_first(rows, PLACE, lead, limit), "may-be-evidence")
    return Q.each_range(_shown(first), cube)


def _deal_rows(cube: Cube, limit: int = max(R.DEAL_LIMIT, R.SLICE_DEAL_LIMIT)) -> DataFrame:
    """Eligible products that may be among the best deals of a scope or slice, scored against its category median.

    A category has the same median in its own scope as in the whole of ``all``, so a product has three scores at most:
    in whole scopes, in its slice of ``all`` and in its slice of its own scope."""
    spans = (Q.WHOLE, Q.OF_ALL, Q.OF_OWN)
    ranks = Q.category_ranks(cube).select("source_category", "span", "slice", F.col("median_price_krw").alias("_m"))
    pieces = Q.by_category(cube.sums, cube).where(F.col(Q.OF_ALL) >= 0).select(*PLACE[:3]).distinct()
    for s in spans:
        mine = ranks.where(F.col("span") == s).select("source_category", F.col("slice").alias("_s"), F.col("_m").alias(f"_{s}"))
        at = F.lit(0) if s == Q.WHOLE else F.col(s)
        pieces = pieces.join(mine.withColumnRenamed("source_category", "_c"), (F.col("source_category") == F.col("_c")) & (F.col("_s") == at), "left").drop("_c", "_s")
    medians = Q.small(pieces, "piece-medians")
    rows = Q.placed(cube.products.where("price_krw is not null"), cube.edges).join(medians, PLACE[:3])
    every = F.array(*(F.struct(F.lit(s).alias("span"), F.col(f"_{s}").alias("category_median_price_krw")) for s in spans))
    rows = rows.withColumn("_f", F.explode(every)).select("*", "_f.*").drop("_f", *(f"_{s}" for s in spans)).where("category_median_price_krw is not null")
    first = materialise(R.may_be_deals(rows, [*PLACE, "span"], limit), "may-be-deals")
    first = R.scored(first)
    shown = Q.each_range(_shown(first), cube)
    whole, of_all = F.col("slice") == 0, (F.col("slice") > 0) & (F.col("scope_slug") == "all") & (F.col("scope_category") == "")
    return shown.where(F.col("span") == F.when(whole, Q.WHOLE).when(of_all, Q.OF_ALL).otherwise(Q.OF_OWN))


def radar(products: DataFrame, generated_at: str, cube: Cube | None = None) -> DataFrame:
    """One nested payload per scope.

    A whole scope is its slice 0, so each kind of result is one job over scopes and slices together.
    """
    cube = price_cube(products) if cube is None else cube
    ranges = Q.RANGES
    found = _sections(cube, [*SCOPE, "slice", *ranges])
    whole = found.where("slice = 0").drop("slice", *ranges).join(_nested(found.where("slice > 0"), SCOPE, "price_range_slices", "slice"), SCOPE, "left")
    options = whole.where("scope_slug = 'all'").select(F.col("categories").alias("category_options"))
    # one row; a category scope shows its benchmark as it stands among all categories
    whole = whole.join(F.broadcast(options), F.lit(True))
    own = F.filter("category_options", lambda c: c["source_category"] == F.col("scope_category"))
    notes = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in zip(("code", "label", "status", "detail"), n))) for n in POLICY_NOTES))
    label = F.when(F.col("scope_category") == "", ALL_LABEL).otherwise(F.concat("scope_category", F.lit(CATEGORY_LABEL)))
    return whole.select(
        *SCOPE,
        F.struct(
            F.lit("shopping").alias("provider"),
            label.alias("scope_label"),
            F.nullif(F.col("scope_category"), F.lit("")).alias("scope_category"),
            F.lit(generated_at[:19]).alias("generated_at"),
            "summary",
            "price_bands",
            F.when(F.col("scope_slug") == "all", F.col("categories")).otherwise(own).alias("categories"),
            "category_options",
            "keywords",
            "category_keywords",
            "price_range_slices",
            "products",
            "deal_candidates",
            F.array().cast("array<map<string,string>>").alias("price_drop_candidates"),
            "seller_insights",
            notes.alias("policy_notes"),
        ).alias("payload"),
    )


def _stamped(rows: DataFrame, facts: DataFrame, version: int, generated_at: str) -> DataFrame:
    return (
        rows.join(F.broadcast(facts), SCOPE)  # a row for each scope
        .withColumn("version", F.lit(version).cast("long"))
        .withColumn("generated_at", F.lit(generated_at))
        .withColumn("created_at", F.lit(generated_at))
    )


def scope_facts(cube: Cube) -> DataFrame:
    return in_scopes(Q.by_category(cube.sums, cube)).groupBy(*SCOPE).agg(F.max("collected_at").alias("source_max_collected_at"), F.sum("cell_count").alias("source_product_count"))


def snapshots(products: DataFrame, version: int, generated_at: str, cube: Cube | None = None) -> DataFrame:
    cube = price_cube(products) if cube is None else cube
    rows = radar(products, generated_at, cube).withColumn("payload_json", F.to_json("payload")).drop("payload")
    return _stamped(rows, scope_facts(cube), version, generated_at).withColumn("snapshot_uuid", uuid_v7(F.timestamp_millis("version")))


def _listed_rows(products: DataFrame, lead: Column, limit: int, group: list[str], descending: bool = True) -> DataFrame:
    """Products that may be among the first ``limit`` of a keyword: those of their kind, before keywords repeat them."""
    return R.may_be_first(products, [KIND, *group], lead, limit, descending)


def keyword_mart(products: DataFrame, version: int, generated_at: str, normalise: bool = True, cube: Cube | None = None) -> DataFrame:
    """Every keyword of every scope with its benchmark, search text and evidence products."""
    cube = price_cube(products, sliced=False) if cube is None else cube
    keys = [*SCOPE, "keyword"]
    words = materialise(in_scopes(Q.by_words(cube.sums, cube)), "mart-sums")

    def of(of_all, of_own, span: str) -> DataFrame:
        return Q.in_all(of_all(cube), span).unionByName(Q.in_own(of_own(cube), span).drop("source_category")).drop("slice")

    known = A.Known(of(Q.keyword_values, Q.word_values, Q.ANY), of(Q.keyword_ranks, Q.word_ranks, Q.WHOLE))
    bench = A.keyword_benchmarks(words, SCOPE, limit=None, known=known).withColumn("keyword_key", K.keyword_key(F.col("keyword"), normalise)).where("keyword_key <> ''")
    categories = words.groupBy(*keys).agg(F.array_sort(F.collect_set(F.nullif(F.trim("source_category"), F.lit("")))).alias("categories"))
    lead = S.reaction(F.col("review_count"), F.col("order_count"))
    rows = materialise(_listed_rows(cube.products, lead, R.EVIDENCE_LIMIT, ["provider"]), "may-be-evidence")
    rows = in_scopes(_shown(rows)).withColumn("keyword", F.explode("keywords"))
    have = [c for c in PRODUCT_COLUMNS if c in rows.columns]
    evidence = _nested(R.top_products(rows, keys).select(*keys, "position", *have), keys, "evidence", "position")
    texts = cube.products
    for n in A.CODE_BEGINS:  # few values first, then more among what is left
        texts = materialise(_listed_rows(texts, A.code_begins(n), A.SEARCH_ROWS, [], descending=False), "may-be-text")
    texts = _shown(texts)
    col = lambda c: F.coalesce(F.col(c), F.lit("")) if c in texts.columns else F.lit("")
    text = F.concat_ws(" ", *(col(c) for c in ("product_name", "product_label", "brand", "seller", "source_category", "category_path", "search_keyword", "product_code")))
    search = A.keyword_search_text(in_scopes(texts).withColumn("keyword", F.explode("keywords")).withColumn("text", text), keys)
    rows = bench.join(categories, keys).join(evidence, keys).join(search, keys)
    squeezed = F.lower(F.concat_ws(" ", "keyword", F.array_join("categories", " "), "search_text"))
    rows = rows.withColumn("search_text", F.substring(squeezed, 1, 12_000)).withColumn("categories_json", F.to_json("categories")).withColumn("products_json", F.to_json("evidence"))
    return _stamped(rows.drop("categories", "evidence", "rank", "interpretation"), scope_facts(cube), version, generated_at).withColumn("keyword_uuid", uuid_v7(F.timestamp_millis("version")))


@dataclass
class Targets:
    """Folders of a refresh."""

    snapshots: str
    mart: str
    markers: str


def refresh(spark: SparkSession, rows: DataFrame, to: Targets, generated: datetime, refresh_uuid: str, normalise: bool = True, categories: tuple[str, ...] = CATEGORIES, repeated: bool = False) -> dict:
    """Build, check, write, verify, and publish with a marker that is written last.

    ``rows`` come from ``sources.catalog.scan_latest``.  Nothing is written unless the build holds, and
    nothing is visible to ``read_published`` before the marker.  Every call writes as an attempt of its own, so what
    a failed one left is in no one's way; a refresh during which another one was published ends with
    ``PublishConflict``, and what it wrote goes.  The figures it returns tell how many rows had no category.
    """
    G.preflight(spark, to.snapshots, to.mart, to.markers)
    head, attempt = sinks.marker_head(spark, to.markers), uuid4().hex
    generated_at = generated.strftime("%Y-%m-%d %H:%M:%S.") + f"{generated.microsecond // 1000:03d}"
    version = spark.range(1).select(F.unix_millis(F.to_timestamp(F.lit(generated_at)))).first()[0]
    seen = Observation("classified")
    products = prepare_plain(rows, normalise, seen, repeated)
    cube = price_cube(products)
    snaps = materialise(snapshots(products, version, generated_at, cube), "snapshots")
    mart = materialise(keyword_mart(products, version, generated_at, normalise, cube), "mart")
    names = spark.createDataFrame([(c,) for c in categories], "category string")
    slugs = ["all", *(CATEGORY_SLUGS[c] for c in categories)]
    scopes = spark.createDataFrame([(s,) for s in slugs], "scope_slug string")
    G.require(G.build_checks(products, snaps, mart, names, scopes, version))
    keyword_rows = mart.count()
    facts = products.agg(F.count("*"), F.max("collected_at")).first()
    marker = {
        "refresh_uuid": refresh_uuid,
        "attempt": attempt,
        "version": version,
        "generated_at": generated_at,
        "source_max_collected_at": facts[1],
        "source_product_count": facts[0],
        "expected_scope_count": len(slugs),
        "snapshot_scope_count": len(slugs),
        "keyword_scope_count": len(slugs),
        "keyword_row_count": keyword_rows,
        "published_at": generated_at,
    }
    try:
        sinks.write_mart(mart.withColumn("attempt", F.lit(attempt)), to.mart)
        sinks.write_snapshots(snaps.withColumn("attempt", F.lit(attempt)), to.snapshots)
        mine = [spark.read.parquet(path).where(F.col("attempt") == attempt) for path in (to.snapshots, to.mart)]
        found = G.verification(*mine, version)
        G.require_verified(found, scopes=slugs, keyword_rows=keyword_rows, products=facts[0], latest=facts[1])
        sinks.write_marker(spark, marker, to.markers, head)
    except Exception:
        for path in (to.snapshots, to.mart):
            files.delete(spark, f"{path}/version={version}/attempt={attempt}")
            if not files.names(spark, f"{path}/version={version}"):
                files.delete(spark, f"{path}/version={version}")
        raise
    G.require_marker(sinks.read_markers(spark, to.markers), marker)
    return marker | {"dropped_rows": seen.get["dropped"]}
