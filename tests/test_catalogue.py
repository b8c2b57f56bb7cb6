"""Golden cases of the catalogue operators, and invariants."""

import collections
import json
from pathlib import Path
from datetime import datetime

import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from shelfwise import queries
from shelfwise.functions import keywords as K
from shelfwise.functions import scores as S
from shelfwise.functions import text as X
from shelfwise.functions.taxonomy import CATEGORIES, CATEGORY_SLUGS, normalise_category, standard_category
from shelfwise.operators import aggregates as A
from shelfwise.operators import checks as G
from shelfwise.operators import cube as Q
from shelfwise.operators import ingest as I
from shelfwise.operators import json_tree as J
from shelfwise.operators import pages as P
from shelfwise.operators import ranking as R
from shelfwise.plans import refresh as RF
from shelfwise.sources import sinks
from shelfwise.sources.tables import spread, work_path
from shelfwise.streaming import events as ST
from shelfwise.streaming import token_index as TI

PRODUCT = "provider string, product_code string, product_name string, source_category string, search_keyword string, seller string, brand string, price_krw long, original_price_krw long, review_count long, order_count long, collected_at string"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def ten_products(spark):
    rows = [("gmarket" if i % 2 else "kurly", f"product-{i:02d}", f"라벤더 {i}", c, f"키워드{i:02d}", "seller", "brand", 10000 + 1000 * i, 12000 + 1000 * i, i + 1, i, "2026-07-31 18:21:46") for i, c in enumerate(CATEGORIES)]
    return spark.createDataFrame(rows, PRODUCT)


def both(spark):
    rows = [("kurly", f"k{i}", "n", "식품", "", "s", "b", 9000 + i, 30000, 1000 - i, 0, "t") for i in range(20)]
    rows += [("gmarket", f"g{i}", "n", "식품", "", "s", "b", 19000 + i, 40000, 10 - i % 10, 0, "t") for i in range(20)]
    return spark.createDataFrame(rows, PRODUCT)


def test_text(spark):
    v = lambda s: F.lit(s)
    assert one(spark, X.clean_text(v("  a \n\t b　"))) == "a b"
    assert one(spark, X.unescape_entities(v("&amp;lt;&#39;"))) == "&lt;'"
    assert one(spark, X.slug(v(" 도서/취미/문구! "))) == "도서-취미-문구"
    assert [one(spark, X.parse_uint(v(s))) for s in ("1,200", "-3", "12a", "")] == [1200, None, None, None]
    assert one(spark, X.fnv1a_32(v("1001"))) == 597150807
    assert one(spark, X.range_label(F.lit(0), F.lit(12000))) == "~₩12,000"
    assert one(spark, X.nfkc_lower(v("ＡＢ①"))) == "ab1"
    assert one(spark, X.valid_json(v('{"a":1}}'))) is False and one(spark, X.valid_json(v("[1]"))) is True
    assert one(spark, X.piped_union(v("a | b"), v("b|c|"))) == ["a", "b", "c"]
    assert one(spark, X.absolute_url(v("\\/x?a=1&amp;b=2"), v("https://h.example/p"))) == "https://h.example/x?a=1&b=2"
    u = one(spark, X.uuid_v7(F.timestamp_millis(F.lit(1785952464934))))
    assert len(u) == 36 and u[14] == "7" and u.replace("-", "")[:12] == f"{1785952464934:012x}"


def test_scores(spark):
    d = lambda x: F.lit(float(x))
    assert one(spark, S.round2(d(1.005))) == 1.0
    assert one(spark, S.percent(F.lit(1), F.lit(3))) == 33.33 and one(spark, S.percent(F.lit(1), F.lit(0))) == 0
    assert [one(spark, S.round_boundary(F.lit(v))) for v in (1450, 24500, 123456, 1250000)] == [1500, 25000, 120000, 1300000]
    assert one(spark, S.deal_score(d(100), d(100), F.lit(9000))) == 100.0


def test_nearest_rank(spark):
    rows = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4)] + [("b", 7)], "k string, v long")
    got = {r.k: (r.p, r.q) for r in A.nearest_rank(rows, ["k"], "v", {"p": 0.5, "q": 0.75}).collect()}
    assert got == {"a": (3, 3), "b": (7, 7)}


def test_keywords(spark):
    rows = [("무료배송 Fresh Apples 국산 사과를 500g", "식품", "", "brand"), ("dogs dogs running shoes", "", "shoes", ""), ("강아지사료 전용", "", "", ""), ("", "", "", "")]
    df = spark.createDataFrame(rows, "product_name string, source_category string, search_keyword string, brand string")
    got = [r.keywords for r in K.add_keywords(df).collect()]
    again = df.unionByName(df).selectExpr("*", "nullif(brand, '') as category_path")
    assert sorted(r.keywords for r in K.add_keywords(again, repeated=True).collect()) == sorted(got + got)
    assert "appl" in got[0] and "사과" in got[0]  # over 5 letters, so the ending es goes
    assert "강아지" in got[1] and not any("shoe" in k or "신발" in k for k in got[1])
    assert got[2] == ["강아지"] and got[3] == []
    assert all(len(k) <= 8 for k in got)


def test_taxonomy(spark):
    cases = [("가공식품", "", "컵라면 12개입", "식품"), ("", "양배추", "국산 양배추 슬라이스", "식품"), ("취미/문구/펫", "", "강아지 사료 2kg", "유아/반려"), ("취미/문구/펫", "", "노트 필기구 세트", "도서/취미/문구"), ("e쿠폰", "", "커피 교환권", "여행/e쿠폰"), ("스포츠/건강", "", "등산 보호대", "스포츠/레저"), ("기타", "", "분류 불가 상품", "")]
    df = spark.createDataFrame(cases, "raw string, kw string, name string, want string")
    got = df.withColumn("got", normalise_category(F.col("raw"), F.lit(""), F.col("kw"), F.col("name"))).collect()
    assert [r.got for r in got] == [c[3] for c in cases]
    alias = {"떡·한과": "식품", "논알콜·무알콜": "식품", "식초·소스·드레싱": "식품", "프로틴": "뷰티/헬스", "스크럽 대디": "생활/주방", "보조배터리": "디지털/가전", "강아지 주식": "유아/반려", "취미·문구·펫": "도서/취미/문구", "모바일 쿠폰": "여행/e쿠폰"}
    df = spark.createDataFrame(list(alias.items()), "raw string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", standard_category(F.col("raw"))).collect())


def test_interleave(spark):
    top = R.top_products(both(spark), [], 10).orderBy("position").collect()
    assert [r.provider for r in top] == ["gmarket", "kurly"] * 5
    deals = R.deal_candidates(both(spark), [], 10).collect()
    assert sorted(r.provider for r in deals) == ["gmarket"] * 5 + ["kurly"] * 5
    single = R.top_products(both(spark).where("provider = 'kurly'"), [], 7)
    assert single.count() == 7


def test_bands_keep_empty_ones(spark):
    got = A.price_bands(ten_products(spark).withColumn("s", F.lit("x")), ["s"]).orderBy("band").collect()
    assert [r.product_count for r in got] == [1, 9, 0, 0, 0] and sum(r.product_percent for r in got) == 100


def test_slices_cover_all_prices(spark):
    df = ten_products(spark).withColumn("s", F.lit("x"))
    slices = A.price_slices(df, ["s"])
    assert A.in_slices(df, slices, ["s"]).count() == 10
    flat = df.withColumn("price_krw", F.lit(500).cast("long"))
    assert A.price_slices(flat, ["s"]).count() == 1


def test_shards_are_disjoint_and_complete(spark):
    rows = spark.createDataFrame([(str(1001 + i),) for i in range(5)], "code string")
    parts = [I.shard(rows, "code", 3, k) for k in range(3)]
    assert sorted(r.code for p in parts for r in p.collect()) == [str(1001 + i) for i in range(5)]


def test_payloads(spark):
    a = {"상품코드": "1234567890", "상품명_목록": "목록 이름", "국내_상품명": "국내 이름", "목록_판매가_KRW": "12,300", "국내_가격_KRW": "11900", "목록_이미지URL": "https://i/1.jpg|https://i/2.jpg", "국내_수집성공": "TRUE"}
    b = {"상품코드": "10012345", "할인가_목록": "7900", "판매가_목록": "9900", "상세_수집성공": "true", "이미지URL_목록": "https://i/1.jpg", "상세이미지_URL_1": "https://i/2.jpg"}
    rows = spark.createDataFrame([(a,), ({"상품명": "no code"},)], "row map<string,string>")
    at = F.timestamp_seconds(F.lit(1785952464))
    p = I.payload_a(rows, "run", at)
    r = p.first()
    assert p.count() == 1 and (r.product_name, r.list_price_krw, r.domestic_price_krw, len(r.all_image_urls)) == ("국내 이름", 12300, 11900, 2)
    raw = I.raw_rows(p, "src").first().asDict()
    assert "raw_row" not in raw and raw["korean_collect_success"] == 1 and json.loads(raw["payload"])["raw_row"]["상품코드"] == "1234567890"
    r = I.payload_b(spark.createDataFrame([(b,)], "row map<string,string>"), "run", at).first()
    assert (r.list_price_krw, r.list_original_price_krw, r.detail_collect_success, len(r.all_image_urls)) == (7900, 9900, True, 2)
    same = I.payload_b(spark.createDataFrame([(b | {"판매가_목록": "7900"},)], "row map<string,string>"), "run", at).first()
    assert same.list_original_price_krw is None
    e = I.envelope(p, "a_product", "src").first()
    assert e.event_type == "a_product" and e.created_at


def test_search_json(spark):
    body = {"data": [{"no": 10012345, "name": "사과", "discountedPrice": 7900, "salesPrice": 9900, "image": "//img.example/apple.jpg", "brandName": "b", "deliveryTypeNames": ["새벽", "택배"]}, {"no": "category-1", "name": "과일"}]}
    df = spark.createDataFrame([(1, json.dumps(body)), (2, "{")], "id int, body string")
    rows = J.product_rows(df, "id", "body").collect()
    assert len(rows) == 1 and rows[0].image_url == "https://img.example/apple.jpg" and rows[0].list_price_krw == "7900" and rows[0].delivery_type == "새벽 | 택배"
    assert "과일" in {r.keyword for r in J.category_keywords(df, "id", "body").collect()}


def test_pages(spark):
    html = "<html><head><title>T &amp; t</title><meta property='og:title' content='Name'></head><body>" + "x" * 900 + "\nSeller\nopen\nShop A\nItem 1 red\n5 left\nItem 2\nshop\n$3 / ₩4,000\n<table><tr><th>원산지</th><td>한국</td></tr></table><img src='/p/detail.jpg'><a href='/item?goodscode=123'>Good thing</a></body></html>"
    df = spark.createDataFrame([(1, "http://h.example/item?goodscode=77", html), (2, "http://h.example/", "short"), (3, "http://h.example/", "Access Denied " + html)], "page_id long, url string, html string")
    got = {r.page_id: r for r in P.detail_records(df, "global").collect()}
    assert got[1].success and got[1].product_name == "Name" and got[1].seller == "Shop A" and got[1].product_code == "77" and got[1].price_krw == 4000
    assert not got[2].success and got[2].error.startswith("too_short") and got[2].product_name is None
    assert got[3].error == "blocked_or_error_page: Access Denied"
    r = df.where("page_id = 1").select(P.key_values(F.col("html")).alias("kv"), P.image_candidates(F.col("html"), F.col("url"), F.lit("")).alias("im"), P.options(P.lines(F.col("html"))).alias("op")).first()
    assert r.kv == {"원산지": "한국"} and r.im["description"] == ["http://h.example/p/detail.jpg"] and r.op[0] == "Item 1 red 5 left"
    assert [x.product_code for x in P.list_rows(df.where("page_id = 1")).collect()] == ["123"]


def test_prices_and_numbers_of_texts(spark):
    cases = {"판매가 1,200원": 1200, "₩99 krw 150": 150, "쿠폰적용가 2,000": 2000, "￦ 3,000": 3000, "12 KRW": None, "1,234 and 5,678": 5678, "0,050": 50, "무료": None, "": None, "판매가: 90원 (₩ 700)": 700}
    df = spark.createDataFrame(list(cases.items()), "t string, want long")
    assert all(r.got == r.want for r in df.withColumn("got", X.price_krw(F.col("t"))).collect())
    v = lambda s: F.lit(s)
    assert [one(spark, X.first_number(v(s))) for s in ("a 12,34", "1,234,567 x", "none")] == [12, 1234567, None]
    assert [one(spark, X.price_usd(v(s))) for s in ("US$ 1,234.5", "5 dollars")] == [1234.5, None]
    assert [one(spark, X.product_code(v(s))) for s in ("?goodsCode=7", "Item No. : 88", "/x/12345678", "/x/1234567", "goodsNo=9")] == ["7", "88", "12345678", "", "9"]
    assert one(spark, X.absolute_url(v("%2Fa%3Fb"), v("https://h.example/p"))) == "https://h.example/a?b"


def test_json_of_any_depth(spark):
    body = {"no": 7, "name": "deep", "price": 5}
    for _ in range(10):
        body = {"x": [body]}
    df = spark.createDataFrame([(1, json.dumps(body)), (2, "[]"), (3, None), (4, "[[[{}]]]")], "id int, body string")
    assert [(r.id, r.product_code) for r in J.product_rows(df, "id", "body").collect()] == [(1, "7")]
    levels = J.json_objects(df, "id", "body").groupBy("id").agg(F.max("level").alias("m")).collect()
    assert {r.id: r.m for r in levels} == {1: 20, 4: 3}
    assert J.json_objects(df.where("false"), "id", "body").count() == 0


def test_category_names_of_any_shape(spark):
    deep = "채소"
    for k in range(12):
        deep = {"text" if k % 2 else "label": deep}
    body = {"a": {"name": "과일(제철)"}, "b": [{"title": {"text": " 유기농   쌀 "}}, {"label": ["견과", "쌀"]}, {"displayName": {"productName": "생수"}}, {"groupName": {"name": None, "title": ["", "a &lt; b", 3]}}]}
    body |= {"c": {"categoryName": deep}, "d": {"name": 12, "title": "과일(제철)", "label": "[x]"}, "e": {"name": {"name": "", "title": False}}}
    df = spark.createDataFrame([(1, json.dumps(body)), (2, "{"), (3, json.dumps([{"name": "ab"}, {"name": "a"}]))], "id int, body string")
    got = J.category_keywords(df, "id", "body").orderBy("id", "position").collect()
    assert [(r.id, r.position, r.keyword) for r in got] == [(1, 1, "과일(제철)"), (1, 2, "유기농 쌀"), (1, 3, "채소"), (1, 4, "false"), (3, 1, "ab")]


def test_second_gate_reads_the_beginning_alone(spark):
    head = "<html><head><title>t</title></head><body><p>" + "xy " * 400 + "</p>"
    pages = [(1, "u", head + "판매가 1,000원</body></html>"), (2, "u", head.replace("<p>", "<p>판매가 1,000원 ") + "</body></html>")]
    got = {r.page_id: (r.success, r.error) for r in P.detail_records(spark.createDataFrame(pages, "page_id long, url string, html string"), "korean").collect()}
    assert got == {1: (False, "korean_product_signal_missing"), 2: (True, "")}


def test_rankings_and_retries(spark):
    rows = spark.range(100).selectExpr("id", "id % 3 as g")
    a, b = (sorted(r.id for r in R.seeded_sample(rows.repartition(n), 5, "id", 10).collect()) for n in (1, 7))
    assert a == b and len(set(a)) == 10 and a != sorted(r.id for r in R.seeded_sample(rows, 6, "id", 10).collect())
    assert [r.id for r in R.first_rows(rows, [F.desc("id")], 2).collect()] == [99, 98]
    assert R.capped_per_group(rows, "g", [F.asc("id")], 4).count() == 4 * rows.select("g").distinct().count()
    tries = []

    def attempt(df, n):
        tries.append(n)
        return df.select("id", (F.col("id") % 10 != 0).alias("success") if n == 1 else (F.col("id") % 20 != 0).alias("success"))

    done = I.retry_failed(rows, attempt, "id")
    assert tries == [1, 2] and done.count() == 100 and done.where("not success").count() == 5


@pytest.mark.parametrize("total", [1, 3, 7, 12, 20, 39, 40, 100])
def test_balanced_limit_is_one_of_each_group_in_turn(spark, total):
    data = [(["a", "b", "", None, "기타", "c"][min(k % 9, 5)], k) for k in range(40)]
    groups = {}
    for g, k in data:
        groups.setdefault(g or "기타", []).append(k)
    want, left = [], {g: sorted(v) for g, v in sorted(groups.items())}
    while len(want) < total and any(left.values()):
        for g in left:
            if left[g] and len(want) < total:
                want.append(left[g].pop(0))
    got = R.balanced_limit(spark.createDataFrame(data, "g string, k long"), F.col("g"), [F.col("k")], total)
    assert got.columns == ["g", "k"] and sorted(r.k for r in got.collect()) == sorted(want)


def test_jobs_are_taken_whole_until_there_are_enough(spark):
    rows = spark.createDataFrame([(j, k) for j, n in (("z", 4), ("m", 9), ("a", 4), ("b", 1)) for k in range(n)], "job string, k long")
    order = [F.desc("job")]
    for target, jobs in ((2, {"z"}), (3, {"z", "m"}), (5, {"z", "m", "b"}), (6, {"z", "m", "b", "a"}), (0, {"z", "m", "b", "a"})):
        got = R.until_enough(rows, "job", order, [F.asc("k")], 5, target).collect()
        assert {r.job for r in got} == jobs and sum(r.job == "m" for r in got) == (5 if "m" in jobs else 0)


def test_dropped_products_are_counted(spark):
    seen = Observation("seen")
    rows = spark.createDataFrame([("식품", "", "사과"), ("기타", "", "무엇")], "source_category string, search_keyword string, product_name string")
    assert RF.classify(rows, dropped=seen).count() == 1
    assert seen.get == {"rows": 2, "dropped": 1}


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default))

    with pytest.raises(ValueError):
        work_path(Session, "x")


def test_refresh_publishes_only_what_holds(spark, tmp_path):
    to = RF.Targets(*(f"{tmp_path}/{n}" for n in ("s", "m", "p")))
    at = datetime(2026, 8, 6, 2, 54, 24, 934000)
    RF.refresh(spark, ten_products(spark), to, at, "u1", normalise=False)
    seen = sinks.read_published(spark, to.snapshots, to.markers).collect()
    assert sorted(r.scope_slug for r in seen) == sorted(["all", *CATEGORY_SLUGS.values()])
    payload = json.loads(next(r.payload_json for r in seen if r.scope_slug == "all"))
    assert payload["summary"]["product_count"] == 10 and payload["price_drop_candidates"] == [] and len(payload["policy_notes"]) == 4
    with pytest.raises(G.GateError):
        RF.refresh(spark, ten_products(spark).limit(9), to, at, "u2", normalise=False)
    assert {r.version for r in sinks.read_published(spark, to.snapshots, to.markers).collect()} == {r.version for r in seen}


def test_of_two_refreshes_one_is_published_and_a_retry_is_not_doubled(spark, tmp_path, monkeypatch):
    to = RF.Targets(*(f"{tmp_path}/{n}" for n in ("s", "m", "p")))
    at = datetime(2026, 8, 6, 2, 54, 24, 934000)
    run = lambda name: RF.refresh(spark, ten_products(spark), to, at, name, normalise=False)
    plain = sinks.write_snapshots

    def overtaken(rows, path):
        plain(rows, path)
        sinks.write_marker(spark, {"refresh_uuid": "other", "attempt": "a", "version": 1}, to.markers, 0)  # while the first is under way

    monkeypatch.setattr(sinks, "write_snapshots", overtaken)
    with pytest.raises(sinks.PublishConflict):
        run("first")
    assert [(r.number, r.refresh_uuid) for r in sinks.read_markers(spark, to.markers).collect()] == [(1, "other")]
    assert not [f for d in (to.snapshots, to.mart) for f in Path(d).rglob("*.parquet")]  # what it wrote is gone
    monkeypatch.setattr(sinks, "write_snapshots", plain)
    marker = run("first")
    assert sinks.marker_head(spark, to.markers) == 2
    sinks.write_snapshots(spark.read.parquet(to.snapshots).withColumn("attempt", F.lit("broken off")), to.snapshots)
    seen = sinks.read_published(spark, to.snapshots, to.markers).collect()
    assert len(seen) == 11 and {r.attempt for r in seen} == {marker["attempt"]}


def test_stream_replays_a_failed_batch(spark, tmp_path):
    spark.range(10).selectExpr("id", "cast(id as string) as payload").repartition(4).write.parquet(f"{tmp_path}/in")
    stream = ST.read_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    write, calls = TI.append_once(f"{tmp_path}/out", "t"), []

    def fail_once(batch, number):
        calls.append(number)
        if len(calls) == 2:
            raise RuntimeError("down")
        write(batch, number)

    with pytest.raises(Exception):
        ST.publish(stream, fail_once, f"{tmp_path}/c").awaitTermination()
    ST.publish(stream, fail_once, f"{tmp_path}/c").awaitTermination()
    assert calls.count(1) == 2 and sorted(r.id for r in TI.read_appended(spark, f"{tmp_path}/out").collect()) == list(range(10))


def test_work_on_rows_of_a_narrow_table_is_spread(spark, tmp_path):
    spark.range(0, 1000, 1, 1).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand").write.parquet(f"{tmp_path}/part.parquet")
    assert spark.read.parquet(f"{tmp_path}/part.parquet").rdd.getNumPartitions() == 1
    pages = queries._item_pages(spark, str(tmp_path))
    assert pages.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and pages.count() == 1000
    assert spread(spark.range(100), "id", 10).rdd.getNumPartitions() == 10


def test_parsing_of_a_page_stands_once_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "https://item.gmarket.co.kr/Item?goodscode=1", "<h1>x</h1>")], "page_id long, url string, html string")
    plan = P.detail_records(pages, "korean")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("*price[") == 1 and plan.count("<h1") == 1 and "json" not in plan


def test_a_section_may_be_longer_than_a_description(spark):
    ls = F.array(F.lit("that"), F.repeat(F.lit("x"), 20_000))
    assert len(one(spark, P.section_text(ls, ("that",), ("with",), most=12_000))) == 12_000
    assert len(one(spark, P.section_text(ls, ("that",), ("with",)))) == P.TEXT_CHARS


def test_clean_text_takes_all_white_space(spark):
    for text in (" a  b ", "a b", "　 a\t\tb\x85", "a \n\r b\x0b", "\x0b x　y ", "", " \n "):
        old = one(spark, F.regexp_replace(F.regexp_replace(F.lit(text), "[\\t\\n\\f\\r ]+", " "), "^[\\s\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\u0085]+|[\\s\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\u0085]+$", ""))
        assert one(spark, X.clean_text(F.lit(text))) == old


def test_rows_beyond_the_limit_are_not_sorted(spark):
    rows = spark.range(1000).selectExpr("IF(id % 10 = 0, NULL, id % 3) AS g", "IF(id % 7 = 0, NULL, id % 100) AS v", "id")
    kept = R.may_be_first(rows, ["g"], F.col("v"), 5)
    w = Window.partitionBy("g").orderBy(F.desc("v"), "id")
    first = lambda df: df.withColumn("n", F.row_number().over(w)).where("n <= 5").select("g", "v", "id", "n")
    assert kept.columns == rows.columns and kept.count() < 60 and first(kept).exceptAll(first(rows)).isEmpty() and first(rows).exceptAll(first(kept)).isEmpty()
    assert R.may_be_first(rows, ["g"], F.col("v"), 5000).count() == 1000
    assert R.may_be_first(rows, [], F.col("v"), 5, descending=False).agg(F.max("v")).first()[0] == 0


def test_a_price_on_a_card_is_read_once(spark):
    pages = spark.createDataFrame([(1, "https://h.example/", "<a href='/?goodscode=1'>Good</a>")], "page_id long, url string, html string")
    plan = P.list_rows(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(original|o-price|coupon)") == 1 and plan.count("(?is)^<a\\b[^>]*>,") <= 3  # two filters and the row


def test_values_that_hold_nothing_are_not_written(spark):
    df = spark.createDataFrame([(1, '{"a":[1,{"b":"x"}],"c":2}')], "id int, body string")
    assert [t.count() for t in J.json_values(df, "id", "body", scalars=False)] == [1, 1, 1]
    assert J.json_objects(df, "id", "body", (("b",),)).select("object").first()[0] == '{"b":"x"}'


def test_a_key_that_a_row_lacks_is_not_cleaned(spark):
    row = F.create_map(F.lit("b"), F.lit("  x  y "), F.lit("c"), F.lit(" "))
    assert one(spark, I._typed(row, "text", ("a", "c", "b"))) == "x y" and one(spark, I._typed(row, "uint0", ("a",))) == 0
    assert one(spark, I._typed(row, "list", ("a", "b", "c"))) == ["x y"]


def test_keywords_of_repeated_names_are_the_same(spark):
    rows = ten_products(spark).unionByName(ten_products(spark).withColumn("product_code", F.concat("product_code", F.lit("-2"))))
    a, b = (RF.prepare(rows, normalise=False, repeated=r).select("product_code", "source_category", "keywords", "product_url") for r in (False, True))
    assert a.count() == 20 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_numbers_are_read_without_casts_that_fail(spark):
    texts = [None, "", "none", ",", "$ ,", "$", "US$ 1,234.5", "$\t\n 7", "$9 " + "9" * 30, "12,34", " \u3000 1,200\x0b", "1 200", "-3.5e2\n", "+.5", "1\n2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select(X.price_usd(F.col("t")), X.first_number(F.col("t")), X.parse_float(F.col("t")), X.parse_uint(F.col("t")), "i").orderBy("i").collect()
    assert [r[0] for r in rows] == [None] * 6 + [1234.5, 7.0, 9.0] + [None] * 6
    assert [r[1] for r in rows] == [None] * 6 + [1234, 7, 9, 12, 1200, 1, 3, 5, 1]
    assert [r[2] for r in rows] == [None] * 9 + [1234.0, 1200.0, None, -350.0, 0.5, None]
    assert [r[3] for r in rows] == [None] * 9 + [1234, 1200, None, None, None, None]
    # a cast of an empty text fails inside: without it, texts without a number cost no more than those with one
    plan = df.select(X.first_number(F.col("t")).alias("n"), X.price_usd(F.col("t")).alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast(replace(" not in plan.lower() and "regexp_replace" not in plan.lower()


def test_tokens_and_slugs_of_every_character(spark):
    """Each code point between letters, and classes by ranges instead of negated ones."""
    points = [i for i in range(0x11000) if not 0xD800 <= i < 0xE000] + [0x1F600, 0x10FFFF]
    texts = [(i, f"a{chr(i)}b") for i in points] + [(-1, ""), (-2, None), (-3, " -- !"), (-4, "--A_b 가 -")]
    df = spark.createDataFrame(texts, "i int, t string")
    old_tokens = F.array_remove(F.split("t", "[^0-9a-zA-Z가-힣]+"), "")
    old_slug = F.trim(F.regexp_replace(F.lower(F.trim("t")), "[^a-z0-9가-힣_-]+", "-"), F.lit("-"))
    new = df.select("t", X.tokens(F.col("t")).alias("w"), X.slug(F.col("t")).alias("s"))
    assert new.where(~F.col("w").eqNullSafe(old_tokens) | ~F.col("s").eqNullSafe(old_slug)).count() == 0
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert "[^" not in plan


def test_a_text_without_a_price_is_not_cast(spark):
    texts = [(None, None), ("", None), (",", None), ("sold out", None), ("₩ \n\t 1,200", 1200), ("krw\f\r7", None), ("1,200  \n원", 1200), ("판매가\t,", None), ("(\n￦  500 )", 500), ("99 원 and 3,000 to 12,000", 12000), ("₩" + "9" * 30, None)]
    rows = spark.createDataFrame([(i, t, w) for i, (t, w) in enumerate(texts)], "i int, t string, w long").select("*", X.price_krw(F.col("t")).alias("p")).orderBy("i")
    assert [r.p for r in rows.collect()] == [w for _, w in texts]
    plan = rows._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "try_cast(replace(" not in plan and "regexp_replace" not in plan


def test_aliases_after_the_first_with_text_are_not_cleaned(spark):
    rows = spark.createDataFrame([(None, " ", " a\tb ", "c"), ("", None, None, None), (None, " x", "y", "z")], "a string, b string, c string, d string")
    found = rows.select(X.first_non_empty(*(F.col(c) for c in "abcd")).alias("x"))
    assert [r.x for r in found.collect()] == ["a b", "", "x"]
    seen = X.first_non_empty(F.lit(" first "), F.raise_error(F.lit("a later alias was read")).cast("string"))
    assert one(spark, seen) == "first"


def test_products_are_not_dealt_out_by_category(spark, tmp_path):
    """Medians are known to be few, so their join leaves the products where they are."""
    ten_products(spark).write.parquet(f"{tmp_path}/p")
    scored = R.score_deals(spark.read.parquet(f"{tmp_path}/p"), [])
    assert scored.count() == 10
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_newest_rows_of_the_history_are_made_of_what_is_asked_for(spark):
    made = queries.raw_history(spark, "/root/testdata/sf0.001")
    assert "collected_at" not in made._jdf.queryExecution().executedPlan().toString()


def many_products(spark, n=1500):
    """Products of two categories with odd prices, sellers, brands and reviews; every seller and most prices are their own."""
    k = F.col("id")
    names = F.array(*(F.lit(x) for x in ("large ring", "hot bolt", "blue ring")))
    return spark.range(n).select(
        F.when(k % 3 == 0, "kurly").otherwise("gmarket").alias("provider"),
        F.concat(F.lit("c"), k).alias("product_code"),
        F.get(names, (k % 3).cast("int")).alias("product_name"),
        F.when(k % 2 == 0, "식품").otherwise("패션").alias("source_category"),
        F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("s"), k)).alias("seller"),
        F.concat(F.lit("b"), k % 5).alias("brand"),
        F.when(k % 53 == 0, None).when(k % 59 == 0, 0).otherwise((k * 7919) % 90001).cast("long").alias("price_krw"),
        ((k * 7919) % 90001 * 2).alias("original_price_krw"),
        F.when(k % 41 == 0, None).otherwise(k % 50).cast("long").alias("review_count"),
        (k % 7).cast("long").alias("order_count"),
        F.concat(F.lit("2026-01-0"), k % 9 + 1).alias("collected_at"),
        F.array(F.get(F.split(F.get(names, (k % 3).cast("int")), " "), F.lit(1)), F.get(names, (k % 3).cast("int"))).alias("keywords"),
    )


def test_figures_of_slices_come_from_counts_of_kinds(spark, tmp_path):
    many_products(spark).write.parquet(f"{tmp_path}/p")
    products = spark.read.parquet(f"{tmp_path}/p")
    cube = RF.price_cube(products)
    # 1,500 products with sellers of their own are six kinds in two times at most 6 slices and 6 bands
    assert cube.kinds.count() == 6 and cube.sums.count() < 6 * 36 and cube.values.where("what = 'brand'").count() == 30
    keys = [*Q.SCOPE, "slice", *Q.RANGES]
    rows = A.in_slices(RF.in_scopes(products), cube.slices, Q.SCOPE)
    ranges = lambda of_all, of_own, *without: Q.in_ranges(of_all(cube), of_own(cube), cube, without)
    whole, words = Q.sums_in_ranges(cube, words=False), Q.sums_in_ranges(cube, words=True)
    by_keyword = A.Known(ranges(Q.keyword_values, Q.word_values, "source_category"), ranges(Q.keyword_ranks, Q.word_ranks, "source_category"))
    pairs = [
        (A.category_benchmarks(whole, keys, known=A.Known(ranges(Q.category_values, Q.category_values), ranges(Q.category_ranks, Q.category_ranks))), A.category_benchmarks(rows, keys)),
        (A.keyword_benchmarks(words, keys, known=by_keyword), A.keyword_benchmarks(rows, keys)),
        (A.category_keywords(words, keys, known=A.Known(ranges(Q.word_values, Q.word_values), ranges(Q.word_ranks, Q.word_ranks))), A.category_keywords(rows, keys)),
        (A.scope_summary(whole, keys, ranges(Q.all_ranks, Q.category_ranks, "source_category").select(*keys, "median_price_krw")), A.scope_summary(rows, keys)),
        (A.price_bands(whole, keys), A.price_bands(rows, keys)),
    ]
    for got, want in pairs:
        cols = sorted(want.columns)
        got, want = (collections.Counter(map(str, x.select(*cols).collect())) for x in (got, want))
        assert got == want and len(got) > 10


def test_listed_products_are_found_before_slices_repeat_them(spark, tmp_path):
    many_products(spark, 6000).write.parquet(f"{tmp_path}/p")
    cube = RF.price_cube(spark.read.parquet(f"{tmp_path}/p"))
    keys = [*Q.SCOPE, "slice", *Q.RANGES]
    rows = A.in_slices(RF.in_scopes(cube.products), cube.slices, Q.SCOPE)
    cols = [*keys, "position", "product_code"]
    few = RF._evidence_rows(cube, 3)
    assert few.select("product_code").distinct().count() < 2000
    for got, want in ((R.top_products(few, keys, 3), R.top_products(rows, keys, 3)), (R.best_deals(RF._deal_rows(cube, 3), keys, 3), R.deal_candidates(rows, keys, 3))):
        got, want = (collections.Counter(map(str, x.select(*cols).collect())) for x in (got, want))
        assert got == want and len(got) > 30


def test_categories_of_cases_are_found_once(spark):
    rows = ten_products(spark).unionByName(ten_products(spark).withColumn("product_code", F.concat("product_code", F.lit("-2"))))
    plan = RF.prepare_plain(rows, normalise=False, repeated=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastHint" in plan or "broadcast" in plan
    assert plan.count("Relation") == 2 and "CASE WHEN" not in plan  # products and cases, joined as they are read


def test_long_pages_are_not_searched_for_tags_they_lack(spark):
    long = "가나다라마 " * 300
    pages = [
        "<TITLE>T</TITLE><h1>N &amp; M</h1><ScRipt>x</sCript><STYLE>y</STYLE><!-- z --><p>a <b>b</b></p>" + long + "<DT>k</DT><DD>v</DD><Li><span>p</span><span>q</span></li><meta name='x' content='m'>",
        long + "Access DENIED" + long, long + "acce가ss denied", "ChecKing your browser" + long, long + "봇 확인", "<p>" + long, None,
        "x" * 2_000 + "<h1></h1><h1>late</h1>",
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    h = F.col("html")
    got = df.select("i", P.gate(h, F.lit("")).alias("g"), P.lines(h, True).alias("l"), P.key_values(h).alias("kv"), P.element_text(h, "h1").alias("h1"), P.meta_content(h, "x").alias("m"), P.ascii_runs(h).alias("r")).orderBy("i").collect()
    assert [r.g.reason.partition(": ")[2] for r in got][:5] == ["", "Access Denied", "", "Checking your Browser", "봇 확인"] and got[6].g.reason == "too_short: 0"
    assert got[0].l == ["T", "N & M", "a b", long.strip(), "k", "v", "pq"] and got[0].kv == {"k": "v", "p": "q"} and (got[0].h1, got[0].m) == ("N & M", "m")
    assert got[6].kv is None and got[6].l is None and got[7].h1 == "" and len(got[1].r) < 20
    assert one(spark, P.section_text(F.array(F.lit("상품평 x"), F.lit("상품상세정보"), F.lit("y z"), F.lit("판매자 정보"), F.lit("w")), ("상품상세정보", "Abc"), ("상품정보제공고시", "판매자 정보", "상품평"))) == "상품상세정보\ny z"
    plan = df.select(P.key_values(h).alias("kv"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<td\\b[^>]*>(.*?)</td>, 0)") == 1  # one search of the page for all groups


def test_patterns_whose_beginning_is_missing_are_not_tried(spark):
    assert [X._always_in(p) for p in ("상품평\\s*([0-9]+)", '"brand"\\s*:', "(?i)abc", "가나*", "가|나", "/([0-9]{8,})")] == ["상품평", '"brand"', "", "", "", ""]
    assert one(spark, X.first_group(F.lit("후기 12 상품평 7"), ["상품평\\s*([0-9]+)", "후기\\s*([0-9]+)"])) == "7" and one(spark, X.first_group(F.lit("후기 12"), ["상품평\\s*([0-9]+)", "후기\\s*([0-9]+)"])) == "12"
