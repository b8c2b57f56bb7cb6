"""SQL of the registered queries, written apart from their operators."""

from __future__ import annotations

from .functions import scores as S
from .functions.taxonomy_tables import CATEGORIES

PRODUCTS = """products AS (
  SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'gmarket' ELSE 'kurly' END AS provider,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS product_code,
    p_name AS product_name, p_type AS source_category, s_name AS seller, p_brand AS brand,
    CAST(round(l_extendedprice * (1 - l_discount)) AS BIGINT) AS price_krw,
    CAST(round(l_extendedprice) AS BIGINT) AS original_price_krw,
    CAST(l_quantity AS BIGINT) AS review_count, CAST(l_linenumber AS BIGINT) AS order_count,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS collected_at, l_partkey
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""
STANDARD = f"""{PRODUCTS}, standard AS (
  SELECT * REPLACE (list_extract([{', '.join(repr(c) for c in CATEGORIES)}], CAST(l_partkey % 10 AS BIGINT) + 1) AS source_category) FROM products)"""


def slug(c: str) -> str:
    return f"regexp_replace(regexp_replace(lower(trim({c})), '[^a-z0-9가-힣_-]+', '-', 'g'), '^-+|-+$', '', 'g')"


def scoped(table: str) -> str:
    return f"scoped AS (SELECT *, 'all' AS scope_slug FROM {table} UNION ALL SELECT *, {slug('source_category')} FROM {table})"


def rank(p: float, c: str = "price_krw") -> str:
    return f"list_sort(list({c}))[CAST(floor({p} * (count({c}) - 1) + 0.5) AS BIGINT) + 1]"


def clamp(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN 0.0::DOUBLE WHEN {x} > 100 THEN 100.0::DOUBLE ELSE round(({x}) * 100) / 100 END)"


def percent(a: str, b: str) -> str:
    return f"(CASE WHEN {b} <= 0 THEN 0.0::DOUBLE ELSE round(CAST({a} AS DOUBLE) * 100 / {b} * 100) / 100 END)"


def ladder(conditions: list[str], texts: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {c} THEN '{t}'" for c, t in zip(conditions, texts))
    return f"CASE {cases} ELSE '{texts[-1]}' END"


def bench(keys: str, table: str, extra: str = "") -> str:
    return f"""raw AS (
  SELECT {keys}, count(*) AS product_count, count(DISTINCT seller) AS seller_count, count(DISTINCT brand) AS brand_count,
    CAST(sum(review_count) AS BIGINT) AS review_sum, CAST(sum(order_count) AS BIGINT) AS order_sum,
    min(price_krw) AS min_price_krw, max(price_krw) AS max_price_krw,
    count(*) FILTER (original_price_krw > price_krw) AS discounted_count, count(*) FILTER (price_krw <= 10000) AS low_price_count,
    max(collected_at) AS latest_collected_at, {rank(0.25)} AS p25_price_krw, {rank(0.5)} AS median_price_krw, {rank(0.75)} AS p75_price_krw {extra}
  FROM {table} GROUP BY {keys}),
bench AS (
  SELECT *, p75_price_krw - p25_price_krw AS iqr_price_krw, {percent('discounted_count', 'product_count')} AS discounted_percent,
    {percent('low_price_count', 'product_count')} AS low_price_percent,
    {clamp('ln(1.0 + product_count + review_sum + 3 * order_sum) * 11')} AS demand_score,
    {clamp('ln(1.0 + product_count) * 18 + ln(1.0 + seller_count) * 10 + ln(1.0 + brand_count) * 8')} AS competition_score
  FROM raw)"""


CATEGORY_SCORED = f"""scored AS (
  SELECT *, {clamp('demand_score * 0.45 + (100 - competition_score) * 0.25 + low_price_percent * 0.15 + discounted_percent * 0.15')} AS opportunity_score
  FROM bench),
final AS (
  SELECT *, {ladder(['opportunity_score >= 70', 'competition_score >= 70', 'iqr_price_krw > median_price_krw'], S.CATEGORY_TEXTS)} AS interpretation FROM scored)"""
#: The part names have two words of a small vocabulary, on which no ending is cut; two are stop words.
KEYWORDED = f"""{PRODUCTS}, words AS (
  SELECT *, list_filter(string_split(product_name, ' '), lambda t: t NOT IN ('new', 'hot') AND t <> lower(source_category)) AS w FROM products),
exploded AS (
  SELECT *, unnest(list_distinct(list_concat(w, CASE WHEN len(w) = 2 AND w[1] <> w[2] THEN [w[1] || ' ' || w[2]] ELSE [] END))) AS keyword FROM words)"""
SUMMARY = f"""count(*) AS product_count, count(DISTINCT source_category) AS category_count,
  count(*) FILTER (original_price_krw > price_krw) AS discounted_count, count(*) FILTER (price_krw <= 10000) AS low_price_count,
  min(price_krw) AS min_price_krw, max(price_krw) AS max_price_krw, min(collected_at) AS first_collected_at,
  max(collected_at) AS latest_collected_at, {rank(0.5)} AS median_price_krw,
  {percent('count(*) FILTER (original_price_krw > price_krw)', 'count(*)')} AS discounted_percent,
  {percent('count(*) FILTER (price_krw <= 10000)', 'count(*)')} AS low_price_percent"""
UNIT = "CASE WHEN v >= 1000000 THEN 100000 WHEN v >= 100000 THEN 10000 WHEN v >= 10000 THEN 1000 ELSE 100 END"
SLICES = f"""bounds AS (SELECT scope_slug, min(price_krw) AS lo, max(price_krw) AS hi FROM scoped GROUP BY 1),
steps AS (SELECT scope_slug, lo, hi, lo + ((hi - lo) * i) // 5 AS v FROM bounds, range(1, 5) AS r(i)),
cuts AS (
  SELECT DISTINCT scope_slug, CAST(round(v / CAST({UNIT} AS DOUBLE)) AS BIGINT) * ({UNIT}) AS b, lo, hi FROM steps),
edges AS (
  SELECT scope_slug, b FROM cuts WHERE b > lo AND b < hi UNION SELECT scope_slug, lo FROM bounds UNION SELECT scope_slug, hi FROM bounds),
pairs AS (SELECT scope_slug, lag(b) OVER w AS prev, b, row_number() OVER w AS n FROM edges WINDOW w AS (PARTITION BY scope_slug ORDER BY b)),
slices AS (SELECT scope_slug, CASE WHEN n = 2 THEN prev ELSE prev + 1 END AS low, b AS high FROM pairs WHERE n > 1)"""
DEALS = f"""medians AS (SELECT source_category, {rank(0.5)} AS category_median_price_krw FROM products GROUP BY 1),
percents AS (
  SELECT p.*, category_median_price_krw,
    CASE WHEN original_price_krw > price_krw AND original_price_krw > 0 THEN round((CAST(original_price_krw - price_krw AS DOUBLE) * 100) / original_price_krw * 100) / 100 ELSE 0.0::DOUBLE END AS discount_percent,
    CASE WHEN category_median_price_krw > price_krw AND category_median_price_krw > 0 THEN round((CAST(category_median_price_krw - price_krw AS DOUBLE) * 100) / category_median_price_krw * 100) / 100 ELSE 0.0::DOUBLE END AS below_category_median_percent
  FROM products p JOIN medians USING (source_category)),
deals AS (
  SELECT *, {clamp('least(45.0, greatest(0.0, below_category_median_percent * 0.45)) + least(35.0, greatest(0.0, discount_percent * 0.35)) + CASE WHEN price_krw <= 10000 THEN 20 WHEN price_krw <= 30000 THEN 10 ELSE 0 END')} AS radar_score,
    {ladder(['discount_percent >= 20 AND below_category_median_percent >= 20', 'discount_percent >= 20', 'below_category_median_percent >= 20', 'price_krw <= 10000'], S.DEAL_TEXTS)} AS reason
  FROM percents WHERE NOT (price_krw > 30000 AND discount_percent < 20 AND below_category_median_percent < 20))"""


def interleave(table: str, part: str, order: str, limit: int) -> str:
    by = f"PARTITION BY {part}" if part else ""
    own = f"{part}, provider" if part else "provider"
    return f"""own AS (SELECT *, row_number() OVER (PARTITION BY {own} ORDER BY {order}) AS o FROM {table}),
turn AS (SELECT *, row_number() OVER ({by} ORDER BY o, provider) AS position FROM own),
taken AS (SELECT * FROM turn WHERE position <= {limit})"""


EVIDENCE = "review_count + 3 * order_count DESC, collected_at DESC, price_krw, provider, product_code"
BLOCK = "(?i)</?(p|div|li|ul|ol|tr|table|h[1-6]|br|article|section|nav|footer|header|title|dt|dd|td|th)\\b[^>]*>"
SPACE = "[\\s\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{0085}]"


def clean(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '[\\t\\n\\f\\r ]+', ' ', 'g'), '^{SPACE}+|{SPACE}+$', '', 'g')"


def visible(c: str, breaks: bool = True) -> str:
    for tag in ("script", "style", "noscript"):
        c = f"regexp_replace({c}, '(?is)<{tag}\\b.*?</{tag}\\s*>', '', 'g')"
    c = f"regexp_replace({c}, '(?s)<!--.*?-->', '', 'g')"
    if breaks:
        c = f"regexp_replace({c}, '{BLOCK}', chr(10), 'g')"
    c = f"regexp_replace({c}, '<[^>]*>', '', 'g')"
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&"), ("&nbsp;", " ")):
        c = f"replace({c}, '{a}', '{b}')"
    return c


LINES = f"""split AS (SELECT page_id, string_split({visible('html')}, chr(10)) AS parts FROM pages),
numbered AS (SELECT page_id, unnest(parts) AS raw, unnest(range(len(parts))) AS n FROM split),
cleaned AS (SELECT page_id, n, {clean('raw')} AS line FROM numbered),
firsts AS (SELECT page_id, line, min(n) AS n FROM cleaned WHERE line <> '' AND lower(line) NOT IN ('open', 'close', 'prev', 'next') GROUP BY 1, 2),
lines AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS line_no, line FROM firsts)"""
BLOCKED = ("ERROR: The request could not be satisfied", "The request could not be satisfied", "504 Gateway Timeout", "Generated by cloudfront", "CloudFront", "Access Denied", "Forbidden", "Service Unavailable", "잠시만 기다리십시오", "원활한 서비스 이용을 위한 간단한 확인 안내", "Checking your Browser", "봇 확인", "captcha")
BLOCKED_B = ("Access Denied", "Forbidden", "Service Unavailable", "ERROR: The request could not be satisfied", "The request could not be satisfied", "CloudFront", "잠시만 기다리십시오", "Checking your Browser", "captcha")


def gate(least: int, blocked: tuple[str, ...], last: str = "") -> str:
    words = " ".join(f"WHEN contains(low, lower('{w}')) THEN 'blocked_or_error_page: {w}'" for w in blocked)
    return f"CASE WHEN size < {least} THEN 'too_short: ' || size {words} {last} ELSE '' END"


GLOBAL_SIGNS = ("item no.", "shipping fee", "specific item info", "seller", "gmarket -", "item weight", "country of manufacture", "product name & model number")
B_SIGNS = ("상품설명", "상품고시정보", "장바구니", "구매하기", "판매자", "포장타입", "중량/용량", "/goods/", "후기")
TITLE = clean(visible("regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1)", False))
H1 = clean(visible("regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)", False))
B_MISSING = "WHEN NOT (" + " OR ".join(f"contains(low, '{s}')" for s in B_SIGNS) + ") AND contains(url, '/goods/') THEN 'product_signal_missing'"
GLOBAL_MISSING = "WHEN NOT (" + " OR ".join(f"contains(low, '{s}')" for s in GLOBAL_SIGNS) + ") THEN 'global_product_signal_missing'"

#: Fields of a domestic page that stand in its tables under labels of their own.
TABLE_FIELDS = (
    *("state", "origin", "country", "maker", "importer", "model", "item_name", "certificate", "voltage", "released", "size", "weight", "colour", "material", "parts"),
    *("shipping_fee", "returns", "warranty", "service", "business_no", "mail_order_no", "seller_phone", "seller_address", "seller_email"),
)

ORACLE_SQL: dict[str, str] = {
    "catalog_scan": f"""WITH {PRODUCTS},
a AS (SELECT *, coalesce(CASE WHEN order_count % 3 = 0 THEN price_krw - 1 END, CASE WHEN order_count <> 5 THEN price_krw END, price_krw + 7) AS price,
  CASE WHEN order_count % 2 = 0 THEN '/d/' ELSE '/g/' END || product_code AS link FROM products WHERE provider = 'gmarket' AND order_count <> 6),
b AS (SELECT *, coalesce(CASE WHEN order_count % 3 = 0 THEN price_krw - 1 END, CASE WHEN order_count <> 5 THEN price_krw END) AS price,
  '/p/' || product_code AS link FROM products WHERE provider = 'kurly' AND order_count <> 6),
u AS (SELECT *, order_count AS orders FROM a UNION ALL SELECT *, 0 FROM b)
SELECT provider, product_code, product_name, source_category, link AS product_url, price AS price_krw, original_price_krw,
  CASE WHEN review_count % 2 = 0 THEN brand ELSE '' END AS brand, seller, CASE WHEN review_count > 5 THEN review_count ELSE 0 END AS review_count,
  CAST(orders AS BIGINT) AS order_count, collected_at FROM u WHERE price > 0""",
    "category_benchmarks": f"WITH {PRODUCTS}, {bench('source_category', 'products')}, {CATEGORY_SCORED} SELECT *, row_number() OVER (ORDER BY low_price_count DESC, discounted_count DESC, product_count DESC, source_category) AS rank FROM final QUALIFY rank <= 40",
    "fine_benchmarks": f"WITH {PRODUCTS}, {bench('provider, l_partkey', 'products')}, {CATEGORY_SCORED} SELECT * FROM final",
    "scope_summary": f"WITH {PRODUCTS}, {scoped('products')} SELECT scope_slug, {SUMMARY} FROM scoped GROUP BY scope_slug",
    "price_bands": f"""WITH {PRODUCTS}, {scoped('products')},
bands AS (SELECT * FROM (VALUES ('<=10k', 0::BIGINT, 10000::BIGINT), ('10k-30k', 10001, 30000), ('30k-50k', 30001, 50000), ('50k-100k', 50001, 100000), ('100k+', 100001, NULL)) AS t(label, min_price_krw, max_price_krw)),
totals AS (SELECT scope_slug, count(*) AS n, sum(review_count + 3 * order_count) AS r FROM scoped GROUP BY 1),
counted AS (
  SELECT t.scope_slug, b.label, b.min_price_krw, b.max_price_krw, t.n, t.r, count(s.price_krw) AS product_count,
    CAST(coalesce(sum(s.review_count), 0) AS BIGINT) AS review_sum, CAST(coalesce(sum(s.order_count), 0) AS BIGINT) AS order_sum
  FROM totals t CROSS JOIN bands b LEFT JOIN scoped s ON s.scope_slug = t.scope_slug AND s.price_krw >= b.min_price_krw AND (b.max_price_krw IS NULL OR s.price_krw <= b.max_price_krw)
  GROUP BY ALL),
shares AS (SELECT *, {percent('product_count', 'n')} AS product_percent, {percent('(review_sum + 3 * order_sum)', 'r')} AS reaction_percent FROM counted)
SELECT scope_slug, label, min_price_krw, max_price_krw, product_count, review_sum, order_sum, product_percent, reaction_percent,
  {ladder(['product_percent >= 30 AND reaction_percent < product_percent', 'reaction_percent >= product_percent + 8', 'product_count <= 3 AND reaction_percent > 0'], S.BAND_TEXTS)} AS interpretation FROM shares""",
    "price_slices": f"""WITH {PRODUCTS}, {scoped('products')}, {SLICES}
SELECT scope_slug, 'range:' || low || '-' || high AS range_key, '₩' || format('{{:,}}', low) || '~₩' || format('{{:,}}', high) AS range_label,
  count(*) AS product_count, min(price_krw) AS min_price_krw, {rank(0.5)} AS median_price_krw, max(price_krw) AS max_price_krw
FROM scoped JOIN slices USING (scope_slug) WHERE price_krw BETWEEN low AND high GROUP BY scope_slug, low, high""",
    "keyword_benchmarks": f"""WITH {KEYWORDED}, {bench('keyword', 'exploded', ', count(DISTINCT source_category) AS category_count')},
scored AS (SELECT *, {clamp('competition_score * 0.65 - demand_score * 0.25 + ln(1.0 + category_count) * 8')} AS saturation_score,
  {clamp('demand_score * 0.50 + (100 - competition_score) * 0.30 + ln(1.0 + category_count) * 5')} AS opportunity_score FROM bench)
SELECT * EXCLUDE (latest_collected_at), {ladder(['opportunity_score >= 70', 'saturation_score >= 70'], S.KEYWORD_TEXTS)} AS interpretation,
  row_number() OVER (ORDER BY review_sum + 3 * order_sum DESC, product_count DESC, keyword) AS rank
FROM scored QUALIFY rank <= 240""",
    "category_keyword_top40": f"""WITH {KEYWORDED}, {bench('source_category, keyword', 'exploded')},
gaps AS (SELECT *, {ladder(['median_price_krw <= 0', 'median_price_krw < 10000', 'median_price_krw < 30000', 'median_price_krw < 70000', 'median_price_krw < 150000'], S.CLUSTER_TEXTS)} AS cluster_label,
  {clamp('(1 - least(CASE WHEN median_price_krw > 0 THEN iqr_price_krw / CAST(median_price_krw AS DOUBLE) ELSE 0 END, 1)) * 35 + (100 - competition_score) * 0.35 + demand_score * 0.30')} AS price_gap_score FROM bench),
scored AS (SELECT *, {clamp('demand_score * 0.40 + price_gap_score * 0.25 + (100 - competition_score) * 0.25')} AS opportunity_score,
  row_number() OVER (PARTITION BY source_category ORDER BY review_sum + 3 * order_sum DESC, product_count DESC, keyword) AS c FROM gaps)
SELECT source_category, keyword, row_number() OVER (ORDER BY source_category, c) AS rank, cluster_label, product_count, median_price_krw, demand_score,
  competition_score, price_gap_score, opportunity_score, {ladder(['opportunity_score >= 75', 'competition_score >= 75', 'price_gap_score >= 65'], S.PAIR_TEXTS)} AS interpretation
FROM scored WHERE c <= 40 QUALIFY row_number() OVER (ORDER BY source_category, c) <= 800""",
    "deal_candidates": f"WITH {PRODUCTS}, {DEALS}, {interleave('deals', '', 'radar_score DESC, discount_percent DESC, below_category_median_percent DESC, price_krw, provider, product_code', 24)} SELECT position, provider, product_code, price_krw, discount_percent, category_median_price_krw, below_category_median_percent, radar_score, reason FROM taken",
    "deal_scores": f"WITH {PRODUCTS}, {DEALS} SELECT product_code, radar_score, discount_percent, below_category_median_percent, reason FROM deals",
    "top_products_interleaved": f"WITH {PRODUCTS}, {scoped('products')}, {interleave('scoped', 'scope_slug', EVIDENCE, 24)} SELECT scope_slug, position, provider, product_code, price_krw FROM taken",
    "seller_insights": f"""WITH {PRODUCTS}, {bench('seller', 'products')}
SELECT seller, product_count, median_price_krw, low_price_percent, discounted_percent,
  {ladder(['low_price_percent >= 45 OR (low_price_percent >= 30 AND product_count >= 12)', 'discounted_percent >= 35', 'product_count <= 3'], tuple(x for x, _ in S.SELLER_LEVELS))} AS competition_level,
  {ladder(['low_price_percent >= 45 OR (low_price_percent >= 30 AND product_count >= 12)', 'discounted_percent >= 35', 'product_count <= 3'], tuple(x for _, x in S.SELLER_LEVELS))} AS recommended_action FROM bench""",
    "price_clusters": f"""WITH {PRODUCTS}, m AS (SELECT l_partkey, {rank(0.5)} AS v FROM products GROUP BY 1)
SELECT {ladder(['v <= 0', 'v < 10000', 'v < 30000', 'v < 70000', 'v < 150000'], S.CLUSTER_TEXTS)} AS cluster_label, count(*) AS n_parts FROM m GROUP BY 1""",
    "balanced_limit": f"""WITH {PRODUCTS}, t AS (SELECT source_category, product_code, row_number() OVER (PARTITION BY source_category ORDER BY product_code) AS n FROM products)
SELECT source_category, product_code FROM t ORDER BY n, source_category, product_code LIMIT 1000""",
    "balanced_third": f"""WITH {PRODUCTS}, k AS (SELECT *, CASE WHEN l_partkey % 7 = 0 THEN '' WHEN l_partkey % 2 = 0 THEN 'large' ELSE seller END AS keyword FROM products),
t AS (SELECT *, CASE WHEN keyword = '' THEN '기타' ELSE keyword END AS grp, row_number() OVER (PARTITION BY keyword ORDER BY price_krw, product_code) AS turn FROM k),
n AS (SELECT *, row_number() OVER (ORDER BY turn, grp) AS place FROM t)
SELECT keyword, count(*) AS row_count, max(price_krw) AS dearest FROM n WHERE place <= (SELECT count(*) // 3 FROM products) GROUP BY 1""",
    "early_stop": f"""WITH {PRODUCTS}, c AS (SELECT l_partkey, product_code FROM products QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY price_krw, product_code) <= 3),
j AS (SELECT l_partkey, count(*) AS size FROM c GROUP BY 1), s AS (SELECT l_partkey, sum(size) OVER (ORDER BY l_partkey DESC) - size AS before FROM j)
SELECT l_partkey, product_code FROM c JOIN s USING (l_partkey) WHERE before < 2 * (SELECT count(*) // 7 FROM products)""",
    "report_sheets": """WITH o AS (SELECT o_orderkey AS k, o_orderkey::VARCHAR AS code, o_orderpriority AS category FROM orders),
d AS (SELECT code, CASE WHEN k % 5 = 0 THEN 'b' || code END AS brand, CASE WHEN k % 5 <> 0 THEN 'true' END AS good, CASE WHEN k % 5 <> 0 THEN code END AS added FROM o WHERE k % 3 = 0),
m AS (SELECT o.code, category, brand, good, added FROM o LEFT JOIN d USING (code))
SELECT sheet, place, name, filled, last FROM (
  SELECT 'list' AS sheet, unnest([0::BIGINT, 1, 2]) AS place, unnest(['z', '상품코드', '수집카테고리']) AS name, unnest([count(*), count(*), count(category)]) AS filled, unnest(['a,"b"', max(code), max(category)]) AS last FROM o UNION ALL
  SELECT 'detail', unnest([0::BIGINT, 1, 2, 3]), unnest(['국내_브랜드', '국내_수집성공', '상품코드', '추가']), unnest([count(brand), count(good), count(code), count(added)]), unnest([max(brand), max(good), max(code), max(added)]) FROM d UNION ALL
  SELECT 'merged', unnest([0::BIGINT, 1, 2, 3, 4, 5]), unnest(['수집카테고리', '상품코드', '국내_브랜드', '국내_수집성공', 'z', '추가']), unnest([count(category), count(code), count(brand), count(good), count(*), count(added)]), unnest([max(category), max(code), max(brand), max(good), 'a,"b"', max(added)]) FROM m)""",
    "category_names": """WITH n AS (SELECT p_partkey, unnest([1, 2, 3, 4]) AS place, unnest([p_brand || ' (제철)', p_name || '& co', '쌀 | n' || p_partkey, trim(p_type)]) AS keyword FROM part)
SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey ORDER BY place) AS position, keyword FROM n WHERE length(keyword) BETWEEN 2 AND 20""",
    "domestic_details": f"""SELECT p_partkey AS page_id, true AS success, p_name AS product_name, 'Tools > ' || p_brand AS category_path, {', '.join(f"'{f}-' || p_partkey AS {f}" for f in TABLE_FIELDS)},
  CASE WHEN p_partkey % 5 < 2 THEN 'B' ELSE 'brand-' END || p_partkey AS brand, CASE WHEN p_partkey % 5 < 2 THEN 'S' ELSE 'seller-' END || p_partkey AS seller,
  CASE WHEN p_partkey % 5 < 2 THEN CAST(p_partkey * 10 + 1000 AS VARCHAR) ELSE '판매가 ' || format('{{:,}}', p_partkey * 10 + 1000) || '원' END AS price_raw,
  CASE WHEN p_partkey % 5 < 2 THEN 7777 ELSE p_partkey * 10 + 1000 END AS price_krw, CASE WHEN p_partkey % 5 < 2 THEN CAST(12 AS BIGINT) END AS review_count, CASE WHEN p_partkey % 5 < 2 THEN CAST(1203 AS BIGINT) END AS order_count,
  CAST(6000 AS BIGINT) AS description_text_chars, CAST(7000 AS BIGINT) AS body_text_chars FROM part""",
    "page_images": """WITH k AS (SELECT p_partkey AS page_id, (p_partkey + 90000000)::VARCHAR AS k, p_partkey % 5 = 0 AS many FROM part),
i AS (SELECT page_id, many, ['https://img.example/' || k || '.jpg', 'https://item.example/a/still/300/b', 'https://item.example/a/still/600/b'] AS first,
  ['https://item.example/bg.gif', 'https://item.example/desc/2.gif', 'https://gdimg.example/' || k || '/still/80', 'https://gdimg.example/' || k || '/still/600', 'https://gi.esmplus.com/q'] AS last,
  CASE WHEN many THEN list_transform(range(1, 61), lambda n: 'https://item.example/detail/' || n || '.png') ELSE [] END AS tags FROM k)
SELECT page_id, array_to_string(list_concat(first, tags, last)[:40], ' ') AS images,
  array_to_string(list_concat([first[1], first[3]], tags, last[2:])[:30], ' ') AS described FROM i""",
    "dedupe_keep_first": "SELECT concat_ws('-', l_orderkey, l_linenumber) AS code, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1",
    "latest_version": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1",
    "shard_counts": f"""WITH {PRODUCTS}, h AS (
  SELECT list_reduce(list_concat([2166136261::HUGEINT], list_transform(string_split(product_code, ''), lambda c: ascii(c)::HUGEINT)), lambda h, c: (xor(h, c) * 16777619) & 4294967295::HUGEINT) AS v FROM products)
SELECT CAST(v % 8 AS INTEGER) AS shard_index, count(*) AS row_count FROM h GROUP BY 1""",
    "sequence_numbers": f"WITH {PRODUCTS} SELECT product_code, row_number() OVER (ORDER BY price_krw, product_code) AS no FROM products",
    "list_detail_merge": """WITH d AS (
  SELECT l_orderkey, CAST(CAST(round(l_extendedprice) AS BIGINT) AS VARCHAR) AS price, CASE WHEN l_linenumber > 3 THEN '' ELSE l_returnflag END AS flag
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1)
SELECT o_orderkey, coalesce(price, CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR)) AS price, o_orderstatus AS name, coalesce(flag, '') AS flag
FROM orders LEFT JOIN d ON o_orderkey = l_orderkey""",
    "detail_union": "SELECT coalesce(c_custkey, s_suppkey * 2) AS key, coalesce(CAST(c_nationkey AS VARCHAR), '') AS d, coalesce(CAST(s_nationkey AS VARCHAR), '') AS f FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 2",
    "discount_rates": f"""WITH {PRODUCTS}, r AS (SELECT CASE WHEN original_price_krw > 0 AND original_price_krw > price_krw
  THEN round((1 - CAST(price_krw AS DOUBLE) / original_price_krw) * 100 * 10) / 10 END AS discount_rate FROM products)
SELECT discount_rate, count(*) AS row_count FROM r GROUP BY 1""",
    "category_counts": "SELECT CASE WHEN lang <> 'es' THEN lang ELSE 'other' END AS category, count(*) AS row_count FROM documents GROUP BY 1",
    "nearest_rank": f"""WITH o AS (SELECT o_orderpriority, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders)
SELECT o_orderpriority, {rank(0.1, 'v')} AS p10, {rank(0.25, 'v')} AS p25, {rank(0.5, 'v')} AS p50, {rank(0.75, 'v')} AS p75, {rank(0.99, 'v')} AS p99 FROM o GROUP BY 1""",
    "set_parity": f"""WITH {PRODUCTS}, c AS (SELECT DISTINCT source_category AS category FROM products), w AS (SELECT category FROM c WHERE category <> 'SMALL' UNION ALL SELECT 'NONE')
SELECT 'outside' AS check, count(*) AS n FROM products WHERE source_category NOT IN (SELECT category FROM w)
UNION ALL SELECT 'gaps', count(*) FROM w WHERE category NOT IN (SELECT category FROM c)
UNION ALL SELECT 'left', count(*) FROM c WHERE category NOT IN (SELECT category FROM w) HAVING count(*) > 0
UNION ALL SELECT 'right', count(*) FROM w WHERE category NOT IN (SELECT category FROM c) HAVING count(*) > 0
UNION ALL SELECT 'twice', count(*) FROM (SELECT seller FROM products GROUP BY 1 HAVING count(*) > 1)""",
    "payload_json_valid": """WITH t AS (SELECT event_type, json_valid(CASE WHEN event_id % 7 = 0 THEN props || '}' ELSE props END) AS ok FROM events)
SELECT event_type, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid FROM t GROUP BY 1""",
    "page_gate": f"""WITH t AS (SELECT page_id, url, lower(trim(html)) AS low, strlen(trim(html)) AS size FROM pages),
g AS (SELECT page_id, {gate(800, BLOCKED)} AS reason, {gate(500, BLOCKED_B, B_MISSING)} AS b_reason, {gate(800, BLOCKED, GLOBAL_MISSING)} AS global_reason FROM t)
SELECT page_id, reason = '' AS ok, reason, b_reason, global_reason,
  CASE WHEN regexp_matches(lower(global_reason), '잠시만|checking your browser|signal_missing') THEN 'wait' WHEN regexp_matches(lower(global_reason), 'cloudfront|504|access denied|forbidden') THEN 'hard' ELSE '' END AS triage FROM g""",
    "page_links": """WITH l AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) AS h FROM pages),
e AS (SELECT page_id, url, unnest(h) AS href, unnest(range(len(h))) AS link_no FROM l),
r AS (SELECT *, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1) AS root FROM e)
SELECT page_id, link_no, href, CASE WHEN href = '' THEN '' WHEN starts_with(href, '//') THEN 'https:' || href WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
  WHEN starts_with(href, '/') THEN root || href ELSE root || '/' || href END AS target FROM r""",
    "page_lines": f"WITH {LINES} SELECT page_id, line_no, line FROM lines",
    "section_text": f"""WITH {LINES},
s AS (SELECT page_id, min(line_no) AS s FROM lines WHERE contains(lower(line), 'that') OR contains(lower(line), 'dans') GROUP BY 1),
e AS (SELECT page_id, min(line_no) AS e FROM lines JOIN s USING (page_id) WHERE line_no > s AND (contains(lower(line), 'with') OR contains(lower(line), 'pour')) GROUP BY 1),
t AS (SELECT page_id, string_agg(line, chr(10) ORDER BY line_no) AS t FROM lines JOIN s USING (page_id) LEFT JOIN e USING (page_id)
  WHERE line_no >= s AND (e IS NULL OR line_no < e) AND length(line) > 1
    AND line NOT IN ('interest', 'Added on your', 'Wish List', 'Quantity', 'Confirm', 'Add to cart', 'Buy now', '수량증가 수량감소') GROUP BY 1)
SELECT page_id, coalesce(substring(t, 1, 12000), '') AS section FROM pages LEFT JOIN t USING (page_id)""",
    "page_details": f"""WITH t AS (SELECT page_id, url, html, lower(trim(html)) AS low, strlen(trim(html)) AS size FROM pages),
g AS (SELECT page_id, {gate(500, BLOCKED_B, B_MISSING)} AS error, {TITLE} AS title, {H1} AS h1 FROM t)
SELECT page_id, error = '' AS success, error, CASE WHEN error = '' THEN coalesce(nullif(h1, ''), title) END AS product_name, CASE WHEN error = '' THEN title END AS page_title FROM g""",
    "page_titles": f"SELECT page_id, {TITLE} AS title, CAST(0 AS BIGINT) AS n_pairs, CAST(0 AS BIGINT) AS n_images FROM pages",
    "search_json_products": "SELECT l_orderkey, count(DISTINCT l_partkey) AS n_products, min(l_partkey) AS first_code FROM lineitem GROUP BY 1",
    "event_envelope": "SELECT event_type || ':' || CASE WHEN event_id % 5 = 0 THEN CAST(event_id AS VARCHAR) ELSE '/user/' || user_id END AS key, CAST(event_id AS VARCHAR) AS event_uuid, props AS payload FROM events",
    "raw_event_rows": f"""WITH {PRODUCTS}
SELECT product_code, CASE WHEN order_count % 2 = 0 THEN product_name || ' x' ELSE product_name END AS product_name, price_krw AS list_price_krw,
  CASE WHEN review_count <= 40 THEN original_price_krw END AS list_original_price_krw, review_count, CAST(order_count > 3 AS BIGINT) AS korean_collect_success,
  CAST(2 AS BIGINT) AS n_images, 'gmarket' AS provider FROM products""",
    "collected_rows": f"""WITH {PRODUCTS}, c AS (SELECT *, product_code || '|' || lpad(CAST(price_krw AS VARCHAR), 12, '0') AS seq, array_to_string(string_split(product_code, '-')[1:2], '-') AS code FROM products),
f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY code ORDER BY seq) = 1),
l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY code ORDER BY seq DESC) = 1)
SELECT f.code AS product_code, f.source_category, f.original_price_krw AS list_price_krw, CAST(NULL AS BIGINT) AS list_original_price_krw, l.price_krw AS detail_price_krw, l.seller FROM f JOIN l USING (code)""",
    "search_text": f"""WITH {PRODUCTS}, r AS (SELECT source_category, product_name || ' ' || brand AS t, row_number() OVER (PARTITION BY source_category ORDER BY provider, product_code) AS n FROM products)
SELECT source_category, substring(lower(string_agg(t, ' ' ORDER BY n)), 1, 12000) AS search_text FROM r WHERE n <= 160 GROUP BY 1""",
    "text_tokens": f"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(lower(text), '[^0-9a-zA-Z가-힣]+'), lambda x: x <> '')) AS BIGINT) AS n_tokens, length({slug('text')}) AS slug_chars FROM documents",
    "prices_from_text": f"WITH {PRODUCTS} SELECT product_code, CASE WHEN order_count IN (1, 2, 4, 5, 6) THEN price_krw WHEN order_count = 3 THEN price_krw + 1000000 END AS price FROM products",
    "numbers_from_text": f"""WITH {PRODUCTS} SELECT product_code, price_krw + CASE WHEN order_count > 3 THEN 0.5::DOUBLE ELSE 0 END AS usd, CAST(12 AS BIGINT) AS ungrouped, price_krw AS grouped,
  price_krw + 0.25::DOUBLE AS decimal, CASE WHEN order_count <= 3 THEN CAST(l_partkey AS VARCHAR) WHEN order_count = 4 THEN CAST(l_partkey + 10000000 AS VARCHAR) ELSE '' END AS code,
  CASE WHEN order_count > 4 THEN 'korean' WHEN order_count > 2 THEN 'global' ELSE 'list' END AS platform FROM products""",
    "link_addresses": f"""WITH {PRODUCTS}, c AS (SELECT product_code, order_count AS n, CASE WHEN order_count <= 5 THEN CAST(l_partkey AS VARCHAR) ELSE '' END AS code FROM products)
SELECT product_code, code, CASE WHEN code <> '' THEN 'https://item.gmarket.co.kr/Item?goodscode=' || code ELSE '' END AS domestic,
  CASE WHEN n = 1 THEN 'https://global.gmarket.co.kr/item?goodscode=' || code || '&a=1' WHEN code <> '' THEN 'https://global.gmarket.co.kr/item?goodscode=' || code ELSE '' END AS foreign_url FROM c""",
    "list_products": """WITH f AS (SELECT l_orderkey, l_partkey, CAST(round(l_extendedprice) AS BIGINT) AS price FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, CAST(round(l_extendedprice) AS BIGINT)) = 1)
SELECT l_orderkey AS page_id, CAST(l_partkey AS VARCHAR) AS product_code, 'Part ' || l_partkey AS product_name, 'https://item.gmarket.co.kr/Item?goodscode=' || l_partkey AS product_url,
  'https://global.gmarket.co.kr/item?goodscode=' || l_partkey AS global_url, 'https://shop.example/i/' || l_partkey || '.jpg' AS image_url, price AS price_krw, price + 1000 AS original_price_krw FROM f""",
    "korean_details": """WITH t AS (SELECT p_partkey, p_name, p_brand, p_partkey % 5 AS n FROM part),
g AS (SELECT *, CASE n WHEN 0 THEN 'korean_product_signal_missing' WHEN 1 THEN 'blocked_or_error_page: Access Denied' ELSE '' END AS error FROM t)
SELECT p_partkey AS page_id, CAST(p_partkey AS VARCHAR) AS product_code, error = '' AS success, error, CASE WHEN error = '' THEN p_name || ' set' END AS product_name,
  CASE WHEN error = '' THEN p_brand END AS origin, CASE WHEN error = '' THEN 'M' || p_partkey END AS model, CASE WHEN error = '' THEN p_partkey * 10 + 1000 END AS price_krw,
  CASE WHEN error = '' THEN n END AS review_count, CASE WHEN error = '' THEN '상품상세정보' || chr(10) || 'about ' || p_partkey END AS description_text FROM g""",
    "global_details": """SELECT p_partkey AS page_id, true AS success, p_name AS product_name, p_brand AS seller, '' AS shipping_fee, '3 kg' AS weight, p_partkey % 5 + 0.5::DOUBLE AS price_usd,
  p_partkey * 10 + 1000 AS price_krw, 'Item 1 red 5 left | Item 2 blue Review 12 of 3 Order 7' AS options, CAST(12 AS BIGINT) AS review_count, CAST(7 AS BIGINT) AS order_count FROM part""",
    "korean_keywords": f"""WITH {PRODUCTS}, k AS (SELECT unnest(CASE WHEN l_partkey % 4 IN (0, 2) THEN ['appl 사과', 'appl', '사과'] WHEN l_partkey % 4 = 1 THEN ['강아지'] ELSE [] END) AS keyword FROM products)
SELECT keyword, count(*) AS row_count FROM k GROUP BY 1""",
    "capped_rows": f"WITH {PRODUCTS} SELECT source_category, product_code FROM products QUALIFY row_number() OVER (PARTITION BY source_category ORDER BY price_krw DESC, product_code) <= 5",
    "first_deals": f"WITH {PRODUCTS}, {scoped('products')}, {interleave('scoped', 'scope_slug', EVIDENCE, 24)} SELECT scope_slug, provider, count(*) AS row_count FROM taken GROUP BY ALL",
    "ndjson_scan": "SELECT event_type, count(*) AS row_count, max(event_id) AS last_id FROM events GROUP BY 1",
    "tabular_scan": "SELECT CAST(o_orderkey AS VARCHAR) AS product_code, 'a,\"b\" ' || o_orderstatus AS product_name, CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) AS price, '' AS brand FROM orders WHERE o_orderkey % 3 <> 0",
    "report_bundle": f"""WITH {PRODUCTS} SELECT 'rows' AS fact, CAST(count(*) AS VARCHAR) AS value FROM products UNION ALL SELECT 'codes', CAST(count(DISTINCT product_code) AS VARCHAR) FROM products
UNION ALL SELECT 'dearest', CAST(max(price_krw) AS VARCHAR) FROM products UNION ALL SELECT 'category ' || source_category, CAST(count(*) AS VARCHAR) FROM products GROUP BY source_category
UNION ALL SELECT 'sheet rows', CAST(count(*) AS VARCHAR) FROM products UNION ALL SELECT 'last names', max(brand || '|' || seller) FROM products""",
    "raw_history": f"""WITH {PRODUCTS}, n AS (SELECT provider, product_code, CAST(max(CASE WHEN order_count >= 2 THEN 2 ELSE 1 END) AS BIGINT) AS version, max(price_krw) AS price FROM products GROUP BY ALL)
SELECT provider, version, count(*) AS row_count, CAST(sum(price + version) AS BIGINT) AS price_sum FROM n GROUP BY ALL""",
    "retried_rows": "SELECT CAST(CASE WHEN event_id % 11 = 0 THEN 2 ELSE 1 END AS BIGINT) AS attempt, event_id % 33 <> 0 AS success, count(*) AS row_count FROM events GROUP BY ALL",
    "stream_enriched": "SELECT o_orderstatus, count(*) AS row_count FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
    "classified_products": f"WITH {STANDARD} SELECT source_category, count(*) AS product_count FROM standard WHERE order_count <> 1 GROUP BY 1",
    "radar_payload": f"""WITH {STANDARD}, {scoped('standard')}, {interleave('scoped', 'scope_slug', EVIDENCE, 24)},
n AS (SELECT scope_slug, count(*) AS n_products, max(product_code) FILTER (position = 1) AS first_product FROM taken GROUP BY 1)
SELECT scope_slug, count(*) AS product_count, {rank(0.5)} AS median_price_krw, CAST(5 AS BIGINT) AS n_bands, count(DISTINCT source_category) AS n_categories, any_value(n_products) AS n_products, any_value(first_product) AS first_product
FROM scoped JOIN n USING (scope_slug) GROUP BY scope_slug""",
    "keyword_mart": f"""WITH {STANDARD}, words AS (
  SELECT *, list_filter(string_split(product_name, ' '), lambda t: t NOT IN ('new', 'hot')) AS w FROM standard), {scoped('words')},
totals AS (SELECT scope_slug, count(*) AS source_product_count FROM scoped GROUP BY 1),
exploded AS (SELECT *, unnest(list_distinct(list_concat(w, CASE WHEN len(w) = 2 AND w[1] <> w[2] THEN [w[1] || ' ' || w[2]] ELSE [] END))) AS keyword FROM scoped)
SELECT scope_slug, keyword, keyword AS keyword_key, count(*) AS product_count, count(DISTINCT source_category) AS category_count, min(price_krw) AS min_price_krw, {rank(0.5)} AS median_price_krw,
  max(price_krw) AS max_price_krw, any_value(source_product_count) AS source_product_count, count(DISTINCT source_category) AS n_categories,
  CAST(least(24, count(*)) AS BIGINT) AS n_evidence FROM exploded JOIN totals USING (scope_slug) GROUP BY scope_slug, keyword""",
    "refresh_published": f"WITH {STANDARD}, {scoped('standard')} SELECT scope_slug, CASE WHEN scope_slug = 'all' THEN '' ELSE max(source_category) END AS scope_category, count(*) AS source_product_count, max(collected_at) AS source_max_collected_at, true AS valid FROM scoped GROUP BY scope_slug",
    "verification": f"WITH {STANDARD}, {scoped('standard')} SELECT count(DISTINCT scope_slug) AS snapshot_rows, string_agg(DISTINCT scope_slug, ',' ORDER BY scope_slug) AS snapshot_scopes, CAST(1 AS BIGINT) AS snapshot_invalid_payloads, count(*) FILTER (scope_slug = 'all') AS snapshot_source_product_count, count(DISTINCT scope_slug) AS keyword_rows, CAST(0 AS BIGINT) AS keyword_invalid_payloads FROM scoped",
    "stream_append": "SELECT event_type, count(*) AS row_count FROM events GROUP BY 1",
    "stream_dedupe": "SELECT event_type, count(*) AS row_count FROM (SELECT DISTINCT event_id, event_type FROM events) GROUP BY 1",
    "stream_latest": "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "published_marker": f"WITH {STANDARD} SELECT CAST(1 AS BIGINT) AS marker_rows, count(*) FILTER (order_count <> 1) AS source_product_count, CAST(11 AS BIGINT) AS expected_scope_count, max(collected_at) FILTER (order_count <> 1) AS source_max_collected_at, true AS whole, count(*) FILTER (order_count = 1) AS dropped_rows FROM standard",
    "decorated_products": f"""WITH {PRODUCTS}, p AS (
  SELECT *, CASE WHEN l_partkey % 3 = 1 THEN 'gmarket' ELSE provider END AS shown, CASE WHEN order_count > 2 THEN product_name ELSE '' END AS name FROM products)
SELECT product_code, shown AS provider, CASE shown WHEN 'kurly' THEN 'Kurly' ELSE 'Gmarket' END AS provider_label, CASE WHEN name = '' THEN product_code ELSE name END AS product_label,
  '수집 시점 관측가' AS price_basis, '/out/' || shown || '/' || product_code || '/' AS product_url FROM p""",
    "event_envelopes": f"""WITH {PRODUCTS}, n AS (SELECT *, l_partkey % 5 AS n FROM products)
SELECT product_code, provider, 'crawler' AS source, 'host-1' AS host, '10.0.0.1' AS ip, '' AS uuid_user, 'product' AS event_type,
  CASE WHEN n IN (0, 4) OR provider = 'gmarket' AND n = 1 OR provider = 'kurly' AND n IN (2, 3) THEN 'https://x/' || n || '/' || product_code ELSE '' END AS url,
  CASE WHEN n < 3 THEN product_code ELSE 'made' END AS event_uuid, CASE WHEN n < 2 THEN collected_at ELSE 'made' END AS created_at FROM n""",
    "topic_messages": """WITH k AS (SELECT event_type || ':' || CASE WHEN event_id % 3 = 0 THEN 'https://x/사과-' || user_id ELSE event_id::VARCHAR END AS key FROM events),
b AS (SELECT DISTINCT key, hex(encode(key)) AS h FROM k),
p AS (SELECT key, CAST(list_reduce(list_concat([2166136261::HUGEINT], list_transform(range(1, len(h) + 1, 2), lambda i: CAST('0x' || h[i:i + 1] AS HUGEINT))),
  lambda a, x: (xor(a, x) * 16777619) & 4294967295::HUGEINT) % 8 AS INTEGER) AS "partition" FROM b)
SELECT "partition", count(*) AS row_count, count(DISTINCT key) AS key_count, count(*) AS offsets, count(*) - 1 AS last_offset, true AS in_order FROM k JOIN p USING (key) GROUP BY 1""",
    "stream_details": """WITH e AS (SELECT event_id // 2 AS code, event_id, ts, value FROM events)
SELECT coalesce(a.code, b.code) AS code, a.event_id AS domestic_id, a.value AS domestic_value, b.event_id AS abroad_id, b.value AS abroad_value
FROM (SELECT * FROM e WHERE event_id % 2 = 0) a FULL JOIN (SELECT * FROM e WHERE event_id % 2 = 1) b
ON a.code = b.code AND b.ts >= a.ts - INTERVAL 6 HOUR AND b.ts <= a.ts + INTERVAL 6 HOUR""",
    "stream_decode": "SELECT event_id % 11 <> 0 AS ok, count(*) AS row_count, CAST(sum(CASE WHEN event_id % 11 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS BIGINT) AS k_sum FROM events WHERE event_type = 'click' GROUP BY 1",
}
