"""Scores, percentages and label ladders, with the rounding that results must have."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(c: Column | float) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("double")


def round2(c: Column) -> Column:
    """Half away from zero of ``c * 100``, over 100; ``round(c, 2)`` would round decimals."""
    return F.round(c * 100) / 100


def clamp(c: Column) -> Column:
    return F.when(c < 0, 0.0).when(c > 100, 100.0).otherwise(round2(c))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole <= 0, 0.0).otherwise(round2(_d(part) * 100 / F.nullif(_d(whole), F.lit(0.0))))


def reaction(reviews: Column, orders: Column) -> Column:
    return reviews + orders * 3


def demand(count: Column, reviews: Column, orders: Column) -> Column:
    return clamp(F.log1p(_d(count) + _d(reviews) + _d(orders) * 3) * 11)


def competition(count: Column, sellers: Column, brands: Column) -> Column:
    return clamp(F.log1p(_d(count)) * 18 + F.log1p(_d(sellers)) * 10 + F.log1p(_d(brands)) * 8)


def category_opportunity(dem: Column, comp: Column, low_percent: Column, discounted_percent: Column) -> Column:
    return clamp(dem * 0.45 + (F.lit(100.0) - comp) * 0.25 + low_percent * 0.15 + discounted_percent * 0.15)


def keyword_saturation(dem: Column, comp: Column, categories: Column) -> Column:
    return clamp(comp * 0.65 - dem * 0.25 + F.log1p(_d(categories)) * 8)


def keyword_opportunity(dem: Column, comp: Column, categories: Column) -> Column:
    return clamp(dem * 0.50 + (F.lit(100.0) - comp) * 0.30 + F.log1p(_d(categories)) * 5)


def price_gap(iqr: Column, median: Column, comp: Column, dem: Column) -> Column:
    ratio = F.when(median > 0, _d(iqr) / F.nullif(_d(median), F.lit(0.0))).otherwise(0.0)
    return clamp((F.lit(1.0) - F.least(ratio, F.lit(1.0))) * 35 + (F.lit(100.0) - comp) * 0.35 + dem * 0.30)


def pair_opportunity(dem: Column, gap: Column, comp: Column) -> Column:
    return clamp(dem * 0.40 + gap * 0.25 + (F.lit(100.0) - comp) * 0.25)


def below_percent(price: Column, reference: Column) -> Column:
    """How far a price is under a reference, in percent; 0 if it is not."""
    known = (reference > price) & (reference > 0)
    return F.when(known, round2((_d(reference - price) * 100) / F.nullif(_d(reference), F.lit(0.0)))).otherwise(0.0)


def rough_below(price: Column, reference: Column) -> Column:
    """``below_percent`` without rounding, which costs most of it."""
    return F.when((reference > price) & (reference > 0), (_d(reference - price) * 100) / F.nullif(_d(reference), F.lit(0.0))).otherwise(0.0)


def _deal_bonus(price: Column) -> Column:
    return F.when(price <= 10000, 20.0).when(price <= 30000, 10.0).otherwise(0.0)


def _deal_part(c: Column, w: float, most: float) -> Column:
    return F.least(F.lit(most), F.greatest(F.lit(0.0), c * w))


def rough_deal_score(below: Column, discount: Column, price: Column) -> Column:
    """``deal_score`` without rounding: it needs no bounds, because its parts add up to 100 at most."""
    return _deal_part(below, 0.45, 45.0) + _deal_part(discount, 0.35, 35.0) + _deal_bonus(price)


def deal_score(below: Column, discount: Column, price: Column) -> Column:
    return clamp(rough_deal_score(below, discount, price))


def discount_rate(price: Column, original: Column) -> Column:
    """Percent to one decimal; null unless the original price is higher."""
    rate = (F.lit(1.0) - _d(price) / F.nullif(_d(original), F.lit(0.0))) * 100
    return F.when((original > 0) & (original > price), F.round(rate * 10) / 10)


def round_boundary(c: Column) -> Column:
    """A price rounded to 100, 1 000, 10 000 or 100 000, by its size."""
    size = F.abs(c)
    unit = F.when(size >= 1000000, 100000).when(size >= 100000, 10000).when(size >= 10000, 1000).otherwise(100)
    return (F.round(_d(c) / _d(unit)).cast("bigint") * unit).cast("bigint")


# The texts of the label ladders.
CATEGORY_TEXTS = (
    "수요 신호 대비 경쟁 부담이 낮아 우선 검토할 시장입니다.",
    "상품·셀러 밀도가 높아 가격 외 차별화가 필요합니다.",
    "가격 분산이 커서 하위 가격군이나 세그먼트별 비교가 필요합니다.",
    "가격 분위수와 키워드 반응을 함께 관찰할 시장입니다.",
)
KEYWORD_TEXTS = (
    "반응 신호가 높고 경쟁 부담이 비교적 낮은 키워드입니다.",
    "노출 상품이 많은 포화 키워드라 롱테일 세분화가 필요합니다.",
    "카테고리와 가격군을 함께 좁혀 확인할 키워드입니다.",
)
PAIR_TEXTS = (
    "반응 대비 공급 밀도가 낮아 진입 후보로 볼 수 있습니다.",
    "경쟁 밀도가 높아 브랜드·구성 차별화가 필요합니다.",
    "가격군 공백 신호가 있어 포지셔닝 검토 가치가 있습니다.",
    "추가 기간 데이터로 추세를 확인할 조합입니다.",
)
CLUSTER_TEXTS = ("가격 미확정", "초저가형", "저가형", "중가형", "중상가형", "프리미엄형")
BAND_TEXTS = (
    "상품 수 대비 반응이 낮아 공급 과밀 가능성이 있습니다.",
    "상품 수보다 반응 비중이 높아 수요가 몰리는 가격군입니다.",
    "표본은 얇지만 반응이 있어 가격공백 후보로 볼 수 있습니다.",
    "상품 수와 반응을 함께 관찰할 가격군입니다.",
)
DEAL_TEXTS = (
    "표시 정가와 카테고리 중앙값 모두 대비 낮은 관측가입니다.",
    "표시 정가 대비 할인 신호가 있습니다.",
    "카테고리 중앙값 대비 낮은 가격대입니다.",
    "1만원 이하 저가 후보입니다.",
    "수집 기준 가격 후보입니다.",
)
SELLER_LEVELS = (
    ("high_price_pressure", "배송비와 옵션 추가금까지 포함한 총액 경쟁력을 먼저 점검하세요."),
    ("promotion_sensitive", "표시 할인보다 실제 최종가와 프로모션 타이밍을 비교하세요."),
    ("thin_sample", "표본이 적으므로 추가 수집이나 셀러 업로드 데이터로 보강하세요."),
    ("watch", "가격 분위수와 키워드 반응을 추가 관찰하세요."),
)


def ladder(conditions: list[Column], texts: tuple[str, ...]) -> Column:
    """The text of the first condition that holds; the last text if none does."""
    out = None
    for cond, text in zip(conditions, texts):
        out = F.when(cond, text) if out is None else out.when(cond, text)
    return out.otherwise(texts[-1])


def category_text(opportunity: Column, comp: Column, iqr: Column, median: Column) -> Column:
    return ladder([opportunity >= 70, comp >= 70, iqr > median], CATEGORY_TEXTS)


def keyword_text(opportunity: Column, saturation: Column) -> Column:
    return ladder([opportunity >= 70, saturation >= 70], KEYWORD_TEXTS)


def pair_text(opportunity: Column, comp: Column, gap: Column) -> Column:
    return ladder([opportunity >= 75, comp >= 75, gap >= 65], PAIR_TEXTS)


def price_cluster(median: Column) -> Column:
    return ladder([median <= 0, median < 10000, median < 30000, median < 70000, median < 150000], CLUSTER_TEXTS)


def band_text(product_percent: Column, reaction_percent: Column, count: Column) -> Column:
    crowded = (product_percent >= 30) & (reaction_percent < product_percent)
    return ladder([crowded, reaction_percent >= product_percent + 8, (count <= 3) & (reaction_percent > 0)], BAND_TEXTS)


def deal_text(discount: Column, below: Column, price: Column) -> Column:
    return ladder([(discount >= 20) & (below >= 20), discount >= 20, below >= 20, price <= 10000], DEAL_TEXTS)


def seller_level(low_percent: Column, discounted_percent: Column, count: Column) -> tuple[Column, Column]:
    """Competition level and recommended action."""
    pressed = (low_percent >= 45) | ((low_percent >= 30) & (count >= 12))
    steps = [pressed, discounted_percent >= 35, count <= 3]
    return ladder(steps, tuple(x for x, _ in SELLER_LEVELS)), ladder(steps, tuple(x for _, x in SELLER_LEVELS))
