"""Rankings: top lists, provider interleaving, balanced limits, dedupe and latest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scores as S
from ..sources.tables import materialise
from .aggregates import nearest_rank

#: Providers in display order; others follow by name.
PROVIDERS = ("gmarket", "kurly")
ROUGH = 0.02
EVIDENCE_LIMIT, DEAL_LIMIT, SLICE_EVIDENCE_LIMIT, SLICE_DEAL_LIMIT = 24, 24, 80, 60


def provider_order(c: Column) -> Column:
    out = None
    for i, p in enumerate(PROVIDERS):
        out = F.when(c == p, i) if out is None else out.when(c == p, i)
    return out.otherwise(len(PROVIDERS))


def evidence_order() -> list[Column]:
    return [F.desc(S.reaction(F.col("review_count"), F.col("order_count"))), F.desc("collected_at"), F.asc("price_krw"), F.asc("provider"), F.asc("product_code")]


def deal_order() -> list[Column]:
    return [F.desc("radar_score"), F.desc("discount_percent"), F.desc("below_category_median_percent"), F.asc("price_krw"), F.asc("provider"), F.asc("product_code")]


def may_be_first(rows: DataFrame, group: list[str], lead: Column, limit: int, descending: bool = True, keep: Column | None = None) -> DataFrame:
    """Rows that can be among the first ``limit`` of their group in an order that begins with ``lead``, of which there
    should be few values: those beyond the value that fills the limit go.

    Counts by value tell that value without a sort, so what is sorted after this are a few rows of a group and not
    all of them, copies of a product in every scope included.
    """
    counts = rows.groupBy(*group, lead.alias("_lead")).agg(F.count("*").alias("_n")).where("_lead is not null")
    up_to = F.sum("_n").over(W.partitionBy(*group).orderBy(F.desc("_lead") if descending else F.asc("_lead")))
    full = counts.withColumn("_up_to", up_to).where(F.col("_up_to") >= limit)
    last = (F.max if descending else F.min)("_lead").alias("_last")
    # written, so that Spark knows how small it is and broadcasts it; groups below the limit are not in it
    lasts = materialise(full.groupBy(*(F.col(c).alias(f"_of_{c}") for c in group)).agg(last), "lasts")
    joined = rows.join(lasts, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group], "left") if group else rows.join(lasts, F.lit(True), "left")
    best = lead if keep is None else keep
    inside = best >= F.col("_last") if descending else best <= F.col("_last")
    return joined.where(F.col("_last").isNull() | inside).drop("_last", *(f"_of_{c}" for c in group))


def may_be_deals(rows: DataFrame, group: list[str], limit: int) -> DataFrame:
    """Rows that can be among the ``limit`` best deals of their group, by a rough score that costs little: it is not
    rounded, so it is less than ``ROUGH`` from the exact one.

    Counted are rows that are certainly eligible, by whole points; kept are those that may be, down to a point below.
    """
    price, median = F.col("price_krw"), F.col("category_median_price_krw")
    discount, below = S.rough_below(price, F.col("original_price_krw")), S.rough_below(price, median)
    rows = rows.withColumns({"_discount": discount, "_below": below})
    eligible = lambda least: (price <= 30000) | (F.col("_discount") >= least) | (F.col("_below") >= least)
    rows = rows.where(eligible(20 - ROUGH)).withColumn("_points", F.floor(S.rough_deal_score(F.col("_below"), F.col("_discount"), price)))
    return may_be_first(rows, group, F.when(eligible(20 + ROUGH), F.col("_points")), limit, keep=F.col("_points") + 1).drop("_discount", "_below", "_points")


def interleave_by_provider(rows: DataFrame, scope: list[str], order: list[Column], limit: int, lead: Column) -> DataFrame:
    """The first ``limit`` rows of each scope, taking one of every provider in turn; ``order`` begins with ``lead``,
    the largest first.

    The rank inside (scope, provider) is limited first, and rows that are certainly beyond it are not sorted.
    """
    rows = may_be_first(rows, [*scope, "provider"], lead, limit)
    own = W.partitionBy(*scope, "provider").orderBy(*order)
    few = rows.withColumn("_own", F.row_number().over(own)).where(F.col("_own") <= limit)
    turn = (W.partitionBy(*scope) if scope else W.partitionBy(F.lit(0))).orderBy("_own", provider_order(F.col("provider")), "provider")
    return few.withColumn("position", F.row_number().over(turn)).where(F.col("position") <= limit).drop("_own")


def top_products(products: DataFrame, scope: list[str], limit: int = EVIDENCE_LIMIT) -> DataFrame:
    return interleave_by_provider(products, scope, evidence_order(), limit, S.reaction(F.col("review_count"), F.col("order_count")))


def score_deals(products: DataFrame, scope: list[str], cells: DataFrame | None = None) -> DataFrame:
    """Discount, distance from the category median, score and reason of all eligible products; medians come from
    ``cells`` of the same products if there are any."""
    keys = [*scope, "source_category"]
    # written, so that Spark knows how small it is before it plans the join: one row a category is broadcast, and
    # products of a few categories are not dealt out by category, each to one task
    medians = materialise(nearest_rank(products if cells is None else cells, keys, "price_krw", {"category_median_price_krw": 0.5}), "medians")
    return scored(products.join(medians, keys))


def scored(products: DataFrame) -> DataFrame:
    """Eligible products with their scores, from ``category_median_price_krw``."""
    price, median = F.col("price_krw"), F.col("category_median_price_krw")
    discount, below = F.col("discount_percent"), F.col("below_category_median_percent")
    return (
        products.withColumn("discount_percent", S.below_percent(price, F.col("original_price_krw")))
        .withColumn("below_category_median_percent", S.below_percent(price, median))
        .where(~((price > 30000) & (discount < 20) & (below < 20)))
        .withColumn("radar_score", S.deal_score(below, discount, price))
        .withColumn("reason", S.deal_text(discount, below, price))
    )


def best_deals(scored: DataFrame, scope: list[str], limit: int = DEAL_LIMIT) -> DataFrame:
    return interleave_by_provider(scored, scope, deal_order(), limit, F.col("radar_score"))


def deal_candidates(products: DataFrame, scope: list[str], limit: int = DEAL_LIMIT, cells: DataFrame | None = None) -> DataFrame:
    return best_deals(score_deals(products, scope, cells), scope, limit)


#: Fixed value: the group of rows without one.
NO_GROUP = "기타"


def quotas(sizes: DataFrame, total: int) -> tuple[int, DataFrame]:
    """How many rows each group gives to ``total`` if they give one in turn: all groups up to a level, and one more
    from the first of the larger ones by name.  ``sizes``: ``name, size``.

    The level comes from how many groups have each size, of which there are few whatever the groups are.
    """
    histogram = sorted((r["size"], r["count"]) for r in sizes.groupBy("size").count().collect())  # distinct sizes: below the root of twice the rows
    level, left, groups = 0, total, sum(n for _, n in histogram)
    for size, n in histogram:
        if (size - level) * groups > left:
            break
        left -= (size - level) * groups
        level, groups = size, groups - n
    if groups:
        level, left = level + left // groups, left % groups
    # at most as many names as there are groups, of which the first are kept before a shuffle
    more = sizes.where(F.col("size") > level).orderBy("name").limit(left if groups else 0).select("name", F.lit(1).alias("_more"))
    return level, sizes.join(more, "name", "left").select("name", F.least("size", level + F.coalesce("_more", F.lit(0))).alias("quota"))


def places_in_groups(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """1..n inside every group, by a sort of the whole table: a group may lie in any number of tasks."""
    numbered = materialise(sequence_numbers(rows, [F.col(group), *order], name), "numbered")
    starts = numbered.groupBy(group).agg((F.min(name) - 1).alias("_start"))
    return numbered.join(starts, group).withColumn(name, F.col(name) - F.col("_start")).drop("_start")


def balanced_limit(rows: DataFrame, group: Column, order: list[Column], total: int) -> DataFrame:
    """Up to ``total`` rows, one of each group in turn, groups by name and rows of a group by ``order``; all rows if
    ``total`` is not positive, or no less than there are.  Blank groups are one."""
    if total <= 0:
        return rows
    named = rows.withColumn("_group", F.coalesce(F.nullif(group, F.lit("")), F.lit(NO_GROUP)))
    sizes = materialise(named.groupBy(F.col("_group").alias("name")).agg(F.count("*").alias("size")), "group-sizes")
    _, quota = quotas(sizes, total)
    placed = places_in_groups(named, "_group", order, "_place")
    return placed.join(quota.withColumnRenamed("name", "_group"), "_group").where(F.col("_place") <= F.col("quota")).drop("_group", "_place", "quota")


def seeded_order(seed: int, *cols: str) -> list[Column]:
    """A shuffle that is the same in every run."""
    return [F.xxhash64(F.lit(seed), *cols).asc(), *(F.asc(c) for c in cols)]


def seeded_sample(rows: DataFrame, seed: int, key: str, n: int) -> DataFrame:
    return rows.orderBy(*seeded_order(seed, key)).limit(n)


def first_rows(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of an order."""
    return rows.orderBy(*order).limit(n)


def provider_counts(top: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """How many rows each provider has in a ranking."""
    return top.groupBy(*(scope or []), "provider").agg(F.count("*").alias("row_count"))


def keep_first(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of every non-blank key, by ``order``."""
    w = W.partitionBy(key).orderBy(*order)
    return rows.where(F.trim(F.col(key).cast("string")) != "").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def latest_version(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the largest version of every key, by a partial aggregate instead of a sort."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*version))
    return rows.groupBy(*keys).agg(best.alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest))


def capped_per_group(rows: DataFrame, group: str, order: list[Column], each: int) -> DataFrame:
    """At most ``each`` rows of a group."""
    w = W.partitionBy(group).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= each).drop("_n")


def until_enough(rows: DataFrame, job: str, job_order: list[Column], order: list[Column], each: int, target: int) -> DataFrame:
    """Rows of jobs in their order, at most ``each`` of a job, until there are twice as many as wanted: the job that
    reaches that is taken whole, and those after it are not.  No target, no end."""
    few = materialise(capped_per_group(rows, job, order, each), "capped")
    if target <= 0:
        return few
    sizes = few.groupBy(job).agg(F.count("*").alias("_size"))
    sums = running_sums(sizes, job_order, "_size", "_sum")
    taken = sums.where(F.col("_sum") - F.col("_size") < 2 * target).select(job)
    return few.join(taken, job, "left_semi")


def running_sums(rows: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """The sum of ``value`` up to every row of a total order: ranges are sorted and summed apart, and the sums of the
    ranges before are added.

    Places are written down with the rows before anything is summed, because a second run of the same
    exchange may be cut into other partitions.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = materialise(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()), "ranged")
    sums = marked.groupBy("_part").agg(F.sum(value).alias("_total"))
    before = F.sum("_total").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))  # a row for each partition
    starts = sums.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.sum(value).over(W.partitionBy("_part").orderBy("_id"))
    return marked.withColumn("_own", own).join(F.broadcast(starts), "_part").withColumn(name, F.col("_own") + F.col("_before")).drop("_part", "_id", "_own", "_before")


def sequence_numbers(rows: DataFrame, order: list[Column], name: str = "no") -> DataFrame:
    """1..n over a total order: ranges are sorted apart, and counts of the ranges before are added.

    Places are written down with the rows before they are counted, because a second run of the same
    exchange may be cut into other partitions.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = materialise(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()), "ranged")
    first = marked.groupBy("_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))  # a row for each partition
    starts = first.select("_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return marked.join(F.broadcast(starts), "_part").withColumn(name, F.col("_id") - F.col("_first") + F.col("_before") + 1).drop("_part", "_id", "_first", "_before")
