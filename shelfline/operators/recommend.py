"""Product-to-product rules, the preference ranker and batch recommendations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.numeric import sized_join, with_scalar
from shelfline.operators.filters import filter_preferences
from shelfline.operators.interval_topk import Order, best_per_key, interval_topk
from shelfline.schema import STRATEGIES, RankingWeights, RecommendParams

BY_RATING_AND_REVIEWS = Order((("rating", True), ("rating_count", True)))
BY_RATING = Order((("rating", True),))
BY_VALUE = Order((("value_score", True),))
BY_RATING_THEN_CHEAP = Order((("rating", True), ("discounted_price", False)))

CANDIDATE_COLUMNS = ["product_id", "main_category", "discounted_price", "rating", "rating_count"]


def _unpack(matched: DataFrame, k: int, keep: Column | None = None, exclude_same: bool = True) -> DataFrame:
    """One row per target and candidate from its `best` array: self removed, ranked 1..k.

    `keep` further limits candidates by a condition that never removes one before another it keeps.
    """
    own = F.col("product_id")
    best = F.col("best")
    if exclude_same:
        best = F.filter(best, lambda c: c["product_id"] != own)
    return (matched.select(own, F.col("rating").alias("target_rating"),
                           F.posexplode(F.slice(best, 1, k)).alias("pos", "c"))
            .where(keep if keep is not None else F.lit(True))
            .select("product_id", F.col("c.product_id").alias("recommended_product_id"),
                    (F.col("pos") + 1).alias("rank"),
                    F.col("c.discounted_price").alias("recommended_price"),
                    F.col("c.rating").alias("recommended_rating"),
                    F.col("c.main_category").alias("recommended_category")))


def _chosen(products: DataFrame, targets: DataFrame | None) -> DataFrame:
    """Rows to recommend for: all products, or those whose id is in `targets`."""
    return products if targets is None else products.join(targets.select("product_id").distinct(), "product_id")


def _same_key(products: DataFrame, key: str, n: int, targets: DataFrame | None,
              exclude_same: bool = True) -> DataFrame:
    """Best n of the same key; one spare candidate makes room for the target itself."""
    candidates = products.where(F.col(key).isNotNull()).select(*dict.fromkeys([*CANDIDATE_COLUMNS, key]))
    best = best_per_key(candidates, [key], BY_RATING_AND_REVIEWS, n + 1)
    matched = sized_join(_chosen(products, targets), best, [key], ["product_id"])
    return _unpack(matched, n, exclude_same=exclude_same)


def _in_interval(products: DataFrame, keys: list[str], order: Order, low: Column, high: Column, n: int,
                 targets: DataFrame | None, candidates: DataFrame | None = None,
                 keep: Column | None = None) -> DataFrame:
    pool = (products if candidates is None else candidates)
    pool = pool.select(*dict.fromkeys([*CANDIDATE_COLUMNS, *keys, *[c for c, _ in order.by]]))
    chosen = _chosen(products, targets).where(F.col("discounted_price").isNotNull())
    counts = chosen.groupBy(*keys, F.col("discounted_price").alias("target_price")).agg(F.count(F.lit(1)).alias("_n"))
    for key in keys:
        counts = counts.where(F.col(key).isNotNull())
    asked = counts.select(*keys, "target_price", low.alias("low"), high.alias("high"))
    best = interval_topk(pool, asked, keys, order, n + 1)
    matched = chosen.select(*dict.fromkeys(["product_id", "rating", *keys]), F.col("discounted_price").alias("target_price"))
    return _unpack(sized_join(matched, best, [*keys, "target_price"], ["product_id"], sizes=counts), n, keep)


def _times(factor: float) -> Column:
    return F.col("target_price") * factor


def _open_end() -> Column:
    return F.lit(None).cast("double")


def by_cluster(products: DataFrame, n: int = 5, targets: DataFrame | None = None,
               exclude_same: bool = True) -> DataFrame:
    """Best rated of the same cluster; a null cluster matches nothing."""
    return _same_key(products, "cluster", n, targets, exclude_same)


def by_category(products: DataFrame, n: int = 5, targets: DataFrame | None = None) -> DataFrame:
    return _same_key(products, "main_category", n, targets)


def by_price_range(products: DataFrame, n: int = 5, targets: DataFrame | None = None,
                   p: RecommendParams = RecommendParams()) -> DataFrame:
    """Best rated of any category within a share of the target price."""
    return _in_interval(products, [], BY_RATING, _times(1 - p.price_tolerance), _times(1 + p.price_tolerance),
                        n, targets)


def better_rated(products: DataFrame, n: int = 5, targets: DataFrame | None = None,
                 p: RecommendParams = RecommendParams()) -> DataFrame:
    """Higher rated in the same category around the target price.

    The rating floor keeps a prefix of the rating order, so it applies after the interval search.
    """
    keep = F.col("c.rating") >= F.col("target_rating") + p.better_rating_by
    return _in_interval(products, ["main_category"], BY_RATING_AND_REVIEWS, _times(p.better_price_low),
                        _times(p.better_price_high), n, targets, keep=keep)


def budget_alternatives(products: DataFrame, n: int = 5, targets: DataFrame | None = None,
                        p: RecommendParams = RecommendParams()) -> DataFrame:
    """Cheaper and decently rated in the same category, by rating per price."""
    pool = products.where(F.col("rating") >= p.budget_min_rating).withColumn(
        "value_score", F.try_divide(F.col("rating"), F.col("discounted_price") + 1))
    return _in_interval(products, ["main_category"], BY_VALUE, _open_end(), _times(p.budget_ratio), n, targets, pool)


def premium_upgrades(products: DataFrame, n: int = 5, targets: DataFrame | None = None,
                     p: RecommendParams = RecommendParams()) -> DataFrame:
    """Well rated and dearer in the same category, best rated and then cheapest first."""
    pool = products.where(F.col("rating") >= p.premium_min_rating)
    return _in_interval(products, ["main_category"], BY_RATING_THEN_CHEAP, _times(p.premium_ratio), _open_end(),
                        n, targets, pool)


def better_rated_nearby(products: DataFrame, n: int = 5, targets: DataFrame | None = None, share: float = 0.2) -> DataFrame:
    """Rated higher than the target, in the same category, within `share` of its price either way."""
    keep = F.col("c.rating") > F.col("target_rating")
    return _in_interval(products, ["main_category"], BY_RATING_AND_REVIEWS, _times(1 - share), _times(1 + share), n, targets, keep=keep)


def value_picks(products: DataFrame, n: int = 5, key: str = "main_category", min_discount: float = 50.0,
                min_rating: float = 4.0) -> DataFrame:
    """(key, rank, product_id, ...): the n best products of each `key` that are both heavily discounted and well rated.

    By falling discount, then rating, then number of ratings, then id. Rows without a key aren't ranked.
    """
    good = products.where(F.col(key).isNotNull() & (F.col("discount_percentage") >= min_discount) & (F.col("rating") >= min_rating))
    order = [F.desc("discount_percentage"), F.desc("rating"), F.desc_nulls_last("rating_count"), F.asc("product_id")]
    ranked = good.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= n)
    return ranked.select(key, "rank", "product_id", "discounted_price", "discount_percentage", "rating", "rating_count")


def hybrid(products: DataFrame, n: int = 5, targets: DataFrame | None = None,
           p: RecommendParams = RecommendParams()) -> dict[str, DataFrame]:
    """The five strategies by name, in priority order."""
    rules = [by_cluster(products, n, targets), better_rated(products, n, targets, p),
             budget_alternatives(products, n, targets, p), premium_upgrades(products, n, targets, p),
             by_price_range(products, n, targets, p)]
    return dict(zip(STRATEGIES, rules))


def recommend_all(products: DataFrame, n: int = 3, targets: DataFrame | None = None,
                  p: RecommendParams = RecommendParams()) -> DataFrame:
    """Every strategy for every product, tagged and unioned; one pair may come from several."""
    tagged = [df.withColumn("strategy", F.lit(name)) for name, df in hybrid(products, n, targets, p).items()]
    return reduce(DataFrame.unionByName, tagged).select(
        "product_id", "recommended_product_id", "strategy", "rank", "recommended_price",
        "recommended_rating", "recommended_category")


def combined(recommendations: DataFrame, strategies: list[str] = STRATEGIES) -> DataFrame:
    """Each recommended product once per target, under its strategy of highest priority."""
    priority = F.array_position(F.array(*[F.lit(s) for s in strategies]), F.col("strategy"))
    # A row number would be limited before the shuffle too, by a sort in each task that drops nothing, as a task has one strategy.
    before = F.lag(F.lit(True)).over(Window.partitionBy("product_id", "recommended_product_id").orderBy(priority))
    return recommendations.withColumn("_before", before).where("_before is null").drop("_before")


def recommend_for(products: DataFrame, product_id: str, n: int = 5,
                  p: RecommendParams = RecommendParams()) -> DataFrame:
    """All strategies for one product, each as one filtered top-n scan; no rows for an unknown id."""
    fields = ["product_id", "cluster", "main_category", "discounted_price", "rating"]
    one = products.where(F.col("product_id") == product_id).agg(F.first(F.struct(*fields)).alias("t"))
    others = with_scalar(products.where(F.col("product_id") != product_id), one, "t")
    price, target = F.col("discounted_price"), F.col("t.discounted_price")
    same_category = F.col("main_category") == F.col("t.main_category")
    rules = {
        "cluster_based": (F.col("cluster") == F.col("t.cluster"), BY_RATING_AND_REVIEWS),
        "category_better_rated": (
            same_category & (F.col("rating") >= F.col("t.rating") + p.better_rating_by)
            & price.between(target * p.better_price_low, target * p.better_price_high), BY_RATING_AND_REVIEWS),
        "budget_alternative": (
            same_category & (F.col("rating") >= p.budget_min_rating) & (price <= target * p.budget_ratio), BY_VALUE),
        "premium_upgrade": (
            same_category & (F.col("rating") >= p.premium_min_rating) & (price >= target * p.premium_ratio),
            BY_RATING_THEN_CHEAP),
        "price_range": (price.between(target * (1 - p.price_tolerance), target * (1 + p.price_tolerance)), BY_RATING),
    }
    # At most n rows per strategy are left to number.
    rank = F.row_number().over(Window.orderBy("sort"))
    parts = []
    for strategy in STRATEGIES:
        condition, order = rules[strategy]
        scored = others.where(condition).withColumn("value_score", F.try_divide(F.col("rating"), price + 1))
        best = scored.select(
            F.lit(product_id).alias("product_id"), F.col("product_id").alias("recommended_product_id"),
            F.lit(strategy).alias("strategy"), price.alias("recommended_price"),
            F.col("rating").alias("recommended_rating"), F.col("main_category").alias("recommended_category"),
            order.struct().alias("sort")).orderBy(*order.fields()).limit(n)
        parts.append(best.withColumn("rank", rank).drop("sort"))
    return reduce(DataFrame.unionByName, parts).select(
        "product_id", "recommended_product_id", "strategy", "rank", "recommended_price",
        "recommended_rating", "recommended_category")


def _positive(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool) and value > 0


def _check_preferences(products: DataFrame, category, max_price, min_rating, min_discount, n) -> None:
    def within(value, top: float) -> bool:
        return isinstance(value, (int, float)) and 0 <= value <= top
    if max_price is not None and not _positive(max_price):
        raise ValueError(f"a price limit above zero is needed, not {max_price!r}")
    if min_rating is not None and not within(min_rating, 5):
        raise ValueError(f"ratings go from 0 to 5, so none is at least {min_rating!r}")
    if min_discount is not None and not within(min_discount, 100):
        raise ValueError(f"discounts go from 0 to 100 percent, so none is at least {min_discount!r}")
    if not isinstance(n, int) or n <= 0:
        raise ValueError(f"the number of results is a whole number above zero, not {n!r}")
    if category is not None and products.where(F.col("main_category") == category).limit(1).isEmpty():
        raise ValueError(f"unknown category: {category!r}")


def by_preferences(products: DataFrame, category: str | None = None, max_price: float | None = None,
                   min_rating: float | None = None, min_discount: float | None = None, n: int = 10,
                   use_cluster_boost: bool = True, weights: RankingWeights = RankingWeights()) -> DataFrame:
    """Top n products under optional limits, by a weighted score over the products that qualify."""
    _check_preferences(products, category, max_price, min_rating, min_discount, n)
    pool = filter_preferences(products, category, max_price, min_rating, min_discount)
    reviews = F.log1p("rating_count")
    parts = {"rating": F.col("rating"), "reviews": reviews, "discount": F.col("discount_percentage")}
    ranges = pool.agg(F.struct(*[
        F.struct(F.min(e).alias("low"), F.max(e).alias("high")).alias(c) for c, e in parts.items()
    ]).alias("ranges"))
    pool = with_scalar(pool, ranges, "_ranges")

    def scaled(name: str) -> Column:
        low, high = F.col(f"_ranges.{name}.low"), F.col(f"_ranges.{name}.high")
        return (parts[name] - low) / (high - low + 1e-6)

    boost = F.lit(0.0)
    if use_cluster_boost and "cluster" in products.columns:
        for cluster, value in weights.boosts.items():
            boost = F.when(F.col("cluster") == cluster, value).otherwise(boost)
    score = (weights.rating * scaled("rating") + weights.reviews * scaled("reviews")
             + weights.discount * scaled("discount") + weights.segment * boost)
    cluster = ["cluster"] if "cluster" in products.columns else []
    fields = ["product_id", "product_name", "main_category", "actual_price", "discounted_price",
              "discount_percentage", "rating", "rating_count", *cluster]
    best = pool.select(*fields, score.alias("composite_score")).orderBy(
        F.desc_nulls_last("composite_score"), "product_id").limit(n)
    # At most n rows are left to number.
    position = F.row_number().over(Window.orderBy(F.desc_nulls_last("composite_score"), "product_id"))
    return best.withColumn("rank", position)


def sample_per_cluster(products: DataFrame, seed: int = 42, n: int = 1) -> DataFrame:
    """n products per cluster, chosen by a seeded hash of the id and so repeatable."""
    position = F.row_number().over(
        Window.partitionBy("cluster").orderBy(
            F.md5(F.concat(F.col("product_id").cast("string"), F.lit(str(seed)))), "product_id"))
    return products.where(F.col("cluster").isNotNull()).withColumn("_n", position).where(
        F.col("_n") <= n).drop("_n")
