"""Column names, table schemas and tunable thresholds of the catalog."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names and lists of the catalog, and the default thresholds and parameters below.
RAW_COLUMNS = [
    "product_id", "product_name", "category", "discounted_price", "actual_price",
    "discount_percentage", "rating", "rating_count", "about_product", "user_id",
    "user_name", "review_id", "review_title", "review_content", "img_link", "product_link",
]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

MEASURES = ["actual_price", "discounted_price", "discount_percentage", "rating", "rating_count"]
DERIVED_MEASURES = [
    "price_savings", "discount_depth", "price_ratio", "category_depth", "log_rating_count",
    "log_discounted_price", "log_actual_price", "review_count_parsed", "avg_review_length",
]
ALL_MEASURES = MEASURES + DERIVED_MEASURES
DASHBOARD_MEASURES = MEASURES + ["price_savings"]
FLAGS = ["has_high_rating", "is_heavily_discounted", "is_budget", "is_premium"]
LEVELS = ["main_category", "sub_category", "level_3", "level_4", "level_5"]

SEGMENT_FEATURES = [
    "discounted_price", "discount_percentage", "rating", "rating_count",
    "log_rating_count", "log_discounted_price",
]
PROFILE_FEATURES = ["discounted_price", "discount_percentage", "rating", "log_rating_count"]
SEGMENT_COLUMNS = [
    "product_id", "product_name", "main_category", "discounted_price", "actual_price",
    "discount_percentage", "rating", "rating_count", "cluster",
]

_double, _int, _str, _bool = T.DoubleType(), T.IntegerType(), T.StringType(), T.BooleanType()

CLEAN_SCHEMA = T.StructType(
    [T.StructField(c, _double if c in MEASURES else _str) for c in RAW_COLUMNS]
    + [T.StructField(c, _str) for c in LEVELS]
    + [T.StructField("category_depth", _int)]
    + [T.StructField(c, _double) for c in ("price_savings", "discount_depth", "price_ratio")]
    + [T.StructField(c, _bool) for c in FLAGS]
    + [T.StructField(c, _double)
       for c in ("log_rating_count", "log_discounted_price", "log_actual_price")]
    + [T.StructField("review_count_parsed", _int), T.StructField("avg_review_length", _double)]
)
SEGMENT_SCHEMA = T.StructType([
    T.StructField(c, _int if c == "cluster" else _double if c in MEASURES else _str)
    for c in SEGMENT_COLUMNS
])
RECOMMENDATION_SCHEMA = T.StructType([
    T.StructField("product_id", _str),
    T.StructField("recommended_product_id", _str),
    T.StructField("strategy", _str),
    T.StructField("rank", _int),
    T.StructField("recommended_price", _double),
    T.StructField("recommended_rating", _double),
    T.StructField("recommended_category", _str),
])

# Discount bands, right-closed, as (upper edge, label); the first opens above -1.
BAND_FLOOR = -1.0
DISCOUNT_BANDS = [
    (10.0, "0-10%"), (30.0, "10-30%"), (50.0, "30-50%"), (70.0, "50-70%"), (100.0, "70-100%"),
]
BAND_LABELS = [label for _, label in DISCOUNT_BANDS]

# Strategies of the product-to-product recommender, highest priority first.
STRATEGIES = [
    "cluster_based", "category_better_rated", "budget_alternative", "premium_upgrade", "price_range",
]

# Display names and ranking boosts of the canonical segments.
SEGMENT_NAMES = {0: "Mainstream", 1: "Budget/Deep-Discount", 2: "Premium"}
SEGMENT_BOOSTS = {0: 0.1, 1: 0.05, 2: 0.0}

# Words of segment labels, (above, below) the average, and market tiers by words of the label, in order.
LABEL_WORDS = {
    "price": ("High-Price", "Low-Price"), "discount": ("High-Discount", "Low-Discount"),
    "rating": ("High-Rating", "Low-Rating"), "popularity": ("Popular", "Niche"),
}
PLAIN_LABEL = "Average"
TIER_WORDS = {
    "mainstream": ("Average", "Mid"), "budget": ("Low-Rating", "Low-Price"), "premium": ("High-Price", "Low-Discount"),
}


@dataclass(frozen=True)
class FeatureThresholds:
    high_rating: float = 4.0
    heavy_discount: float = 50.0
    budget_price: float = 500.0
    premium_price: float = 10000.0


@dataclass(frozen=True)
class LabelThresholds:
    price: float = 0.3
    discount: float = 0.3
    rating: float = 0.15
    popularity: float = 0.3
    notable_pct: float = 20.0


@dataclass(frozen=True)
class RecommendParams:
    price_tolerance: float = 0.3
    better_rating_by: float = 0.2
    better_price_low: float = 0.5
    better_price_high: float = 1.5
    budget_ratio: float = 0.7
    budget_min_rating: float = 3.5
    premium_ratio: float = 1.5
    premium_min_rating: float = 4.0


@dataclass(frozen=True)
class RankingWeights:
    rating: float = 0.4
    reviews: float = 0.3
    discount: float = 0.2
    segment: float = 0.1
    boosts: dict = field(default_factory=lambda: dict(SEGMENT_BOOSTS))
