"""Category levels, engineered features and discount bands as plain projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import parsing
from shelfline.functions.numeric import band_ordinal, no_nan, right_closed_band
from shelfline.schema import BAND_FLOOR, BAND_LABELS, DISCOUNT_BANDS, LEVELS, FeatureThresholds


def add_category_levels(df: DataFrame, path: str = "category", levels: list[str] = LEVELS) -> DataFrame:
    """Split a `|` path into named levels plus its depth; deeper levels count in the depth only."""
    parts = parsing.path_levels(path)
    named = {name: F.get(parts, F.lit(i)) for i, name in enumerate(levels)}
    return df.withColumns({**named, "category_depth": parsing.path_depth(path)})


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def add_features(df: DataFrame, t: FeatureThresholds = FeatureThresholds()) -> DataFrame:
    """The twelve engineered columns of a cleaned catalog."""
    price, actual = F.col("discounted_price"), F.col("actual_price")
    discount, rating, reviews = F.col("discount_percentage"), F.col("rating"), F.col("rating_count")
    return df.withColumns({
        "price_savings": actual - price,
        "discount_depth": discount / 100.0,
        "price_ratio": F.try_divide(price, actual),
        "has_high_rating": _flag(rating >= t.high_rating),
        "is_heavily_discounted": _flag(discount >= t.heavy_discount),
        "is_budget": _flag(price <= t.budget_price),
        "is_premium": _flag(price >= t.premium_price),
        "log_rating_count": no_nan(F.log1p(reviews)),
        "log_discounted_price": no_nan(F.log1p(price)),
        "log_actual_price": no_nan(F.log1p(actual)),
        "review_count_parsed": parsing.list_size("review_id"),
        "avg_review_length": parsing.mean_part_length("review_content"),
    })


def add_bullet_count(df: DataFrame, column: str = "about_product", sep: str = r"\|", name: str = "bullet_count") -> DataFrame:
    """How many of the delimited points of a product text say something; 0 for blank or missing text."""
    points = F.filter(F.split(F.coalesce(F.col(column), F.lit("")), sep, -1), lambda p: parsing.strip(p) != "")
    return df.withColumn(name, F.size(points))


def add_discount_band(df: DataFrame, column: str = "discount_percentage",
                      floor: float = BAND_FLOOR, bands: list = DISCOUNT_BANDS) -> DataFrame:
    """Band label and its ordinal; other edges give bands of any other measure."""
    labels = [label for _, label in bands]
    return df.withColumn("discount_band", right_closed_band(F.col(column), floor, bands)).withColumn(
        "discount_band_ord", band_ordinal(F.col("discount_band"), labels))


__all__ = ["add_bullet_count", "add_category_levels", "add_features", "add_discount_band", "BAND_LABELS"]
