"""Row selection: dashboard filters, text search and optional preferences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_catalog(df: DataFrame, categories: list[str] | None = None,
                   price: tuple[float, float] | None = None,
                   discount: tuple[float, float] | None = None) -> DataFrame:
    """Inclusive category, price and discount filters; each applies only when given."""
    if categories is not None:
        df = df.where(F.col("main_category").isin(list(categories)))
    if price is not None:
        df = df.where(F.col("discounted_price").between(*price))
    if discount is not None:
        df = df.where(F.col("discount_percentage").between(*discount))
    return df


def filter_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, low, high): the exact range of each column."""
    return (df.select([F.col(c).cast("double").alias(c) for c in columns])
            .unpivot([], columns, "column", "value")
            .groupBy("column").agg(F.min("value").alias("low"), F.max("value").alias("high")))


def search_products(df: DataFrame, term: str, category: str | None = None,
                    literal: bool = False, column: str = "product_name") -> DataFrame:
    """Case-insensitive search, by regular expression or by literal text; null never matches."""
    if category is not None:
        df = df.where(F.col("main_category") == category)
    if literal:
        return df.where(F.lower(column).contains(term.lower()))
    return df.where(F.col(column).rlike("(?iu)" + term))


def filter_preferences(df: DataFrame, category: str | None = None, max_price: float | None = None,
                       min_rating: float | None = None, min_discount: float | None = None) -> DataFrame:
    if category is not None:
        df = df.where(F.col("main_category") == category)
    if max_price is not None:
        df = df.where(F.col("discounted_price") <= max_price)
    if min_rating is not None:
        df = df.where(F.col("rating") >= min_rating)
    if min_discount is not None:
        df = df.where(F.col("discount_percentage") >= min_discount)
    return df


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def product_details(df: DataFrame, product_id: str, name_length: int = 80) -> DataFrame:
    """Main fields of one product, its name cut to `name_length`; no row for an unknown id."""
    name = F.when(F.length("product_name") > name_length,
                  F.concat(F.substring("product_name", 1, name_length), F.lit("...")))
    cluster = [F.col("cluster")] if "cluster" in df.columns else [F.lit(None).cast("int").alias("cluster")]
    return df.where(F.col("product_id") == product_id).select(
        "product_id", F.coalesce(name, "product_name").alias("product_name"), "main_category",
        "discounted_price", "actual_price", "discount_percentage", "rating", "rating_count", *cluster)
