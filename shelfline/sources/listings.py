"""A messy marketplace catalog seen through order lines: every line is one listing of its part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.cleaning import keep_ties, sift_first

# Order of the listings of one product, on parsed values; the text columns settle what is left.
LISTING_ORDER = ["listing_ord", "actual_price", "discounted_price", "rating", "rating_count",
                 "review_id", "review_content"]


def _ordinal() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def read_listings(spark: SparkSession, folder: str) -> DataFrame:
    return _listed(spark, folder, spark.read.parquet(f"{folder}/lineitem.parquet"))


def read_first_listings(spark: SparkSession, folder: str) -> DataFrame:
    """The listings of each product that can be first in `LISTING_ORDER`: all of its smallest `listing_ord`.

    Every line is read, and they are chosen as numbers, before the part is joined and text is made and parsed again. What is
    sorted for it has few lines of a product.
    """
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    first = keep_ties(sift_first(lines.withColumn("_ord", _ordinal()), "l_partkey", "_ord"), "l_partkey", ["_ord"])
    return _listed(spark, folder, first.drop("_ord"))


def _listed(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    part = spark.read.parquet(f"{folder}/part.parquet").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    pct = F.least(F.round(F.col("l_discount") * 1000).cast("int"), F.lit(95))
    listings = lines.withColumn("pct", pct).join(part, F.col("l_partkey") == F.col("p_partkey"))
    size, money = F.col("p_size") % 3, F.col("l_extendedprice")
    reviews = (F.col("l_orderkey") * F.col("l_linenumber") * 37) % 50021
    return listings.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(size == 0, F.col("p_type"))
         .when(size == 1, F.concat_ws("|", "p_type", "p_brand"))
         .otherwise(F.concat_ws("|", "p_type", "p_brand", "p_name")).alias("category"),
        F.concat(F.lit("₹"), F.format_number(money * (100 - F.col("pct")) / 100, 2)).alias("discounted_price"),
        F.concat(F.lit("₹"), F.format_number(money, 2)).alias("actual_price"),
        F.concat(F.col("pct").cast("string"), F.lit("%")).alias("discount_percentage"),
        F.when(F.col("l_orderkey") % 400 == 7, "|")
         .otherwise(F.round(5 - F.col("l_tax") * 37, 1).cast("string")).alias("rating"),
        F.when(F.col("l_orderkey") % 500 != 0, F.format_number(reviews, 0)).alias("rating_count"),
        F.concat(F.lit("R"), F.col("l_linenumber").cast("string"),
                 F.when(F.col("l_linenumber") > 3,
                        F.concat(F.lit(",R"), F.col("l_orderkey").cast("string"))).otherwise(""))
         .alias("review_id"),
        F.concat("p_name", F.lit(", "), "l_returnflag", F.lit(",,"), "p_brand").alias("review_content"),
        _ordinal().alias("listing_ord"),
    )
