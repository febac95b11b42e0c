"""Typed parsing, keep-first deduplication and median imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import parsing
from shelfline.functions.numeric import with_scalar
from shelfline.operators.distribution import quantile_row
from shelfline.operators.quality import row_versions
from shelfline.schema import MEASURES

PARSERS = {
    "discounted_price": parsing.parse_price,
    "actual_price": parsing.parse_price,
    "discount_percentage": parsing.parse_percent,
    "rating": parsing.parse_rating,
    "rating_count": parsing.parse_count,
}


# Neighbouring keys share this many bounds when rows are sifted.
SIFT_BOUNDS = 1 << 18


def parse_measures(df: DataFrame, parsers: dict = PARSERS) -> DataFrame:
    """Replace the text measures by doubles; works on streaming input too."""
    return df.withColumns({c: parse(c) for c, parse in parsers.items() if c in df.columns})


def keep_first(df: DataFrame, key: str | list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first by `order`, which must name the file order and its tie-breaks.

    Spark limits each map partition to its own first row per key before the shuffle, so a key that
    owns a large share of the rows sends one row per map task.
    """
    return _foremost(df, key, order, F.row_number())


def keep_ties(df: DataFrame, key: str | list[str], order: list[Column | str]) -> DataFrame:
    """All rows of each key that `order` puts first, equal ones included; limited before the shuffle like `keep_first`.

    A first cut by the order columns that are at hand, so that what is costly is worked out for its rows only.
    """
    return _foremost(df, key, order, F.rank())


def _foremost(df: DataFrame, key: str | list[str], order: list[Column | str], rank: Column) -> DataFrame:
    if not order:
        raise ValueError("keep_first needs an explicit order; a Spark DataFrame has no file order")
    keys = [key] if isinstance(key, str) else key
    asc = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order]
    return df.withColumn("_first", rank.over(Window.partitionBy(*keys).orderBy(*asc))).where("_first = 1").drop("_first")


def sift_first(df: DataFrame, key: str, order: str, bounds: int = SIFT_BOUNDS) -> DataFrame:
    """`df` without most of the rows that `keep_ties` by the whole numbers `key` and `order` drops; all that it keeps are left.

    The least order of each key comes from a hash aggregate, which sorts nothing and shuffles two numbers a key. The range of
    keys is cut into at most `bounds` parts, and a row stays if its order is not above the largest least order of the keys of
    its part. So only bounds are broadcast at any table size, and a sort of what is left has few rows of a key. Reads `df` three times.
    """
    last = F.lit((1 << 63) - 1)
    ends = df.agg(F.struct(F.min(key).cast("double").alias("low"), F.max(key).cast("double").alias("high")))

    def parted(rows: DataFrame) -> DataFrame:
        # A null key has the part -1. Neither rounding nor equal ends take a key to two parts.
        share = (F.col(key).cast("double") - F.col("_ends.low")) / (F.col("_ends.high") - F.col("_ends.low") + 1.0)
        return with_scalar(rows, ends, "_ends").withColumn("_part", F.coalesce(F.floor(share * bounds), F.lit(-1))).drop("_ends")

    # Nulls come last, so a key without any order keeps all rows.
    least = df.groupBy(key).agg(F.min(order).alias("_least"))
    bound = parted(least).groupBy("_part").agg(F.max(F.coalesce("_least", last)).alias("_bound"))
    kept = parted(df).join(F.broadcast(bound), "_part").where(F.coalesce(order, last) <= F.col("_bound"))
    return kept.select(*df.columns)


def with_file_order(df: DataFrame, name: str = "file_order") -> DataFrame:
    """Opt-in order column from the split layout; prefer an order column of the source."""
    return df.withColumn(name, F.monotonically_increasing_id())


def duplicate_removal(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """One row: rows before, exact copies removed, repeated keys removed, rows after."""
    per_key = row_versions(df, key, columns).groupBy(key).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("versions"))
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("original_rows"),
        F.coalesce(F.sum(F.col("rows") - F.col("versions")), F.lit(0)).alias("removed_exact"),
        F.coalesce(F.sum(F.col("versions") - 1), F.lit(0)).alias("removed_repeated_ids"),
        F.count(F.lit(1)).alias("final_rows"),
    )


def impute_median(df: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    """Fill nulls by the exact interpolated median of each column."""
    out = with_scalar(df, quantile_row(df, columns, [0.5]), "_medians")
    return out.withColumns({c: F.coalesce(c, F.col(f"_medians.{c}")[0]) for c in columns}).drop("_medians")
