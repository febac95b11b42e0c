"""Grouped statistics, pivots and headline figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numeric import with_scalar
from shelfline.operators.distribution import grouped_quantiles, long_values, quantile_row
from shelfline.schema import BAND_LABELS, MEASURES

STATISTICS = ["mean", "median", "std", "count", "min", "max"]
_SIMPLE = {
    "mean": F.avg, "sum": F.sum, "std": F.stddev_samp, "min": F.min, "max": F.max, "count": F.count,
}


def require_columns(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"column(s) not found: {missing}")


def group_statistics_long(df: DataFrame, key: str, columns: list[str] = MEASURES,
                          statistics: list[str] = STATISTICS) -> DataFrame:
    """(key, column, statistics...): one row per group and column."""
    require_columns(df, [key, *columns])
    simple = [s for s in statistics if s != "median"]
    out = long_values(df, columns, [key]).groupBy(key, "column").agg(
        *[_SIMPLE[s]("value").alias(s) for s in simple])
    if "median" in statistics:
        middle = grouped_quantiles(df, columns, [0.5], [key]).select(
            key, "column", F.col("q")[0].alias("median"))
        out = out.join(middle, [key, "column"])
    return out.select(key, "column", *statistics)


def group_statistics(df: DataFrame, key: str, columns: list[str] = MEASURES,
                     statistics: list[str] = STATISTICS) -> DataFrame:
    """Wide form: one row per group with columns named `column_statistic`."""
    long = group_statistics_long(df, key, columns, statistics)
    cells = [F.max(F.when(F.col("column") == c, F.col(s))).alias(f"{c}_{s}")
             for c in columns for s in statistics]
    wide = long.groupBy(key).agg(*cells)
    counts = [f"{c}_count" for c in columns] if "count" in statistics else []
    # Groups whose every value is null still belong to the report, with zero counts.
    groups = df.where(F.col(key).isNotNull()).select(key).distinct()
    return groups.join(wide, key, "left").fillna(0, counts)


def pivot_cells(df: DataFrame, index: str, columns: str, values: str, aggfunc: str = "mean") -> DataFrame:
    """(index, columns, cell): the pivot in long form, without empty cells."""
    require_columns(df, [index, columns, values])
    keyed = df.where(F.col(index).isNotNull() & F.col(columns).isNotNull())
    if aggfunc == "median":
        return grouped_quantiles(keyed, [values], [0.5], [index, columns]).select(
            index, columns, F.col("q")[0].alias("cell"))
    return keyed.groupBy(index, columns).agg(_SIMPLE[aggfunc](values).alias("cell"))


def pivot(df: DataFrame, index: str, columns: str, values: str, aggfunc: str = "mean",
          headers: list | None = None, fill: float | None = None) -> DataFrame:
    """Wide pivot over known headers; aggregation happens before the cells are spread out.

    Without `headers` the distinct header values are looked up first, as any pivot must.
    """
    cells = pivot_cells(df, index, columns, values, aggfunc)
    spread = cells.groupBy(index).pivot(columns, headers).agg(F.first("cell"))
    return spread if fill is None else spread.fillna(fill, [c for c in spread.columns if c != index])


def band_pivot(df: DataFrame, values: str, aggfunc: str = "mean", fill: float | None = None) -> DataFrame:
    return pivot(df, "main_category", "discount_band", values, aggfunc, BAND_LABELS, fill)


def kpis(df: DataFrame, columns: list[str] = ("discounted_price", "discount_percentage", "rating")) -> DataFrame:
    """One row: products, mean and median of the headline measures, distinct categories, clusters."""
    extra = [F.count_distinct("cluster").alias("clusters")] if "cluster" in df.columns else []
    row = df.agg(F.count(F.lit(1)).alias("products"),
                 *[F.avg(c).alias(f"mean_{c}") for c in columns],
                 F.count_distinct("main_category").alias("categories"), *extra)
    row = with_scalar(row, quantile_row(df, list(columns), [0.5]), "_medians")
    return row.withColumns({f"median_{c}": F.col(f"_medians.{c}")[0] for c in columns}).drop("_medians")


def category_overview(df: DataFrame, key: str = "main_category") -> DataFrame:
    """Product count, mean price and mean rating of each category, largest first."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count("product_id").alias("count"), F.avg("discounted_price").alias("avg_price"),
                 F.avg("rating").alias("avg_rating"))
            .orderBy(F.desc("count"), key))


def category_metric(df: DataFrame, metric: str = "count", key: str = "main_category") -> DataFrame:
    """`count`, or `mean_<column>`, per category."""
    keyed = df.where(F.col(key).isNotNull()).groupBy(key)
    if metric == "count":
        return keyed.agg(F.count(F.lit(1)).alias("count"))
    if not metric.startswith("mean_"):
        raise ValueError(f"unknown metric: {metric}")
    return keyed.agg(F.avg(metric.removeprefix("mean_")).alias(metric))


def category_means(df: DataFrame, columns: list[str] = MEASURES, key: str = "main_category") -> DataFrame:
    """(key, column, mean): chart order is ascending mean within each column."""
    return (long_values(df, columns, [key]).groupBy(key, "column").agg(F.avg("value").alias("mean"))
            .orderBy("column", "mean", key))


def category_counts_ascending(df: DataFrame, key: str = "main_category") -> DataFrame:
    return category_metric(df, "count", key).orderBy("count", key)


def compare_products(df: DataFrame, product_ids: list[str], columns: list[str] = MEASURES,
                     key: str = "product_id") -> DataFrame:
    """(key, column, value) of the chosen products side by side."""
    return long_values(df.where(F.col(key).isin(list(product_ids))), columns, [key])


def category_rollup(df: DataFrame, levels: list[str], measure: str = "discounted_price") -> DataFrame:
    """Counts and means at every prefix of the category path; `grouping_level` 0 is the finest."""
    return df.rollup(*levels).agg(
        F.grouping_id().alias("grouping_bits"), F.count(F.lit(1)).alias("count"),
        F.avg(measure).alias(f"avg_{measure}"))


def union_named(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union of aligned tables with their name as a column."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged)

