"""Named bundles of lazy tables: the statistical report and the chart datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfline.functions.numeric import present
from shelfline.operators import association, charts, grouping, summary
from shelfline.operators.features import add_discount_band
from shelfline.operators.quality import numeric_columns
from shelfline.schema import MEASURES

BAND_KEY = "discount_band"


def statistical_report(df: DataFrame, columns: list[str] = MEASURES, places: int | None = 4) -> dict[str, DataFrame]:
    """Up to seven tables, each present when its columns are. Cache or write `df` first."""
    columns = numeric_columns(df, columns)
    report = {
        "summary": summary.summary_statistics(df, columns),
        "correlation": association.to_matrix(association.correlation(df, columns), columns),
        "covariance": association.to_matrix(association.covariance(df, columns), columns),
    }
    has_category, has_discount = "main_category" in df.columns, "discount_percentage" in df.columns
    if has_category:
        report["group_by_category"] = grouping.group_statistics(df, "main_category", columns)
    if has_discount:
        banded = add_discount_band(df)
        report["group_by_discount_band"] = grouping.group_statistics(banded, BAND_KEY, columns)
        if has_category:
            report["pivot_category_discount"] = grouping.band_pivot(banded, "product_id", "count")
            report["pivot_category_rating"] = grouping.band_pivot(banded, "rating", "mean")
    return report if places is None else {name: present(t, places) for name, t in report.items()}


def chart_data(df: DataFrame, columns: list[str] = MEASURES, category: str = "main_category") -> dict[str, DataFrame]:
    """Every chart dataset by name. One table serves all columns of a chart family."""
    banded = add_discount_band(df)
    pair = charts.pair_plot(df, columns)
    shape = charts.violin(df, "rating", category)
    data = {
        "histograms": charts.histogram(df, [*columns, "price_savings"]),
        "densities": charts.kde(df, [*columns, "price_savings"]),
        "markers": charts.distribution_markers(df, [*columns, "price_savings"]),
        "boxes": charts.box_stats(df, columns),
        "boxes_by_category": charts.box_stats(df, columns, [category]),
        "correlation_heatmap_pearson": association.lower_triangle(df, columns),
        "correlation_heatmap_spearman": association.lower_triangle(df, columns, "spearman"),
        "correlation_with_rating": association.target_correlation(df, "rating", columns),
        "correlation_with_discounted_price": association.target_correlation(df, "discounted_price", columns),
        "category_counts": grouping.category_counts_ascending(df, category),
        "category_means": grouping.category_means(df, columns, category),
        "pivot_counts": grouping.band_pivot(banded, "product_id", "count", fill=0),
        "pair_histograms": pair["diagonal"],
        "pair_bins": pair["pairs"],
        "violin_density": shape["density"],
        "violin_box": shape["box"],
        "cumulative_discount": charts.ecdf(df, "discount_percentage"),
        "cumulative_discount_markers": charts.ecdf_markers(df, "discount_percentage"),
    }
    for value in ("rating", "discounted_price", "discount_percentage"):
        data[f"pivot_mean_{value}"] = grouping.band_pivot(banded, value, "mean")
    for x, y, hue in (("discounted_price", "rating", "discount_percentage"),
                      ("discounted_price", "rating_count", None), ("discount_percentage", "rating", None)):
        data[f"scatter_{y}_vs_{x}"] = charts.scatter_points(df, x, y, hue)
        data[f"scatter_{y}_vs_{x}_correlation"] = charts.scatter_correlation(df, x, y)
    return data


def manifest(tables: dict[str, DataFrame], spark=None) -> DataFrame:
    """(position, name, columns) of a bundle."""
    spark = spark or next(iter(tables.values())).sparkSession
    rows = [(i, name, df.columns) for i, (name, df) in enumerate(tables.items())]
    return spark.createDataFrame(rows, "position int, name string, columns array<string>")

