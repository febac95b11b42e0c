"""Every operator as a query over the given tables; `catalog_oracles` holds the matching SQL."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators import association as assoc
from shelfline.functions.numeric import present
from shelfline.operators import charts, cleaning, features, filters, grouping, quality, recommend, segments, summary
from shelfline.plans import report, segmentation
from shelfline.plans.catalog import deduplicate, finish_catalog
from shelfline.schema import ALL_MEASURES, BAND_LABELS, LEVELS, MEASURES, SEGMENT_FEATURES
from shelfline.session import materialize, shared_folder
from shelfline.sources import tables
from shelfline.sources.listings import LISTING_ORDER, read_first_listings, read_listings

_prepared: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that later stages start from, written once per session and folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _prepared:
        _prepared[key] = materialize(build(), name)
    return _prepared[key]


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return read_listings(spark, folder)


def unique_products(spark: SparkSession, folder: str) -> DataFrame:
    return _once(spark, folder, "unique", lambda: deduplicate(read_first_listings(spark, folder), LISTING_ORDER))


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _once(spark, folder, "catalog", lambda: finish_catalog(unique_products(spark, folder)))


def banded(spark: SparkSession, folder: str) -> DataFrame:
    return features.add_discount_band(products(spark, folder))


def clustered(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog with a cluster rule that SQL can repeat, in place of K-Means."""
    return products(spark, folder).withColumn(
        "cluster", F.when(F.col("discounted_price") >= 30000, 2)
        .when(F.col("discount_percentage") >= 50, 1).otherwise(0))


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Six places: means of cents over a few thousand rows then have no ties to round."""
    return df.select([F.round(f.name, places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                      else F.col(f.name) for f in df.schema.fields])


def _scaled_example(spark: SparkSession, folder: str) -> DataFrame:
    columns = [c + "_z" for c in SEGMENT_FEATURES]
    scaled = segments.zscore(segments.select_features(clustered(spark, folder)), SEGMENT_FEATURES)
    return scaled.select("product_id", "cluster", *columns)


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return _once(spark, folder, "vectors", lambda: segments.scaled_vectors(products(spark, folder)).select(
        "product_id", "main_category", "discounted_price", "features"))


def _kmeans_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The inertia a product, and facts that hold for any right clustering: every row is with its nearest centre, centres
    are means, ids go by size."""
    vectors = _vectors(spark, folder).cache()
    fit = segments.train_kmeans(vectors, 3, restarts=20, tol=0.0)
    vectors.unpersist()
    centres = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in fit.model.clusterCenters()])
    placed = fit.model.transform(vectors).withColumn("p", vector_to_array("features"))
    gaps = F.transform(centres, lambda c: F.aggregate(
        F.zip_with("p", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    rows = placed.withColumn("gaps", gaps)
    width = len(SEGMENT_FEATURES)
    means = rows.groupBy("cluster").agg(F.array(*[F.avg(F.col("p")[i]) for i in range(width)]).alias("mean"))
    drift = means.select(F.array_max(F.zip_with("mean", centres[F.col("cluster")], lambda a, b: F.abs(a - b))).alias("d"))
    sizes = segments.assign_clusters(vectors, fit.model).groupBy("cluster").count()
    by_size = sizes.agg(F.sort_array(F.collect_list(F.struct("cluster", "count"))).alias("s")).select(
        F.aggregate(F.slice("s", 1, 10), F.struct(F.lit(True).alias("ok"), F.lit(1 << 62).alias("last")),
                    lambda a, x: F.struct((a["ok"] & (x["count"] <= a["last"])).alias("ok"), x["count"].alias("last")))["ok"])
    own = F.col("gaps")[F.col("cluster")]
    facts = rows.agg(F.count("*").alias("rows"), F.count_if(own > F.array_min("gaps") + 1e-9).alias("misplaced"),
                     F.round(F.sum(own) / F.count("*"), 2).alias("inertia"), (F.abs(F.sum(own) / fit.cost - 1) < 1e-9).alias("cost_agrees"))
    return facts.select("*", (drift.agg(F.max("d")).scalar() < 1e-9).alias("centres_are_means"),
                        by_size.scalar().alias("ids_by_size"))


#: Up to this K the sweep's inertia is compared; beyond it, restarts end in optima that differ in the digits compared.
COMPARED_K = 4


def _sweep(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each k, the inertia a product of the smaller ones, and facts of a sweep: inertia does not rise by
    more than a hundredth, silhouettes are in range."""
    vectors = _vectors(spark, folder).select("features").cache()
    table = segments.elbow_table(segments.sweep_k(vectors))
    n = vectors.count()
    vectors.unpersist()
    before = F.lag("inertia").over(Window.orderBy("k"))
    return table.select("k", "metric", F.when(F.col("k") <= COMPARED_K, F.round(F.col("inertia") / n, 2)).alias("inertia"),
                        F.coalesce(F.col("inertia") <= before * 1.01, F.lit(True)).alias("falls"),
                        F.col("silhouette").between(-1, 1).alias("in_range"),
                        (F.col("bend").isNull() == F.col("k").isin(2, 10)).alias("bend_inside"))


def _whole_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    """The plan from catalog to analysed segments: its tables, products and inertia a product."""
    result = segmentation.segment_catalog(products(spark, folder), ks=range(2, 5), sweep_restarts=2, k=3)
    sizes = result.tables["cluster_sizes"].agg(F.sum("size").alias("products"), F.count("*").alias("clusters"))
    return sizes.select("products", "clusters", F.lit(len(result.tables)).alias("tables"),
                        F.round(F.lit(result.fit.cost) / F.col("products"), 2).alias("inertia"))


def _pipeline_silhouette(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluator that sweeps use, on the stand-in clusters."""
    rows = segments.scaled_vectors(clustered(spark, folder)).select("features", F.col("cluster").cast("int").alias("cluster"))
    return spark.createDataFrame([(segments.silhouette(rows),)], "silhouette double")


def _segment_plan(spark: SparkSession, folder: str) -> DataFrame:
    return _digests(segmentation.analyse_segments(clustered(spark, folder)))


def _digests(bundle: dict[str, DataFrame]) -> DataFrame:
    """(name, rows, cells, total): for every table of a bundle its rows, its known numbers, and a sum over all of them.

    The sum is of signed logarithms, so that small and large numbers count alike, and free of any order.
    """
    parts = []
    for name, df in bundle.items():
        numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
        values = [F.round(F.col(f"`{c}`").cast("double"), 6) for c in numbers]
        total = sum((F.coalesce(F.sum(F.signum(v) * F.ln(1 + F.abs(v))), F.lit(0.0)) for v in values), F.lit(0.0))
        parts.append(df.agg(F.count("*").alias("rows"), sum((F.count(v) for v in values), F.lit(0)).alias("cells"),
                            F.round(total, 3).alias("total")).select(F.lit(name).alias("name"), "rows", "cells", "total"))
    return functools.reduce(DataFrame.unionByName, parts)


def _outlier_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Outliers by their rounded value: differences of prices may differ in the last digit of a double only."""
    return rounded(charts.outliers(df, columns, ["main_category"])).groupBy("main_category", "column", "value").agg(F.sum("n").alias("n"))


def _round_trip(write: Callable, read: Callable) -> Callable:
    """A query that writes its table to a fresh folder and returns what is read back."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = f"{shared_folder(spark)}/round-trip-{uuid.uuid4().hex}"
        write(spark, folder, path)
        return read(spark, folder, path)
    return query


def _write_listing_files(spark: SparkSession, folder: str, path: str) -> None:
    text = listings(spark, folder)
    text.select(*sorted(text.columns, reverse=True), F.lit("more").alias("extra")).write.option("header", True).option(
        "escape", '"').csv(path)


def _read_listing_files(spark: SparkSession, folder: str, path: str) -> DataFrame:
    names = listings(spark, folder).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return tables.read_raw_catalog(spark, path, schema, multi_line=False).withColumn("listing_ord", F.col("listing_ord").cast("long"))


def _segment_report(spark: SparkSession, folder: str) -> DataFrame:
    interpreted = segments.interpret_clusters(clustered(spark, folder))
    path = f"{shared_folder(spark)}/segment-report-{uuid.uuid4().hex}"
    tables.write_segment_report({"labels": interpreted}, path)
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "characteristics" else f.dataType)
                           for f in interpreted.schema.fields])
    back = tables.read_report(spark, path, {"labels": schema})["labels"]
    return rounded(back.withColumn("characteristics", F.array_join(F.from_json("characteristics", "array<string>"), "; ")))


def _model_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All products placed by a fitted and by the saved and loaded model, scaled by the saved parameters."""
    catalog = products(spark, folder)
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    fit = segments.train_kmeans(_vectors(spark, folder), 3, restarts=1)
    tables.write_model(fit.model, segments.scaling_parameters(catalog), path)
    model, parameters = tables.read_model(spark, path)
    first = fit.model.transform(segments.scaled_vectors(catalog)).select("product_id", F.col("cluster").alias("before"))
    second = model.transform(segments.scale_with(catalog, parameters)).select("product_id", "cluster")
    return first.join(second, "product_id").agg(F.count("*").alias("rows"), F.count_if(F.col("before") != F.col("cluster")).alias("moved"))


def _scaled_covariance(df: DataFrame) -> DataFrame:
    """Covariances, also as shares of the deviations: cells of small measures are compared as closely as large ones."""
    cells = assoc.covariance(df)
    own = cells.where(F.col("row") == F.col("col")).select(F.col("row").alias("of"), F.sqrt("value").alias("sd"))
    sides = [own.withColumnsRenamed({"of": side, "sd": f"sd_{side}"}) for side in ("row", "col")]
    return cells.join(sides[0], "row").join(sides[1], "col").select(
        "row", "col", F.round("value", 0).alias("value"), (F.col("value") / F.col("sd_row") / F.col("sd_col")).alias("scaled"))


def _digits(df: DataFrame, *names: str) -> DataFrame:
    """Eight significant digits as text."""
    return df.withColumns({n: F.format_string("%.7e", n) for n in names})


def _accented_search(spark: SparkSession, folder: str) -> DataFrame:
    named = products(spark, folder).withColumn("product_name", F.concat("product_name", F.when(
        F.col("is_heavily_discounted"), " GRÖSSE ÉTÉ").otherwise(" größe etc")))
    return filters.search_products(named, "ing größe|RED.*été$").select("product_id", "product_name")


def _marketplace_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of all parts and of all suppliers, which share no id with products."""
    part = spark.read.parquet(f"{folder}/part.parquet").select(F.concat(F.lit("P"), "p_partkey").alias("product_id"))
    supplier = spark.read.parquet(f"{folder}/supplier.parquet").select(F.concat(F.lit("S"), "s_suppkey").alias("product_id"))
    return segments.attach_clusters(part.union(supplier), clustered(spark, folder).select("product_id", "cluster"))


def _gappy_features(spark: SparkSession, folder: str) -> DataFrame:
    """Filled cluster features of products whose ratings and counts may be missing."""
    raw = features.add_features(unique_products(spark, folder))
    return segments.select_features(raw).select("product_id", *SEGMENT_FEATURES)


def _pca(part: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        vectors = segments.scaled_vectors(clustered(spark, folder))
        return rounded(segments.pca_projection(vectors)[part])
    return query


def _search_term(literal: bool):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        term = "RING" if literal else "^(red|blue) .*(ring|bolt)"
        found = filters.search_products(products(spark, folder), term, "ECONOMY", literal)
        return found.select("product_id", "product_name", "main_category")
    return query


def _recommend(rule: Callable, n: int = 3):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(rule(clustered(spark, folder), n), 2)
    return query


def _with_labels(df: DataFrame) -> DataFrame:
    """Lists as text, so that both engines print them alike."""
    listed = lambda c: F.array_join(F.transform(c, lambda e: F.concat(
        e["name"], F.lit("="), F.format_number(e["pct"], 2))), "; ")
    return df.withColumns({"categories": listed("categories"), "bands": listed("bands")})


def _filtered(spark: SparkSession, folder: str) -> DataFrame:
    return filters.filter_catalog(banded(spark, folder), ["ECONOMY", "PROMO", "SMALL"], (1000.0, 60000.0), (10.0, 80.0))


def _on(source: Callable, operator: Callable, places: int = 6):
    return lambda spark, folder: rounded(operator(source(spark, folder)), places)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # Sources, parsing, cleaning
    "listings_text": lambda s, d: listings(s, d),
    "parse_listings": _on(listings, lambda df: cleaning.parse_measures(df).select("product_id", "listing_ord", *MEASURES)),
    "parse_clean": _on(listings, lambda df: deduplicate(df, LISTING_ORDER).select("product_id", "product_name", "listing_ord", *MEASURES)),
    "duplicate_removal": _on(listings, lambda df: cleaning.duplicate_removal(df, "product_id")),
    "impute_median": _on(unique_products, lambda df: cleaning.impute_median(df).select("product_id", *MEASURES)),
    "clean_catalog": _on(products, lambda df: df.select("product_id", "product_name", *MEASURES, *LEVELS, "category_depth", "price_savings", "is_premium", "listing_ord")),
    "category_levels": _on(listings, lambda df: features.add_category_levels(df).select("product_id", "listing_ord", *LEVELS, "category_depth")),
    "features": _on(products, lambda df: df.select("product_id", *ALL_MEASURES, "has_high_rating", "is_heavily_discounted", "is_budget", "is_premium")),
    "review_lists": _on(listings, lambda df: features.add_features(cleaning.parse_measures(df)).select("product_id", "listing_ord", "review_count_parsed", "avg_review_length", "price_ratio")),
    "discount_bands": _on(banded, lambda df: df.select("product_id", "discount_percentage", "discount_band", "discount_band_ord")),
    # Quality
    "inspect_shape": _on(listings, lambda df: quality.inspect(df)["shape"]),
    "inspect_head": _on(listings, lambda df: quality.inspect(df, ["listing_ord", "product_id", "actual_price"])["head"]),
    "inspect_tail": _on(listings, lambda df: quality.inspect(df, ["listing_ord", "product_id", "actual_price"])["tail"]),
    "missing_profile": _on(listings, lambda df: quality.missing_values(df).drop("dtype")),
    "missing_after_parse": _on(listings, lambda df: quality.missing_values(cleaning.parse_measures(df), MEASURES, only_missing=True).drop("dtype")),
    "total_missing": _on(listings, lambda df: quality.total_missing(cleaning.parse_measures(df))),
    "duplicate_profile": _on(listings, quality.duplicate_profile),
    "id_count_distribution": _on(listings, quality.id_count_distribution),
    "quality_summary": _on(listings, lambda df: quality.quality_summary(cleaning.parse_measures(df))),
    "category_distinct": _on(products, lambda df: quality.category_profile(df)["distinct"]),
    "category_depths": _on(products, lambda df: quality.category_profile(df)["depth"]),
    "category_top": _on(products, lambda df: quality.category_profile(df)["top"]),
    "feature_profile": _on(products, quality.feature_profile),
    "distinct_values": _on(products, lambda df: filters.distinct_values(df, "sub_category")),
    # Statistics
    "central_tendency": _on(products, summary.central_tendency),
    "dispersion": _on(products, lambda df: _digits(summary.dispersion(df), "Variance")),
    "distribution_labels": _on(products, summary.shape_labels),
    "percentiles": _on(products, summary.percentiles),
    "summary_statistics": _on(products, lambda df: _digits(summary.summary_statistics(df), "Variance")),
    "corr_pearson": _on(products, lambda df: assoc.correlation(df, MEASURES), 6),
    "corr_spearman": _on(products, lambda df: assoc.correlation(df, MEASURES, "spearman"), 6),
    "corr_kendall": _on(products, lambda df: assoc.correlation(df, MEASURES, "kendall"), 6),
    "corr_matrix": _on(products, lambda df: assoc.to_matrix(assoc.correlation(df, MEASURES), MEASURES), 6),
    "corr_spearman_nulls": _on(unique_products, lambda df: assoc.correlation(df, ["rating", "rating_count", "actual_price"], "spearman"), 6),
    "cov_matrix": _on(products, _scaled_covariance),
    "corr_target": _on(products, lambda df: assoc.target_correlation(df, "rating", MEASURES), 6),
    "corr_target_signed": _on(products, lambda df: assoc.target_correlation(df, "rating", signed=True), 6),
    "heatmap_lower": _on(products, lambda df: assoc.lower_triangle(df, MEASURES, "spearman"), 6),
    # Groups and pivots
    "group_by_category": _on(products, lambda df: grouping.group_statistics(df, "main_category")),
    "group_by_band": _on(banded, lambda df: grouping.group_statistics(df, "discount_band")),
    "pivot_count": _on(banded, lambda df: grouping.pivot(df, "level_3", "discount_band", "product_id", "count", BAND_LABELS)),
    "pivot_count_filled": _on(banded, lambda df: grouping.pivot(df, "level_3", "discount_band", "product_id", "count", BAND_LABELS, 0)),
    "pivot_sum": _on(banded, lambda df: grouping.band_pivot(df, "rating_count", "sum")),
    "pivot_min": _on(banded, lambda df: grouping.band_pivot(df, "discounted_price", "min")),
    "pivot_max": _on(banded, lambda df: grouping.band_pivot(df, "discounted_price", "max")),
    "pivot_mean": _on(banded, lambda df: grouping.band_pivot(df, "rating", "mean"), 6),
    "pivot_median": _on(banded, lambda df: grouping.band_pivot(df, "discounted_price", "median")),
    "pivot_cells_std": _on(banded, lambda df: grouping.pivot_cells(df, "main_category", "discount_band", "rating", "std")),
    "kpis": _on(clustered, grouping.kpis),
    "category_overview": _on(products, grouping.category_overview),
    "category_metric": _on(products, lambda df: grouping.category_metric(df, "mean_discount_percentage")),
    "category_means": _on(products, grouping.category_means),
    "category_counts": _on(products, grouping.category_counts_ascending),
    "category_rollup": _on(products, lambda df: grouping.category_rollup(df, LEVELS), 6),
    "compare_products": _on(products, lambda df: grouping.compare_products(df, ["P1", "P20", "P300"])),
    "rating_price_bands": _on(products, lambda df: grouping.pivot_cells(
        features.add_discount_band(df.withColumn("rating_band", F.floor("rating").cast("int")), "discounted_price", 0.0,
                                   [(1000.0, "low"), (10000.0, "middle"), (1e9, "high")]),
        "rating_band", "discount_band", "product_id", "count")),
    # Filters and look-ups
    "filter_catalog": _on(_filtered, lambda df: df.select("product_id", "main_category", "discounted_price", "discount_percentage")),
    "filtered_pivot": _on(_filtered, lambda df: grouping.band_pivot(df, "discounted_price", "mean"), 6),
    "filter_bounds": _on(products, lambda df: filters.filter_bounds(df, MEASURES)),
    "product_search": _search_term(False),
    "product_search_literal": _search_term(True),
    "product_search_accents": _accented_search,
    "filter_preferences": _on(products, lambda df: filters.filter_preferences(df, "SMALL", 40000, 3.5, 20).select("product_id", "discounted_price", "rating")),
    "product_details": _on(clustered, lambda df: filters.product_details(df, "P20", 8)),
    "cluster_lookup": _marketplace_lookup,
    # Charts
    "histogram": _on(products, charts.histogram, 8),
    "distribution_markers": _on(products, charts.distribution_markers),
    "kde": _on(products, lambda df: charts.kde(df, ["discounted_price", "rating"]), 8),
    "box_stats": _on(products, charts.box_stats, 6),
    "box_by_category": _on(products, lambda df: charts.box_stats(df, MEASURES, ["main_category"]), 6),
    "outlier_values": _on(products, lambda df: _outlier_counts(df, ["discounted_price", "price_savings"])),
    "violin_density": _on(products, lambda df: charts.violin(df)["density"], 6),
    "violin_box": _on(products, lambda df: charts.violin(df)["box"], 6),
    "ecdf": _on(products, lambda df: charts.ecdf(df, "discount_percentage")),
    "ecdf_price": _on(products, lambda df: charts.ecdf(df, "discounted_price")),
    "ecdf_markers": _on(products, charts.ecdf_markers),
    "scatter_points": _on(products, lambda df: charts.scatter_points(df, "discounted_price", "rating", "discount_percentage")),
    "scatter_bins": _on(products, lambda df: charts.scatter_bins(df, [("discounted_price", "rating"), ("discount_percentage", "rating")])),
    "scatter_corr": _on(products, lambda df: charts.scatter_correlation(df, "discount_percentage", "discounted_price").drop("p")),
    "scatter_p_value": _on(products, lambda df: charts.scatter_correlation(df, "actual_price", "rating"), 6),
    "pair_histograms": _on(clustered, lambda df: charts.pair_plot(df, MEASURES, 20, "cluster")["diagonal"], 8),
    "pair_bins": _on(clustered, lambda df: charts.pair_plot(df, MEASURES, 20, "cluster")["pairs"]),
    # Segments
    "zscore_features": _on(_scaled_example, lambda df: df, 6),
    "cluster_sizes": _on(clustered, segments.cluster_sizes),
    "cluster_stats": _on(clustered, segments.cluster_statistics),
    "cluster_labels": _on(clustered, lambda df: segments.interpret_clusters(df).withColumn("characteristics", F.array_join("characteristics", "; "))),
    "cluster_profile": _on(clustered, segments.cluster_profiles, 6),
    "cluster_composition": _on(clustered, segments.composition),
    "cluster_bands": _on(clustered, segments.band_composition),
    "cluster_band_matrix": _on(clustered, lambda df: segments.composition_matrix(segments.band_composition(df), "discount_band", BAND_LABELS)),
    "cluster_summary": _on(clustered, segments.cluster_summary),
    "cluster_facts": _on(clustered, lambda df: _with_labels(segments.cluster_facts(df))),
    "canonical_clusters": _on(clustered, lambda df: segments.canonical_clusters(df.select("product_id", "discounted_price", "cluster")).select("product_id", "cluster")),
    "silhouette_squared": _on(_scaled_example, lambda df: segments.silhouette_squared(df, [c + "_z" for c in SEGMENT_FEATURES]), 6),
    "silhouette_euclidean": _on(_scaled_example, lambda df: segments.silhouette_euclidean(
        df.select("cluster", F.array(*[c + "_z" for c in SEGMENT_FEATURES]).alias("features"))), 6),
    "kmeans_segments": _kmeans_segments,
    "k_sweep": _sweep,
    "pca_projection": _pca("scores"),
    "pca_variance": _pca("variance"),
    "pca_loadings": _pca("loadings"),
    "cluster_representatives": _on(_scaled_example, lambda df: segments.mean_representatives(df, [c + "_z" for c in SEGMENT_FEATURES], 3)),
    "silhouette_pipeline": _on(_pipeline_silhouette, lambda df: df, 6),
    "segment_features_filled": _on(_gappy_features, lambda df: df),
    # Sources, sinks and bundles
    "csv_source": _round_trip(_write_listing_files, _read_listing_files),
    "catalog_round_trip": _round_trip(
        lambda s, d, path: tables.write_catalog(products(s, d), path, "csv"),
        lambda s, d, path: rounded(tables.read_catalog(s, path, "csv", products(s, d).schema).select(
            "product_id", "product_name", *MEASURES, *LEVELS, "category_depth", "price_savings", "is_premium", "listing_ord"))),
    "report_round_trip": _round_trip(
        lambda s, d, path: tables.write_report({"bands": grouping.group_statistics(banded(s, d), "discount_band")}, path),
        lambda s, d, path: rounded(tables.read_report(s, path, {
            "bands": grouping.group_statistics(banded(s, d), "discount_band").schema})["bands"])),
    "recommendations_round_trip": _round_trip(
        lambda s, d, path: tables.write_recommendations(recommend.recommend_all(clustered(s, d), 3), path),
        lambda s, d, path: rounded(tables.read_recommendations(s, path), 2)),
    "segments_round_trip": _round_trip(
        lambda s, d, path: tables.write_segments(clustered(s, d), path),
        lambda s, d, path: tables.read_segments(s, path).select("product_id", "cluster")),
    "segment_report_round_trip": _segment_report,
    "model_round_trip": _model_round_trip,
    "report_bundle": _on(products, lambda df: _digests(report.statistical_report(df, places=None))),
    "report_presented": _on(products, lambda df: present(grouping.category_means(df), 2), 2),
    "chart_bundle": _on(products, lambda df: _digests(report.chart_data(df))),
    "segment_bundle": _segment_plan,
    "segment_catalog": _whole_segmentation,
    # Recommendations
    "rec_cluster": _recommend(recommend.by_cluster),
    "rec_category": _recommend(recommend.by_category),
    "rec_price_range": _recommend(recommend.by_price_range),
    "rec_better_rated": _recommend(recommend.better_rated),
    "rec_budget": _recommend(recommend.budget_alternatives),
    "rec_premium": _recommend(recommend.premium_upgrades),
    "rec_all": _recommend(recommend.recommend_all),
    "rec_combined": _recommend(lambda df, n: recommend.combined(recommend.recommend_all(df, n))),
    "rec_one_product": _recommend(lambda df, n: recommend.recommend_for(df, "P20", 5)),
    "rec_preferences": _on(clustered, lambda df: recommend.by_preferences(df, max_price=50000, min_rating=3.0, min_discount=20)),
    "rec_preferences_open": _on(clustered, lambda df: recommend.by_preferences(df, use_cluster_boost=False)),
    "sample_per_cluster": _on(clustered, lambda df: recommend.sample_per_cluster(df).select("product_id", "cluster")),
}
