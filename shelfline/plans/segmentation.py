"""From a cleaned catalog to named segments with their analysis."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from shelfline.operators import segments
from shelfline.schema import PROFILE_FEATURES, SEGMENT_FEATURES
from shelfline.session import materialize


@dataclass(frozen=True)
class Segmentation:
    fit: segments.Fit
    sweep: DataFrame
    products: DataFrame
    tables: dict[str, DataFrame]


def segment_catalog(df: DataFrame, features: list[str] = SEGMENT_FEATURES, ks=range(2, 11), seed: int = 42,
                    sweep_restarts: int = 10, restarts: int = 20, metric: str = "squared_euclidean",
                    k: int | None = None, parallelism: int = 8, margin: float = 0.05) -> Segmentation:
    """Scale, sweep K, choose it, train, assign canonical clusters and analyse them.

    The scaled vectors are written once; every iteration of every fit reads them. `margin` is how much
    better another K's silhouette must be than the elbow's. 0.05 suits the plain metric; squared
    silhouettes are larger and differ more, so give a larger margin with them to keep the elbow as often.
    """
    vectors = materialize(segments.scaled_vectors(df, features), "vectors").cache()
    sweep = segments.sweep_k(vectors, ks, seed, sweep_restarts, metric=metric, parallelism=parallelism)
    if k is None:
        # One row per k.
        k = segments.choose_k([(r["k"], r["inertia"], r["silhouette"]) for r in sweep.collect()], margin)
    fit = segments.train_kmeans(vectors, k, seed, restarts, parallelism=parallelism)
    assigned = materialize(segments.assign_clusters(vectors, fit.model), "segments")
    vectors.unpersist()
    products = assigned.drop("features")
    projection = segments.pca_projection(assigned, features=features)
    tables = {
        "cluster_sizes": segments.cluster_sizes(products),
        "cluster_profiles": segments.cluster_profiles(products, features),
        "pca_scores": projection["scores"],
        "pca_variance": projection["variance"],
        "pca_loadings": projection["loadings"],
        **analyse_segments(products, features),
    }
    return Segmentation(fit, sweep, products, tables)


def analyse_segments(products: DataFrame, features: list[str] = SEGMENT_FEATURES) -> dict[str, DataFrame]:
    """Statistics, interpretation and composition of products that carry a cluster."""
    return {
        "cluster_statistics": segments.cluster_statistics(products),
        "cluster_interpretations": segments.interpret_clusters(products, features),
        "cluster_category": segments.composition(products),
        "cluster_discount_band": segments.band_composition(products),
        "cluster_summary": segments.cluster_summary(products),
        "cluster_dashboard_profile": segments.cluster_profiles(products, PROFILE_FEATURES),
        "cluster_facts": segments.cluster_facts(products, features),
    }
