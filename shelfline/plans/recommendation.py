"""Batch recommendations for every product."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfline.operators.recommend import CANDIDATE_COLUMNS, recommend_all
from shelfline.operators.segments import attach_clusters
from shelfline.schema import RecommendParams
from shelfline.session import materialize
from shelfline.sources.tables import write_recommendations


def batch_recommendations(catalog: DataFrame, clusters: DataFrame | None = None, n: int = 3,
                          params: RecommendParams = RecommendParams()) -> DataFrame:
    """Five strategies for all products. The few columns the rules read are written once."""
    products = catalog if clusters is None else attach_clusters(catalog, clusters)
    slim = materialize(products.select(*CANDIDATE_COLUMNS, "cluster"), "recommend-input")
    return recommend_all(slim, n, p=params)


def save_batch(catalog: DataFrame, path: str, clusters: DataFrame | None = None, n: int = 3) -> None:
    write_recommendations(batch_recommendations(catalog, clusters, n), path)
