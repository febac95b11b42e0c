import math

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
import catalog_estimates
from catalog_oracles import ORACLES
from catalog_queries import QUERIES, products
from shelfline.operators import filters

TABLES = ["part", "lineitem", "supplier"]
CHECKED = ["parse_clean", "features", "duplicate_profile", "group_by_band", "pivot_count", "summary_statistics",
           "corr_spearman_nulls", "box_by_category", "kde", "cluster_facts", "rec_all", "rec_preferences", "csv_source", "catalog_round_trip",
           "recommendations_round_trip", "pivot_count", "cluster_lookup", "cov_matrix", "product_search_accents", "kmeans_segments",
           "cluster_representatives", "sample_per_cluster", "scatter_p_value", "pca_projection", "pca_variance", "segment_bundle", "report_bundle", *catalog_estimates.QUERIES]


def canonical(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        v = v.item() if hasattr(v, "item") else v
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    rows = [tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def database(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def test_every_catalog_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(catalog_estimates.ORACLES) == set(catalog_estimates.QUERIES) and not set(ORACLES) & set(catalog_estimates.ORACLES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, folder, database, name):
    got = queries()[name](spark, folder).toPandas()
    expected = database.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark, folder):
    kept = filters.filter_catalog(products(spark, folder), ["SMALL"], (100.0, 5000.0)).select("product_id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # The printed plan cuts the list of pushed filters short.
    assert "_category,SMALL), GreaterThan" in plan.split("PushedFilters")[1]
    assert "review_content" not in plan.split("ReadSchema")[1]
