"""Raw text catalog to typed, deduplicated, imputed and feature-engineered catalog."""

from __future__ import annotations

from itertools import takewhile

from pyspark.sql import DataFrame

from shelfline.operators.cleaning import PARSERS, impute_median, keep_first, keep_ties, parse_measures
from shelfline.operators.features import add_category_levels, add_features
from shelfline.schema import MEASURES, FeatureThresholds


def deduplicate(raw: DataFrame, order: list[str], key: str = "product_id") -> DataFrame:
    """Parsed measures, first listing per product.

    `order` may use parsed measures. The columns it names before the first of them choose among the raw rows, so that
    only those tied in first place are parsed.
    """
    plain = list(takewhile(lambda c: isinstance(c, str) and c not in PARSERS, order))
    return keep_first(parse_measures(keep_ties(raw, key, plain) if plain else raw), key, order)


def clean_catalog(raw: DataFrame, order: list[str], key: str = "product_id",
                  thresholds: FeatureThresholds = FeatureThresholds()) -> DataFrame:
    """The whole cleaning plan. Medians are taken over the deduplicated rows.

    The deduplicated rows are read twice, for the medians and for the output; write them with
    `session.materialize` first when the raw input is large.
    """
    return finish_catalog(deduplicate(raw, order, key), thresholds)


def finish_catalog(products: DataFrame, thresholds: FeatureThresholds = FeatureThresholds()) -> DataFrame:
    """Imputation, category levels and features over deduplicated products."""
    return add_features(add_category_levels(impute_median(products, MEASURES)), thresholds)
