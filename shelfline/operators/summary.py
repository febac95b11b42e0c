"""Descriptive statistics per column: centre, spread, shape and percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numeric import no_nan
from shelfline.operators.distribution import long_values, modes, quantiles, value_counts
from shelfline.schema import MEASURES

PERCENTILES = [10, 25, 50, 75, 90, 95, 99]


def corrected_skewness(g1: Column, n: Column) -> Column:
    """Bias-corrected skewness from the population value; null below 3 values."""
    n = n.cast("double")
    return F.when(n > 2, no_nan(g1) * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis; null below 3 values, uncorrected at exactly 3."""
    n, g2 = n.cast("double"), no_nan(g2)
    corrected = ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))
    return F.when(n > 3, F.when(g2.isNotNull(), corrected)).when(n == 3, g2)


def moments(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Count, mean, range, sample variance and shape of every column in one shuffle."""
    return long_values(df, columns, by).groupBy(*by, "column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.var_samp("value").alias("variance"), F.stddev_samp("value").alias("std"),
        F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2"))


def _all_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The wanted column names as rows, so that an all-null column keeps its row."""
    return df.sparkSession.createDataFrame([(c,) for c in columns], "column string")


def central_tendency(df: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    counts = value_counts(df, columns)
    mean = moments(df, columns).select("column", F.col("mean").alias("Mean"))
    middle = quantiles(counts, ["column"], [0.5]).select("column", F.col("q")[0].alias("Median"))
    mode = modes(counts, ["column"]).withColumnRenamed("mode", "Mode")
    out = _all_columns(df, columns)
    for part in (mean, middle, mode):
        out = out.join(part, "column", "left")
    return out


def _spread(m: DataFrame) -> list[Column]:
    enough = F.col("count") >= 2
    return [F.when(enough, e).alias(name) for name, e in (
        ("Minimum", F.col("min")), ("Maximum", F.col("max")),
        ("Range", F.col("max") - F.col("min")),
        ("Variance", F.col("variance")), ("Std_Deviation", F.col("std")))]


def _shape() -> list[Column]:
    return [corrected_skewness(F.col("g1"), F.col("count")).alias("Skewness"),
            corrected_kurtosis(F.col("g2"), F.col("count")).alias("Kurtosis")]


def dispersion(df: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    m = moments(df, columns)
    return _all_columns(df, columns).join(m, "column", "left").select("column", *_spread(m))


def distribution_shape(df: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    m = moments(df, columns)
    return _all_columns(df, columns).join(m, "column", "left").select("column", *_shape())


def percentiles(df: DataFrame, columns: list[str] = MEASURES, at: list[int] = PERCENTILES) -> DataFrame:
    q = quantiles(value_counts(df, columns), ["column"], [p / 100 for p in at])
    return _all_columns(df, columns).join(q, "column", "left").select(
        "column", *[F.col("q")[i].alias(f"P{p}") for i, p in enumerate(at)])


def summary_statistics(df: DataFrame, columns: list[str] = MEASURES, at: list[int] = PERCENTILES) -> DataFrame:
    """The seventeen statistics of every column; moments and distribution each need one scan."""
    counts = value_counts(df, columns)
    m = moments(df, columns)
    q = quantiles(counts, ["column"], [0.5, *[p / 100 for p in at]])
    joined = _all_columns(df, columns)
    for part in (m, q, modes(counts, ["column"])):
        joined = joined.join(part, "column", "left")
    return joined.select(
        "column", F.col("mean").alias("Mean"), F.col("q")[0].alias("Median"), F.col("mode").alias("Mode"),
        *_spread(m), *_shape(), *[F.col("q")[i + 1].alias(f"P{p}") for i, p in enumerate(at)])


# The wording of shape interpretations; |x| below 0.5 counts as near zero.
SKEWNESS_WORDS = ("Approximately symmetric", "Right-skewed (positive skew)", "Left-skewed (negative skew)")
KURTOSIS_WORDS = ("Mesokurtic (normal-like)", "Leptokurtic (heavy-tailed, peaked)",
                  "Platykurtic (light-tailed, flat)")


def interpretation(value: Column, words: tuple[str, str, str], near: float = 0.5) -> Column:
    close, above, below = words
    return (F.when(value.isNull() | F.isnan(value), "Undefined")
            .when(F.abs(value) < near, close).when(value > 0, above).otherwise(below))


def shape_labels(df: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    return distribution_shape(df, columns).select(
        "column", "Skewness", "Kurtosis",
        interpretation(F.col("Skewness"), SKEWNESS_WORDS).alias("skewness_label"),
        interpretation(F.col("Kurtosis"), KURTOSIS_WORDS).alias("kurtosis_label"))
