"""Mergeable quantile summaries: stored once per group, merged for any filter, with a stated rank error.

A summary of a group and column holds weighted values whose weights add up to its rows. The rows up to
any value are at least the summary's weight up to it and at most `error` more. Summaries merge by putting their
values together, so the order of merging has no effect; errors add up. Cutting a summary to about
`resolution` values adds one step of ranks to its error. Rows are thus ranked once, when summaries
are built; a question about some categories and bands reads a few hundred values of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.distribution import _hits, _walk, value_counts
from shelfline.schema import MEASURES

RESOLUTION = 200


def _cut(counts: DataFrame, keys: list[str], resolution: int) -> DataFrame:
    """(keys..., n, step, points): of (keys..., value, n), the values at every `resolution`-th part of the ranks.

    A point stands for the ranks behind the one before it, up to its own; `step` is the most that one stands for, less one.
    """
    # Rank j * (total - 1) div resolution is at least r from j = r * resolution / (total - 1) on, rounded up.
    first = f"(below * {resolution} + total - 2) div (total - 1)"
    last = f"least({resolution}, ((below + n) * {resolution} + total - 2) div (total - 1) - 1)"
    low, high = (F.when(F.col("total") > 1, F.expr(e)).otherwise(F.lit(0)).cast("long") for e in (first, last))
    ranks = F.transform(F.sequence(low, high), lambda j: F.call_function("div", j * (F.col("total") - 1), F.lit(resolution)))
    found = _walk(counts, keys, lambda level: level.where(low <= high)).select(
        *keys, "total", F.explode(F.array_distinct(ranks)).alias("i"), "value")
    # At most resolution + 1 points of a group.
    listed = found.groupBy(*keys).agg(F.first("total").alias("n"), F.sort_array(F.collect_list(F.struct("i", "value"))).alias("at"))
    gaps = F.transform("at", lambda x, k: F.struct(
        x["value"].alias("value"), (x["i"] - F.when(k > 0, F.get("at", k - 1)["i"]).otherwise(F.lit(-1).cast("long"))).alias("weight")))
    listed = listed.select(*keys, "n", gaps.alias("points"))
    step = F.greatest(F.array_max(F.transform("points", lambda p: p["weight"])) - 1, F.lit(0))
    return listed.select(*keys, "n", step.alias("step"), "points")


def quantile_summaries(df: DataFrame, columns: list[str] = MEASURES, by: list[str] = (), resolution: int = RESOLUTION) -> DataFrame:
    """(by..., column, n, error, points) from rows; null values and rows with a null key are left out."""
    keys = [*by, "column"]
    return _cut(value_counts(df, columns, by), keys, resolution).select(*keys, "n", F.col("step").alias("error"), "points")


def _together(summaries: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The merged values (keys..., value, n) of all summaries, and the merged errors (keys..., error)."""
    values = (summaries.select(*keys, F.inline("points")).groupBy(*keys, "value").agg(F.sum("weight").alias("n")))
    return values, summaries.groupBy(*keys).agg(F.sum("error").alias("error"))


def merge_summaries(summaries: DataFrame, by: list[str] = (), resolution: int = RESOLUTION) -> DataFrame:
    """Summaries of coarser groups: all that agree in `by` and the column become one, cut to `resolution` again."""
    keys = [*by, "column"]
    values, errors = _together(summaries, keys)
    # One row per group on both sides.
    return _cut(values, keys, resolution).join(errors, keys).select(
        *keys, "n", (F.col("error") + F.col("step")).alias("error"), "points")


def summary_quantiles(summaries: DataFrame, probabilities: list[float], by: list[str] = ()) -> DataFrame:
    """(by..., column, n, error, q): for each probability p, a value whose rank is that of p or less than `error` + 1 below.

    The rank of p among n rows, counted from 0, is p * (n - 1) rounded down. Values are those of rows, not interpolated.
    """
    keys = [*by, "column"]
    values, errors = _together(summaries, keys)
    ranks = F.array(*[F.floor((F.col("total") - 1) * F.lit(float(p))).cast("long") for p in probabilities])
    found = (_walk(values, keys, lambda level: level.where(F.size(_hits(F.array_distinct(ranks))) > 0))
             .select(*keys, "total", F.explode(_hits(F.array_distinct(ranks))).alias("i"), "value"))
    picked = found.groupBy(*keys).agg(F.first("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("i", "value"))).alias("at"))
    return picked.join(errors, keys).select(*keys, F.col("total").alias("n"), "error", F.transform(ranks, lambda i: F.col("at")[i]).alias("q"))
