"""The data behind charts: histograms, densities, box statistics, cumulative curves, scatter bins."""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.inversions import two_sided_p
from shelfline.functions.numeric import no_nan, with_scalar, sized_join
from shelfline.operators.association import pearson
from shelfline.operators.distribution import cumulative, long_values, quantiles, value_counts
from shelfline.schema import MEASURES

# exp(-z*z/2) is zero in doubles beyond 38.6 bandwidths, so a value has nothing to give farther out.
KERNEL_REACH = 39.0


def _ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the lowest and highest value of every column as one struct."""
    def span(c: str) -> Column:
        v = no_nan(F.col(c).cast("double"))
        low, high = F.min(v), F.max(v)
        flat = low == high
        # A constant column gets a unit range around its value.
        return F.struct(F.when(flat, low - 0.5).otherwise(low).alias("low"),
                        F.when(flat, high + 0.5).otherwise(high).alias("high")).alias(c)
    return df.agg(F.struct(*[span(c) for c in columns]).alias("ranges"))


def _bin(column: str, bins: int) -> Column:
    """Equal-width bin of a value within `_ranges`; the last bin includes the upper end."""
    value = no_nan(F.col(column).cast("double"))
    low, high = F.col(f"_ranges.{column}.low"), F.col(f"_ranges.{column}.high")
    return F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, columns: list[str] = MEASURES, bins: int = 50,
              by: list[str] = ()) -> DataFrame:
    """(by..., column, bin, low, high, count, density) with every bin of every column present."""
    ranges = _ranges(df, columns)
    binned = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), _bin(c, bins).alias("bin")) for c in columns]))
    counts = (with_scalar(df.select(*dict.fromkeys([*by, *columns])), ranges, "_ranges").select(*by, binned).where("bin is not null")
              .groupBy(*by, "column", "bin").agg(F.count(F.lit(1)).alias("count")))
    edges = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"ranges.{c}.low").alias("start"),
                 F.col(f"ranges.{c}.high").alias("stop")) for c in columns]))
    frame = ranges.select(edges).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    if by:
        # Only groups that have values are framed; each brings `bins` rows per column.
        groups = counts.groupBy(*by, "column").agg(F.sum("count").alias("total"))
        frame = groups.join(frame, "column")
    else:
        totals = counts.groupBy("column").agg(F.sum("count").alias("total"))
        frame = frame.join(totals, "column")
    width = (F.col("stop") - F.col("start")) / bins
    filled = frame.join(counts, [*by, "column", "bin"], "left").fillna(0, ["count"])
    return filled.select(
        *by, "column", "bin", (F.col("start") + F.col("bin") * width).alias("low"),
        (F.col("start") + (F.col("bin") + 1) * width).alias("high"), "count",
        (F.col("count") / (F.col("total") * width)).alias("density"))


def distribution_markers(df: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    """Mean and median lines of the distribution charts."""
    counts = value_counts(df, columns)
    mean = long_values(df, columns).groupBy("column").agg(F.avg("value").alias("mean"))
    middle = quantiles(counts, ["column"], [0.5]).select("column", F.col("q")[0].alias("median"))
    return mean.join(middle, "column")


def kde(df: DataFrame, columns: list[str] = MEASURES, points: int = 300, by: list[str] = (),
        cut: float = 0.0) -> DataFrame:
    """(by..., column, point, x, density): Gaussian density with Scott's bandwidth.

    Each distinct value adds to the grid points within reach of its kernel, which is exact: farther
    kernels are zero. The reach shrinks with the row count, and sums combine before the shuffle.
    """
    keys = [*by, "column"]
    values = long_values(df, columns, by)
    counts = values.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    h = F.col("std") * F.pow(F.col("total"), -0.2)
    grid = (values.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("total"), F.stddev_samp("value").alias("std"),
                 F.min("value").alias("min"), F.max("value").alias("max"))
            .where("std > 0").withColumn("h", h)
            .select(*keys, "total", "h", (F.col("min") - cut * F.col("h")).alias("start"),
                    ((F.col("max") - F.col("min") + 2 * cut * F.col("h")) / (points - 1)).alias("step")))
    last = F.lit(points - 1)
    x = F.col("start") + F.col("point") * F.col("step")
    low = F.ceil((F.col("value") - KERNEL_REACH * F.col("h") - F.col("start")) / F.col("step"))
    high = F.floor((F.col("value") + KERNEL_REACH * F.col("h") - F.col("start")) / F.col("step"))
    reach = F.sequence(F.greatest(low, F.lit(0)).cast("int"), F.least(high, last).cast("int"), F.lit(1))
    z = (x - F.col("value")) / F.col("h")
    sums = (sized_join(counts, grid, keys, ["value"])
            .where((low <= last) & (high >= 0) & (low <= high))
            .withColumn("point", F.explode(reach))
            .groupBy(*keys, "point").agg(F.sum(F.col("n") * F.exp(-0.5 * z * z)).alias("mass")))
    framed = grid.withColumn("point", F.explode(F.sequence(F.lit(0), last)))
    scale = F.col("total") * F.col("h") * F.lit((2 * 3.141592653589793) ** 0.5)
    return (framed.join(sums, [*keys, "point"], "left").fillna(0.0, ["mass"])
            .select(*keys, "point", x.alias("x"), (F.col("mass") / scale).alias("density")))


def kde_binned(df: DataFrame, columns: list[str] = MEASURES, points: int = 300, by: list[str] = (), cut: float = 0.0,
               finest: int = 64) -> DataFrame:
    """(by..., column, point, x, density) like `kde`, by linear binning and convolution on a grid.

    A value's weight is shared between the two grid points beside it, in proportion to its nearness; then the kernel is
    laid over the grid. After the first aggregate the work depends on the grid alone, whatever the number of distinct
    values. The grid refines the points that are asked for until its step is a tenth of the bandwidth, at most
    `finest` times; the curve is then off by about an eighth of the squared step over the bandwidth, relative to its curvature.
    """
    keys = [*by, "column"]
    values = long_values(df, columns, by)
    h = F.col("std") * F.pow(F.col("total"), -0.2)
    stats = (values.groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("total"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
             .where("std > 0").withColumn("h", h).withColumn("start", F.col("min") - cut * F.col("h"))
             .withColumn("step", (F.col("max") - F.col("min") + 2 * cut * F.col("h")) / (points - 1)))
    refine = F.greatest(F.lit(1), F.least(F.lit(finest), F.ceil(10.0 * F.col("step") / F.col("h")).cast("int")))
    grid = stats.withColumn("refine", refine).withColumn("fine", F.col("step") / F.col("refine")).select(
        *keys, "total", "h", "start", "step", "refine", "fine")
    at = (F.col("value") - F.col("start")) / F.col("fine")
    left = F.least(F.greatest(F.floor(at), F.lit(0)), F.lit(points - 1) * F.col("refine") - 1).cast("int")
    shares = F.inline(F.array(F.struct(F.col("left").alias("bin"), (1.0 - F.col("part")).alias("w")),
                              F.struct((F.col("left") + 1).alias("bin"), F.col("part").alias("w"))))
    placed = sized_join(values, grid, keys, ["value"]).withColumn("left", left).withColumn("part", at - F.col("left"))
    bins = placed.select(*keys, shares).groupBy(*keys, "bin").agg(F.sum("w").alias("w")).where("w > 0")
    # From here on the rows of a key are bounded by its grid.
    last = F.lit(points - 1)
    reach = KERNEL_REACH * F.col("h") / F.col("fine")
    low = F.greatest(F.ceil((F.col("bin") - reach) / F.col("refine")), F.lit(0)).cast("int")
    high = F.least(F.floor((F.col("bin") + reach) / F.col("refine")), last).cast("int")
    z = (F.col("point") * F.col("refine") - F.col("bin")) * F.col("fine") / F.col("h")
    sums = (bins.join(grid, keys).where(low <= high).withColumn("point", F.explode(F.sequence(low, high, F.lit(1))))
            .groupBy(*keys, "point").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("mass")))
    framed = grid.withColumn("point", F.explode(F.sequence(F.lit(0), last)))
    scale = F.col("total") * F.col("h") * F.lit((2 * 3.141592653589793) ** 0.5)
    return (framed.join(sums, [*keys, "point"], "left").fillna(0.0, ["mass"])
            .select(*keys, "point", (F.col("start") + F.col("point") * F.col("step")).alias("x"), (F.col("mass") / scale).alias("density")))


def box_stats(df: DataFrame, columns: list[str] = MEASURES, by: list[str] = ()) -> DataFrame:
    """Quartiles, range, 1.5 IQR fences, outlier count and whiskers (last value inside the fences)."""
    keys = [*by, "column"]
    counts = value_counts(df, columns, by)
    iqr = F.col("q3") - F.col("q1")
    fences = quantiles(counts, keys, [0.25, 0.5, 0.75]).select(
        *keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    ).select("*", (F.col("q1") - 1.5 * iqr).alias("lower_fence"),
             (F.col("q3") + 1.5 * iqr).alias("upper_fence"))
    inside = F.col("value").between(F.col("lower_fence"), F.col("upper_fence"))
    return sized_join(counts, fences, keys, ["value"]).groupBy(
        *keys, "q1", "median", "q3", "lower_fence", "upper_fence").agg(
        F.sum("n").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        F.min(F.when(inside, F.col("value"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("value"))).alias("upper_whisker"))


def outliers(df: DataFrame, columns: list[str] = MEASURES, by: list[str] = ()) -> DataFrame:
    """(by..., column, value, n): the distinct values outside the fences."""
    keys = [*by, "column"]
    fences = box_stats(df, columns, by).select(*keys, "lower_fence", "upper_fence")
    inside = F.col("value").between(F.col("lower_fence"), F.col("upper_fence"))
    return sized_join(value_counts(df, columns, by), fences, keys, ["value"]).where(~inside).select(*keys, "value", "n")


def violin(df: DataFrame, column: str = "rating", by: str = "main_category",
           points: int = 100) -> dict[str, DataFrame]:
    """Density per group, drawn two bandwidths past its range, and the inner box."""
    return {"density": kde(df, [column], points, [by], cut=2.0), "box": box_stats(df, [column], [by])}


def ecdf(df: DataFrame, column: str = "discount_percentage") -> DataFrame:
    """(value, n, cumulative_n, cumulative_pct) per distinct value."""
    return cumulative(value_counts(df, [column]), ["column"]).drop("column")


def ecdf_markers(df: DataFrame, column: str = "discount_percentage",
                 at: tuple[float, ...] = (25, 50, 75)) -> DataFrame:
    """(percent, value): the first value at which the curve reaches each percentage."""
    curve = ecdf(df, column)
    reached = curve.agg(F.array(*[
        F.struct(F.lit(float(p)).alias("percent"),
                 F.min(F.when(F.col("cumulative_pct") >= float(p), F.col("value"))).alias("value"))
        for p in at]).alias("rows"))
    return reached.select(F.inline("rows"))


def scatter_points(df: DataFrame, x: str, y: str, hue: str | None = None, size: str | None = None) -> DataFrame:
    """Every complete point with its optional colour and size columns."""
    extra = [c for c in (hue, size) if c and c in df.columns]
    return df.select(x, y, *extra).where(F.col(x).isNotNull() & F.col(y).isNotNull())


def scatter_bins(df: DataFrame, pairs: list[tuple[str, str]], bins: int = 50,
                 by: list[str] = ()) -> DataFrame:
    """(by..., x, y, x_bin, y_bin, count): two-dimensional bins, bounded at any table size."""
    columns = sorted({c for pair in pairs for c in pair})
    cells = F.inline(F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), _bin(a, bins).alias("x_bin"), _bin(b, bins).alias("y_bin"))
        for a, b in pairs]))
    binned = with_scalar(df.select(*dict.fromkeys([*by, *columns])), _ranges(df, columns), "_ranges")
    return (binned.select(*by, cells).where("x_bin is not null and y_bin is not null")
            .groupBy(*by, "x", "y", "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count")))


def scatter_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: r, complete pairs, t statistic and two-sided p-value."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    row = df.agg(no_nan(pearson(xs, ys)).alias("r"),
                 F.count_if(xs.isNotNull() & ys.isNotNull()).alias("n"))
    row = row.withColumn("r", F.when(F.col("n") > 2, F.col("r")))
    t = F.try_divide(F.col("r") * F.sqrt(F.col("n") - 2), F.sqrt(1 - F.col("r") * F.col("r")))

    @F.pandas_udf("double")
    def p_value(r: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([two_sided_p(a, b) if pd.notna(a) else None for a, b in zip(r, n)], dtype="float64")

    return row.select("r", "n", t.alias("t"), p_value("r", "n").alias("p"))


def pair_plot(df: DataFrame, columns: list[str] = MEASURES, bins: int = 50,
              hue: str | None = None) -> dict[str, DataFrame]:
    """Diagonal histograms and off-diagonal two-dimensional bins."""
    by = [hue] if hue else []
    return {"diagonal": histogram(df, columns, bins, by),
            "pairs": scatter_bins(df, list(combinations(columns, 2)), bins, by)}
