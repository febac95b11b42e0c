"""Correlation and covariance in long form (row, col, value), over pairwise complete rows."""

from __future__ import annotations

from itertools import combinations
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.inversions import weighted_inversions
from shelfline.functions.numeric import no_nan, sized_join, with_scalar
from shelfline.operators.distribution import with_ranks
from shelfline.operators.sampling import priority_sample
from shelfline.schema import MEASURES
from shelfline.session import materialize

# Rank cells per axis of the Kendall count, and the fewest rows that a cell is made for.
KENDALL_CELLS = 512
KENDALL_MIN_CELL = 4096
# The most distinct value pairs of a cell that one task counts at once.
KENDALL_LIMIT = 1_000_000

Pair = tuple[str, str]


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over the rows where both are known; null, not an error, for a constant side."""
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def _pairwise(df: DataFrame, pairs: list[Pair], measure) -> DataFrame:
    """One global aggregate with one expression per pair, turned into rows."""
    row = df.agg(F.array(*[
        F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"),
                 no_nan(measure(F.col(a).cast("double"), F.col(b).cast("double"))).alias("value"))
        for a, b in pairs]).alias("cells"))
    return row.select(F.inline("cells"))


def _mirrored(half: DataFrame, diagonal: DataFrame) -> DataFrame:
    other = half.select(F.col("col").alias("row"), F.col("row").alias("col"), "value")
    return half.unionByName(other).unionByName(diagonal)


def covariance(df: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    """Sample covariance of every pair of columns."""
    pairs = [*combinations(columns, 2), *[(c, c) for c in columns]]
    cells = _pairwise(df, pairs, F.covar_samp)
    off_diagonal = cells.where("row <> col").select(
        F.col("col").alias("row"), F.col("row").alias("col"), "value")
    return cells.unionByName(off_diagonal)


def contingency(df: DataFrame, pairs: list[Pair]) -> DataFrame:
    """(row, col, x, y, n): distinct value pairs of each column pair and how often they occur.

    Equal rows are counted before the shuffle, so repeated values cost one row per map task.
    """
    columns = sorted({c for pair in pairs for c in pair})
    clean = df.select([no_nan(F.col(c).cast("double")).alias(c) for c in columns])
    both = F.inline(F.array(*[
        F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"),
                 F.col(a).alias("x"), F.col(b).alias("y")) for a, b in pairs]))
    return (clean.select(both).where("x is not null and y is not null")
            .groupBy("row", "col", "x", "y").agg(F.count(F.lit(1)).alias("n")))


def _ranked_pairs(cells: DataFrame, keys: list[str] = ("row", "col")) -> DataFrame:
    """Contingency with the count, the rows below and the total of both values, within each key."""
    sides = F.inline(F.array(
        F.struct(F.lit("x").alias("side"), F.col("x").alias("value")),
        F.struct(F.lit("y").alias("side"), F.col("y").alias("value"))))
    counts = (cells.select(*keys, "n", sides).groupBy(*keys, "side", "value")
              .agg(F.sum("n").alias("n")))
    ranked = with_ranks(counts, [*keys, "side"])

    def side(s: str, keep: list[Column]) -> DataFrame:
        return ranked.where(F.col("side") == s).select(
            *keys, F.col("value").alias(s), F.col("n").alias(f"n_{s}"),
            F.col("below").alias(f"below_{s}"), *keep)

    # A value that many pairs share, as in a column of few values, is spread by the other side's value.
    def sizes(s: str) -> DataFrame:
        return cells.groupBy(*keys, s).agg(F.count(F.lit(1)).alias("_n"))

    joined = sized_join(cells, side("x", [F.col("total")]), [*keys, "x"], ["y"], sizes=sizes("x"))
    return sized_join(joined, side("y", []), [*keys, "y"], ["x"], sizes=sizes("y"))


def _pearson_pairs(df: DataFrame, pairs: list[Pair]) -> DataFrame:
    return _pairwise(df, pairs, pearson)


def _spearman_pairs(df: DataFrame, pairs: list[Pair]) -> DataFrame:
    """Pearson on average ranks. Ranks are taken from their known mean, so sums lose no digits."""
    ranked = _ranked_pairs(contingency(df, pairs))

    def centred(s: str) -> Column:
        return F.col(f"below_{s}") + (F.col(f"n_{s}") - F.col("total")) / 2.0

    dx, dy, n = centred("x"), centred("y"), F.col("n")
    r = F.try_divide(F.sum(n * dx * dy), F.sqrt(F.sum(n * dx * dx)) * F.sqrt(F.sum(n * dy * dy)))
    return ranked.groupBy("row", "col").agg(r.alias("value"))


def _rank_cell(s: str, cells: int, smallest: int) -> Column:
    """Cell of about total/cells rows. A value as large as a cell has an odd cell of its own."""
    size = F.greatest(F.col("total") / F.lit(float(cells)), F.lit(float(smallest)))
    return F.floor(F.col(f"below_{s}") / size) * 2 + F.when(F.col(f"n_{s}") >= size, 1).otherwise(0)


def _discordant(items: DataFrame, keys: list[str], cells: int, smallest: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(keys..., d): weighted pairs of items (x, y, n) whose x and y run against each other; and the ranked items.

    Both values are cut into rank cells. Two items in different cells on both axes are judged by a matrix
    of cell counts. Items that share a cell on one axis are counted inside that cell, which holds below two
    cells' worth of rows unless it is a single value, and that has no such pair. A cell with more than `limit`
    items is cut again in the same way, so no task holds more. Ranked items are written once when called.
    """
    points = materialize(_ranked_pairs(items, keys).select(
        *keys, "x", "y", "n", "n_x", "n_y", "total",
        _rank_cell("x", cells, smallest).alias("cx"), _rank_cell("y", cells, smallest).alias("cy")), "ranked-pairs")
    kinds = {f.name: f.dataType.simpleString() for f in points.schema.fields}
    schema = ", ".join([f"{k} {kinds[k]}" for k in keys] + ["d double"])

    def row(key: tuple, d: float) -> pd.DataFrame:
        return pd.DataFrame([(*key[:len(keys)], float(d))], columns=[*keys, "d"])

    def across(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cx, ix = np.unique(pdf["cx"], return_inverse=True)
        cy, iy = np.unique(pdf["cy"], return_inverse=True)
        grid = np.zeros((len(cx), len(cy)))
        np.add.at(grid, (ix, iy), pdf["n"].to_numpy("float64"))
        left = np.cumsum(grid, axis=0) - grid
        above = np.flip(np.cumsum(np.flip(left, 1), axis=1), 1) - left
        return row(key, (grid * above).sum())

    def inside(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return row(key, weighted_inversions(pdf["x"].to_numpy(), pdf["y"].to_numpy(), pdf["n"].to_numpy()))

    grid = points.groupBy(*keys, "cx", "cy").agg(F.sum("n").alias("n"))
    parts = grid.groupBy(*keys).applyInPandas(across, schema)
    # Items of one y cell that also share the x cell were counted there, so x counts by cell here.
    by_y = points.groupBy(*keys, "cy", F.col("cx").alias("x"), "y").agg(F.sum("n").alias("n"))
    depth = f"_cell{len(keys)}"
    for cell, inner in (("cx", points), ("cy", by_y)):
        inner = inner.where(F.col(cell) % 2 == 0).select(*keys, F.col(cell).alias(depth), F.col("x").cast("double").alias("x"), "y", "n")
        large = inner.groupBy(*keys, depth).agg(F.count(F.lit(1)).alias("_items")).where(F.col("_items") > limit).drop("_items")
        if not large.isEmpty():
            large = materialize(large, "large-cells")
            deeper, _ = _discordant(inner.join(large, [*keys, depth], "left_semi"), [*keys, depth], cells, smallest, limit)
            parts = parts.unionByName(deeper.select(*keys, "d"))
            inner = inner.join(large, [*keys, depth], "left_anti")
        parts = parts.unionByName(inner.groupBy(*keys, depth).applyInPandas(inside, schema))
    return parts.groupBy(*keys).agg(F.sum("d").alias("d")), points


def _kendall_pairs(df: DataFrame, pairs: list[Pair], cells: int = KENDALL_CELLS,
                   smallest: int = KENDALL_MIN_CELL, limit: int = KENDALL_LIMIT) -> DataFrame:
    """Tau-b. Discordant pairs are counted without forming pairs; runs jobs when called."""
    d, points = _discordant(contingency(df, pairs), ["row", "col"], cells, smallest, limit)

    def choose_two(c: Column) -> Column:
        c = c.cast("double")
        return c * (c - 1) / 2.0

    # A value's own pairs, spread over its contingency rows in proportion to their counts.
    tied = lambda s: F.sum(F.col("n") * (F.col(f"n_{s}") - 1) / 2.0)
    ties = points.groupBy("row", "col").agg(
        choose_two(F.sum("n")).alias("all"), tied("x").alias("tx"), tied("y").alias("ty"),
        F.sum(choose_two(F.col("n"))).alias("txy"))
    untied = F.sqrt(F.col("all") - F.col("tx")) * F.sqrt(F.col("all") - F.col("ty"))
    score = F.col("all") - F.col("tx") - F.col("ty") + F.col("txy") - 2.0 * F.col("d")
    return ties.join(d, ["row", "col"]).select("row", "col", F.try_divide(score, untied).alias("value"))


def kendall_sampled(df: DataFrame, columns: list[str] = MEASURES, rows: int = 20_000, block: int = 250, key: str = "product_id",
                    confidence: float = 0.95, seed: int = 42) -> DataFrame:
    """(row, col, value, std_error, low, high, sampled): tau-b of every pair of columns, estimated from a bounded sample.

    The sample is the `rows` rows of the highest seeded priority, cut into blocks of about `block` rows in that order. Only
    pairs inside a block are compared: an incomplete U-statistic of rows * block / 2 pairs, at any table size. Tau-b is the
    share of concordant less discordant pairs over the root of the shares untied on either side. Blocks are
    independent, so its error is the delete-one-block jackknife's. A block of all rows gives tau-b itself, without an error.
    """
    width = len(columns)
    sample = priority_sample(df.select(key, *[no_nan(F.col(c).cast("double")).alias(c) for c in columns]), rows, key, seed=seed)
    # At most `rows` rows are left to number.
    place = F.row_number().over(Window.orderBy(F.desc("priority"), key)) - 1
    blocks = sample.withColumn("block", F.floor(place / F.lit(block)).cast("int")).select("block", F.array(*columns).alias("v"))
    pairs = list(combinations(range(width), 2))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.array([[np.nan if x is None else x for x in row] for row in pdf["v"]], dtype="float64").reshape(-1, width)
        i, j = np.triu_indices(len(v), 1)
        signs = np.sign(v[i] - v[j])
        out = []
        for a, b in pairs:
            x, y = signs[:, a], signs[:, b]
            known = ~(np.isnan(x) | np.isnan(y))
            x, y = x[known], y[known]
            out.append((int(pdf["block"].iloc[0]), columns[a], columns[b], float((x * y).sum()), float((x * x).sum()), float((y * y).sum())))
        return pd.DataFrame(out, columns=["block", "row", "col", "s", "ux", "uy"])

    parts = blocks.groupBy("block").applyInPandas(compare, "block int, row string, col string, s double, ux double, uy double")
    keys = ["row", "col"]
    # One row per block and pair of columns.
    total = parts.groupBy(*keys).agg(*[F.sum(c).alias(f"t_{c}") for c in ("s", "ux", "uy")], F.count(F.lit(1)).alias("blocks"),
                                     F.collect_list(F.struct("s", "ux", "uy")).alias("each"))

    def tau(s: Column, ux: Column, uy: Column) -> Column:
        return F.try_divide(s, F.sqrt(ux) * F.sqrt(uy))

    out = F.transform("each", lambda e: tau(F.col("t_s") - e["s"], F.col("t_ux") - e["ux"], F.col("t_uy") - e["uy"]))
    found = total.select(*keys, tau(F.col("t_s"), F.col("t_ux"), F.col("t_uy")).alias("value"), "blocks", F.array_compact(out).alias("out"))
    mean = F.aggregate("out", F.lit(0.0), lambda a, x: a + x) / F.size("out")
    squares = F.aggregate("out", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean")))
    found = found.withColumn("mean", F.when(F.size("out") > 0, mean)).withColumn("variance", F.coalesce(squares * (F.col("blocks") - 1) / F.col("blocks"), F.lit(0.0)))
    reach = NormalDist().inv_cdf(0.5 + confidence / 2)
    error = F.sqrt("variance")
    counted = with_scalar(found, sample.agg(F.count(F.lit(1)).alias("n")), "sampled")
    return counted.select(*keys, "value", error.alias("std_error"), (F.col("value") - reach * error).alias("low"),
                          (F.col("value") + reach * error).alias("high"), "sampled")


_METHODS = {"pearson": _pearson_pairs, "spearman": _spearman_pairs, "kendall": _kendall_pairs}


def correlation_pairs(df: DataFrame, pairs: list[Pair], method: str = "pearson") -> DataFrame:
    if method not in _METHODS:
        raise ValueError(f"method must be one of {sorted(_METHODS)}")
    known = df.sparkSession.createDataFrame(pairs, "row string, col string")
    return known.join(_METHODS[method](df, pairs), ["row", "col"], "left")


def correlation(df: DataFrame, columns: list[str] = MEASURES, method: str = "pearson") -> DataFrame:
    """Full matrix in long form. A constant column correlates with nothing, itself included."""
    if len(columns) > 1:
        half = correlation_pairs(df, list(combinations(columns, 2)), method)
    else:
        half = df.sparkSession.createDataFrame([], "row string, col string, value double")
    varied = [F.struct(F.lit(c).alias("row"), F.lit(c).alias("col"),
                       F.when(F.min(F.col(c).cast("double")) < F.max(F.col(c).cast("double")), 1.0)
                       .alias("value")) for c in columns]
    diagonal = df.agg(F.array(*varied).alias("cells")).select(F.inline("cells"))
    return _mirrored(half, diagonal)


def to_matrix(long: DataFrame, columns: list[str]) -> DataFrame:
    return long.groupBy("row").pivot("col", columns).agg(F.first("value")).withColumnRenamed("row", "column")


def lower_triangle(df: DataFrame, columns: list[str] = MEASURES, method: str = "pearson") -> DataFrame:
    """Cells strictly below the diagonal, the ones a heatmap shows."""
    half = correlation_pairs(df, list(combinations(columns, 2)), method)
    return half.select(F.col("col").alias("row"), F.col("row").alias("col"), "value")


def target_correlation(df: DataFrame, target: str, features: list[str] | None = None,
                       method: str = "pearson", signed: bool = False) -> DataFrame:
    """(feature, value) against one target, by |r| or, when `signed`, by r.

    A target named in `features` stays in, as its own perfect match; by default it is left out.
    """
    if target not in df.columns:
        raise ValueError(f"target column not found: {target}")
    features = [c for c in MEASURES if c != target] if features is None else list(features)
    others = [f for f in features if f != target]
    out = correlation_pairs(df, [(target, f) for f in others], method).select(
        F.col("col").alias("feature"), "value")
    if target in features:
        own = correlation(df, [target], method).select(F.col("col").alias("feature"), "value")
        out = out.unionByName(own)
    return out.orderBy(F.desc("value" if signed else F.abs("value")), "feature")
