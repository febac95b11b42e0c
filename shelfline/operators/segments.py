"""Segmentation: scaling, K-Means with restarts, choice of K, profiles and composition of segments."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.functions.numeric import min_max_scaled, share_pct, with_scalar
from shelfline.operators.cleaning import impute_median
from shelfline.operators.distribution import grouped_quantiles
from shelfline.operators.features import add_discount_band
from shelfline.operators.grouping import group_statistics, require_columns
from shelfline.operators.lloyd import fit_centres
from shelfline.schema import (
    BAND_LABELS, DASHBOARD_MEASURES, LABEL_WORDS, PLAIN_LABEL, PROFILE_FEATURES, SEGMENT_FEATURES, SEGMENT_NAMES, TIER_WORDS,
    LabelThresholds,
)
from shelfline.session import materialize


def select_features(df: DataFrame, features: list[str] = SEGMENT_FEATURES) -> DataFrame:
    """The clustering features, nulls filled by their medians; a missing feature is an error."""
    require_columns(df, features)
    return impute_median(df, features)


def zscore(df: DataFrame, features: list[str] = SEGMENT_FEATURES, suffix: str = "_z") -> DataFrame:
    """Add features scaled by mean and population deviation; a constant feature becomes 0."""
    stats = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in features
    ]).alias("stats"))

    def scaled(c: str) -> Column:
        mean, std = F.col(f"_stats.{c}.mean"), F.col(f"_stats.{c}.std")
        return F.when(std > 0, (F.col(c) - mean) / std).when(F.col(c).isNotNull(), 0.0)

    return (with_scalar(df, stats, "_stats").withColumns({c + suffix: scaled(c) for c in features})
            .drop("_stats"))


def scaled_vectors(df: DataFrame, features: list[str] = SEGMENT_FEATURES) -> DataFrame:
    """`df` with the scaled features as the vector column `features`."""
    scaled = zscore(select_features(df, features), features)
    assembler = VectorAssembler(inputCols=[c + "_z" for c in features], outputCol="features",
                                handleInvalid="error")
    return assembler.transform(scaled).drop(*[c + "_z" for c in features])


def scaling_parameters(df: DataFrame, features: list[str] = SEGMENT_FEATURES) -> DataFrame:
    """(position, feature, median, mean, std): what is needed to scale further products alike."""
    filled = select_features(df, features)
    stats = filled.agg(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"), F.avg(f).alias("mean"),
                 F.stddev_pop(f).alias("std")) for i, f in enumerate(features)]).alias("rows"))
    medians = grouped_quantiles(df, features, [0.5]).select(
        F.col("column").alias("feature"), F.col("q")[0].alias("median"))
    return stats.select(F.inline("rows")).join(medians, "feature", "left").select(
        "position", "feature", "median", "mean", "std")


def scale_with(df: DataFrame, parameters: DataFrame, features: list[str] = SEGMENT_FEATURES) -> DataFrame:
    """Vectors of further products under saved parameters; no statistics are taken from `df`."""
    entry = F.struct("feature", F.struct("median", "mean", "std"))
    out = with_scalar(df, parameters.agg(F.map_from_entries(F.collect_list(entry)).alias("m")), "_scaling")

    def scaled(c: str) -> Column:
        p = F.col("_scaling")[c]
        return F.when(p["std"] > 0, (F.coalesce(c, p["median"]) - p["mean"]) / p["std"]).otherwise(0.0)

    out = out.withColumns({c + "_z": scaled(c) for c in features}).drop("_scaling")
    assembler = VectorAssembler(inputCols=[c + "_z" for c in features], outputCol="features", handleInvalid="error")
    return assembler.transform(out).drop(*[c + "_z" for c in features])


@dataclass(frozen=True)
class Fit:
    """Centres of the best assignment that a start led to, and their cost over all rows."""
    k: int
    seed: int
    cost: float
    centres: tuple[tuple[float, ...], ...]

    @cached_property
    def model(self) -> KMeansModel:
        """The centres as a model of Spark's: K-Means over nothing but these centres, each its own cluster."""
        spark = SparkSession.active()
        points = spark.createDataFrame([(Vectors.dense(c),) for c in self.centres], ["features"]).coalesce(1)
        return KMeans(k=self.k, seed=self.seed, initMode="random", featuresCol="features", predictionCol="cluster").fit(points)


def _fit_many(vectors: DataFrame, jobs: list[tuple[int, int]], max_iter: int, tol: float = 1e-4) -> list[Fit]:
    return [Fit(c.k, c.seed, c.cost, c.points) for c in fit_centres(vectors, jobs, max_iter, tol)]


def train_many(vectors: DataFrame, k: int, seeds: list[int], max_iter: int = 300, parallelism: int = 8,
               tol: float = 1e-4) -> list[Fit]:
    """One fit for each seed; all share each pass over the rows, so `parallelism` has no effect."""
    return _fit_many(vectors, [(k, seed) for seed in seeds], max_iter, tol)


def train_kmeans(vectors: DataFrame, k: int, seed: int = 42, restarts: int = 20, max_iter: int = 300,
                 parallelism: int = 8, tol: float = 1e-4) -> Fit:
    """Best of several seeded starts by cost. `vectors` should be cached or written, as it is read twice.

    A fit ends when no centre moves farther than `tol`; with 0, when no row changes its cluster.
    """
    fits = train_many(vectors, k, [seed + i for i in range(restarts)], max_iter, parallelism, tol)
    return min(fits, key=lambda f: (f.cost, f.seed))


def sweep_k(vectors: DataFrame, ks=range(2, 11), seed: int = 42, restarts: int = 10, max_iter: int = 300,
            metric: str = "squared_euclidean", parallelism: int = 8) -> DataFrame:
    """(k, inertia, silhouette, metric) for every k, and with metric "both" also `silhouette_euclidean`.

    `squared_euclidean` is linear in the rows at any size and larger than the plain one, so the margin of
    `choose_k` must be chosen for the metric. `euclidean` is the plain silhouette, exact but quadratic in
    the rows. `both` puts the linear one into `silhouette`.
    """
    jobs = [(k, seed + i) for k in ks for i in range(restarts)]
    fits = _fit_many(vectors, jobs, max_iter)
    rows = []
    for k in ks:
        best = min((f for f in fits if f.k == k), key=lambda f: (f.cost, f.seed))
        assigned = best.model.transform(vectors)
        first = "squared_euclidean" if metric == "both" else metric
        row = (k, best.cost, silhouette(assigned, first), first)
        rows.append((*row, silhouette(assigned, "euclidean")) if metric == "both" else row)
    schema = "k int, inertia double, silhouette double, metric string"
    return vectors.sparkSession.createDataFrame(rows, schema + ", silhouette_euclidean double" * (metric == "both"))


def silhouette(assigned: DataFrame, metric: str = "squared_euclidean") -> float:
    if metric == "euclidean":
        return float(silhouette_euclidean(assigned).first()["silhouette"])
    if metric == "euclidean_sampled":
        return float(silhouette_sampled(assigned).first()["silhouette"])
    if metric == "squared_euclidean":
        metric = "squaredEuclidean"
    return float(ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette",
                                     distanceMeasure=metric).evaluate(assigned))


def silhouette_squared(df: DataFrame, columns: list[str], cluster: str = "cluster") -> DataFrame:
    """Mean silhouette under squared distances from cluster sums alone: two passes, linear work."""
    sums = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s_{c}") for c in columns],
        F.sum(sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))).alias("sq"))
    # One row per cluster.
    packed = sums.agg(F.collect_list(F.struct("*")).alias("clusters"))
    norm = sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))
    rows = with_scalar(df.select(F.col(cluster).alias("own"), *columns, norm.alias("norm")), packed, "clusters")

    def distance_sum(s: Column) -> Column:
        """Sum of squared distances from this row to all rows of a cluster."""
        dot = sum((F.col(c) * s[f"s_{c}"] for c in columns), F.lit(0.0))
        return F.col("norm") * s["n"] + s["sq"] - 2.0 * dot

    sums_by = F.transform("clusters", lambda s: F.struct(
        s[cluster].alias("cluster"), s["n"].alias("n"), distance_sum(s).alias("d")))
    return _mean_silhouette(rows.select("own", sums_by.alias("sums")))


def _mean_silhouette(rows: DataFrame, weight: Column | None = None) -> DataFrame:
    """From (own, sums): sums of distances and sizes per cluster. A row alone in its cluster scores 0."""
    mine = F.filter("sums", lambda s: s["cluster"] == F.col("own"))[0]
    near = F.array_min(F.transform(F.filter("sums", lambda s: s["cluster"] != F.col("own")),
                                   lambda s: s["d"] / s["n"]))
    own = F.try_divide(mine["d"], mine["n"] - 1)
    score = F.when(mine["n"] > 1, F.coalesce(F.try_divide(near - own, F.greatest(near, own)), F.lit(0.0))).otherwise(0.0)
    scored = rows.select(score.alias("s"), (F.lit(1) if weight is None else weight).alias("w"))
    return scored.agg((F.sum(F.col("s") * F.col("w")) / F.sum("w")).alias("silhouette"))


def _points(assigned: DataFrame, features: str, cluster: str, *more: Column) -> DataFrame:
    """(own, p, more...): the cluster and the coordinates as an array."""
    p = vector_to_array(features) if dict(assigned.dtypes)[features] == "vector" else F.col(features)
    return assigned.select(F.col(cluster).alias("own"), p.alias("p"), *more)


def _distance_sums(left: DataFrame, right: DataFrame, blocks: int) -> DataFrame:
    """(left..., cluster, part, d, m): for each row of `left` (own, p, ...), the summed distances to the rows of each
    cluster and part of `right` (cluster, part, p, n), `n` being how often a row counts, and their number.

    Rows of both sides are hashed into blocks. Each pair of blocks is one task, which adds up distances per
    row, cluster and part; no pair of rows is ever emitted and no task holds more than two blocks.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def dealt(df: DataFrame) -> Column:
        # Both sides' keys are of one type, or equal keys would be dealt apart.
        return F.pmod(F.xxhash64(*df.columns), F.lit(blocks)).cast("int")

    a = left.withColumn("_block", dealt(left)).withColumn("_other", every)
    b = right.withColumn("_other", dealt(right)).withColumn("_block", every)
    given = left.columns
    out = [*given, "cluster", "part", "d", "m"]

    def add_up(x_rows: pd.DataFrame, y_rows: pd.DataFrame) -> pd.DataFrame:
        if x_rows.empty or y_rows.empty:
            return pd.DataFrame({c: pd.Series([], dtype="object") for c in out})
        x, y = np.stack(x_rows["p"].to_numpy()), np.stack(y_rows["p"].to_numpy())
        weight = y_rows["n"].to_numpy("float64")
        groups = list(y_rows.groupby(["cluster", "part"], sort=True).indices.items())
        parts = []
        for lo in range(0, len(x), 256):
            chunk = x[lo:lo + 256]
            # Differences and not products of coordinates, so that near points keep their digits.
            squares = np.zeros((len(chunk), len(y)))
            for k in range(x.shape[1]):
                squares += (chunk[:, k, None] - y[:, k]) ** 2
            gap = np.sqrt(squares) * weight
            for (label, piece), at in groups:
                part = x_rows.iloc[lo:lo + 256][given].copy()
                part["cluster"], part["part"] = label, piece
                part["d"], part["m"] = gap[:, at].sum(axis=1), int(weight[at].sum())
                parts.append(part)
        return pd.concat(parts)

    kinds = dict(left.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in given] + [f"cluster {dict(right.dtypes)['cluster']}", "part int", "d double", "m long"])
    sums = a.groupBy("_block", "_other").cogroup(b.groupBy("_block", "_other")).applyInPandas(add_up, schema)
    return sums.groupBy(*given, "cluster", "part").agg(F.sum("d").alias("d"), F.sum("m").alias("m"))


# A tile of distances between this many points of either side fits a processor's cache.
_TILE = 256
# Squared gaps up to this share of a point's own square are worked out again.
_NEAR = 1e-3
# Where there are points enough, they make so many blocks before a block gets more than `rows_per_block` of them.
_BLOCKS = 24
# A block has at most so many times `rows_per_block` points, and fewer where it has many clusters to add up for.
_FOLD = 10
_FOLDED_CLUSTERS = 300


def _tiles(weights: np.ndarray) -> list[tuple[slice, slice, np.ndarray]]:
    """For each tile of points its place, its run of clusters, and its weights of those."""
    tiles = []
    for at in range(0, len(weights), _TILE):
        tile = weights[at:at + _TILE]
        held = np.flatnonzero(tile.any(axis=0))
        run = slice(held[0], held[-1] + 1)
        tiles.append((slice(at, at + len(tile)), run, np.ascontiguousarray(tile[:, run])))
    return tiles


def _add_distances(x: np.ndarray, y: np.ndarray, wx: np.ndarray, wy: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each column of `x` the distances to those of `y`, added up by the columns of `wy`; and from `y` to `x` by those of `wx`.

    A tile is added up for the clusters it has, so points in the order of their clusters take the least work.
    """
    dx, dy = np.zeros_like(wx), np.zeros_like(wy)
    if not (np.isfinite(x).all() and np.isfinite(y).all()):
        return dx + np.nan, dy + np.nan
    middle = x.mean(axis=1, keepdims=True)
    x, y = x - middle, y - middle
    xx, yy = (x * x).sum(axis=0), (y * y).sum(axis=0)
    left = np.ascontiguousarray(np.vstack([-2.0 * x, xx, np.ones_like(xx)]).T)
    right = np.vstack([y, np.ones_like(yy), yy])
    gaps, close = np.empty(_TILE * _TILE), xx * _NEAR
    tiles = _tiles(wy)
    for i, own, weights in _tiles(wx):
        for j, other, other_weights in tiles:
            shape = i.stop - i.start, j.stop - j.start
            gap = np.matmul(left[i], right[:, j], out=gaps[:shape[0] * shape[1]].reshape(shape))
            # Products lose the digits of near points, whose gaps are taken from their differences.
            rows = np.flatnonzero(gap.min(axis=1) <= close[i])
            if rows.size:
                at, to = np.nonzero(gap[rows] <= close[i][rows, None])
                at = rows[at]
                gap[at, to] = ((x[:, i.start + at] - y[:, j.start + to]) ** 2).sum(axis=0)
            np.sqrt(gap, out=gap)
            dx[i, other] += gap @ other_weights
            if not same:
                dy[j, own] += gap.T @ weights
    return dx, dy


def _block_count(points: int, clusters: int, rows_per_block: int) -> int:
    """Every point gets sums from each block, so a large table has larger blocks and not only more of them. Few points still make several tasks."""
    small, fold = -(-points // rows_per_block), max(1, min(_FOLD, _FOLDED_CLUSTERS // clusters))
    return max(-(-small // fold), min(_BLOCKS, small), min(8, -(-points // 1000)))


def _all_distances(points: DataFrame, clusters: int, blocks: int, piece: int) -> DataFrame:
    """(place, n, d): for the weighted points (place, p, n) of clusters 0 .. `clusters` - 1, their summed distances to each cluster.

    Points are hashed into blocks, each packed into one row and dealt to a partition of its own. A task is a pair of partitions, so
    blocks travel when they are read and are not written for each pair. Each pair of blocks is measured once, for the points
    of both; no pair of points is ever emitted and a task holds two blocks. What a pair writes is sums, a row for `piece` points.
    """
    def pack(table: pa.Table) -> pa.Table:
        p, order = table["p"], np.argsort(table["place"].to_numpy(), kind="stable")
        width = pc.unique(pc.list_value_length(p)).to_pylist()
        if len(width) > 1:
            raise ValueError("points differ in their number of coordinates")
        flat = np.full(len(p), np.nan) if width == [None] else pc.list_flatten(p).to_numpy().astype("float64")
        return pa.table({"block": table["block"][:1], "size": pa.array([len(p)], pa.int32()),
                         "p": [np.ascontiguousarray(flat.reshape(len(p), -1)[order].T).tobytes()],
                         **{c: [table[c].to_numpy()[order].tobytes()] for c in ("place", "n")}})

    def opened(size: int, p: bytes, place: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
        weights = np.zeros((size, clusters))
        weights[np.arange(size), np.frombuffer(place, "int64")] = np.frombuffer(n, "int64")
        return np.frombuffer(p, "float64").reshape(-1, size), weights

    def pieces(block: int, other: int, d: np.ndarray) -> pd.DataFrame:
        cut = [d[at:at + piece].tobytes() for at in range(0, len(d), piece)]
        return pd.DataFrame({"block": block, "piece": range(len(cut)), "other": other, "d": cut})

    def measure(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                x, wx = opened(r.size, r.p, r.place, r.n)
                y, wy = opened(r.size2, r.p2, r.place2, r.n2)
                dx, dy = _add_distances(x, y, wx, wy, r.block == r.block2)
                yield pieces(r.block, r.block2, dx)
                if r.block != r.block2:
                    yield pieces(r.block2, r.block, dy)

    def total(block: pa.Table, parts: pa.Table) -> pa.Table:
        d = sum(np.frombuffer(v.as_py(), "float64") for v in parts.sort_by("other")["d"])
        place, n = (np.frombuffer(block[c][0].as_py(), "int64") for c in ("place", "n"))
        ends = pa.array(np.arange(0, len(d) + 1, clusters), pa.int32())
        # Unknown sums are null.
        return pa.table({"place": place, "n": n, "d": pa.ListArray.from_arrays(ends, pa.array(d, from_pandas=True))})

    dealt = points.withColumn("block", F.pmod(F.xxhash64("place", "p"), F.lit(blocks)).cast("int"))
    packed = materialize(dealt.groupBy("block").applyInArrow(pack, "block int, size int, p binary, place binary, n binary"), "point-blocks")
    apart = packed.repartitionById(blocks, "block")
    other = apart.withColumnsRenamed({c: f"{c}2" for c in packed.columns}).hint("shuffle_replicate_nl")
    sums = apart.join(other, F.col("block") <= F.col("block2")).mapInPandas(measure, "block int, piece int, other int, d binary")
    cut = packed.select("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / piece).cast("int"))).alias("piece"), "place", "n")
    cut = cut.select("block", "piece", *[F.substring(c, F.col("piece") * 8 * piece + 1, F.lit(8 * piece)).alias(c) for c in ("place", "n")])
    keys = "block", "piece"
    return cut.groupBy(*keys).cogroup(sums.groupBy(*keys)).applyInArrow(total, "place long, n long, d array<double>")


def silhouette_euclidean(assigned: DataFrame, features: str = "features", cluster: str = "cluster",
                         rows_per_block: int = 20000) -> DataFrame:
    """Exact mean silhouette under plain distances. Every row must meet every other, so the work is quadratic by
    definition; `silhouette_sampled` is the bounded form. Blocks have up to ten times `rows_per_block` points in a large
    table. Writes the points when called.
    """
    # Equal points are interchangeable, so distinct points with counts stand for all of them.
    points = _points(assigned, features, cluster).groupBy("own", "p").agg(F.count(F.lit(1)).alias("n"))
    # One row per cluster. The number of points is needed to lay out the blocks.
    sizes = points.groupBy("own").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("points")).collect()
    distinct = sum(r["points"] for r in sizes)
    if not distinct:
        return _mean_silhouette(points.select("own", "n", F.array(F.struct(F.col("own").alias("cluster"), "n", F.lit(0.0).alias("d"))).alias("sums")), F.col("n"))
    place = F.coalesce(*[F.when(F.col("own").eqNullSafe(F.lit(r["own"])), F.lit(i)) for i, r in enumerate(sizes)]).cast("long")
    blocks = _block_count(distinct, len(sizes), rows_per_block)
    kind = dict(points.dtypes)["own"]
    names = F.array(*[F.lit(r["own"]).cast(kind) for r in sizes])
    counts = F.array(*[F.lit(r["n"]).cast("long") for r in sizes])
    found = _all_distances(points.select(place.alias("place"), "p", "n"), len(sizes), blocks, rows_per_block)
    own = F.get(names, F.col("place").cast("int"))
    sums = F.transform("d", lambda d, i: F.struct(F.get(names, i).alias("cluster"), F.get(counts, i).alias("n"), d.alias("d")))
    # A point and its copies share one score.
    return _mean_silhouette(found.select(own.alias("own"), "n", sums.alias("sums")), F.col("n"))


def stratified_sample(assigned: DataFrame, rows: int, least: int = 50, key: str | None = None, features: str = "features",
                      cluster: str = "cluster", seed: int = 42) -> DataFrame:
    """(own, p, place, size, total): a cluster's share of about `rows` rows, and `least` of them at least, by a seeded hash.

    `place` numbers a cluster's sampled rows in hash order, `size` and `total` count its rows and all rows. Rows
    of null clusters are left out. The hash is taken of `key`, or of the coordinates without one.
    """
    known = _points(assigned.where(F.col(cluster).isNotNull()), features, cluster,
                    *([] if key is None else [F.col(key).cast("string").alias("key")]))
    told = F.col("key") if key else F.concat_ws(",", F.col("p").cast("array<string>"))
    sizes = known.groupBy("own").agg(F.count(F.lit(1)).alias("size"))
    # One row per cluster.
    lookup = sizes.agg(F.map_from_entries(F.collect_list(F.struct("own", "size"))).alias("by"))
    hashed = known.withColumn("hash", F.md5(F.concat(told, F.lit(str(seed)))))
    order = Window.partitionBy("own").orderBy("hash", *(["key"] if key else []))
    # The fixed limit lets each map task keep no more than that many rows of a cluster.
    ranked = hashed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rows + least)
    ranked = with_scalar(ranked, lookup, "by").select(
        "own", "p", (F.col("place") - 1).alias("place"), F.col("by")[F.col("own")].alias("size"),
        F.aggregate(F.map_values("by"), F.lit(0).cast("long"), lambda a, b: a + b).alias("total"))
    quota = F.greatest(F.least("size", F.lit(least)), F.ceil(F.lit(float(rows)) * F.col("size") / F.col("total")))
    return ranked.where(F.col("place") < quota)


def silhouette_sampled(assigned: DataFrame, rows: int = 4000, groups: int = 20, confidence: float = 0.95, least: int = 50,
                       key: str | None = None, features: str = "features", cluster: str = "cluster", seed: int = 42,
                       rows_per_block: int = 1000) -> DataFrame:
    """(silhouette, std_error, low, high, sampled, rows): the plain silhouette, estimated from a stratified sample.

    The sampled rows are scored against each other and clusters weighted by their true sizes, so the work is
    one pass over the rows and about the square of `rows`, at any table size. The error is the delete-a-group jackknife's: the
    sample is cut into `groups` parts, each left out once both as rows and as neighbours, with the finite population
    correction. A sample of all rows gives the exact value and no error. Writes the sample when called.
    """
    sample = materialize(stratified_sample(assigned, rows, least, key, features, cluster, seed).withColumn(
        "part", (F.col("place") % groups).cast("int")), "silhouette-sample")
    blocks = max(1, -(-sample.count() // rows_per_block))
    queries = sample.select("own", "p", "place", "part")
    sums = _distance_sums(queries.withColumnRenamed("part", "own_part"), sample.select(
        F.col("own").alias("cluster"), "part", "p", F.lit(1).cast("long").alias("n")), blocks)
    # Per row and cluster, at most `groups` parts.
    whole = sums.groupBy("own", "place", "own_part", "cluster").agg(
        F.sum("d").alias("d"), F.sum("m").alias("m"),
        F.map_from_entries(F.collect_list(F.struct("part", F.struct("d", "m")))).alias("parts"))
    # Leaving out part -1 leaves all in.
    left = whole.withColumn("out", F.explode(F.sequence(F.lit(-1), F.lit(groups - 1)))).where("own_part <> out")
    gone = F.col("parts")[F.col("out")]
    left = left.select("out", "own", "place", "cluster", (F.col("d") - F.coalesce(gone["d"], F.lit(0.0))).alias("d"),
                       (F.col("m") - F.coalesce(gone["m"], F.lit(0))).alias("m")).where("m > 0")
    own = F.col("cluster") == F.col("own")
    mean = left.groupBy("out", "own", "place").agg(
        F.max(F.when(own, F.try_divide("d", F.col("m") - 1))).alias("a"), F.max(F.when(own, F.col("m"))).alias("n"),
        F.min(F.when(~own, F.col("d") / F.col("m"))).alias("b"))
    score = F.when(F.col("n") > 1, F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))).otherwise(0.0)
    strata = mean.groupBy("out", "own").agg(F.avg(score).alias("s"))
    sizes = sample.groupBy("own").agg(F.first("size").alias("size"), F.first("total").alias("total"), F.count(F.lit(1)).alias("n"))
    overall = strata.join(F.broadcast(sizes), "own").groupBy("out").agg((F.sum(F.col("s") * F.col("size")) / F.sum("size")).alias("s"))
    part = F.when(F.col("out") >= 0, F.col("s"))
    used = sizes.agg(F.sum("n").alias("n"), F.max("total").alias("total"))
    spread = F.coalesce(F.var_pop(part) * (F.count(part) - 1), F.lit(0.0)).alias("variance")
    found = with_scalar(overall.agg(F.max(F.when(F.col("out") < 0, F.col("s"))).alias("silhouette"), spread),
                        used.agg(F.first(F.struct("n", "total"))), "used")
    error = F.sqrt(F.col("variance") * (1 - F.col("used.n") / F.col("used.total")))
    reach = NormalDist().inv_cdf(0.5 + confidence / 2)
    return found.select("silhouette", error.alias("std_error"), (F.col("silhouette") - reach * error).alias("low"),
                        (F.col("silhouette") + reach * error).alias("high"), F.col("used.n").alias("sampled"), F.col("used.total").alias("rows"))


def choose_k(table: list[tuple[int, float, float | None]], margin: float = 0.05) -> int:
    """K from (k, inertia, silhouette) rows: the elbow, or the best silhouette if clearly better."""
    table = sorted(table)
    ks, inertia = [r[0] for r in table], [r[1] for r in table]
    scores = {r[0]: r[2] for r in table if r[2] is not None}
    bends = [inertia[i + 1] - 2 * inertia[i] + inertia[i - 1] for i in range(1, len(ks) - 1)]
    elbow = ks[bends.index(max(bends)) + 1] if bends else ks[0]
    if not scores:
        return elbow
    best = max(scores, key=scores.get)
    return best if scores[best] - scores.get(elbow, 0.0) > margin else elbow


def elbow_table(sweep: DataFrame) -> DataFrame:
    """The sweep with the second difference of inertia; the elbow has the largest. One row per k."""
    w = Window.orderBy("k")
    bend = F.lead("inertia").over(w) - 2 * F.col("inertia") + F.lag("inertia").over(w)
    return sweep.withColumn("bend", bend)


def canonical_clusters(assigned: DataFrame, by: str = "discounted_price") -> DataFrame:
    """Renumber clusters by size, largest first, ties by mean price; ids then keep their meaning.

    Rows without a cluster stay and have no number.
    """
    sizes = assigned.where(F.col("cluster").isNotNull()).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg(by).alias("mean"))
    # One row per cluster.
    order = F.row_number().over(Window.orderBy(F.desc("n"), "mean", "cluster")) - 1
    ids = sizes.select("cluster", order.cast("int").alias("canonical"))
    return (assigned.join(F.broadcast(ids), "cluster", "left").drop("cluster")
            .withColumnRenamed("canonical", "cluster"))


def assign_clusters(vectors: DataFrame, model: KMeansModel) -> DataFrame:
    return canonical_clusters(model.transform(vectors))


def attach_clusters(df: DataFrame, clusters: DataFrame, key: str = "product_id") -> DataFrame:
    """Left lookup of the cluster by product id."""
    return df.drop("cluster").join(clusters.select(key, "cluster"), key, "left")


def pca_projection(vectors: DataFrame, keep: list[str] = ("product_id", "cluster"),
                   features: list[str] = SEGMENT_FEATURES, components: int = 2) -> dict[str, DataFrame]:
    """Scores, explained variance and loadings; the largest loading of a component is positive."""
    model = PCA(k=components, inputCol="features", outputCol="pca").fit(vectors)
    loadings = model.pc.toArray()
    signs = [float(np.sign(loadings[np.argmax(np.abs(loadings[:, i])), i])) or 1.0 for i in range(components)]
    scores = model.transform(vectors).withColumn("pca", vector_to_array("pca"))
    kept = [c for c in keep if c in scores.columns]
    spark = vectors.sparkSession
    names = [f"PC{i + 1}" for i in range(components)]
    return {
        "scores": scores.select(*kept, *[(F.col("pca")[i] * signs[i]).alias(n) for i, n in enumerate(names)]),
        "variance": spark.createDataFrame(
            [(n, float(v)) for n, v in zip(names, model.explainedVariance)], "component string, explained double"),
        "loadings": spark.createDataFrame(
            [(f, *[float(loadings[j, i] * signs[i]) for i in range(components)])
             for j, f in enumerate(features)], "feature string, " + ", ".join(f"{n} double" for n in names)),
    }


def cluster_statistics(df: DataFrame, columns: list[str] = DASHBOARD_MEASURES) -> DataFrame:
    return group_statistics(df, "cluster", columns, ["count", "mean", "median", "std", "min", "max"])


def cluster_sizes(df: DataFrame) -> DataFrame:
    sizes = df.where(F.col("cluster").isNotNull()).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    sizes = with_scalar(sizes, df.agg(F.count(F.lit(1)).alias("n")), "_total")
    return sizes.withColumn("percentage", F.col("size") / F.col("_total") * 100.0).drop("_total")


def _cluster_means(df: DataFrame, features: list[str]) -> DataFrame:
    """One row per cluster: size, share, its means and the overall means as `all_<feature>`."""
    overall = df.agg(F.struct(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f) for f in features]).alias("o"))
    means = df.where(F.col("cluster").isNotNull()).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), *[F.avg(f).alias(f"mean_{f}") for f in features])
    return with_scalar(means, overall, "_all").withColumns({
        "percentage": F.col("size") / F.col("_all.n") * 100.0,
        **{f"all_{f}": F.col(f"_all.{f}") for f in features}}).drop("_all")


def _relative(feature: str) -> Column:
    return F.try_divide(F.col(f"mean_{feature}") - F.col(f"all_{feature}"), F.col(f"all_{feature}"))


def _beyond(gap: Column, threshold: float, above: str, below: str) -> Column:
    return F.when(gap > threshold, above).when(gap < -threshold, below)


def segment_label(features: list[str], t: LabelThresholds = LabelThresholds()) -> Column:
    """Label of a row of cluster means from its distinctive levels only."""
    price = "log_discounted_price" if "log_discounted_price" in features else "discounted_price"
    levels = [_beyond(_relative(price), t.price, *LABEL_WORDS["price"])]
    if "discount_percentage" in features:
        levels.append(_beyond(_relative("discount_percentage"), t.discount, *LABEL_WORDS["discount"]))
    if "rating" in features:
        gap = F.col("mean_rating") - F.col("all_rating")
        levels.append(_beyond(gap, t.rating, *LABEL_WORDS["rating"]))
    if "log_rating_count" in features:
        levels.append(_beyond(_relative("log_rating_count"), t.popularity, *LABEL_WORDS["popularity"]))
    joined = F.concat_ws(" / ", *levels)
    return F.when(joined == "", PLAIN_LABEL).otherwise(joined)


def interpret_clusters(df: DataFrame, features: list[str] = SEGMENT_FEATURES,
                       t: LabelThresholds = LabelThresholds()) -> DataFrame:
    """Label, size, share, means and notable differences of every cluster."""
    def note(f: str) -> Column:
        pct = _relative(f) * 100.0
        text = F.concat(F.lit(f"{f}: "), F.when(pct > 0, "higher").otherwise("lower"),
                        F.lit(" than average ("), F.format_string("%+.1f", pct), F.lit("%)"))
        return F.when(F.abs(pct) > t.notable_pct, text)

    return _cluster_means(df, features).select(
        "cluster", segment_label(features, t).alias("label"), "size", "percentage",
        *[f"mean_{f}" for f in features],
        F.array_compact(F.array(*[note(f) for f in features])).alias("characteristics"))


def cluster_profiles(df: DataFrame, features: list[str] = PROFILE_FEATURES) -> DataFrame:
    """Mean of each feature per cluster after scaling it to 0..1 over all rows."""
    ranges = df.agg(F.struct(*[
        F.struct(F.min(f).alias("low"), F.max(f).alias("high")).alias(f) for f in features]).alias("r"))
    norms = {f"{f}_norm": min_max_scaled(F.col(f), F.col(f"_ranges.{f}.low"), F.col(f"_ranges.{f}.high"))
             for f in features}
    known = with_scalar(df.where(F.col("cluster").isNotNull()), ranges, "_ranges")
    return (known.select("cluster", *[e.alias(n) for n, e in norms.items()])
            .groupBy("cluster").agg(*[F.avg(n).alias(n) for n in norms]))


def composition(df: DataFrame, by: str = "main_category", values: list[str] | None = None) -> DataFrame:
    """(cluster, by, count, pct_in_cluster, pct_in_<by>) with every combination present."""
    known = df.where(F.col("cluster").isNotNull() & F.col(by).isNotNull())
    counts = known.groupBy("cluster", by).agg(F.count(F.lit(1)).alias("count"))
    if values is None:
        # Each label carries the list of clusters, one entry per cluster, so no join forms the grid.
        labels = with_scalar(counts.select(by).distinct(), counts.agg(F.sort_array(F.collect_set("cluster")).alias("v")), "_clusters")
        grid = labels.select(F.explode("_clusters").alias("cluster"), by)
    else:
        labels = F.array(*[F.lit(v) for v in values])
        grid = counts.select("cluster").distinct().select("cluster", F.explode(labels).alias(by))
    full = grid.join(counts, ["cluster", by], "left").fillna(0, ["count"])
    in_cluster = F.sum("count").over(Window.partitionBy("cluster"))
    in_label = F.sum("count").over(Window.partitionBy(by))
    full = full.select("cluster", by, "count", in_cluster.alias("_c"), in_label.alias("_l"))
    return full.select("cluster", by, "count", share_pct(F.col("count"), F.col("_c")).alias("pct_in_cluster"),
                       F.when(F.col("_l") > 0, share_pct(F.col("count"), F.col("_l"))).alias(f"pct_in_{by}"))


def band_composition(df: DataFrame) -> DataFrame:
    banded = df if "discount_band" in df.columns else add_discount_band(df)
    return composition(banded, "discount_band", BAND_LABELS)


def composition_matrix(long: DataFrame, by: str, values: list[str], cell: str = "count") -> DataFrame:
    return long.groupBy("cluster").pivot(by, values).agg(F.first(cell))


def cluster_summary(df: DataFrame, names: dict[int, str] = SEGMENT_NAMES) -> DataFrame:
    """Dashboard row per cluster with its display name; other ids are named by number."""
    stats = group_statistics(df, "cluster", ["discounted_price"], ["mean", "median"])
    means = df.groupBy("cluster").agg(
        F.count("product_id").alias("count"), F.avg("discount_percentage").alias("avg_discount"),
        F.avg("rating").alias("avg_rating"), F.avg("rating_count").alias("avg_reviews"))
    name = F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))
    for cluster, text in names.items():
        name = F.when(F.col("cluster") == cluster, text).otherwise(name)
    means = with_scalar(means, df.agg(F.count(F.lit(1)).alias("n")), "_total")
    return means.join(stats, "cluster").select(
        "cluster", name.alias("name"), "count", F.col("discounted_price_mean").alias("avg_price"),
        F.col("discounted_price_median").alias("median_price"), "avg_discount", "avg_rating", "avg_reviews",
        (F.col("count") / F.col("_total") * 100.0).alias("percentage"))


def tier(label: Column) -> Column:
    """Market tier by what the label says, tested in this order."""
    def says(*words: str) -> Column:
        found = F.lit(False)
        for w in words:
            found = found | label.contains(w)
        return found
    found = F.lit(None).cast("string")
    for name, words in reversed(TIER_WORDS.items()):
        found = F.when(says(*words), name).otherwise(found)
    return found


def cluster_facts(df: DataFrame, features: list[str] = SEGMENT_FEATURES, above_pct: float = 5.0) -> DataFrame:
    """Per cluster: label, tier, size, key means, and its main categories and bands, largest first."""
    def main_parts(long: DataFrame, by: str, name: str) -> DataFrame:
        # Bounded by 100 / above_pct entries per cluster.
        entry = F.struct((-F.col("pct_in_cluster")).alias("order"), F.col(by).alias("name"))
        listed = F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(
            e["name"].alias("name"), (-e["order"]).alias("pct")))
        return long.where(F.col("pct_in_cluster") > above_pct).groupBy("cluster").agg(listed.alias(name))

    facts = interpret_clusters(df, features)
    keys = ["discounted_price", "discount_percentage", "rating", "rating_count"]
    return (facts.select("cluster", "label", tier(F.col("label")).alias("tier"), "size", "percentage",
                         *[f"mean_{k}" for k in keys if k in features])
            .join(main_parts(composition(df), "main_category", "categories"), "cluster", "left")
            .join(main_parts(band_composition(df), "discount_band", "bands"), "cluster", "left"))


def representatives(vectors: DataFrame, model: KMeansModel, n: int = 1) -> DataFrame:
    """The n products nearest to the centre of their cluster."""
    centres = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in model.clusterCenters()])
    assigned = model.transform(vectors).withColumn("p", vector_to_array("features"))
    return _nearest(assigned, centres[F.col("cluster")], n)


def mean_representatives(df: DataFrame, columns: list[str], n: int = 1) -> DataFrame:
    """The n products nearest to the mean of the given clusters; rows without a cluster have none."""
    rows = df.where(F.col("cluster").isNotNull())
    # One row per cluster.
    means = rows.groupBy("cluster").agg(F.array(*[F.avg(c) for c in columns]).alias("mean"))
    lookup = means.agg(F.map_from_entries(F.collect_list(F.struct("cluster", "mean"))))
    placed = with_scalar(rows.withColumn("p", F.array(*columns)), lookup, "_means")
    return _nearest(placed, F.col("_means")[F.col("cluster")], n)


def _nearest(assigned: DataFrame, centre: Column, n: int) -> DataFrame:
    gap = F.aggregate(F.zip_with("p", centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    ranked = F.row_number().over(Window.partitionBy("cluster").orderBy("distance", "product_id"))
    return (assigned.select("product_id", "cluster", F.sqrt(gap).alias("distance"))
            .withColumn("rank", ranked).where(F.col("rank") <= n))
