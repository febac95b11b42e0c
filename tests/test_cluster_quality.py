import math
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from shelfline.operators import cluster_quality, segments


def blobs(n, seed=5, spread=1.0):
    rng = np.random.default_rng(seed)
    labels = rng.choice(4, n, p=[0.5, 0.3, 0.15, 0.05])
    centres = np.array([[0, 0, 0], [4, 0, 1], [0, 5, 2], [6, 6, 6]])
    return labels, centres[labels] + rng.normal(0, spread, (n, 3))


def frame(spark, labels, points):
    rows = [(f"P{i}", None if c is None else int(c), [float(v) for v in p]) for i, (c, p) in enumerate(zip(labels, points))]
    return spark.createDataFrame(rows, "product_id string, cluster int, features array<double>")


@pytest.fixture
def partitions(spark):
    def use(n, merged):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(merged).lower())
    yield use
    use(8, True)


@pytest.mark.parametrize("n, merged", [(1, True), (4, False), (17, False), (17, True)])
def test_exact_silhouette_does_not_depend_on_partitions(spark, partitions, n, merged):
    labels, points = blobs(150)
    df = frame(spark, labels, points)
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    scores = []
    for i, own in enumerate(labels):
        a = gaps[i, labels == own].sum() / max((labels == own).sum() - 1, 1)
        b = min(gaps[i, labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    partitions(n, merged)
    assert segments.silhouette_euclidean(df, rows_per_block=40).first()["silhouette"] == pytest.approx(np.mean(scores), abs=1e-12)


def test_a_sample_of_all_rows_is_exact(spark, partitions):
    labels, points = blobs(300)
    labels = [*labels, 9, None]
    points = np.vstack([points, [[20, 20, 20], [0, 0, 0]]])
    df = frame(spark, labels, points)
    exact = segments.silhouette_euclidean(df.where("cluster is not null")).first()["silhouette"]
    partitions(17, False)
    got = segments.silhouette_sampled(df, rows=400, rows_per_block=70, key="product_id").first()
    assert got["silhouette"] == pytest.approx(exact, abs=1e-12) and got["std_error"] == 0
    assert (got["sampled"], got["rows"]) == (301, 301)


def test_interval_of_the_sampled_silhouette_holds_the_exact_value(spark):
    labels, points = blobs(3000, 6, 1.6)
    df = frame(spark, labels, points).cache()
    exact = segments.silhouette_euclidean(df).first()["silhouette"]
    held = 0
    for seed in range(8):
        got = segments.silhouette_sampled(df, rows=400, key="product_id", seed=seed).first()
        assert got["sampled"] < 460 and 0 < got["std_error"] < 0.03
        held += got["low"] <= exact <= got["high"]
    df.unpersist()
    assert held >= 7
    assert segments.silhouette(df.selectExpr("features", "cluster"), "euclidean_sampled") == pytest.approx(exact, abs=1e-9)


def test_sample_repeats_and_is_bounded(spark):
    labels, points = blobs(2000)
    df = frame(spark, labels, points)
    a, b = (sorted(map(str, segments.stratified_sample(x, 100, 10, "product_id").collect())) for x in (df, df.repartition(13)))
    assert a == b and len(a) <= 100 + 4 + 10
    by_points = segments.stratified_sample(df, 100, 10)
    assert 100 <= by_points.count() <= 114


def plain_agreement(a, b):
    n, cells = len(a), Counter(zip(a, b))
    same = lambda counts: sum(c * (c - 1) / 2 for c in counts.values())
    both, ca, cb, every = same(cells), same(Counter(a)), same(Counter(b)), n * (n - 1) / 2
    expected = ca * cb / every
    vi = -sum(c / n * (math.log(c / Counter(a)[x]) + math.log(c / Counter(b)[y])) for (x, y), c in cells.items())
    alike = sum((a[i] == a[j]) == (b[i] == b[j]) for i, j in combinations(range(n), 2))
    return alike / every, (both - expected) / ((ca + cb) / 2 - expected), vi


def test_agreement_of_labelings(spark):
    rng = np.random.default_rng(1)
    a = [int(x) for x in rng.integers(0, 4, 120)]
    b = [x if rng.random() < 0.8 else int(rng.integers(0, 3)) for x in a]
    rows = [(x, str(y), (x + 1) % 4) for x, y in zip(a, b)] + [(None, "1", 2), (1, None, 2)]
    got = {(r["first"], r["second"]): r for r in cluster_quality.labeling_agreement(
        spark.createDataFrame(rows, "a int, b string, c int"), ["a", "b", "c"]).collect()}
    r = got["a", "b"]
    assert (r["rand"], r["adjusted_rand"], r["variation_of_information"]) == pytest.approx(plain_agreement(a, b), abs=1e-12)
    assert r["rows"] == 120 and len(got) == 3
    one = spark.createDataFrame([(1, 2)] * 5, "a int, b int")
    assert cluster_quality.labeling_agreement(one, ["a", "b"]).first()["adjusted_rand"] == 1.0
    assert cluster_quality.labeling_agreement(one.where("false"), ["a", "b"]).isEmpty()


def test_stability_over_seeds(spark):
    from pyspark.ml.functions import array_to_vector
    labels, points = blobs(400, spread=0.2)
    vectors = frame(spark, labels, points).select(array_to_vector("features").alias("features")).cache()
    table = cluster_quality.cluster_stability(vectors, 2, [1, 2, 3]).collect()
    assert {(r["first"], r["second"]) for r in table} == {("seed_1", "seed_2"), ("seed_1", "seed_3"), ("seed_2", "seed_3")}
    for r in table:
        if abs(r["cost_first"] - r["cost_second"]) < 1e-6:
            assert r["adjusted_rand"] == pytest.approx(1.0) and r["variation_of_information"] == pytest.approx(0.0, abs=1e-9)


def test_pairs_of_blocks_are_measured_once_for_both_sides():
    random = np.random.default_rng(3)
    x, y = 1e4 + random.normal(size=(3, 700)), 1e4 + random.normal(size=(3, 300))
    # Near and equal points keep their digits.
    y[:, :100] = x[:, :100] + np.where(np.arange(100) % 2, 1e-7, 0.0)
    wx, wy = np.eye(2)[random.integers(0, 2, 700)], 3.0 * np.eye(2)[random.integers(0, 2, 300)]
    gaps = np.sqrt(((x[:, :, None] - y[:, None, :]) ** 2).sum(axis=0))
    to_y, to_x = segments._add_distances(x, y, wx, wy, False)
    assert np.allclose(to_y, gaps @ wy, rtol=1e-11, atol=0) and np.allclose(to_x, gaps.T @ wx, rtol=1e-11, atol=0)


def test_blocks_are_not_written_for_each_pair(spark):
    labels, points = blobs(230, seed=11)
    # Repeated points, blocks of unlike sizes, and last pieces that are not full.
    labels, points = np.concatenate([labels, labels[:30]]), np.concatenate([points, points[:30]])
    found = segments.silhouette_euclidean(frame(spark, labels, points), rows_per_block=7)
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    below = plan[next(i for i, line in enumerate(plan) if "MapInPandas" in line) + 1]
    # An exchange here would write two blocks for every pair.
    assert "CartesianProduct" in below
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    scores = []
    for i, own in enumerate(labels):
        a = gaps[i, labels == own].sum() / ((labels == own).sum() - 1)
        b = min(gaps[i, labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    assert found.first()["silhouette"] == pytest.approx(np.mean(scores), abs=1e-12)


def test_large_tables_have_larger_blocks():
    assert [segments._block_count(n, 3, 20000) for n in (1, 20000, 400000, 1200000, 7200000)] == [1, 8, 20, 24, 36]
    # Sums of many clusters leave less room for points.
    assert segments._block_count(7200000, 300, 20000) == 360


def test_points_of_several_clusters_in_a_tile_and_unknown_coordinates():
    random = np.random.default_rng(4)
    x, y = random.normal(size=(2, 600)), random.normal(size=(2, 520))
    wx, wy = np.eye(5)[np.sort(random.integers(0, 5, 600))], 2.0 * np.eye(5)[np.sort(random.integers(0, 5, 520))]
    gaps = np.sqrt(((x[:, :, None] - y[:, None, :]) ** 2).sum(axis=0))
    to_y, to_x = segments._add_distances(x, y, wx, wy, False)
    assert np.allclose(to_y, gaps @ wy, rtol=1e-11, atol=0) and np.allclose(to_x, gaps.T @ wx, rtol=1e-11, atol=0)
    x[0, 3] = np.nan
    assert all(np.isnan(d).all() for d in segments._add_distances(x, y, wx, wy, False))


def test_unknown_coordinates_leave_no_score(spark):
    rows = [(i % 2, [float(i), float(i * i % 7)]) for i in range(12)]
    for odd in (float("nan"), None):
        df = spark.createDataFrame([*rows, (1, [odd, 0.0])], "cluster int, features array<double>")
        assert segments.silhouette_euclidean(df, rows_per_block=5).first()["silhouette"] == 0.0
