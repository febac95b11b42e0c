import random
import time

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfline import session
from shelfline.operators import lloyd, segments
from shelfline.plans.segmentation import segment_catalog
from shelfline.schema import SEGMENT_FEATURES
from shelfline.sources.tables import read_model, write_model

# Fixed values, a known result of the K sweep: k, inertia, silhouette.
SWEEP = [(2, 6483.67, .2118), (3, 5243.38, .2188), (4, 4318.21, .2317), (5, 3693.07, .2286), (6, 3299.61, .2225),
         (7, 2942.85, .2349), (8, 2725.19, .2305), (9, 2512.65, .2280), (10, 2350.26, .2220)]


@pytest.fixture(scope="module")
def catalog(spark):
    rng = random.Random(11)
    rows = []
    for i in range(360):
        base, disc = [(300, 20.0), (900, 70.0), (20000, 30.0)][0 if i % 6 < 3 else 1 if i % 6 < 5 else 2]
        price = base * rng.uniform(.9, 1.1)
        rows.append((f"p{i}", f"name {i}", "ABC"[i % 3], price * 2, price, disc + rng.uniform(-2, 2),
                     3.5 + disc / 100 + rng.uniform(-.02, .02), disc * 40 + rng.randrange(100), price))
    df = spark.createDataFrame(rows, "product_id string, product_name string, main_category string, actual_price double, "
                               "discounted_price double, discount_percentage double, rating double, rating_count double, "
                               "price_savings double")
    return df.withColumns({"log_rating_count": F.log1p("rating_count"), "log_discounted_price": F.log1p("discounted_price")}).cache()


def test_choice_of_k():
    assert segments.choose_k(SWEEP) == 3
    clear = [(k, i, .5 if k == 7 else s) for k, i, s in SWEEP]
    assert segments.choose_k(clear) == 7
    assert segments.choose_k(SWEEP[:2]) == 2
    assert segments.choose_k([(k, i, None) for k, i, _ in SWEEP]) == 3


def test_elbow_table(spark):
    rows = segments.elbow_table(spark.createDataFrame(SWEEP, "k int, inertia double, silhouette double")).collect()
    bends = {r["k"]: r["bend"] for r in rows if r["bend"] is not None}
    assert max(bends, key=bends.get) == 3 and bends[3] == pytest.approx(315.12)


def test_zscore(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, flat double")
    rows = segments.zscore(df, ["a", "flat"]).orderBy("a").collect()
    assert [r["a_z"] for r in rows] == [-1.0, 1.0] and [r["flat_z"] for r in rows] == [0.0, 0.0]


def test_missing_feature(spark):
    with pytest.raises(ValueError):
        segments.select_features(spark.range(2), SEGMENT_FEATURES)


def test_labels(spark):
    """Known means of three segments, with the overall means weighted by their sizes."""
    sizes = [646, 555, 150]
    means = {"discounted_price": [1461.13, 1023.28, 19686.5], "discount_percentage": [38.93, 59.79, 31.63],
             "rating": [4.2, 3.94, 4.18], "rating_count": [31196.15, 2780.22, 14107.8],
             "log_rating_count": [9.42, 6.7, 8.82], "log_discounted_price": [6.8, 6.31, 9.74]}
    overall = {f: float(np.average(v, weights=sizes)) for f, v in means.items()}
    rows = [(i, *[float(v[i]) for v in means.values()], *overall.values()) for i in range(3)]
    df = spark.createDataFrame(rows, "cluster int, " + ", ".join(f"mean_{f} double" for f in means)
                               + ", " + ", ".join(f"all_{f} double" for f in means))
    labels = [r[0] for r in df.orderBy("cluster").select(segments.segment_label(list(means))).collect()]
    assert labels[0] == "Average" and labels[2] == "High-Price / Low-Discount"
    # The rating gap of cluster 1 is at the threshold, and the means above are rounded.
    assert labels[1] in ("Low-Rating", "Average")
    tiers = [r[0] for r in spark.createDataFrame([("Average",), ("Low-Rating",), ("High-Price / Low-Discount",), ("Popular",)], "l string")
             .select(segments.tier(F.col("l"))).collect()]
    assert tiers == ["mainstream", "budget", "premium", None]


def test_composition_percentages(spark):
    """Known counts; percentages are rounded shares times 100."""
    counts = {0: [68, 169, 213, 162, 34], 1: [4, 17, 136, 244, 154], 2: [10, 68, 58, 13, 1]}
    percent = {0: [10.53, 26.16, 32.97, 25.08, 5.26], 1: [0.72, 3.06, 24.5, 43.96, 27.75], 2: [6.67, 45.33, 38.67, 8.67, 0.67]}
    inside = [5.0, 20.0, 40.0, 60.0, 90.0]
    rows = [(c, inside[i]) for c, ns in counts.items() for i, n in enumerate(ns) for _ in range(n)]
    df = spark.createDataFrame(rows, "cluster int, discount_percentage double")
    got = segments.band_composition(df).collect()
    labels = ["0-10%", "10-30%", "30-50%", "50-70%", "70-100%"]
    for r in got:
        i = labels.index(r["discount_band"])
        assert r["count"] == counts[r["cluster"]][i]
        assert r["pct_in_cluster"] == pytest.approx(percent[r["cluster"]][i], abs=1e-9)


@pytest.mark.parametrize("rows_per_block", [1000, 7])
def test_euclidean_silhouette(spark, rows_per_block):
    rng = np.random.default_rng(2)
    points = np.vstack([rng.normal(0, 1, (20, 2)), rng.normal(4, 1, (25, 2)), [[9, 9]]])
    points = np.vstack([points, points[:3]])
    labels = np.array([0] * 20 + [1] * 25 + [2] + [0] * 3)
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    scores = []
    for i, own in enumerate(labels):
        if (labels == own).sum() == 1:
            scores.append(0.0)
            continue
        a = gaps[i, labels == own].sum() / ((labels == own).sum() - 1)
        b = min(gaps[i, labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    df = spark.createDataFrame([(int(c), [float(v) for v in p]) for c, p in zip(labels, points)], "cluster int, features array<double>")
    got = segments.silhouette_euclidean(df, rows_per_block=rows_per_block).first()["silhouette"]
    assert got == pytest.approx(float(np.mean(scores)), abs=1e-12)


def test_segmentation_end_to_end(spark, catalog, tmp_path):
    result = segment_catalog(catalog, ks=range(2, 5), sweep_restarts=2, restarts=3, k=3)
    sweep = [r["inertia"] for r in result.sweep.orderBy("k").collect()]
    assert sweep == sorted(sweep, reverse=True)
    sizes = {r["cluster"]: r["size"] for r in result.tables["cluster_sizes"].collect()}
    assert sizes == {0: 180, 1: 120, 2: 60}
    prices = {r["cluster"]: r["avg_price"] for r in result.tables["cluster_summary"].collect()}
    assert prices[2] > prices[1] > prices[0]
    variance = [r["explained"] for r in result.tables["pca_variance"].collect()]
    assert 0 < variance[1] <= variance[0] and sum(variance) <= 1 + 1e-9
    for name, table in result.tables.items():
        assert table.count() > 0, name

    vectors = segments.scaled_vectors(catalog)
    assigned = [(np.array(r["features"].toArray()), r["cluster"]) for r in result.fit.model.transform(vectors).collect()]
    centres = np.array(result.fit.model.clusterCenters())
    gaps = np.array([((centres - p) ** 2).sum(1) for p, _ in assigned])
    assert [int(g.argmin()) for g in gaps] == [c for _, c in assigned]
    assert gaps.min(1).sum() == pytest.approx(result.fit.cost)

    own = segments.silhouette_squared(segments.zscore(result.products, SEGMENT_FEATURES), [f + "_z" for f in SEGMENT_FEATURES])
    assert own.first()["silhouette"] == pytest.approx(segments.silhouette(result.fit.model.transform(vectors)), abs=1e-6)

    write_model(result.fit.model, segments.scaling_parameters(catalog), str(tmp_path / "model"))
    model, parameters = read_model(spark, str(tmp_path / "model"))
    assert np.allclose(model.clusterCenters(), centres)
    few = segments.scale_with(catalog.where("product_id in ('p1', 'p5')"), parameters)
    whole = {r["product_id"]: r["features"] for r in vectors.collect()}
    assert all(np.allclose(r["features"].toArray(), whole[r["product_id"]].toArray()) for r in few.collect())
    near = segments.representatives(vectors, result.fit.model, 2).collect()
    assert len(near) == 6 and all(r["distance"] >= 0 for r in near)


def test_sweep_names_its_metric_and_gives_both(spark):
    rows = [(f"p{i}", Vectors.dense([float(i % 2) * 10 + (i % 5) * 0.1, float(i % 3)])) for i in range(60)]
    vectors = spark.createDataFrame(rows, ["product_id", "features"]).cache()
    both = segments.sweep_k(vectors, [2, 3], restarts=2, metric="both").collect()
    assert [r["metric"] for r in both] == ["squared_euclidean"] * 2
    plain = {r["k"]: r for r in segments.sweep_k(vectors, [2, 3], restarts=2, metric="euclidean").collect()}
    for r in both:
        assert plain[r["k"]]["metric"] == "euclidean"
        assert r["silhouette_euclidean"] == pytest.approx(plain[r["k"]]["silhouette"], abs=1e-9)
        assert r["silhouette"] > r["silhouette_euclidean"]
    vectors.unpersist()


def test_blocks_do_not_change_the_plain_silhouette(spark):
    rows = [(i % 3, [float(i % 3) * 4 + (i * 37 % 11) / 7, float(i * 13 % 5)]) for i in range(90)]
    df = spark.createDataFrame(rows, "cluster int, features array<double>")
    one, many = (segments.silhouette_euclidean(df, rows_per_block=n).first()[0] for n in (1000, 17))
    x, c = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    scores = []
    for i in range(len(x)):
        a = d[i][c == c[i]].sum() / ((c == c[i]).sum() - 1)
        b = min(d[i][c == k].mean() for k in set(c) - {c[i]})
        scores.append((b - a) / max(a, b))
    assert one == pytest.approx(np.mean(scores), abs=1e-9) and many == pytest.approx(one, abs=1e-9)


def test_released_tables_are_gone(spark, monkeypatch):
    monkeypatch.setattr(session, "_written", {})
    df = session.materialize(spark.range(5), "short-lived")
    path = df.inputFiles()[0]
    assert df.count() == 5 and session.release(spark) == 1 and session.release(spark) == 0
    with pytest.raises(Exception):
        spark.read.schema("id long").parquet(path).count()


def _highest_job(spark):
    return max(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_fits_of_many_seeds_share_their_passes(spark):
    random = np.random.default_rng(5)
    points = np.concatenate([random.normal(c, 1.0, (300, 2)) for c in (1e6, 1e6 + 8, 1e6 + 30)])
    vectors = spark.createDataFrame([(Vectors.dense(p),) for p in points], ["features"]).repartition(4).cache()
    vectors.count()
    start = _highest_job(spark)
    fits = segments.train_many(vectors, 3, list(range(24)), tol=0.0)
    assert _highest_job(spark) - start < 24 * 4
    for fit in fits:
        centres = np.array(fit.centres)
        gaps = ((points[:, None] - centres) ** 2).sum(axis=2)
        assert fit.cost == pytest.approx(gaps.min(axis=1).sum(), rel=1e-9)
        for i, c in enumerate(centres):
            assert c == pytest.approx(points[gaps.argmin(axis=1) == i].mean(axis=0), abs=1e-8)
    best = min(fits, key=lambda f: f.cost)
    assert sorted(map(tuple, best.model.clusterCenters())) == sorted(best.centres)


def _plain_sums(x, sets):
    """The nearest centre of each row, looked up row by row."""
    ends, every = np.cumsum([len(c) for c in sets]), np.concatenate(sets)
    total = np.zeros((len(every), x.shape[1] + 2))
    for lo in range(0, len(x), 970):
        rows = x[lo:lo + 970]
        score = (every ** 2).sum(axis=1) - 2.0 * (rows @ every.T)
        mine = np.zeros_like(score)
        for stop, centres in zip(ends, sets):
            nearest = score[:, stop - len(centres):stop].argmin(axis=1)
            mine[np.arange(len(rows)), stop - len(centres) + nearest] = 1.0
            gaps = ((rows - centres[nearest]) ** 2).sum(axis=1)
            total[stop - len(centres):stop, -1] += np.bincount(nearest, gaps, len(centres))
        total[:, :-2] += mine.T @ rows
        total[:, -2] += mine.sum(axis=0)
    return total


def test_pass_adds_up_whole_lines(spark):
    random = np.random.default_rng(3)
    x = np.concatenate([random.normal(size=(30_000, 6)), np.zeros((50, 6))])
    # The zero rows lie as near to one centre of the last set as to the other.
    sets = [*[random.normal(size=(k, 6)) for k in range(2, 11) for _ in range(10)], np.array([[1.0] * 6, [-1.0] * 6])]
    packed = spark.createDataFrame([(bytearray(x[i:i + 10_000].tobytes()),) for i in range(0, len(x), 10_000)], "block binary").coalesce(1)
    plain = _plain_sums(x, sets)
    assert np.allclose(lloyd._pass(packed, sets, np.zeros(6), True), plain, rtol=1e-9, atol=1e-6)
    assert np.allclose(lloyd._pass(packed, sets, np.zeros(6), False)[:, :-1], plain[:, :-1], rtol=1e-9, atol=1e-6)

    def seconds(run):
        starts = []
        for _ in range(3):
            start = time.process_time()
            run()
            starts.append(time.process_time() - start)
        return min(starts)

    assert seconds(lambda: lloyd._sums(x, sets, False)) < 0.7 * seconds(lambda: _plain_sums(x, sets))


def test_fits_of_fewer_points_than_centres(spark):
    vectors = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 5 + [(Vectors.dense([3.0, 2.0]),)], ["features"])
    fit = segments.train_kmeans(vectors, 4, restarts=2)
    assert fit.cost == 0 and sorted(map(tuple, fit.model.clusterCenters())) == [(1.0, 2.0), (3.0, 2.0)]
    with pytest.raises(Exception, match="finite"):
        segments.train_kmeans(spark.createDataFrame([(Vectors.dense([float("nan")]),)], ["features"]), 2, restarts=1)
