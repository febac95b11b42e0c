import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.operators import association, charts, sampling
from shelfline.operators import quantile_summaries as qs


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    n = 4000
    group = rng.choice(list("abc"), n, p=[0.7, 0.2, 0.1])
    band = rng.choice(["x", "y"], n)
    value = np.where(rng.random(n) < 0.3, 7.0, np.round(rng.lognormal(3, 1.5, n), 2)) - 5
    other = np.round(value + rng.normal(0, 30, n), 1)
    rows = [(f"P{i}", g, b, float(v), None if i % 50 == 0 else float(w)) for i, (g, b, v, w) in enumerate(zip(group, band, value, other))]
    rows += [("Q1", None, "x", 1.0, 1.0), ("Q2", "a", None, 1.0, 1.0), (None, "a", "x", None, None)]
    df = spark.createDataFrame(rows, "product_id string, g string, b string, v double, w double").cache()
    yield df
    df.unpersist()


def held(df, column, where=lambda r: True):
    return np.sort([r[column] for r in df.collect() if r[column] is not None and where(r)])


def check(row, values, probabilities):
    assert row["n"] == len(values)
    for p, q in zip(probabilities, row["q"]):
        rank = math.floor((len(values) - 1) * p)
        low, high = np.searchsorted(values, q, "left"), np.searchsorted(values, q, "right") - 1
        # Of the ranks that the value has, one lies from the wanted rank to `error` above it... or it is exact.
        assert low <= rank + row["error"] and high >= rank, (p, q, rank, low, high, row["error"])


P = [0.0, 0.01, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]


@pytest.mark.parametrize("resolution", [5, 10_000])
def test_merged_summaries_keep_their_error(numbers, resolution):
    stored = qs.quantile_summaries(numbers, ["v", "w"], ["g", "b"], resolution).cache()
    some = stored.where("g in ('a', 'c') and b = 'x'")
    chosen = lambda r: r["g"] in ("a", "c") and r["b"] == "x"
    for r in qs.summary_quantiles(some, P).collect():
        values = held(numbers, r["column"], chosen)
        check(r, values, P)
        assert r["error"] <= len(values) / resolution + 2
        if resolution == 10_000:
            assert r["error"] == 0 and r["q"] == [values[math.floor((len(values) - 1) * p)] for p in P]
    coarse = qs.merge_summaries(stored, ["g"], resolution)
    for r in qs.summary_quantiles(coarse, P, ["g"]).collect():
        check(r, held(numbers, r["column"], lambda x, g=r["g"]: x["g"] == g and x["b"]), P)
    for r in stored.collect():
        assert sum(p["weight"] for p in r["points"]) == r["n"] and len(r["points"]) <= resolution + 1


def test_order_of_merging_has_no_effect(numbers):
    stored = qs.quantile_summaries(numbers, ["v"], ["g", "b"], 20).cache()
    a = qs.summary_quantiles(stored.orderBy("n"), P).collect()
    b = qs.summary_quantiles(stored.where("g='a'").union(stored.where("g<>'a'")).repartition(5), P).collect()
    stored.unpersist()
    assert a == b
    assert qs.quantile_summaries(numbers.where("false"), ["v"], ["g"]).isEmpty()


def test_binned_density_is_near_the_exact_one(numbers):
    exact = {(r["column"], r["point"]): r for r in charts.kde(numbers, ["v", "w"], 100).collect()}
    got = charts.kde_binned(numbers, ["v", "w"], 100).collect()
    assert len(got) == len(exact)
    for c in ("v", "w"):
        peak = max(r["density"] for (k, _), r in exact.items() if k == c)
        for r in got:
            if r["column"] == c:
                assert r["x"] == pytest.approx(exact[c, r["point"]]["x"])
                assert abs(r["density"] - exact[c, r["point"]]["density"]) < 1e-3 * peak
    grouped = charts.kde_binned(numbers, ["v"], 20, ["g"], cut=2.0).collect()
    assert len(grouped) == 60 and charts.kde_binned(numbers.where("v = 1"), ["v"]).isEmpty()


def test_bins_do_not_grow_with_the_values(spark):
    plan = charts.kde_binned(spark.range(1000).selectExpr("id / 7.0 AS v"), ["v"], 10)
    assert plan.count() == 10 and plan.agg(F.sum("density")).first()[0] > 0


def test_samples_repeat_merge_and_weigh(numbers):
    one = sampling.public(sampling.priority_sample(numbers, 100))
    rows = sorted(map(str, one.collect()))
    assert len(rows) == 100 and rows == sorted(map(str, sampling.public(sampling.priority_sample(numbers.repartition(11), 100)).collect()))
    parts = [sampling.priority_sample(numbers.where(c), 100) for c in ("b = 'x'", "b = 'y'", "b is null")]
    assert sorted(map(str, sampling.public(sampling.merge_samples(parts, 100)).collect())) == rows
    total = one.agg(F.sum("estimate")).first()[0]
    assert total == pytest.approx(4002, rel=0.3)
    small = sampling.priority_sample(numbers.where("g = 'c'"), 10_000)
    assert small.agg(F.sum("estimate")).first()[0] == small.count() == numbers.where("g = 'c'").count()
    groups = sampling.priority_sample(numbers, 30, by=["g"]).groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in groups} == {"a": 30, "b": 30, "c": 30, None: 1}


def test_weighted_sums_are_estimated_without_bias(numbers):
    true = numbers.where("v > 0 and product_id is not null").agg(F.sum("v")).first()[0]
    found = [sampling.priority_sample(numbers, 200, weight="v", seed=s).agg(F.sum("estimate")).first()[0] for s in range(6)]
    assert np.mean(found) == pytest.approx(true, rel=0.08)


def test_panels_share_one_sample(numbers):
    panels = sampling.scatter_panels(numbers.withColumn("u", F.col("v") * 2), 50, ["v", "w", "u"], hue="g").collect()
    ids = {(r["x"], r["y"]): {p["product_id"] for p in panels if (p["x"], p["y"]) == (r["x"], r["y"])} for r in panels}
    assert len(ids) == 3 and len(ids["v", "u"]) == 50 and ids["v", "w"] <= ids["v", "u"]


def test_sampled_kendall(numbers):
    exact = {(r["row"], r["col"]): r["value"] for r in association.correlation(numbers, ["v", "w"], "kendall").collect()}["v", "w"]
    r = association.kendall_sampled(numbers.where("v is not null and w is not null"), ["v", "w"], rows=10_000, block=10_000).first()
    assert r["value"] == pytest.approx(exact, abs=1e-12) and r["std_error"] == 0
    held_ = 0
    for seed in range(4):
        r = association.kendall_sampled(numbers, ["v", "w"], rows=1000, block=50, seed=seed).first()
        assert r["sampled"] == 1000 and 0 < r["std_error"] < 0.05
        held_ += r["low"] <= exact <= r["high"]
    assert held_ >= 3
    flat = association.kendall_sampled(numbers.withColumn("z", F.lit(1.0)), ["v", "z"], rows=100).first()
    assert flat["value"] is None


def test_samples_send_little_more_than_their_rows(spark):
    df = spark.range(40_000).select(F.col("id").alias("product_id"), F.when(F.col("id") < 30_000, F.lit(None)).otherwise(F.col("id") % 3).alias("g"),
                                    (F.col("id") % 50).cast("double").alias("w"))
    weights = F.when(F.col("product_id") == 7, float("inf")).when(F.col("product_id") == 8, float("nan")).otherwise(F.col("w"))
    for by in ([], ["g"]):
        rows = df.withColumn("w", weights).where("w > 0").withColumn("priority", F.col("w") / sampling.hashed_unit("product_id", 42))
        few = sampling._promising(rows, 200, by)
        groups = few.groupBy(*by).count().collect()
        assert len(groups) == (4 if by else 1) and all(201 <= r["count"] <= 260 for r in groups)
        got = sampling.priority_sample(df.withColumn("w", weights), 200, weight="w", by=by)
        best = rows.toPandas().sort_values(["priority", "product_id"], ascending=[False, True], na_position="first")
        expected = best.groupby(by, dropna=False).head(200) if by else best.head(200)
        assert sorted(r["product_id"] for r in got.collect()) == sorted(expected.product_id)
    assert sampling.priority_sample(df.where("false"), 5).collect() == []
