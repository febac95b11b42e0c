import math
import random

import pytest
from pyspark.sql import functions as F

from shelfline.operators import charts, recommend
from shelfline.operators.interval_topk import Order, interval_topk
from shelfline.plans.recommendation import save_batch
from shelfline.schema import STRATEGIES
from shelfline.sources.tables import read_recommendations

COLUMNS = "product_id string, main_category string, discounted_price double, rating double, rating_count double, cluster int"


def build(spark, n=400, seed=1):
    """Repeated price points, one category with most rows, null keys, prices at and below zero."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        price = rng.choice([99.0, 99.0, 199.0, 0.0, round(rng.lognormvariate(5, 1.5), 2), 150 + rng.random() / 1e4])
        rows.append((f"p{i:04d}", rng.choice(["A", "A", "A", "B", "C", None]), rng.choice([price] * 20 + [None, -5.0]),
                     rng.choice([3.0, 3.5, 3.7, 3.9, 4.0, 4.5, 5.0]), float(rng.randrange(50)), rng.choice([0, 1, None])))
    return rows, spark.createDataFrame(rows, COLUMNS)


def brute(rows, n):
    """Every strategy for every product, straight from the definitions."""
    fields = ["id", "cat", "price", "rating", "count", "cluster"]
    items = [dict(zip(fields, r)) for r in rows]
    out = set()
    for t in items:
        others = [c for c in items if c["id"] != t["id"]]
        priced = [c for c in others if c["price"] is not None and t["price"] is not None]
        same = [c for c in priced if c["cat"] == t["cat"] and t["cat"] is not None]
        p = t["price"]
        rules = {
            "cluster_based": ([c for c in others if c["cluster"] == t["cluster"] and t["cluster"] is not None],
                              lambda c: (-c["rating"], -c["count"])),
            "category_better_rated": ([c for c in same if c["rating"] >= t["rating"] + 0.2 and p * 0.5 <= c["price"] <= p * 1.5],
                                      lambda c: (-c["rating"], -c["count"])),
            "budget_alternative": ([c for c in same if c["rating"] >= 3.5 and c["price"] <= p * 0.7],
                                   lambda c: (-(c["rating"] / (c["price"] + 1)),)),
            "premium_upgrade": ([c for c in same if c["rating"] >= 4.0 and c["price"] >= p * 1.5],
                                lambda c: (-c["rating"], c["price"])),
            "price_range": ([c for c in priced if p * (1 - 0.3) <= c["price"] <= p * (1 + 0.3)], lambda c: (-c["rating"],)),
        }
        for name, (found, key) in rules.items():
            for rank, c in enumerate(sorted(found, key=lambda c: (key(c), c["id"]))[:n], 1):
                out.add((t["id"], c["id"], name, rank))
    return out


def edges(df):
    return {(r["product_id"], r["recommended_product_id"], r["strategy"], r["rank"]) for r in df.collect()}


def test_all_strategies_match_brute_force(spark):
    rows, df = build(spark)
    assert edges(recommend.recommend_all(df.cache(), 3)) == brute(rows, 3)


@pytest.mark.parametrize("partitions", [1, 17])
def test_result_does_not_depend_on_layout(spark, partitions):
    rows, df = build(spark, 150, 2)
    got = recommend.better_rated(df.repartition(partitions), 2).withColumn("strategy", F.lit("category_better_rated"))
    assert edges(got) == {e for e in brute(rows, 2) if e[2] == "category_better_rated"}


def test_one_product_agrees_with_the_batch(spark):
    rows, df = build(spark)
    for product in ("p0003", "p0017"):
        assert edges(recommend.recommend_for(df, product, 4)) == {e for e in brute(rows, 4) if e[0] == product}
    assert recommend.recommend_for(df, "unknown").count() == 0


def test_rating_step_follows_double_arithmetic(spark):
    df = spark.createDataFrame([("a", "A", 10.0, 3.7, 1.0, 0), ("b", "A", 10.0, 3.9, 1.0, 0)], COLUMNS)
    assert recommend.better_rated(df, 3).count() == 0


def test_single_product_has_no_recommendation(spark):
    df = spark.createDataFrame([("a", "A", 10.0, 4.0, 1.0, 0)], COLUMNS)
    assert recommend.recommend_all(df, 3).count() == 0


def test_plan_compares_no_pairs(spark):
    _, df = build(spark, 50)
    plan = recommend.premium_upgrades(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_dense_cell_and_hot_price(spark):
    """All prices within one cell, most of them equal."""
    rng = random.Random(5)
    rows = [(f"p{i:03d}", 100 + (rng.randrange(30) / 1e3 if i % 3 else 0.0), float(rng.randrange(9))) for i in range(200)]
    df = spark.createDataFrame(rows, "product_id string, discounted_price double, score double")
    targets = df.select(F.col("discounted_price").alias("target_price")).distinct().withColumn(
        "low", F.col("target_price") - 0.004).withColumn("high", F.col("target_price") + 0.0061)
    got = {r["target_price"]: [b["product_id"] for b in r["best"]]
           for r in interval_topk(df, targets, [], Order((("score", True),)), 4).collect()}
    for t in {r[1] for r in rows}:
        inside = [r for r in rows if t - 0.004 <= r[1] <= t + 0.0061]
        assert got[t] == [r[0] for r in sorted(inside, key=lambda r: (-r[2], r[0]))[:4]]


def test_combined_keeps_the_first_strategy(spark):
    _, df = build(spark, 120, 3)
    everything = recommend.recommend_all(df, 3).cache()
    first = {}
    for e in sorted(edges(everything), key=lambda e: STRATEGIES.index(e[2])):
        first.setdefault((e[0], e[1]), e)
    assert edges(recommend.combined(everything)) == set(first.values())


def test_combined_sorts_after_the_shuffle_only(spark):
    _, df = build(spark, 30, 3)
    everything = recommend.recommend_all(df, 3).localCheckpoint()
    plan = recommend.combined(everything)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "WindowGroupLimit" not in plan
    twice = recommend.combined(everything.union(everything))
    assert twice.count() == recommend.combined(everything).count()


def test_preferences(spark):
    _, df = build(spark, 200, 4)
    df = df.withColumns({"product_name": F.col("product_id"), "actual_price": F.col("discounted_price") * 2,
                         "discount_percentage": F.lit(50.0)})
    rows = recommend.by_preferences(df, "A", 500, 3.5, 10, 5).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
    assert all(r["main_category"] == "A" and r["discounted_price"] <= 500 and r["rating"] >= 3.5 for r in rows)
    assert recommend.by_preferences(df, min_discount=60).count() == 0
    for bad in ({"category": "nope"}, {"max_price": 0}, {"min_rating": 6}, {"min_discount": -1}, {"n": 0}):
        with pytest.raises(ValueError):
            recommend.by_preferences(df, **bad)


def test_saved_batch_reads_back(spark, tmp_path):
    rows, df = build(spark, 60, 6)
    save_batch(df, str(tmp_path / "recs"))
    assert edges(read_recommendations(spark, str(tmp_path / "recs"))) == brute(rows, 3)


def test_sample_per_cluster_repeats(spark):
    _, df = build(spark)
    a, b = (sorted(r["product_id"] for r in recommend.sample_per_cluster(d).collect()) for d in (df, df.repartition(9)))
    assert a == b and len(a) == 2


def test_large_sides_are_dealt_by_more_than_the_hot_key(spark):
    """With joins that can't broadcast, no product meets its category, cluster or price by that key alone."""
    df = spark.range(2000).select(F.concat(F.lit("p"), "id").alias("product_id"), F.lit("all").alias("main_category"), F.lit(0).alias("cluster"),
                                  F.when(F.col("id") % 10 > 0, 100.0).otherwise(F.col("id") + 1.0).alias("discounted_price"),
                                  (F.col("id") % 5).cast("double").alias("rating"), (F.col("id") % 7).cast("double").alias("rating_count"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        for rule, key in ((recommend.by_cluster, "cluster"), (recommend.by_category, "main_category"), (recommend.by_price_range, "target_price")):
            out = rule(df, 3)
            plan = out._jdf.queryExecution().executedPlan().toString()
            joins = [x for x in plan.split("\n") if "SortMergeJoin" in x]
            assert any("_salt#" in x for x in joins), (key, joins)
            assert out.count() > 5000
        for table in (charts.kde(df, ["rating"]), charts.box_stats(df, ["rating"])):
            plan = table._jdf.queryExecution().executedPlan().toString()
            assert any("_salt#" in x for x in plan.split("\n") if "SortMergeJoin" in x)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffled_rows(df):
    """Rows that the shuffles of a table wrote, each once."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "ReusedExchange":
            return 0
        own = node.metrics().get("shuffleRecordsWritten").get().value() if name == "Exchange" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))
    return walk(df._jdf.queryExecution().executedPlan())


def test_search_of_different_prices_shuffles_no_blocks_of_targets(spark):
    # 20,000 different prices in some 360 cells; a block for each target and level would be hundreds of thousands of rows.
    rng = random.Random(5)
    n = 20_000
    rows = [(f"p{i:05d}", "A", 100 + 300 * (i + rng.random()) / n, rng.choice([3.0, 4.0, 5.0]), float(rng.randrange(10**6)), 0) for i in range(n)]
    assert shuffled_rows(recommend.better_rated(spark.createDataFrame(rows, COLUMNS).cache(), 3)) < 20 * n


def test_candidates_that_improve_along_an_end_cell(spark):
    # The best candidates lie in the end cells, so nothing is sifted and places change at every step.
    for factor in (1.0, -1.0):
        rows = [(f"p{i:04d}", "A", round(100 + i / 1000, 3), 3.0 + factor * (i % 97) / 97, float(i), 0) for i in range(300)]
        rows += [(f"q{i:04d}", "A", round(49.9 + i / 1000, 3), 4.0 + factor * i / 1000, 1.0, 0) for i in range(300)]
        got = recommend.better_rated(spark.createDataFrame(rows, COLUMNS), 2).withColumn("strategy", F.lit("category_better_rated"))
        assert edges(got) == {e for e in brute(rows, 2) if e[2] == "category_better_rated"}


def test_narrow_and_open_intervals_with_infinite_and_unknown_prices(spark):
    nan, inf = float("nan"), float("inf")
    prices = [100.0, 100.001, 100.002, 100.003, 100.1, 0.0, -5.0, inf, -inf, nan, 1e30, 1e-9] * 3
    rng = random.Random(3)
    items = [(f"p{i:02d}", "A", p, float(rng.randrange(5)), 0.0, 0) for i, p in enumerate(prices)]
    asked = [(1.0, 100.0, 100.001), (2.0, 100.0005, 100.0025), (3.0, None, 100.001), (4.0, 100.002, None), (5.0, None, None),
             (6.0, -6.0, 0.0), (7.0, nan, nan), (8.0, 100.003, nan), (9.0, 100.0011, 100.0012), (10.0, 1e30, inf), (11.0, -inf, -5.0), (12.0, 99.0, 100.05)]
    above = lambda a, b: math.isnan(a) or (not math.isnan(b) and a >= b)  # NaN is the largest, as in Spark
    expected = {}
    for t, low, high in asked:
        low, high = -inf if low is None else low, inf if high is None else high
        inside = sorted((-r, i) for i, _, p, r, _, _ in items if above(p, low) and above(high, p))
        expected[t] = [i for _, i in inside[:4]]
    targets = spark.createDataFrame([("A", *a) for a in asked], "main_category string, target_price double, low double, high double")
    found = interval_topk(spark.createDataFrame(items, COLUMNS), targets, ["main_category"], Order((("rating", True),)), 4).collect()
    assert {r["target_price"]: [c["product_id"] for c in r["best"]] for r in found} == {t: e for t, e in expected.items() if e}
