import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import catalog_queries
from shelfline.functions.inversions import two_sided_p, weighted_inversions
from shelfline.functions.numeric import sized_join
from shelfline.operators import association as assoc
from shelfline.operators import charts, distribution, grouping, summary
from shelfline.operators.distribution import PREFIX_SHIFTS, quantiles, value_code, with_ranks


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        hot = rng.random() < 1 / 3
        rows.append((f"g{0 if rng.random() < .4 else rng.randrange(6)}",
                     100.0 if hot else round(rng.lognormvariate(6, 2), 2), float(rng.randrange(-3, 4)),
                     rng.gauss(0, 1) if rng.random() > .1 else None))
    return spark.createDataFrame(rows, "g string, a double, b double, c double")


@pytest.fixture(scope="module")
def frame(mixed):
    return mixed.toPandas()


def test_quantiles_match_numpy(mixed, frame):
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    rows = {r["column"]: r["q"] for r in distribution.grouped_quantiles(mixed, ["a", "b", "c"], ps).collect()}
    for c in "abc":
        assert rows[c] == pytest.approx(list(frame[c].quantile(ps)), rel=1e-12, abs=1e-12)


def test_grouped_quantiles_match_pandas(mixed, frame):
    rows = {(r["g"], r["column"]): r["q"][0] for r in distribution.grouped_quantiles(mixed, ["a", "c"], [0.5], ["g"]).collect()}
    expected = frame.groupby("g")[["a", "c"]].median()
    assert len(rows) == 2 * len(expected)
    for (g, c), v in rows.items():
        assert v == pytest.approx(expected.loc[g, c], rel=1e-12)


def test_ranks_match_sorting(mixed, frame):
    counts = distribution.value_counts(mixed, ["a", "b"])
    got = {(r["column"], r["value"]): (r["below"], r["n"]) for r in distribution.with_ranks(counts, ["column"]).collect()}
    for c in "ab":
        for v, n in frame[c].value_counts().items():
            assert got[(c, v)] == (int((frame[c] < v).sum()), n)


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(1, 4)), min_size=1, max_size=40))
def test_weighted_inversions(points):
    x, y, w = (np.array(v) for v in zip(*points))
    expected = sum(w[i] * w[j] for i in range(len(x)) for j in range(len(x)) if x[i] < x[j] and y[i] > y[j])
    assert weighted_inversions(x, y, w) == expected


def _tau_b(x, y):
    score = n_x = n_y = 0
    for i, j in itertools.combinations(range(len(x)), 2):
        dx, dy = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
        score, n_x, n_y = score + dx * dy, n_x + (dx != 0), n_y + (dy != 0)
    return score / math.sqrt(n_x * n_y)


def test_kendall_over_many_small_cells(spark):
    rng = random.Random(3)
    rows = [(float(rng.choice([1, 1, 1, rng.randrange(60)])), float(rng.choice([5, rng.randrange(40)]))) for _ in range(250)]
    df = spark.createDataFrame(rows, "x double, y double")
    expected = _tau_b(*[np.array(v) for v in zip(*rows)])
    # A small limit cuts cells again, several levels deep.
    for cells, smallest, limit in ((512, 4096, 10 ** 6), (8, 5, 10 ** 6), (3, 1, 10 ** 6), (3, 1, 8), (5, 4, 12)):
        got = assoc._kendall_pairs(df, [("x", "y")], cells, smallest, limit).first()["value"]
        assert got == pytest.approx(expected, abs=1e-12)


def test_spearman_ranks_pairwise(mixed, frame):
    got = {(r["row"], r["col"]): r["value"] for r in assoc.correlation(mixed, ["a", "b", "c"], "spearman").collect()}
    for a, b in itertools.permutations("abc", 2):
        both = frame[[a, b]].dropna().rank()
        assert got[(a, b)] == pytest.approx(both[a].corr(both[b]), abs=1e-12)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, y double")
    for method in ("pearson", "spearman", "kendall"):
        got = {(r["row"], r["col"]): r["value"] for r in assoc.correlation(df, ["x", "y"], method).collect()}
        assert got[("x", "x")] == 1.0 and got[("x", "y")] is None and got[("y", "y")] is None


def test_covariance_and_correlation_agree(mixed):
    cov = {(r["row"], r["col"]): r["value"] for r in assoc.covariance(mixed, ["a", "b"]).collect()}
    r = assoc.correlation_pairs(mixed, [("a", "b")]).first()["value"]
    assert r == pytest.approx(cov[("a", "b")] / math.sqrt(cov[("a", "a")] * cov[("b", "b")]))


@pytest.mark.parametrize("values", [[], [2.0], [1.0, 3.0], [1.0, 2.0, 4.0], [5.0] * 6])
def test_small_columns(spark, values):
    df = spark.createDataFrame([(v,) for v in values] or [(None,)], "v double")
    row = summary.summary_statistics(df, ["v"]).first()
    s = pd.Series(values, dtype="float64")
    assert row["Mean"] == (None if s.empty else pytest.approx(s.mean()))
    assert row["Minimum"] == (s.min() if len(s) >= 2 else None)
    assert row["Std_Deviation"] == (pytest.approx(s.std()) if len(s) >= 2 else None)
    if len(values) == 3:
        assert row["Skewness"] == pytest.approx(s.skew()) and row["Kurtosis"] == pytest.approx(-1.5)
    if len(values) < 3 or len(set(values)) == 1:
        assert row["Skewness"] is None or math.isclose(row["Skewness"], 0)


def test_mode_takes_the_smallest(spark):
    df = spark.createDataFrame([(v,) for v in (3.0, 1.0, 3.0, 1.0, 2.0)], "v double")
    assert summary.central_tendency(df, ["v"]).first()["Mode"] == 1.0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 4.0), (5.0, 4.0), (10.0, 4.0)], "v double, flat double")
    rows = charts.histogram(df, ["v", "flat"], 10).collect()
    got = {(r["column"], r["bin"]): r["count"] for r in rows}
    assert len(rows) == 20 and got[("v", 9)] == 1 and got[("v", 5)] == 1 and got[("v", 0)] == 1
    assert got[("flat", 5)] == 3
    area = sum(r["density"] * (r["high"] - r["low"]) for r in rows if r["column"] == "v")
    assert area == pytest.approx(1.0)


def test_density_matches_the_plain_formula(mixed, frame):
    got = [(r["x"], r["density"]) for r in charts.kde(mixed, ["c"], 50).orderBy("point").collect()]
    data = frame["c"].dropna().to_numpy()
    h = data.std(ddof=1) * len(data) ** -0.2
    for x, density in got:
        plain = np.exp(-0.5 * ((x - data) / h) ** 2).sum() / (len(data) * h * math.sqrt(2 * math.pi))
        assert density == pytest.approx(plain, rel=1e-9)


def test_p_value():
    # Student t, two-sided: t = 2.228 at 10 degrees of freedom is the 5 % point.
    t, df = 2.2281388519649385, 10
    r = t / math.sqrt(df + t * t)
    assert two_sided_p(r, df + 2) == pytest.approx(0.05, abs=1e-9)
    assert two_sided_p(0.0, 30) == pytest.approx(1.0) and two_sided_p(1.0, 30) == 0.0
    assert two_sided_p(0.5, 2) is None


def test_group_statistics_skip_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0), (None, 9.0), ("c", None)], "g string, v double")
    rows = {r["g"]: r for r in grouping.group_statistics(df, "g", ["v"]).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"]["v_median"] == 2.0 and rows["b"]["v_std"] is None
    assert rows["c"]["v_count"] == 0 and rows["c"]["v_mean"] is None
    with pytest.raises(ValueError):
        grouping.group_statistics(df, "missing", ["v"])


def test_codes_follow_the_order_of_doubles(spark):
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 1 << 64, 20_000, dtype=np.uint64).view(np.float64)
    near = [np.nextafter(2.0 ** k, to) for k in range(-1074, 1024, 7) for to in (0.0, np.inf)]
    edge = [0.0, -0.0, 5e-324, 2.0 ** -1022, float(np.nextafter(2.0 ** -1022, 0)), 1.7e308, float("inf"), 1.0, 0.1, 99.5, 1.7e12]
    values = np.unique(np.concatenate([bits[~np.isnan(bits)], near, [2.0 ** k for k in range(-1074, 1024)], edge, -np.array(edge)]))
    df = spark.createDataFrame([(float(v),) for v in values], "value double")
    got = np.array([r[0] for r in df.select(value_code(F.col("value"))).collect()])
    expected = np.abs(values).view(np.int64) * np.where(values < 0, -1, 1)
    assert (got == expected).all()


@pytest.mark.parametrize("low, step", [(1.7e12, 0.25), (99.5, 1e-9)])
def test_windows_stay_small_whatever_the_values(spark, low, step):
    counts = spark.range(1_000_000).select(F.lit("k").alias("column"), (F.lit(low) + F.col("id") * step).alias("value"),
                                           F.lit(1).cast("long").alias("n"))
    code = value_code(F.col("value"))
    widths = []
    for above, finer in zip([None, *PREFIX_SHIFTS], [*PREFIX_SHIFTS, 0]):
        outer = F.lit(0) if above is None else F.shiftright(code, above)
        sizes = counts.select(outer.alias("o"), F.shiftright(code, finer).alias("f")).distinct().groupBy("o").count()
        widths.append(sizes.agg(F.max("count")).first()[0])
    assert max(widths) <= 65_536
    got = with_ranks(counts, ["column"]).where("below in (0, 500000, 999999)").orderBy("below").collect()
    assert [r["below"] for r in got] == [0, 500_000, 999_999] and all(r["total"] == 1_000_000 for r in got)
    assert got[1]["value"] == low + 500_000 * step
    assert quantiles(counts, ["column"], [0.5]).first()["q"] == [low + 499_999 * step + (low + 500_000 * step - low - 499_999 * step) * 0.5]


def test_sized_join_cuts_hot_keys_only(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1500).alias("k"), F.col("id"))
    rows = rows.withColumn("k", F.when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.col("k")))
    facts = rows.where("k is not null and k <> 5").select("k").distinct().withColumn("fact", F.col("k") * 2)
    for how in ("inner", "left"):
        for hot_keys in (1000, 3):
            got = sized_join(rows, facts, ["k"], ["id"], how, hot_keys=hot_keys)
            assert sorted(map(str, got.select("k", "id", "fact").collect())) == sorted(
                map(str, rows.join(facts, "k", how).select("k", "id", "fact").collect()))
    told = sized_join(rows.limit(0), facts, ["k"], ["id"])
    assert told.columns == ["k", "id", "fact"] and told.collect() == []


def test_outliers_equal_to_six_places_are_one(spark):
    prices = [(1.0, 1.0)] * 20 + [(1.0, 100.1 - 50.05), (1.0, 200.2 - 150.15), (1.0, 50.05)]
    assert len({p for _, p in prices}) > 2
    df = spark.createDataFrame([("x", *p) for p in prices], "main_category string, discounted_price double, price_savings double")
    got = catalog_queries._outlier_counts(df, ["discounted_price", "price_savings"]).collect()
    assert [tuple(r) for r in got] == [("x", "price_savings", 50.05, 3)]
