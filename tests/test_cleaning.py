import math

import pytest
from pyspark.sql import functions as F

from shelfline.functions import parsing
from shelfline.operators import cleaning, features, quality
from shelfline.plans.catalog import clean_catalog, deduplicate
from shelfline.schema import CLEAN_SCHEMA, RAW_COLUMNS
from shelfline.sources.listings import LISTING_ORDER, read_first_listings, read_listings


def values(spark, rows, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


@pytest.mark.parametrize("parser, text, expected", [
    ("parse_price", "₹1,899", 1899.0), ("parse_price", "399", 399.0), ("parse_price", "", None),
    ("parse_price", None, None), ("parse_price", "|", None), ("parse_price", "abc", None),
    ("parse_price", "nan", None), ("parse_price", "4d", None), ("parse_price", "1e3", 1000.0),
    ("parse_price", "1e999", None), ("parse_price", " ₹1,00 ", 100.0), ("parse_price", ".5", 0.5),
    ("parse_percent", "64%", 64.0), ("parse_percent", "12.5%", 12.5),
    ("parse_count", "24,269", 24269.0), ("parse_count", "100", 100.0),
    ("parse_rating", " 4.2 ", 4.2), ("parse_rating", " 4.2\t", 4.2), ("parse_rating", "5.1", None),
    ("parse_rating", "-1", None), ("parse_rating", "0", 0.0), ("parse_rating", "5", 5.0),
])
def test_parsers(spark, parser, text, expected):
    assert values(spark, [text], getattr(parsing, parser)("v")) == [expected]


def test_category_levels(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "A"), (4, "A|B|C|D|E|F"), (5, "A||B")], "i int, category string")
    rows = {r["i"]: r for r in features.add_category_levels(df).collect()}
    assert [rows[i]["category_depth"] for i in range(1, 6)] == [0, 0, 1, 6, 3]
    assert rows[1]["main_category"] is None and rows[3]["sub_category"] is None
    assert rows[4]["level_5"] == "E" and rows[5]["sub_category"] == ""


def test_review_lists(spark):
    texts = [None, "", "a", "a,,b", " , ", "ab, c"]
    assert values(spark, texts, parsing.list_size("v")) == [0, 0, 1, 3, 2, 2]
    assert values(spark, texts, parsing.mean_part_length("v")) == [0.0, 0.0, 1.0, 1.0, 0.0, 1.5]


def test_bands(spark):
    given = [-1.0, 0.0, 10.0, 10.01, 30.0, 50.0, 70.0, 100.0, 100.1, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, discount_percentage double")
    rows = features.add_discount_band(df).orderBy("i").collect()
    assert [r["discount_band"] for r in rows] == [
        None, "0-10%", "0-10%", "10-30%", "10-30%", "30-50%", "50-70%", "70-100%", None, None]
    assert [r["discount_band_ord"] for r in rows] == [None, 0, 0, 1, 1, 2, 3, 4, None, None]


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_keep_first_at_any_layout(spark, partitions):
    rows = [(f"p{i % 7}", i, i * 10) for i in range(500)]
    df = spark.createDataFrame(rows, "id string, ord int, v int").repartition(partitions)
    kept = sorted(tuple(r) for r in cleaning.keep_first(df, "id", ["ord"]).collect())
    assert kept == [(f"p{i}", i, i * 10) for i in range(7)]


def test_keep_first_needs_an_order(spark):
    with pytest.raises(ValueError):
        cleaning.keep_first(spark.range(3), "id", [])


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as o")
    plan = cleaning.keep_first(df, "k", ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_deduplicate_parses_only_rows_tied_in_first_place(spark):
    rows = [("a", 2, "1"), ("a", 1, "10"), ("a", 1, "9"), ("b", None, "3"), ("b", 5, "x"), ("c", None, "7"), ("c", None, "5")]
    raw = spark.createDataFrame(rows, "product_id string, ord int, actual_price string")
    found = deduplicate(raw, ["ord", "actual_price"])
    assert sorted(map(tuple, found.collect())) == [("a", 1, 9.0), ("b", 5, None), ("c", None, 5.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("regexp_extract") < plan.rindex("WindowGroupLimit")


def test_first_listings_are_those_of_all(spark, folder):
    first, every = (deduplicate(read(spark, folder), LISTING_ORDER) for read in (read_first_listings, read_listings))
    assert first.exceptAll(every).isEmpty() and every.exceptAll(first).isEmpty()


def test_duplicates(spark):
    rows = [("a", 1), ("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)]
    df = spark.createDataFrame(rows, "product_id string, v int")
    row = quality.duplicate_profile(df).first()
    assert row["exact_duplicate_rows"] == 5 and row["exact_duplicate_groups"] == 2
    assert row["repeated_product_ids"] == 1 and row["unique_product_ids"] == 2
    assert row["rows_with_repeated_ids"] == 6 and row["max_rows_per_product_id"] == 4
    removed = cleaning.duplicate_removal(df, "product_id").first()
    assert (removed["removed_exact"], removed["removed_repeated_ids"], removed["final_rows"]) == (3, 1, 3)


def test_median_imputation(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 4.0, None), (3, None, None)], "i int, a double, b double")
    rows = {r["i"]: r for r in cleaning.impute_median(df, ["a", "b"]).collect()}
    assert rows[3]["a"] == 2.5 and rows[3]["b"] is None


def test_whole_cleaning_plan(spark):
    base = {c: "x" for c in RAW_COLUMNS}
    base |= {"category": "A|B", "discounted_price": "₹1,000", "actual_price": "₹2,000", "discount_percentage": "50%",
             "rating": "4.0", "rating_count": "9", "review_id": "r1,r2", "review_content": "good, bad"}
    rows = [{**base, "product_id": "p1", "ord": 1}, {**base, "product_id": "p1", "ord": 2},
            {**base, "product_id": "p2", "actual_price": "₹0", "rating": "|", "ord": 3}]
    raw = spark.createDataFrame([tuple(r[c] for c in [*RAW_COLUMNS, "ord"]) for r in rows],
                                ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", ord int")
    out = clean_catalog(raw, ["ord"])
    assert [f.name for f in CLEAN_SCHEMA] == [c for c in out.columns if c != "ord"]
    assert [f.dataType for f in CLEAN_SCHEMA] == [f.dataType for f in out.schema if f.name != "ord"]
    by_id = {r["product_id"]: r for r in out.collect()}
    assert len(by_id) == 2 and by_id["p2"]["rating"] == 4.0 and by_id["p2"]["price_ratio"] is None
    assert by_id["p1"]["price_ratio"] == 0.5 and by_id["p1"]["is_heavily_discounted"] is True
    assert math.isclose(by_id["p1"]["log_rating_count"], math.log(10))
    assert by_id["p1"]["avg_review_length"] == 3.5 and by_id["p1"]["review_count_parsed"] == 2


def test_row_operators_accept_streams(spark, tmp_path):
    spark.createDataFrame([("₹5", "₹10", "50%", "4", "1")],
                          "discounted_price string, actual_price string, discount_percentage string, rating string, rating_count string"
                          ).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = features.add_discount_band(cleaning.parse_measures(stream))
    query = out.writeStream.format("memory").queryName("parsed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r["discount_band"] for r in spark.table("parsed").collect()] == ["30-50%"]


def test_missing_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    rows = {r["column"]: r for r in quality.missing_values(df).collect()}
    assert rows["b"]["missing"] == 2 and rows["b"]["missing_pct"] == 66.67
    assert quality.total_missing(df).first()[0] == 3
    assert quality.numeric_columns(df.withColumn("c", F.lit(True)), ["a", "b", "c", "zz"]) == ["a", "c"]


def test_sifted_rows_hold_all_first_ones_and_few_others(spark):
    # Blocks of neighbouring keys have orders of their own, as keys made one after the other do.
    random_order = F.floor(F.rand(7) * 1000).cast("long")
    rows = spark.range(60_000).select((F.col("id") % 2000).alias("k"), (random_order + F.floor(F.col("id") % 2000 / 100) * 10_000).alias("o"), "id")
    odd = spark.createDataFrame([(None, 5, -1), (None, 5, -2), (None, 6, -3), (-9, None, -4), (-9, None, -5), (-8, None, -6), (-8, 3, -7)], "k long, o long, id long")
    df = rows.union(odd).cache()
    for bounds in (1, 400, 1 << 18):
        left = cleaning.sift_first(df, "k", "o", bounds)
        assert left.columns == df.columns
        ids = lambda kept: sorted(r["id"] for r in cleaning.keep_ties(kept, "k", ["o"]).collect())
        assert ids(left) == ids(df)
    assert cleaning.sift_first(df, "k", "o", 400).count() < 0.25 * df.count()
    assert cleaning.sift_first(df.where("false"), "k", "o").isEmpty()
    assert cleaning.sift_first(df.where("id < 0 and k = -8"), "k", "o").count() == 1


def test_first_listings_are_sifted_before_the_sort(spark, folder):
    plan = read_first_listings(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "_bound" in plan.split("Window")[-1]
