import glob

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfline.functions.numeric import counted_join
from shelfline.operators import encoding, filters, search_index, validation
from shelfline.plans import segment_pipeline
from shelfline.sources import layout


def test_dictionary_codes_by_falling_count(spark, tmp_path):
    words = ["b"] * 5 + ["a"] * 5 + ["zz"] * 9 + ["c"] + [None] * 3 + [f"w{i}" for i in range(50)]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, code int").repartition(6)
    found = encoding.fit_dictionary(df, "word")
    order = sorted(set(words) - {None}, key=lambda w: (-words.count(w), w))
    assert {r["value"]: r["code"] for r in found.collect()} == {w: i for i, w in enumerate(order)}
    assert encoding.fit_dictionary(df, "word", 5).count() == 3
    encoding.write_dictionary(found, f"{tmp_path}/d")
    again = encoding.read_dictionary(spark, f"{tmp_path}/d")
    more = df.union(spark.createDataFrame([("unseen", 99)], df.schema))
    got = encoding.one_hot(encoding.encode(more, "word", again), "word_code", len(order)).collect()
    assert len(got) == len(words) + 1
    for r in got:
        code = order.index(r["word"]) if r["word"] in order else len(order)
        assert r["word_code"] == code
        assert (r["word_code_vector"].size, list(r["word_code_vector"].indices), list(r["word_code_vector"].values)) == (len(order) + 1, [code], [1.0])
    empty = encoding.fit_dictionary(df.where("false"), "word")
    assert empty.isEmpty() and {r["word_code"] for r in encoding.encode(df, "word", empty).collect()} == {0}


@pytest.mark.parametrize("hot_keys", [1, 4, 1000])
def test_counted_join_keeps_rows(spark, hot_keys):
    rows = spark.createDataFrame([(k, i) for k in "abcd" for i in range(1 + 60 * (k == "b"))] + [(None, 0), ("x", 1)], "k string, i int")
    facts = rows.where("k <> 'x'").groupBy("k").agg(F.count("*").alias("n"))
    got = sorted(map(str, counted_join(rows, facts, "k", "n", hot_keys, "left").collect()))
    assert got == sorted(map(str, rows.join(facts, "k", "left").collect()))
    assert counted_join(rows, facts, "k", "n", hot_keys).count() == rows.where("k <> 'x'").count()


def test_validation_beside_a_write(spark, tmp_path):
    rows = [(f"P{i}", 10.0 * i, 100.0, None if i % 7 == 0 else "x") for i in range(30)]
    df = spark.createDataFrame(rows, "product_id string, price double, most double, name string")
    rules = [validation.within("price", 0, 250), validation.at_most("price", "most"), validation.not_null("name"),
             validation.one_of("name", ["x"]), validation.Constraint("strict", "name = 'x'", strict=True), validation.matches("product_id", "^P")]
    got = {r["constraint"]: r for r in validation.validated_write(df, f"{tmp_path}/t", rules).collect()}
    assert [got[r.name]["failed"] for r in rules] == [4, 19, 5, 0, 5, 0] and all(r["rows"] == 30 for r in got.values())
    assert spark.read.parquet(f"{tmp_path}/t").count() == 30
    for r in got.values():
        assert len(r["witnesses"]) <= 3 and bool(r["witnesses"]) == (r["failed"] > 0) and r["passed"] == (r["failed"] == 0)
    assert set(got["price from 0 to 250"]["witnesses"]) <= {"P26", "P27", "P28", "P29"}
    watched, _ = validation.observed(df, rules)
    plan = watched._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CollectMetrics") == 1 and plan.count("LogicalRDD") == 1
    empty = validation.validated_write(df.where("false"), f"{tmp_path}/e", rules)
    assert {r["failed"] for r in empty.collect()} == {0}


def test_pipeline_is_saved_as_a_whole(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(f"P{i}", None if i % 9 == 0 else float(x), float(y), 3.0) for i, (x, y) in enumerate(
        np.vstack([rng.normal(c, 1, (60, 2)) for c in ((0, 0), (9, 9), (0, 20))]))]
    df = spark.createDataFrame(rows, "product_id string, a double, b double, c double").cache()
    model = segment_pipeline.fit_segments(df, 3, ["a", "b", "c"], restarts=3)
    segment_pipeline.save_segments(model, f"{tmp_path}/m")
    loaded = segment_pipeline.load_segments(f"{tmp_path}/m")
    first, second = (segment_pipeline.place_products(m, df).select("product_id", "cluster").collect() for m in (model, loaded))
    assert sorted(first) == sorted(second) and len({r["cluster"] for r in first}) == 3
    assert loaded.stages[0].getOrDefault("medians")[0] == pytest.approx(np.median([r[1] for r in rows if r[1] is not None]))
    one = df.where("product_id = 'P5'")
    assert segment_pipeline.place_products(loaded, one).first()["cluster"] == dict(first)["P5"]
    plain = segment_pipeline.segment_pipeline(2, ["a", "b"]).fit(df).transform(df)
    stats = plain.agg(F.avg("a_z"), F.stddev_pop("a_z")).first()
    assert tuple(stats) == pytest.approx((0, 1), abs=1e-9)
    with pytest.raises(ValueError, match="no median"):
        segment_pipeline.segment_pipeline(2, ["a"]).fit(df.withColumn("a", F.lit(None).cast("double")))
    df.unpersist()


NAMES = ["Red Bolt ring", "RING of steel", "blue kſit", "Kelvin Kit", "İstanbul ring", "ısi bolt", "größe RED", "a.b*c ring", "ri", "", None,
         "thin gring", "ring ring ring", "Red.*ring"]


@pytest.mark.parametrize("term, literal", [
    ("ring", True), ("RING", True), ("ri", True), ("bolt r", True), ("a.b*c", True), ("zzzz", True), ("größe", True), ("istanbul", True), ("ring zz", True),
    ("ring", False), ("red.*ring", False), ("^ring", False), ("gr?ing", False), ("ring+s?", False), ("(bolt|steel)", False), ("bolt|kit", False),
    ("rings*", False), ("[rg]ing", False), ("ring{2}", False), ("kit\\b", False), ("ısi", False), ("skit", False), ("kelvin kit", False), ("rin\\w", False)])
def test_indexed_search_finds_what_the_scan_finds(spark, index, term, literal):
    df, path = index
    got = search_index.search_indexed(df, path, term, literal=literal).collect()
    assert sorted(map(str, got)) == sorted(map(str, filters.search_products(df, term, literal=literal).collect()))


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    df = spark.createDataFrame([(f"P{i}", n) for i, n in enumerate(NAMES * 3)], "product_id string, product_name string")
    path = str(tmp_path_factory.mktemp("index"))
    search_index.write_index(df, path)
    return df, path


def test_index_is_read_in_part(spark, index):
    df, path = index
    plan = search_index.search_indexed(df, path, "steel", literal=True)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "postings" in plan and "PushedFilters" in plan
    assert search_index.required_grams("a(bcd)?ring", False) == [] and search_index.required_grams("ab|ring", False) == []
    assert search_index.required_grams("abcd*e", False) == ["abc"]


def groups_read(path, price, discount):
    hit = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(at[c]).statistics for c in ("discounted_price", "discount_percentage")]
            total += 1
            hit += all(s.min <= high and s.max >= low for s, (low, high) in zip(stats, (price, discount)))
    return hit, total


def test_layout_lets_both_ranges_skip(spark, tmp_path):
    df = spark.range(40_000).select(F.concat(F.lit("P"), "id").alias("product_id"), (F.rand(1) * F.rand(2) * 1000).alias("discounted_price"),
                                    F.floor(F.rand(3) * 90).cast("double").alias("discount_percentage")).cache()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        layout.write_clustered(df, f"{tmp_path}/z")
        df.repartition(64).write.parquet(f"{tmp_path}/plain")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for price, discount in (((0, 20), (0, 100)), ((0, 1000), (80, 90)), ((100, 150), (30, 40))):
        hit, total = groups_read(f"{tmp_path}/z", price, discount)
        plain, every = groups_read(f"{tmp_path}/plain", price, discount)
        assert plain == every and total >= 60 and hit <= total / 3
        wanted = lambda x: x.where(F.col("discounted_price").between(*price) & F.col("discount_percentage").between(*discount))
        assert wanted(spark.read.parquet(f"{tmp_path}/z")).exceptAll(wanted(df)).isEmpty()
    assert spark.read.parquet(f"{tmp_path}/z").count() == 40_000
    hot = df.withColumn("discounted_price", F.when(F.col("discounted_price") < 300, 5.0).otherwise(F.col("discounted_price"))).withColumn(
        "discount_percentage", F.lit(None).cast("double"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = layout.clustered_layout(hot, ["discounted_price", "discount_percentage"])
        sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 40_000 and max(sizes) < 10_000
    df.unpersist()
