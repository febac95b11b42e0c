import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.filters import search_products
from shelfline.operators.segments import canonical_clusters
from shelfline.plans.catalog import clean_catalog
from shelfline.plans.report import chart_data, manifest, statistical_report
from shelfline.schema import CLEAN_SCHEMA, MEASURES, RAW_COLUMNS
from shelfline.sources import tables

HEADER = ",".join(RAW_COLUMNS)


def line(i, **changes):
    row = {c: f"{c}{i}" for c in RAW_COLUMNS}
    row |= {"product_id": f"p{i}", "category": "A|B" if i % 2 else "C", "discounted_price": f"₹{100 * i + 50}", "actual_price": f"₹1,{i:03d}",
            "discount_percentage": f"{(i * 9) % 100}%", "rating": f"{3 + (i % 20) / 10:.1f}", "rating_count": f"{i * 37}"}
    row |= changes
    return ",".join('"' + row[c].replace('"', '""') + '"' for c in RAW_COLUMNS)


def raw_file(tmp_path, n=40):
    lines = [line(i) for i in range(n)] + [line(1, review_content='a "quoted", text\nover two lines', rating="|")]
    path = tmp_path / "raw.csv"
    path.write_text(HEADER + "\n" + "\n".join(lines) + "\n")
    return str(path)


def test_raw_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    df = tables.read_raw_catalog(spark, raw_file(tmp_path))
    assert df.count() == 41 and {f.dataType.typeName() for f in df.schema} == {"string"}
    assert df.where("rating = '|'").first()["review_content"] == 'a "quoted", text\nover two lines'


def test_clean_report_and_charts_from_a_file(spark, tmp_path):
    raw = tables.read_raw_catalog(spark, raw_file(tmp_path)).coalesce(1).withColumn("ord", F.monotonically_increasing_id())
    tables.write_catalog(clean_catalog(raw, ["ord"]).drop("ord"), str(tmp_path / "clean"))
    tables.write_catalog(tables.read_catalog(spark, str(tmp_path / "clean")), str(tmp_path / "clean_csv"), "csv")
    clean = tables.read_catalog(spark, str(tmp_path / "clean")).cache()
    assert clean.count() == 40 and len(clean.columns) == 34
    again = tables.read_catalog(spark, str(tmp_path / "clean_csv"), "csv")
    assert again.schema == CLEAN_SCHEMA and sorted(again.collect()) == sorted(clean.collect())

    report = statistical_report(clean)
    assert list(report) == ["summary", "correlation", "covariance", "group_by_category", "group_by_discount_band",
                            "pivot_category_discount", "pivot_category_rating"]
    tables.write_report(report, str(tmp_path / "stats"))
    schemas = {name: df.schema for name, df in report.items()} | {"never": report["summary"].schema}
    loaded = tables.read_report(spark, str(tmp_path / "stats"), schemas)
    assert loaded["never"].count() == 0 and loaded["summary"].count() == len(MEASURES)
    assert sorted(map(str, loaded["summary"].collect())) == sorted(map(str, report["summary"].collect()))

    charts = chart_data(clean)
    assert manifest(charts).count() == len(charts) == 27
    for name in ("histograms", "violin_density", "pivot_counts", "scatter_rating_vs_discounted_price_correlation"):
        assert charts[name].count() > 0, name


def test_clusters_are_looked_up_by_id(spark, tmp_path):
    clean = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "product_id string, discounted_price double")
    tables.write_catalog(clean, str(tmp_path / "c"))
    tables.write_segments(clean.where("product_id = 'a'").withColumn("cluster", F.lit(1)), str(tmp_path / "s"))
    got = tables.read_catalog_with_clusters(spark, str(tmp_path / "c"), str(tmp_path / "s"))
    assert {r["product_id"]: r["cluster"] for r in got.collect()} == {"a": 1, "b": None}


def small_schema(*names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def test_columns_are_read_by_name(spark, tmp_path):
    for name, text in (("a.csv", "b,a,extra\n1,2,3\n"), ("b.csv", "b,a,extra\n4,5,6\n")):
        (tmp_path / name).write_text(text)
    got = tables.read_raw_catalog(spark, str(tmp_path), small_schema("a", "b"))
    assert sorted(map(tuple, got.collect())) == [("2", "1"), ("5", "4")]
    with pytest.raises(ValueError, match="no column c"):
        tables.read_raw_catalog(spark, str(tmp_path), small_schema("a", "c"))
    (tmp_path / "c.csv").write_text("a,b,extra\n7,8,9\n")
    with pytest.raises(Exception):
        tables.read_raw_catalog(spark, str(tmp_path), small_schema("a", "b")).collect()


@pytest.mark.parametrize("row", ["1,2,3", "1"])
@pytest.mark.parametrize("multi_line", [True, False])
def test_rows_of_another_width_are_errors(spark, tmp_path, row, multi_line):
    (tmp_path / "x.csv").write_text(f"a,b\n0,0\n{row}\n")
    read = lambda mode: tables.read_raw_catalog(spark, str(tmp_path / "x.csv"), small_schema("a", "b"), multi_line, mode)
    with pytest.raises(Exception):
        read("FAILFAST").select("a").collect()
    assert [r["a"] for r in read("DROPMALFORMED").collect()] == ["0"]


def test_only_a_missing_report_is_empty(spark, tmp_path):
    tables.write_report({"one": spark.range(3)}, str(tmp_path / "r"))
    schema = spark.range(1).schema
    got = tables.read_report(spark, str(tmp_path / "r"), {"one": schema, "two": schema})
    assert got["one"].count() == 3 and got["two"].count() == 0
    with pytest.raises(Exception):
        tables.read_report(spark, "nosuchstore://x", {"one": schema})


def test_rows_without_a_cluster_keep_none(spark):
    df = spark.createDataFrame([("a", 1.0, 5), ("b", 2.0, 5), ("c", 3.0, 7), ("d", 4.0, None)], "product_id string, discounted_price double, cluster int")
    got = {r["product_id"]: r["cluster"] for r in canonical_clusters(df).collect()}
    assert got == {"a": 0, "b": 0, "c": 1, "d": None}


def test_search_folds_letters_of_all_scripts(spark):
    df = spark.createDataFrame([("CAFÉ",), ("café",), ("cafe",), (None,)], "product_name string")
    for literal in (True, False):
        assert {r[0] for r in search_products(df, "café", literal=literal).collect()} == {"CAFÉ", "café"}
