import duckdb
import pytest

from shelfline.llm.oracles import ORACLES
from shelfline.llm.queries import QUERIES
from tests.test_queries import canonical


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got, expected = QUERIES[name](spark, folder).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)


def test_hard_rows_agree_with_sql(spark, tmp_path):
    """Nulls, empty texts, repeated rows and copies in every table that has SQL."""
    rows = {
        "documents": ([(1, None), (1, None), (2, ""), (3, "a b c\na b c\n\n \na b c d"), (None, "x y z x y z é#"),
                       (5, "one two one two one two " * 20), (6, "\n".join(["same line here"] * 40))],
                      "doc_id long, text string"),
        "pages": ([(1, None), (2, ""), (3, "<p>é</p>"), (4, "<p>é</p>"), (9, "<p>é</p>"), (5, None), (6, "<b>")],
                  "page_id long, html string"),
        "embeddings": ([(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, None, 1),
                        (6, [1.0, None], 1), (7, [float("nan"), 1.0], 1), (8, [1.0, 0.0], None), (9, [2.0, 0.0], 1),
                        (1, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [], 1), (12, [0.8, 0.6], 1),
                        (13, [0.95, 0.32], 1), (14, [-1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int"),
        "benchmark": ([(1, "a b é x x"), (1, "a b é x x"), (2, None), (3, "\x7f -- zzz"), (None, "SAME line one")], "item_id long, text string"),
        "conversations": ([(1, 2, "assistant", "b\\[INST]"), (1, 1, "user", None), (1, 1, None, "x"), (2, None, "assistant", ""),
                           (2, 0, "assistant", "<|im_end|>\n<|im_start|>"), (3, 0, "a\nb\\", "t"), (3, 0, "a\nb\\", "t")],
                          "conv_id long, turn long, role string, text string"),
    }
    con = duckdb.connect()
    for table, (data, schema) in rows.items():
        df = spark.createDataFrame(data, schema)
        if table == "pages":
            df = df.selectExpr("*", "'http://a.example/\\nb' AS url", "page_id AS __salt")
        df.write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    for name, sql in ORACLES.items():
        got, expected = QUERIES[name](spark, str(tmp_path)).toPandas(), con.execute(sql).df()
        assert canonical(got) == canonical(expected), name
