import hashlib
import random
import re

import pytest

from shelfline.functions.numeric import counted_join
from shelfline.llm import chunk_recipes as cr
from pyspark.sql import functions as F

rng = random.Random(11)


def prose(n):
    return " ".join("".join(rng.choice("aabcdeeéfllmnoopßrsttu漢") for _ in range(rng.randint(1, 9))) for _ in range(n))


def plain(rows):
    groups = {}
    for r, (doc, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc is None, doc or 0, r, doc))
    out = []
    for text, members in groups.items():
        first = min(members)
        out += [(doc, first[4], len(members), r == first[3], hashlib.sha256(text.encode()).hexdigest())
                for *_, r, doc in members]
    return sorted(out, key=str)


def made():
    long = prose(4000)
    return [(1, long), (2, long.replace(" ", "\n")), (3, long + " "), (4, long[:-1]), (5, None), (6, ""), (7, " \t\r\n"), (None, "a b"),
            (8, "ab"), (9, "a\x0bb"), (9, "a\x0bb"), (9, "a\x0bb"), (None, "zz"), (10, "a b"), (11, "x" * 20000), (12, "x" * 20001),
            (None, "only null"), (None, "only null"), *[(100 + i, prose(60)) for i in range(40)], *[(200 + i, "copy of this") for i in range(90)]]


ROWS = made()


def test_every_row_agrees_with_plain_code(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr(
        "*", "1 AS keep_id", "'x' AS recipe", "2 AS row", "3 AS kept", "4 AS text_sha256", "5 AS chunk").repartition(7)
    got = cr.exact_duplicates(df)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(ROWS)


def test_empty_table(spark):
    assert cr.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


def test_clashing_identifiers_are_found_and_widened(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert not cr.clashes(cr.chunk_store(df, hashes=1, bits=6)).isEmpty()
    assert cr.verified_hashes(df, hashes=1, bits=6) > 1
    assert sorted(map(tuple, cr.exact_duplicates(df, hashes=1, bits=6).collect()), key=str) == plain(ROWS)


def test_recipes_and_store_give_the_texts_back(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    store = {tuple(r["chunk_id"]): r["chunk"] for r in cr.chunk_store(df).collect()}
    table = cr.recipes(df).orderBy("row").collect()
    for (doc, text), r in zip(ROWS, table):
        ids = [tuple(r["recipe"][i:i + cr.HASHES]) for i in range(0, len(r["recipe"]), cr.HASHES)]
        assert r["doc_id"] == doc and "".join(store[i] for i in ids) == re.sub(r"[\x20\x09-\x0D]", "", text or "")
    assert all(len(c) <= cr.MOST for c in store.values())


def test_shared_passages_share_chunks(spark):
    passage, (a, b) = prose(800), (prose(50), prose(70))
    df = spark.createDataFrame([(a + passage,), (b + passage,)], "text string")
    cut = [set(r[0]) for r in df.select(cr.chunks(cr.normalized(F.col("text")))).collect()]
    size = sum(map(len, cut[0] & cut[1]))
    assert size > 0.8 * len(passage.replace(" ", ""))


def test_plan_is_native(spark):
    """Neither the result nor any job before it runs Python."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    for part in (cr.clashes(cr.chunk_store(df)), cr.recipes(df)):
        assert not re.search("Python|Arrow|Pandas", part._jdf.queryExecution().optimizedPlan().toString())


@pytest.mark.parametrize("hot_keys", [1, 3, 1000])
def test_counted_join_keeps_every_row(spark, hot_keys):
    left = spark.createDataFrame([(k, i) for k in range(10) for i in range(1 + 100 * (k == 3) + 5 * k)], "k long, i long")
    facts = left.groupBy("k").agg(F.count("*").alias("n"))
    got = counted_join(left, facts, "k", "n", hot_keys)
    assert sorted(map(tuple, got.collect())) == sorted((r.k, r.i, 1 + 100 * (r.k == 3) + 5 * r.k) for r in left.collect())
