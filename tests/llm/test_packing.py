from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.llm import packing


def padding(histogram, cuts):
    return sum(n * min(c for c in cuts if c >= length) - t for length, n, t in histogram)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 9), max_size=9), st.integers(1, 5))
def test_boundaries_are_optimal(counts, k):
    histogram = [(length, n, length * n) for length, n in counts.items()]
    got = packing.boundaries(histogram, k)
    if not histogram:
        assert got == []
        return
    lengths = sorted(counts)
    best = min(padding(histogram, (*c, lengths[-1])) for m in range(min(k, len(lengths))) for c in combinations(lengths[:-1], m))
    assert len(got) <= k and got == sorted(set(got)) and got[-1] == lengths[-1]
    assert padding(histogram, got) == best


def test_batches_are_full_and_within_the_budget(spark):
    texts = [None, "", "a"] + ["w " * (i % 37 + 1) for i in range(400)] + ["v " * 500] + ["w " * 5] * 3
    df = spark.createDataFrame([(i % 399, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, bucket string")
    got = packing.pack(df, buckets=4, budget=120, shard_rows=16).toPandas()
    assert len(got) == len(texts)
    assert sorted(got.n_tokens) == sorted(len((t or "").split()) for t in texts)
    histogram = got.groupby("n_tokens").size()
    ends = packing.boundaries([(int(i), int(n), int(i * n)) for i, n in histogram.items()], 4)
    assert sorted(set(got.bucket_length)) == ends and (got.padding == got.bucket_length - got.n_tokens).all()
    for _, b in got.groupby("bucket"):
        room = max(1, 120 // max(1, b.bucket_length.iloc[0]))
        places = sorted(b.batch * room + b.slot)
        assert places == list(range(len(b))) and (b.slot < room).all()
    assert packing.pack(df.where("false")).collect() == []


def test_long_lengths_are_packed_by_their_exact_number(spark):
    df = spark.createDataFrame([(1, 70_001), (2, 3), (3, 1_000_003), (4, 1_000_001), (5, 70_000)], "doc_id long, n long")
    df = df.withColumn("text", F.lit(""))
    got = {r["doc_id"]: (r["bucket_length"], r["padding"]) for r in packing.pack(df, length=F.col("n"), buckets=4).collect()}
    assert got == {1: (70_001, 0), 2: (3, 0), 3: (1_000_003, 0), 4: (1_000_001, 0), 5: (70_001, 1)}


def test_many_distinct_long_lengths():
    """Against the plain recursion over all last cuts."""
    rng = np.random.default_rng(4)
    lengths = np.unique(rng.integers(60_000, 10_000_000, 300))
    counts = rng.integers(1, 1000, len(lengths))
    n, t = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(lengths * counts))
    best = np.where(np.arange(len(n)) == 0, 0, 1 << 60)
    for _ in range(6):
        last = best
        best = np.array([0] + [min(last[i] + lengths[j - 1] * (n[j] - n[i]) - (t[j] - t[i]) for i in range(j)) for j in range(1, len(n))])
    histogram = list(zip(lengths.tolist(), counts.tolist(), (lengths * counts).tolist()))
    assert padding(histogram, packing.boundaries(histogram, 6)) == best[-1]
