"""Packing by length: optimal buckets, and batches of a token budget inside each.

A dynamic programme over the histogram of all lengths chooses bucket boundaries so that padding every text
to its bucket's boundary adds the fewest tokens. A bucket's batch holds as many texts as fit the token
budget at that length, at least one. Batches are full but for the last of each bucket.

The histogram is combined before the shuffle and holds exact lengths, so boundaries are optimal at any length. It
reaches the driver as three numbers per distinct length: d distinct lengths need more than d * d / 2 words, so
10**13 words have fewer than 4.5 million, and the programme keeps one number per length and bucket. Places within a bucket are numbered in shards of about `SHARD_ROWS` rows, whose
sizes are summed up, so no task sorts a whole bucket.

Defined cases: a null or empty text has length 0 and pads like any other. Repeated rows are packed one by
one. A text longer than the budget is a batch by itself. Equal paddings keep the earlier boundary.
An empty table gives no batches. Other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections import deque
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.session import materialize

BUCKETS = 16
TOKEN_BUDGET = 1 << 16
SHARD_ROWS = 1024


def word_count(text: str) -> Column:
    """The number of words `[^\\x20\\x09-\\x0D]+`; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def boundaries(histogram: Iterable[tuple[int, int, int]], buckets: int = BUCKETS) -> list[int]:
    """The last length of each bucket, at most `buckets`, for the least padding.

    `histogram` has (length, texts, their tokens). The best split before a length is a lower envelope of
    lines, as slopes fall and lengths rise, so a layer takes time in proportion to the histogram.
    """
    histogram = sorted(histogram)
    lengths = [h[0] for h in histogram]
    texts, tokens = array("q", [0]), array("q", [0])
    for _, n, t in histogram:
        texts.append(texts[-1] + n)
        tokens.append(tokens[-1] + t)
    d = len(histogram)
    if not d:
        return []
    best: list[int | None] = [0] + [None] * d
    choices, layers = [], []
    for _ in range(min(buckets, d)):
        new: list[int | None] = [None] * (d + 1)
        chosen = array("q", bytes(8 * (d + 1)))
        lines: deque[tuple[int, int, int]] = deque()
        for j in range(1, d + 1):
            if best[j - 1] is not None:
                line = (-texts[j - 1], best[j - 1] + tokens[j - 1], j - 1)
                while len(lines) >= 2 and _hidden(lines[-2], lines[-1], line):
                    lines.pop()
                lines.append(line)
            x = lengths[j - 1]
            while len(lines) >= 2 and lines[1][0] * x + lines[1][1] < lines[0][0] * x + lines[0][1]:
                lines.popleft()
            if lines:
                slope, at_zero, chosen[j] = lines[0]
                new[j] = slope * x + at_zero + x * texts[j] - tokens[j]
        choices.append(chosen)
        layers.append(new[d])
        best = new
    k = min(range(len(layers)), key=lambda i: (layers[i] if layers[i] is not None else float("inf"), i))
    cuts, j = [], d
    for layer in range(k, -1, -1):
        cuts.append(lengths[j - 1])
        j = choices[layer][j]
    return cuts[::-1]


def _hidden(a: tuple, b: tuple, c: tuple) -> bool:
    """Whether line b is nowhere below both a and c; slopes fall from a to c."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: Column | None = None,
         buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_length, batch, slot, padding) for every row. Runs jobs when called.

    `length` defaults to the number of words; `batch` counts from 0 within a bucket.
    """
    measured = materialize(df.select(
        F.col(doc_id).alias("doc_id"), (word_count(text) if length is None else length.cast("long")).alias("n_tokens"),
        F.monotonically_increasing_id().alias("row")), "lengths")
    counted = measured.groupBy("n_tokens").agg(F.count("*").alias("n")).toArrow().sort_by("n_tokens")
    lengths, counts = (counted.column(c).to_numpy() for c in ("n_tokens", "n"))
    ends = boundaries(zip(lengths.tolist(), counts.tolist(), (lengths * counts).tolist()), buckets)
    sizes = np.diff(np.append(0, np.cumsum(counts))[np.searchsorted(lengths, ends, "right")], prepend=0).tolist()
    bucket = sum([(F.col("n_tokens") > e).cast("int") for e in ends[:-1]], F.lit(0))

    def by_bucket(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values or [1]]), F.col("bucket") + 1)

    spread = F.xxhash64("doc_id", "row")
    placed = (measured.withColumn("bucket", bucket)
              .withColumn("shard", F.pmod(spread, by_bucket([max(1, -(-n // shard_rows)) for n in sizes]))))
    shards = placed.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = shards.select("bucket", "shard", F.coalesce(before, F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy(spread, "row"))
    place = F.col("offset") + F.col("rank") - 1
    room = by_bucket([max(1, budget // max(1, e)) for e in ends])
    return (placed.withColumn("rank", rank).join(offsets, ["bucket", "shard"])
            .withColumn("bucket_length", by_bucket(ends))
            .select("doc_id", "n_tokens", "bucket", "bucket_length", F.floor(place / room).alias("batch"),
                    F.pmod(place, room).alias("slot"), (F.col("bucket_length") - F.col("n_tokens")).alias("padding")))
