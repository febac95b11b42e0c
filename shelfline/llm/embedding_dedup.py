"""Near-duplicate embeddings by counting collisions of sorted one-dimensional projections.

Every vector gets `tables` random projections. In each table the vectors of a label are sorted by a
prefix of random signs and by their projection; the prefix only cuts the sorted list into shorter ones.
A pair collides in a table if it shares the prefix and lies within a window of fixed half-width around
the one that asks. Pairs that collide in enough tables are verified by cosine in double precision. The
number of tables and the count needed are set from the collision chance of a pair exactly at the
threshold, so that such a pair is found with a chance of `RECALL`; closer ones are found more surely. The
prefix grows with the logarithm of the largest label, so lists stay short.

Signatures are made once and travel with the vector, so the task of one table can count a pair's
collisions in all tables; the first table it collides in owns it. So pairs are never shuffled: a task
returns, for each vector, its number of links and one vector it is joined to. Copies of a vector are
one node with a count. A list with more than `BLOCK_ROWS` rows is cut into blocks, compared two
at a time; no task holds more than two blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a
null label or vec_id, link with nothing and are their own component. Vectors of different lengths don't
link; their size doesn't matter, from the smallest to the largest double. Repeated rows are vectors that link with each other. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from math import acos, ceil, comb, erf, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from shelfline.functions.numeric import spread_join
from shelfline.llm.components import smallest_members
from shelfline.session import materialize

THRESHOLD = 0.93
RECALL = 0.9995
LIST_ROWS = 64
BLOCK_ROWS = 4096
SEED = 17
_PAIRS = 1 << 17


def calibrate(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> dict:
    """Sign bits, tables, window and the collisions needed for lists of about `LIST_ROWS` of `rows` rows."""
    bits = min(24, max(0, round(log2(max(1, rows) / LIST_ROWS))))
    distance = sqrt(2 - 2 * threshold)
    window = 1.5 * distance
    chance = (1 - acos(threshold) / pi) ** bits * erf(1.5 / sqrt(2))
    tables = 2
    while True:
        tail = 1.0
        for need in range(1, tables + 1):
            tail -= comb(tables, need - 1) * chance ** (need - 1) * (1 - chance) ** (tables - need + 1)
            if tail < recall:
                break
        # `need` is the first count that is passed too rarely.
        if need > 2:
            return {"bits": bits, "tables": tables, "window": window, "needed": need - 1}
        tables += 1


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors by powers of two so that their largest components lie from 0.5 to 1: squares neither overflow nor vanish."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def _signatures(vectors: np.ndarray, plan: dict) -> tuple[np.ndarray, np.ndarray]:
    """Per vector and table, the sign prefix and the projection of its direction."""
    vectors = _scaled(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    random = np.random.default_rng([SEED, vectors.shape[1]])
    lines = random.standard_normal((vectors.shape[1], plan["tables"]))
    planes = random.standard_normal((vectors.shape[1], plan["tables"] * max(1, plan["bits"])))
    signs = (unit @ planes > 0).reshape(len(unit), plan["tables"], -1)[:, :, :plan["bits"]]
    prefix = signs @ (1 << np.arange(plan["bits"])[::-1]).astype(np.int64) if plan["bits"] else np.zeros(
        (len(unit), plan["tables"]), np.int64)
    return prefix.astype(np.int32), (unit @ lines).astype(np.float32)


def _lists(nodes: DataFrame, plan: dict) -> DataFrame:
    """Each node once per table, with the head of its prefix, its signature and its vector."""
    head = max(0, plan["bits"] - 4)

    def task(batches):
        for batch in batches:
            names = [batch.column(i) for i in range(5)]
            lengths = names[2].to_numpy()
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                for cut in np.array_split(rows, ceil(len(rows) / 1024)):
                    at = pa.array(cut)
                    vectors = np.stack(names[4].take(at).to_numpy(zero_copy_only=False)).astype(np.float64)
                    prefix, line = _signatures(vectors, plan)
                    own = vectors.astype(plan["kind"])
                    bodies = pa.array([b"".join((prefix[i].tobytes(), line[i].tobytes(), own[i].tobytes()))
                                       for i in range(len(cut))], pa.binary())
                    for t in range(plan["tables"]):
                        yield pa.RecordBatch.from_arrays(
                            [names[0].take(at), names[1].take(at), names[2].take(at), names[3].take(at),
                             pa.array(np.full(len(cut), t, np.int32)),
                             pa.array(prefix[:, t] >> (plan["bits"] - head) if plan["bits"] else prefix[:, t]), bodies],
                            names=["node", "label", "length", "copies", "table", "head", "body"])

    return nodes.select("node", "label", "length", "copies", "vector").mapInArrow(
        task, "node string, label string, length int, copies long, table int, head int, body binary")


def _linked(table: pa.Table, plan: dict, threshold: float) -> pa.Table:
    """Links within one list or between two blocks of it: (node, joined, links)."""
    t, length = table.column("table")[0].as_py(), table.column("length")[0].as_py()
    body = np.frombuffer(b"".join(table.column("body").to_pylist()), np.uint8).reshape(table.num_rows, -1)
    width = 4 * plan["tables"]
    prefix = np.ascontiguousarray(body[:, :width]).view(np.int32)
    line = np.ascontiguousarray(body[:, width:2 * width]).view(np.float32).astype(np.float64)
    vectors = _scaled(np.ascontiguousarray(body[:, 2 * width:]).view(plan["kind"]).astype(np.float64).reshape(-1, length))
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    side, across = table.column("side").to_numpy(), table.column("low")[0].as_py() != table.column("high")[0].as_py()
    copies = table.column("copies").to_numpy()
    order = np.lexsort((line[:, t], prefix[:, t]))
    sorted_prefix = prefix[order, t]
    group = np.concatenate([[0], np.cumsum(sorted_prefix[1:] != sorted_prefix[:-1])])
    span = float(np.ptp(line[:, t])) + 2 * plan["window"] + 1
    key = group * span + (line[order, t] - line[:, t].min())
    # A little wider than the window: the exact test is the one below, the same in every task.
    last = np.searchsorted(key, key + plan["window"] + 1e-3, "right")
    counts = last - np.arange(len(key)) - 1
    links = np.zeros(len(key), np.int64)
    root = np.arange(len(key))
    ends = np.cumsum(counts)
    at = 0
    while at < len(key):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + _PAIRS, "right")))
        n = counts[at:to]
        left = np.repeat(np.arange(at, to), n)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        a, b = order[left], order[right]
        if across:
            use = side[a] != side[b]
            a, b = a[use], b[use]
        hits = (prefix[a] == prefix[b]) & (np.abs(line[a] - line[b]) <= plan["window"])
        use = (hits.sum(axis=1) >= plan["needed"]) & (hits.argmax(axis=1) == t) & hits[:, t]
        a, b = a[use], b[use]
        close = np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norms[a] * norms[b]) >= threshold
        a, b = a[close], b[close]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        root = _joined(root, a, b)
        at = to
    found = np.flatnonzero(links)
    node = table.column("node").combine_chunks()
    return pa.table({"node": node.take(pa.array(found)), "joined": node.take(pa.array(root[found])),
                     "links": pa.array(links[found])})


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining a[i] with b[i]: the smallest of each group of rows."""
    while len(a):
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            break
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    return root


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, recall: float = RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `df`. Runs jobs when called."""
    v = F.col("vector")
    given = df.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("label"),
                      F.col(vector).cast("array<double>").alias("vector"))
    fit = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()
           & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    fit = F.coalesce(fit, F.lit(False))
    key = F.concat(F.hex(F.xxhash64("label", "vector")), F.lit("-"), F.hex(F.xxhash64("vector", "label")))
    members = materialize(given.where(fit).withColumn("node", key), "vectors")
    nodes = materialize(members.groupBy("node").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("vector").alias("vector")).withColumn("length", F.size("vector")), "vector-nodes")
    largest = nodes.groupBy("label", "length").count().agg(F.max("count")).first()[0] or 0
    # Floats travel as floats, which loses nothing.
    single = isinstance(df.schema[vector].dataType.elementType, FloatType)
    plan = calibrate(largest, threshold, recall) | {"kind": "f4" if single else "f8"}
    keys = ["label", "length", "table", "head"]
    lists = materialize(_lists(nodes, plan), "vector-lists")
    long = lists.groupBy(*keys).count().where(F.col("count") > block_rows).select(
        *keys, F.ceil(F.col("count") * 2 / block_rows).cast("int").alias("blocks"))
    long = materialize(long, "long-lists")
    one = F.lit(0)
    if long.isEmpty():
        blocks = lists.select("*", one.alias("low"), one.alias("high"), one.alias("side"))
    else:
        # Block i of n meets every block: as the lower one of the pairs (i, j) and the higher one of (j, i).
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        split = lists.join(long, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        split = split.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        blocks = split.select(*lists.columns, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                              (F.col("own") > F.col("other")).cast("int").alias("side"))
    links = materialize(blocks.groupBy(*keys, "low", "high").applyInArrow(
        lambda table: _linked(table, plan, threshold), "node string, joined string, links long"), "vector-links")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    joined = smallest_members(nodes.select("node", "least"),
                              links.where(F.col("node") != F.col("joined")).select(
                                  F.col("node").alias("a"), F.col("joined").alias("b")), "node", "least")
    facts = (nodes.select("node", "copies").join(counts, "node", "left").join(joined, "node")
             .select("node", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    linked = spread_join(members.select("vec_id", "node"), facts, ["node"], ["vec_id"]).select(
        "vec_id", "n_links", F.col("component").alias("component_id"))
    alone = given.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
