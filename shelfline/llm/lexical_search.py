"""Ranked lexical search by branch and bound over document FP-trees.

Items are the queries, all documents the collection. Documents are cut down to the terms that some item
asks for, with the terms' frequencies and the length norm m. Tasks put about `TREE_DOCS` such vectors at a
time into an FP-tree: terms go from the most to the least frequent of the collection, so that vectors
share their paths from the root; a node is the run of sorted vectors below a shared path. The largest tf of
each term and the smallest m below a node bound every score below it. A depth-first search goes down with
the items whose bound still reaches their 50th best score so far; at a single document the bound is
its score. A node is bounded for all of its items at once, by one product of its term values and their weights: sums
of whole numbers below 2**53 in doubles, so exact for items of up to 250,000 terms.

Items come to the driver in blocks of at most `BLOCK_ITEMS` items and about `BLOCK_TERMS` terms, whatever their
number, and each block is searched against all documents; an item with more terms than that is a block by itself.
The statistics that a block gathers have one row per term of the block. Best scores meet in two steps, so
that an item's candidates of all tasks don't meet in one.

Defined cases: a null or empty text has no terms; documents without a term count nowhere. Items without
terms, or whose terms no document has, have no rows. A null doc_id comes behind all others of one score.
Repeated rows of documents are ranked each, and repeated items get their rows each. Empty tables give an empty
result. Long texts are read in pieces. Further columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.arrays import Run, map_runs
from shelfline.session import materialize

TOP = 50
TREE_DOCS = 1024
BLOCK_ITEMS, BLOCK_TERMS = 256, 16_384
PIECE_BYTES = 1 << 20
#: Candidates of one item from all tasks meet in so many parts before the last ranking.
PARTS = 64

# In UTF-8 all characters beyond ASCII are of bytes from 0x80 on, so terms can be cut from bytes.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_OTHER = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists that together are all of them in order."""
    at = 0
    while at < len(raw):
        cut = _OTHER.search(raw, at + PIECE_BYTES)
        to = cut.start() if cut else len(raw)
        yield _TERM.findall(raw[at:to].translate(_LOWER))
        at = to


@dataclass
class Block:
    """Some items: their ids, their texts' distinct terms, and a number for each term of the block."""

    ids: list
    terms: list[list[int]]
    vocabulary: dict[bytes, int]


def blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", most_items: int = BLOCK_ITEMS,
           most_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    block = Block([], [], {})
    for name, told in items.select(item_id, text).toLocalIterator():
        found = {t for piece in terms((told or "").encode()) for t in piece}
        if block.ids and (len(block.ids) == most_items or len(block.vocabulary.keys() | found) > most_terms):
            yield block
            block = Block([], [], {})
        block.ids.append(name)
        block.terms.append([block.vocabulary.setdefault(t, len(block.vocabulary)) for t in sorted(found)])
    if block.ids:
        yield block


def term_vectors(df: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs): all terms of a document counted, and the number and frequency of those of the vocabulary."""
    def work(run: Run, fields: dict[str, pa.Array]) -> pa.RecordBatch:
        totals, found, counts = [], [], []
        for raw in run.texts():
            n, numbers = 0, [np.zeros(0, np.int32)]
            for piece in terms(raw):
                n += len(piece)
                known = np.fromiter(map(vocabulary.get, piece, repeat(-1)), np.int32, len(piece))
                numbers.append(known[known >= 0])
            own, tf = np.unique(np.concatenate(numbers), return_counts=True)
            totals.append(n)
            found.append(own)
            counts.append(tf)
        ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), kind))
                 for x, kind in ((found, pa.int32()), (counts, pa.int64()))]
        return pa.RecordBatch.from_arrays([fields[doc_id], pa.array(totals, pa.int64()), *lists],
                                          names=["doc_id", "n", "terms", "tfs"])

    kind = dict(df.dtypes)[doc_id]
    return map_runs(df, text, [doc_id], f"doc_id {kind}, n long, terms array<int>, tfs array<long>", work)


class Best:
    """The best scores of each item so far, and the scores that may still enter."""

    def __init__(self, items: int, top: int = TOP) -> None:
        self.top, self.least = top, np.ones(items, np.int64)
        none = np.zeros(0, np.int64)
        self.kept = (none, none, none)  # item, score and row of the task
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.number = 0

    def offer(self, item: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        self.waiting.append((item, score, row))
        self.number += len(item)

    def settle(self, order: np.ndarray) -> None:
        """Keep the best; `order` places the task's rows by doc_id."""
        item, score, row = (np.concatenate(x) for x in zip(self.kept, *self.waiting))
        sorted_ = np.lexsort((order[row], -score, item))
        item, score, row = item[sorted_], score[sorted_], row[sorted_]
        starts = np.searchsorted(item, item, "left")
        place = np.arange(len(item)) - starts
        full = place == self.top - 1
        self.least[item[full]] = score[full]
        keep = place < self.top
        self.kept, self.waiting, self.number = (item[keep], score[keep], row[keep]), [], 0


def value(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Tree:
    """The FP-tree of some documents, as their sorted vectors.

    `places` has the documents' terms by falling frequency in the collection, `tf` their frequencies, as lists of arrays.
    A node is a run of documents; `weights` has a column per item.
    """

    def __init__(self, places: list[np.ndarray], tf: list[np.ndarray], m: np.ndarray, weights: np.ndarray) -> None:
        keys = [p.astype(">u4").tobytes() for p in places]
        self.documents = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        ordered = [places[d] for d in self.documents]
        self.used = np.unique(np.concatenate(ordered))
        self.tf = np.zeros((len(ordered), len(self.used)), np.int64)
        sizes = [len(p) for p in ordered]
        self.tf[np.repeat(np.arange(len(ordered)), sizes), np.searchsorted(self.used, np.concatenate(ordered))] = (
            np.concatenate([tf[d] for d in self.documents]))
        self.m = m[self.documents]
        self.weights = weights[self.used]
        self.shared = np.zeros(len(ordered), np.int64)  # terms shared with the document before
        for i in range(1, len(ordered)):
            size = min(sizes[i - 1], sizes[i])
            differ = np.flatnonzero(ordered[i - 1][:size] != ordered[i][:size])
            self.shared[i] = differ[0] if len(differ) else size

    def children(self, low: int, high: int) -> np.ndarray:
        """Where the children of the node of documents low to high start."""
        inner = self.shared[low + 1:high]
        return np.concatenate([[low], low + 1 + np.flatnonzero(inner == inner.min())])

    def bounds(self, starts: np.ndarray, high: int, items: np.ndarray) -> np.ndarray:
        """For nodes that start at `starts`, no less than any score of `items` below them; a document's score for a leaf."""
        low = starts[0]
        tf = np.maximum.reduceat(self.tf[low:high], starts - low, axis=0)
        m = np.minimum.reduceat(self.m[low:high], starts - low)
        some = np.flatnonzero(tf.any(axis=0))
        weights = self.weights[some] if len(items) == self.weights.shape[1] else self.weights[np.ix_(some, items)]
        return (value(tf[:, some], m[:, None]).astype(np.float64) @ weights).astype(np.int64)

    def search(self, best: Best, first_row: int, settle) -> int:
        """Offer the documents that can be among the best; `first_row` is the task's row of the first one. Gives the nodes met."""
        every = np.arange(self.weights.shape[1])
        stack, met = [(0, len(self.m), every)], 0
        while stack:
            low, high, items = stack.pop()
            # The scores to reach may have risen since the node was put by.
            starts = self.children(low, high) if high - low > 1 else np.array([low])
            ends = np.append(starts[1:], high)
            bounds = self.bounds(starts, high, items)
            met += len(starts)
            hopeful = bounds >= best.least[items]
            single = ends - starts == 1
            child, item = np.nonzero(hopeful & single[:, None])
            if len(child):
                best.offer(items[item], bounds[child, item], first_row + self.documents[starts[child]])
                if best.number > 20_000:
                    settle()
            for c in np.flatnonzero(~single & hopeful.any(axis=1))[::-1]:
                stack.append((int(starts[c]), int(ends[c]), items[hopeful[c]]))
        return met


def _weights(block: Block, df: dict[int, int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each term's place by falling frequency, and the weights of the terms in that order, a column per item."""
    known = np.array([df.get(t, 0) for t in range(len(block.vocabulary))], np.int64)
    order = np.lexsort((np.arange(len(known)), -known))
    place = np.empty(len(known), np.int64)
    place[order] = np.arange(len(known))
    weights = np.zeros((len(known), len(block.ids)))
    w = np.floor(1000 * np.log((2.0 * n + 2) / (2.0 * known + 1)))
    for column, own in enumerate(block.terms):
        weights[place[own], column] = w[own]
    return place, weights


def search_block(docs: DataFrame, block: Block, doc_id: str = "doc_id", text: str = "text", top: int = TOP,
                 tree_docs: int = TREE_DOCS) -> DataFrame:
    """(item, rank, doc_id, score) of the items of one block, `item` being their position in it. Runs jobs."""
    vectors = materialize(term_vectors(docs, block.vocabulary, doc_id, text), "term-vectors")
    n, length = vectors.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the block.
    counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    place, weights = _weights(block, {r["term"]: r["df"] for r in counts}, n)
    kind = dict(vectors.dtypes)["doc_id"]

    def task(batches):
        best, held, rows = Best(len(block.ids), top), [], 0

        def settle():
            """Cut to the best, and let go of the ids of other rows."""
            ids = pa.concat_arrays([x for _, x in held]) if held else pa.array([], pa.int64())
            order = np.empty(len(ids), np.int64)
            order[pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
            best.settle(order)
            return ids

        for batch in batches:
            found, tfs = batch.column(2), batch.column(3)
            ends = found.offsets.to_numpy()
            flat, flat_tf, sizes = place[found.values.to_numpy()], tfs.values.to_numpy(), batch.column(1).to_pylist()
            for low in range(0, batch.num_rows, tree_docs):
                high = min(low + tree_docs, batch.num_rows)
                places, counts = [], []
                for a, b in zip(ends[low:high].tolist(), ends[low + 1:high + 1].tolist()):
                    order = np.argsort(flat[a:b])
                    places.append(flat[a:b][order])
                    counts.append(flat_tf[a:b][order])
                m = np.array([50 + 50 * s * n // length for s in sizes[low:high]], np.int64)
                held.append((rows, batch.column(0).slice(low, high - low)))
                Tree(places, counts, m, weights).search(best, rows, settle)
                rows += high - low
                ids = settle()
                used = np.unique(best.kept[2])
                held, rows = [(0, ids.take(pa.array(used)))], len(used)
                best.kept = (*best.kept[:2], np.searchsorted(used, best.kept[2]))
        item, score, row = best.kept
        if len(item):
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), held[0][1].take(pa.array(row)), pa.array(score)],
                                             names=["item", "doc_id", "score"])

    found = vectors.where(F.size("terms") > 0).mapInArrow(task, f"item int, doc_id {kind}, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part")
    some = found.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    ranked = some.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of each item with a score above 0. Runs jobs when called."""
    spark = docs.sparkSession
    kinds = dict(items.dtypes)[item_id], dict(docs.dtypes)[doc_id]
    parts = []
    for block in blocks(items, item_id, item_text):
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {kinds[0]}")
        # At most one row per item of a block.
        parts.append(search_block(docs, block, doc_id, text, top).join(F.broadcast(names), "item")
                     .select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    return reduce(DataFrame.unionByName, parts)
