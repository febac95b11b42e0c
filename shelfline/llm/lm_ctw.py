"""Context-tree weighting over bytes, beside a unigram base score.

Every byte is eight binary decisions; each decision has its own tree over the preceding bytes, up to
`DEPTH` of them. A node estimates its bit by Krichevsky and Trofimov's rule, and the weighting mixes
the estimates of all depths: a node's own estimate against the product of its children, half and half
a priori. The tree is learnt from all training texts and then fixed, so a text's probability does not
depend on the others scored with it. Texts are lower-cased in A-Z; an end mark that no UTF-8 text holds
stands before and after each one and is scored at its end.

All texts' grams (a context and its byte) are counted, combined per task before the shuffle, with the number
of times that training texts have them. Sorted by their context, latest byte first, they stream through
tasks that build the tree from the leaves up: what lies below three context bytes is held at a time, and
nodes of two bytes and of one are put together from those, 256 at a time. Depths one and none meet
on the driver (1 MB at most), whose mixture goes down again: to a table of at most 65,536 nodes of two bytes in the shared
folder, and from there, in a second stream over the grams, to the log probability of every gram that occurs in
any text: 12 bytes a gram, in the shared folder too. Tasks look grams up in memory, about `SHARD_GRAMS` at a time: more are
gone through in several shards, so memory stays bounded and nothing is left out.

The base needs counts of every word. Words that make up 2 ** -20 of all tokens or more, 2 ** 20 words at
most, are broadcast; other words of a text are joined to their counts by a shuffle. A word is known by
a 64-bit hash.

Defined cases: a null or empty text has one token, the end. A null doc_id belongs to the training part.
Repeated rows count and are scored one by one. Without any training text every bit has probability
one half and the base is log10(0.1 / 0.1). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.arrays import Run, lowered, runs, span_hashes, words
from shelfline.llm.storage import read_parquet
from shelfline.session import materialize, shared_path

DEPTH = 5  # grams of six bytes; `_Block` holds the depths from three on
END = 255
SHARD_GRAMS = 1 << 23
HEAVY_WORDS = 1 << 20
_GRAM, _WORD = 0, 1


def _padded(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Each row's lower-cased bytes with `DEPTH` end marks before and one after; where its first byte is."""
    rows = np.arange(run.rows)
    out = np.full(len(run.data) + (DEPTH + 1) * run.rows, END, np.uint8)
    shift = np.repeat((DEPTH + 1) * rows + DEPTH, np.diff(run.offsets))
    out[np.arange(len(run.data)) + shift] = lowered(run.data)
    return out, run.offsets[:-1] + (DEPTH + 1) * rows + DEPTH


def _grams(padded: np.ndarray) -> np.ndarray:
    """For each position from `DEPTH` on, the bytes before it, the latest one highest, and then its own."""
    b = padded.astype(np.uint64)
    n = len(b) - DEPTH
    out = b[DEPTH - 1:DEPTH - 1 + n]
    for k in range(2, DEPTH + 1):
        out = (out << np.uint64(8)) | b[DEPTH - k:DEPTH - k + n]
    return (out << np.uint64(8)) | b[DEPTH:]


def _scored(padded: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Which positions from `DEPTH` on belong to a row's text or its end, not to its leading marks."""
    use = np.ones(len(padded), bool)
    for k in range(1, DEPTH + 1):
        use[firsts - k] = False
    return use[DEPTH:]


def count_tokens(docs: DataFrame, text: str, training: str) -> DataFrame:
    """(kind, key, n): the grams (0) of all rows and the words by their hash (1), and how often training rows have them."""
    def task(batches):
        for batch in batches:
            learnt = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for run in runs(batch, "__text"):
                own = learnt[run.first:run.first + run.rows]
                padded, firsts = _padded(run)
                use = _scored(padded, firsts)
                of = np.repeat(own, np.diff(run.offsets) + 1)
                data = lowered(run.data)
                starts, ends, rows = words(run, data)
                told = own[rows]
                for kind, keys, times in ((_GRAM, _grams(padded)[use], of), (_WORD, span_hashes(data, starts[told], ends[told]), None)):
                    order = np.argsort(keys)
                    keys = keys[order]
                    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
                    n = np.diff(np.append(first, len(keys))) if times is None else (
                        np.add.reduceat(times[order].astype(np.int64), first) if len(first) else first)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(first), kind, np.int8)), pa.array(keys[first].view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["kind", "key", "n"])

    counted = docs.select(F.col(text).alias("__text"), F.col(training).alias("__training")).mapInArrow(
        task, "kind tinyint, key long, n long")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log(gamma(x)) for x > 0: Stirling's series after eight steps of the recurrence."""
    y = x + 8
    steps = np.ones_like(x)
    for k in range(8):
        steps = steps * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(steps)


def _bit_counts(byte_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of bits 0 and 1 at the 255 inner nodes of the byte's binary tree (node z has 2z and 2z+1)."""
    level, zeros, ones = byte_counts, [], []
    while level.shape[1] > 1:
        zeros.append(level[:, 0::2])
        ones.append(level[:, 1::2])
        level = zeros[-1] + ones[-1]
    return np.concatenate(zeros[::-1], axis=1), np.concatenate(ones[::-1], axis=1)


_TABLE = 1 << 13
_HALVES, _WHOLES = _log_gamma(np.arange(_TABLE) + 0.5), _log_gamma(np.arange(2 * _TABLE) + 1.0)


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    if zeros.size and max(zeros.max(), ones.max()) < _TABLE:
        a, b = zeros.astype(np.int32), ones.astype(np.int32)
        return _HALVES[a] + _HALVES[b] - np.log(np.pi) - _WHOLES[a + b]
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - np.log(np.pi) - _log_gamma(zeros + ones + 1)


def _next_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1)


def _weighted(own: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the weighted probability of a node, and the share of its own estimate in it."""
    total = np.logaddexp(own, children) - np.log(2)
    return total, np.exp(own - np.log(2) - total)


_NODES = np.array([[(256 + byte) >> (8 - level) for level in range(8)] for byte in range(256)]) - 1
_BITS = np.array([[(byte >> (7 - level)) & 1 for level in range(8)] for byte in range(256)], bool)


def _log_bytes(ones: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
    """log10 probability of a byte in each row, from the row's probabilities of a one at the inner nodes."""
    p = np.take_along_axis(ones, _NODES[bytes_], axis=1)
    return np.log10(np.where(_BITS[bytes_], p, 1 - p)).sum(axis=1)


class _Node:
    """Nodes of the tree, one a row, with the product of their children's weighted probabilities; a column per inner node
    of the byte's tree."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> None:
        self.zeros, self.ones = zeros, ones
        self.total, self.share = _weighted(_log_kt(zeros, ones), children)

    def mixed(self, upper: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is mixed so far, and the weight left for deeper nodes, after these nodes' own estimates."""
        return upper + rest * self.share * _next_one(self.zeros, self.ones), rest * (1 - self.share)


def _runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values start, and the run of each value."""
    new = np.append(True, values[1:] != values[:-1])
    return np.flatnonzero(new), np.cumsum(new) - 1


class _Block:
    """Sorted grams of whole contexts of three bytes, and the nodes of three, four and five context bytes above them.

    The leaves' counts are made for `LEAVES` of them at a time.
    """

    LEAVES = 2048

    def __init__(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys, self.n = keys, n
        self.start5, self.at5 = _runs_of(keys >> 8)
        self.start4, self.at4 = _runs_of(keys[self.start5] >> 16)
        self.start3, self.at3 = _runs_of(keys[self.start5][self.start4] >> 24)
        self.threes = keys[self.start5][self.start4][self.start3] >> 24
        below = [np.zeros((len(self.start4), 255)) for _ in range(3)]
        for low, high, first, last in self._parts():
            zeros, ones = self._leaves(low, high)
            for into, values in zip(below, (zeros, ones, _log_kt(zeros, ones))):
                into[first:last] = np.add.reduceat(values, self.start4[first:last] - low)
        self.four = _Node(*below)
        self.three = _Node(*(np.add.reduceat(x, self.start3) for x in (self.four.zeros, self.four.ones, self.four.total)))

    def _parts(self) -> Iterator[tuple[int, int, int, int]]:
        """Leaves low to high below the nodes of four bytes first to last; such a node has 256 leaves at most."""
        ends = np.append(self.start4[1:], len(self.start5))
        first = 0
        while first < len(self.start4):
            low = self.start4[first]
            last = max(first + 1, int(np.searchsorted(ends, low + self.LEAVES, "right")))
            yield int(low), int(ends[last - 1]), first, last
            first = last

    def _grams(self, low: int, high: int) -> slice:
        return slice(self.start5[low], self.start5[high] if high < len(self.start5) else len(self.keys))

    def _leaves(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        own = self._grams(low, high)
        counts = np.zeros((high - low, 256))
        counts[self.at5[own] - low, self.keys[own] & 255] = self.n[own]
        return _bit_counts(counts)

    def logs(self, upper: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """The log10 probability of each gram's byte in its context, mixing on from what the nodes of two bytes above each
        node of three give."""
        upper, rest = self.three.mixed(upper, rest)
        upper, rest = self.four.mixed(upper[self.at3], rest[self.at3])
        out = np.empty(len(self.keys))
        for low, high, _, _ in self._parts():
            zeros, ones = self._leaves(low, high)
            above = self.at4[low:high]
            own = self._grams(low, high)
            one = upper[above] + rest[above] * _next_one(zeros, ones)
            out[own] = _log_bytes(one[self.at5[own] - low], self.keys[own] & 255)
        return out


BLOCK_GRAMS = 4096


def _blocks(batches) -> Iterator[_Block]:
    """A stream sorted by gram in blocks of at least `BLOCK_GRAMS` grams, but for the last."""
    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        n = np.concatenate([n, batch.column(1).to_numpy()])
        # The last three context bytes may go on in the next batch.
        starts = _runs_of(keys >> 24)[0]
        low = 0
        for to in starts[1:].tolist():
            if to - low >= BLOCK_GRAMS:
                yield _Block(keys[low:to], n[low:to])
                low = to
        keys, n = keys[low:].copy(), n[low:].copy()
    if len(keys):
        yield _Block(keys, n)


_SUMS = "zeros binary, ones binary, weighted binary"


def _sum_rows(key: str, values: list[int], nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    return pa.table({key: pa.array(values, pa.int32()), **{
        name: pa.array([x[k].tobytes() for x in nodes], pa.binary()) for k, name in enumerate(("zeros", "ones", "weighted"))}})


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.sum([np.frombuffer(x.as_py()) for x in table.column(c)], axis=0) for c in ("zeros", "ones", "weighted"))


def _upward(batches):
    """One row per three context bytes: the node's counts and weighted log probabilities, under the two latest."""
    for block in _blocks(batches):
        node = block.three
        yield from _sum_rows("pair", (block.threes >> 8).tolist(), list(zip(node.zeros, node.ones, node.total))).to_batches()


def _node_two(table: pa.Table) -> pa.Table:
    """The node of two context bytes from its children: counts and the product of the children."""
    return _sum_rows("pair", [table.column("pair")[0].as_py()], [_added(table)])


def _node_one(table: pa.Table) -> pa.Table:
    """For one context byte, its counts and the product of its weighted children."""
    nodes = [_Node(*(np.frombuffer(row[c]) for c in ("zeros", "ones", "weighted"))) for row in table.to_pylist()]
    return _sum_rows("pair", [table.column("pair")[0].as_py() >> 8], [
        (sum(x.zeros for x in nodes), sum(x.ones for x in nodes), sum(x.total for x in nodes))])


class ContextTree:
    """A finished tree: the folder of its grams' log probabilities, and in how many shards they are."""

    def __init__(self, path: str, shards: int):
        self.path, self.shards = path, shards

    def shard(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(grams in order, log10 probabilities)."""
        key = (self.path, k)
        if _loaded.get("key") != key:
            _loaded.clear()
            rows = read_parquet(f"{self.path}/shard={k}", ["key", "log"])
            grams, logs = rows.column("key").to_numpy(), rows.column("log").to_numpy()
            del rows
            order = np.argsort(grams)
            _loaded.update(key=key, value=(grams[order], logs[order]))
        return _loaded["value"]


_loaded: dict = {}


def build_tree(counts: DataFrame) -> ContextTree:
    """The weighted tree of a written table (kind, key, n). Runs jobs and writes tables when called."""
    spark = counts.sparkSession
    grams = counts.where(F.col("kind") == _GRAM).select("key", "n")
    total = grams.count()
    # Grams of the same three latest bytes are in one partition, together and in order.
    stream = grams.repartition(F.shiftright("key", 24)).sortWithinPartitions("key")
    twos = materialize(stream.mapInArrow(_upward, f"pair int, {_SUMS}").groupBy("pair").applyInArrow(_node_two, f"pair int, {_SUMS}"), "lm-pairs")
    ones = {r["pair"]: r for r in twos.groupBy(F.shiftright("pair", 8)).applyInArrow(_node_one, f"pair int, {_SUMS}").collect()}
    zeros, set_, below = np.zeros((256, 255)), np.zeros((256, 255)), np.zeros((256, 255))
    for b, r in ones.items():
        zeros[b], set_[b], below[b] = (np.frombuffer(r[c]) for c in ("zeros", "ones", "weighted"))
    first = _Node(zeros, set_, below)
    root = _Node(zeros.sum(axis=0), set_.sum(axis=0), first.total.sum(axis=0))
    upper, rest = first.mixed(*root.mixed(np.zeros(255), np.ones(255)))

    def mix(batches):
        for batch in batches:
            rows = batch.to_pylist()
            found = [_Node(*(np.frombuffer(r[c]) for c in ("zeros", "ones", "weighted"))).mixed(
                upper[r["pair"] >> 8], rest[r["pair"] >> 8]) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r["pair"] for r in rows], pa.int32()), *(
                pa.array([x[k].tobytes() for x in found], pa.binary()) for k in (0, 1))], names=["pair", "upper", "rest"])

    path = shared_path(spark, "context-tree")
    twos.mapInArrow(mix, "pair int, upper binary, rest binary").write.parquet(f"{path}/pairs")

    def downward(batches):
        pairs = None
        for block in _blocks(batches):
            if pairs is None:
                # At most 65,536 rows.
                rows = read_parquet(f"{path}/pairs")
                order = np.argsort(rows.column("pair").to_numpy())
                pairs = rows.column("pair").to_numpy()[order]
                above = [np.frombuffer(rows.column(c).combine_chunks().cast(pa.large_binary()).buffers()[2], np.float64).reshape(-1, 255)
                         for c in ("upper", "rest")]
            at = order[np.searchsorted(pairs, block.threes >> 8)]
            logs = block.logs(above[0][at], above[1][at])
            yield pa.RecordBatch.from_arrays([pa.array(block.keys), pa.array(logs.astype(np.float32))], names=["key", "log"])

    shards = max(1, -(-total // SHARD_GRAMS))
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
    (stream.mapInArrow(downward, "key long, log float").withColumn("shard", shard)
     .write.partitionBy("shard").parquet(f"{path}/grams"))
    empty = spark.createDataFrame([], "key long, log float")
    for k in range(shards):
        # A shard without grams still is a folder to read.
        if total == 0 or shards > 1:
            empty.write.mode("append").parquet(f"{path}/grams/shard={k}")
    return ContextTree(f"{path}/grams", shards)


def _tree_scores(tree: ContextTree, held: list[Run]) -> list[np.ndarray]:
    """log10 probabilities of the rows of some runs, one shard of the tree after the other."""
    asked = []
    for run in held:
        padded, firsts = _padded(run)
        keys, at = np.unique(_grams(padded)[_scored(padded, firsts)].view(np.int64), return_inverse=True)
        asked.append((keys, at.astype(np.int32), np.full(len(keys), np.nan, np.float32)))
    for k in range(tree.shards):
        grams, logs = tree.shard(k)
        for keys, _, found in asked:
            place = np.minimum(np.searchsorted(grams, keys), max(0, len(grams) - 1))
            here = grams[place] == keys if len(grams) else np.zeros(len(keys), bool)
            found[here] = logs[place[here]]
    out = []
    for run, (keys, at, found) in zip(held, asked):
        if np.isnan(found).any():
            raise RuntimeError("a gram of a text is missing from the tree")
        # A row has one position a byte and one for its end.
        firsts = run.offsets[:-1] + np.arange(run.rows)
        out.append(np.add.reduceat(found[at].astype(np.float64), firsts) if run.rows else np.zeros(0))
    return out


def score_documents(df: DataFrame, held_out: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `df`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes.

    `held_out` is a SQL condition; rows for which it is not true are learnt from. Runs jobs when called.
    """
    spark = df.sparkSession
    given = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.expr(held_out), F.lit(False)).alias("held_out"),
                      F.col(text).alias("__text"))
    counts = materialize(count_tokens(given.withColumn("__training", ~F.col("held_out")), "__text", "__training"), "lm-counts")
    training_docs = given.where(~F.col("held_out")).count()
    vocabulary = counts.where(F.col("kind") == _WORD).select(F.col("key").alias("word"), F.col("n").alias("c"))
    v, n_words = vocabulary.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    total, distinct = n_words + training_docs, v + (training_docs > 0)
    heavy_from = max(1, -(-total // HEAVY_WORDS))
    # At most HEAVY_WORDS words can have this many occurrences.
    heavy = vocabulary.where(F.col("c") >= heavy_from).toArrow()
    order = np.argsort(heavy.column("word").to_numpy())
    shared = spark.sparkContext.broadcast(
        (heavy.column("word").to_numpy()[order], heavy.column("c").to_numpy()[order].astype(float)))
    tree = build_tree(counts)
    norm = total + 0.1 * (distinct + 1)
    end_score = float(np.log10((training_docs + 0.1) / norm))

    def texts(batches) -> Iterator[tuple[Run, pa.RecordBatch]]:
        for batch in batches:
            for run in runs(batch, "__text"):
                yield run, batch.slice(run.first, run.rows)

    def task(batches):
        next_row = TaskContext.get().partitionId() << 40
        held, size = [], 0
        for item in texts(batches):
            held.append(item)
            size += len(item[0].data)
            if tree.shards == 1 or size > 8 << 20:
                yield from flush(held, next_row)
                next_row += sum(r.rows for r, _ in held)
                held, size = [], 0
        yield from flush(held, next_row)

    def flush(held, next_row):
        for (run, cut), scores in zip(held, _tree_scores(tree, [r for r, _ in held])):
            yield output(run, cut, scores, next_row)
            next_row += run.rows

    def output(run: Run, cut: pa.RecordBatch, scores: np.ndarray, next_row: int) -> pa.RecordBatch:
        data = lowered(run.data)
        starts, ends, rows = words(run, data)
        codes = span_hashes(data, starts, ends).view(np.int64)
        own, at = np.unique(codes, return_inverse=True)
        heavy_codes, heavy_counts = shared.value
        place = np.minimum(np.searchsorted(heavy_codes, own), max(0, len(heavy_codes) - 1))
        known = heavy_codes[place] == own if len(heavy_codes) else np.zeros(len(own), bool)
        logs = np.zeros(len(own))
        logs[known] = np.log10((heavy_counts[place[known]] + 0.1) / norm)
        base = np.bincount(rows, logs[at], run.rows) + end_score
        n_known = np.bincount(rows[known[at]], minlength=run.rows) + (training_docs > 0)
        far = ~known[at]
        key, times = np.unique(rows[far] * max(1, len(own)) + at[far], return_counts=True)
        lengths = np.bincount(key // max(1, len(own)), minlength=run.rows)
        cuts = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(next_row + np.arange(run.rows)), cut.column(0), cut.column(1),
             pa.array(np.bincount(rows, minlength=run.rows) + 1), pa.array(n_known.astype(np.int64)),
             pa.array(base), pa.array(scores), pa.array(np.diff(run.offsets)),
             pa.ListArray.from_arrays(cuts, pa.array(own[key % max(1, len(own))])),
             pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32)))],
            names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes",
                   "far_words", "far_times"])

    kind = given.schema["doc_id"].dataType.simpleString()
    scored = materialize(given.mapInArrow(
        task, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, "
              "score double, n_bytes long, far_words array<long>, far_times array<int>"), "lm-scores")
    far = (scored.select("row", F.explode(F.arrays_zip("far_words", "far_times")).alias("x"))
           .select("row", F.col("x.far_words").alias("word"), F.col("x.far_times").alias("times")))
    c = F.coalesce("c", F.lit(0))
    rest = (far.join(vocabulary.where(F.col("c") < heavy_from), "word", "left")
            .groupBy("row").agg(F.sum(F.col("times") * F.log10((c + 0.1) / F.lit(float(norm)))).alias("rest"),
                                F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rest_known")))
    return (scored.drop("far_words", "far_times").join(rest, "row", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
                    F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base_score") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score", "n_bytes",
                    (-F.col("score") * F.lit(float(np.log2(10))) / (F.col("n_bytes") + 1)).alias("bits_per_byte")))
