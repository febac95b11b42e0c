"""Vectorised views of Arrow text columns, shared by the operators that read whole texts in tasks.

A batch is cut into runs of whole rows of about `CHUNK_BYTES` of text, so that temporary arrays stay
small whatever the size of an Arrow batch; one longer text is a run by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
U64 = np.uint64


@dataclass
class Run:
    """Whole rows: `data[offsets[i]:offsets[i + 1]]` is the UTF-8 of row i; a null is empty."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    present: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def texts(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist())]


def runs(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[Run]:
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    present = np.asarray(texts.is_valid())
    _, starts, values = texts.buffers()
    offsets = np.frombuffer(starts, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Run(at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], present[at:to])
        at = to


def map_runs(df: DataFrame, column: str, fields: list[str], schema: str,
             work: Callable[[Run, dict[str, pa.Array]], pa.RecordBatch | None],
             setup: Callable[[], None] | None = None) -> DataFrame:
    """Apply `work` to every run of rows of `df`; it gets the run and the same rows of `fields`."""
    def task(batches):
        if setup:
            setup()
        for batch in batches:
            for run in runs(batch, "__text"):
                cut = batch.slice(run.first, run.rows)
                out = work(run, {f: cut.column(cut.schema.get_field_index(places[f])) for f in fields})
                if out is not None:
                    yield out

    places = {f: "__text" if f == column else f"__f{i}" for i, f in enumerate(fields)}
    given = [F.col(_quoted(f)).alias(places[f]) for f in fields if f != column]
    return df.select(F.col(_quoted(column)).alias("__text"), *given).mapInArrow(task, schema)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (the one of the splitmix64 generator)."""
    x = x.astype(U64, copy=True)
    x += U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTES = mixed(np.arange(256, dtype=U64) + U64(1 << 32)) | U64(1)
_PLACES = mixed(np.arange(4096, dtype=U64)) | U64(1)


def _places(n: int) -> np.ndarray:
    global _PLACES
    if n > len(_PLACES):
        _PLACES = mixed(np.arange(max(n, 2 * len(_PLACES)), dtype=U64)) | U64(1)
    return _PLACES


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty span of bytes; spans are in order and do not overlap."""
    if not len(starts):
        return np.zeros(0, U64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    byte = data[place + np.repeat(starts, sizes)]
    sums = np.add.reduceat(_BYTES[byte] * _places(int(sizes.max()))[place], first)
    return mixed(sums + mixed(sizes.astype(U64)))


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII letters in lower case; other bytes stay."""
    return _LOWER[data]


def words(run: Run, data: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words `[^\\x20\\x09-\\x0D]+` of a run."""
    data = run.data if data is None else data
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[run.offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(run.offsets, starts, "right") - 1


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums per row as float64; exact for whole numbers below 2**53."""
    return np.bincount(rows, values, n)


def span_counts(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set within each span."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def sheltered(df: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """`df` under column names that no operator uses, its columns' new names, and the way back."""
    names = {c: f"__column{i}" for i, c in enumerate(df.columns)}
    return (df.select(*[F.col(_quoted(c)).alias(n) for c, n in names.items()]), names,
            lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()]))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores before it as keep it apart from the columns of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
