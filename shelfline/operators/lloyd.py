"""K-Means of many starts at once: every pass over the rows moves the centres of all starts that still move.

Rows are packed once into blocks of numbers. A task adds up sums and counts for each centre, so a pass sends a few
numbers per centre and task to the driver, whatever the number of rows. The sums are added in the order of the tasks,
so rows that keep their clusters give the same centres again, to the last digit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Starts are drawn from this many rows; every row takes part in all that follows.
START_ROWS = 10_000
# The numbers that a task holds for a group of rows and all centres.
TILE = 1 << 19


@dataclass(frozen=True)
class Centres:
    k: int
    seed: int
    cost: float
    points: tuple[tuple[float, ...], ...]


def _packed(vectors: DataFrame) -> DataFrame:
    """(block): rows of `features` as blocks of doubles, kept while a fit runs."""
    def pack(batches):
        for batch in batches:
            lists = batch.column(0)
            if lists.null_count:
                raise ValueError("features must not be null")
            values = lists.flatten().to_numpy(zero_copy_only=False)
            if not np.isfinite(values).all():
                raise ValueError("features must be finite")
            if len(lists):
                yield pa.RecordBatch.from_arrays([pa.array([values.astype("float64").tobytes()], pa.binary())], ["block"])
    return vectors.select(vector_to_array("features").alias("p")).mapInArrow(pack, "block binary")


def _starts(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most `k` different rows, each drawn in proportion to its squared distance from those before (k-means++)."""
    random = np.random.default_rng([seed, k])
    chosen = [rows[random.integers(len(rows))]]
    gap = ((rows - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k and gap.sum() > 0:
        chosen.append(rows[random.choice(len(rows), p=gap / gap.sum())])
        gap = np.minimum(gap, ((rows - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _settled(rows: np.ndarray, centres: np.ndarray, rounds: int = 50, tol: float = 1e-3) -> np.ndarray:
    """Starts moved over the drawn rows first, which saves passes over all rows."""
    at = np.arange(len(rows))
    for _ in range(rounds):
        mine = np.zeros((len(rows), len(centres)))
        mine[at, ((centres ** 2).sum(axis=1) - 2.0 * (rows @ centres.T)).argmin(axis=1)] = 1.0
        count = mine.sum(axis=0)[:, None]
        before, centres = centres, np.where(count > 0, mine.T @ rows / np.maximum(count, 1), centres)
        if np.abs(centres - before).max() <= tol:
            break
    return centres


def _sums(x: np.ndarray, sets: list[np.ndarray], with_cost: bool) -> np.ndarray:
    """A row for each centre of all sets: the sums of its rows' coordinates, their number, and their squared distances if
    asked for. A row as near to several centres of a set goes to the first of them."""
    width, ends = x.shape[1], np.cumsum([len(s) for s in sets])
    every = np.concatenate(sets)
    total = np.zeros((len(every), width + 2))
    # A coordinate that is 1 throughout carries the squares of the centres, and counts the rows.
    weights = np.hstack([-2.0 * every, (every ** 2).sum(axis=1)[:, None]])
    x = np.hstack([x, np.ones((len(x), 1))])
    tile = max(64, TILE // len(every))
    for lo in range(0, len(x), tile):
        rows = x[lo:lo + tile]
        # Centres lie along the first axis, so that the least of a set is taken of whole lines of numbers.
        score = weights @ rows.T
        near = np.empty(score.shape, dtype=bool)
        for stop, centres in zip(ends, sets):
            part = score[stop - len(centres):stop]
            np.equal(part, part.min(axis=0), out=near[stop - len(centres):stop])
        tied = np.count_nonzero(near) > len(sets) * len(rows)
        for stop, centres in zip(ends, sets) if tied or with_cost else ():
            start = stop - len(centres)
            nearest = near[start:stop].argmax(axis=0)
            near[start:stop] = np.arange(len(centres))[:, None] == nearest
            if with_cost:
                gaps = ((rows[:, :width] - centres[nearest]) ** 2).sum(axis=1)
                total[start:stop, -1] += np.bincount(nearest, gaps, len(centres))
        total[:, :width + 1] += (rows.T @ near.astype("float64").T).T
    return total


def _pass(blocks: DataFrame, sets: list[np.ndarray], shift: np.ndarray, with_cost: bool) -> np.ndarray:
    """The `_sums` of all rows. Coordinates are taken from `shift` on, so that sums and products keep their digits."""
    width, count = len(shift), sum(len(s) for s in sets)

    def add_up(batches):
        total = np.zeros((count, width + 2))
        for batch in batches:
            for blob in batch.column(0):
                x = np.frombuffer(blob.as_buffer(), "float64").reshape(-1, width) - shift
                total += _sums(x, sets, with_cost)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["task", "total"])

    parts = sorted(blocks.mapInArrow(add_up, "task int, total binary").collect())
    return np.sum([np.frombuffer(bytes(p["total"]), "float64").reshape(count, width + 2) for p in parts], axis=0)


def fit_centres(vectors: DataFrame, jobs: list[tuple[int, int]], max_iter: int, tol: float) -> list[Centres]:
    """The centres and the cost of a K-Means fit for each (k, seed), over all rows of the vector column `features`.

    A fit ends when no centre moves farther than `tol`, or after `max_iter` passes. A centre without rows stays.
    """
    blocks = _packed(vectors).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Which rows starts are drawn from depends on the layout, as it does for any seeded start in Spark.
        drawn = vectors.select(vector_to_array("features").alias("p")).withColumn("_r", F.rand(0)).orderBy("_r").limit(START_ROWS)
        rows = np.array([r["p"] for r in drawn.collect()], dtype="float64")
        if not len(rows):
            raise ValueError("no rows to cluster")
        shift = rows.mean(axis=0)
        rows = rows - shift
        found = [_settled(rows, _starts(rows, k, seed)) for k, seed in jobs]
        moving = list(range(len(jobs))) if max_iter > 0 else []
        for _ in range(max_iter):
            if not moving:
                break
            total = _pass(blocks, [found[i] for i in moving], shift, False)
            start, still = 0, []
            for i in moving:
                part = total[start:start + len(found[i])]
                start += len(found[i])
                count = part[:, -2:-1]
                new = np.where(count > 0, part[:, :len(shift)] / np.maximum(count, 1), found[i])
                if ((new - found[i]) ** 2).sum(axis=1).max() > tol * tol:
                    still.append(i)
                found[i] = new
            moving = still
        total = _pass(blocks, found, shift, True)
    finally:
        blocks.unpersist()
    costs = np.split(total[:, -1], np.cumsum([len(c) for c in found])[:-1])
    return [Centres(k, seed, float(cost.sum()), tuple(map(tuple, (c + shift).tolist()))) for (k, seed), c, cost in zip(jobs, found, costs)]
