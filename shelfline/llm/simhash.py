"""SimHash near-duplicates by meeting in the middle of the Hamming ball.

A fingerprint has a bit set where more than half of its shingles' XXH64 values have it. Fingerprints at
most `radius` bits apart share a variant that lies within half the radius of both, so each distinct
fingerprint emits all such variants once (65 for radius 2), variants meet by a shuffle, and colliding
pairs are verified. All fingerprints around one variant are within the radius of each other and at most
as many as a fingerprint has variants, so a chain through them, sorted, links them all without forming
their pairs. Copies share one fingerprint and enter once.

Defined cases: a null or empty text has no words and fingerprint zero, linked like any other. Repeated
rows are rows of their own. Rows without a doc_id are linked too; a component of such rows alone has a
null component_id. An empty table gives an empty result. Other columns don't matter to links.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.numeric import spread_join
from shelfline.llm.arrays import Run, lowered, map_runs, words
from shelfline.llm.components import smallest_members
from shelfline.session import materialize

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42


def shingle_hashes(run: Run, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The XXH64 values of the shingles of all rows in order, and their number per row."""
    data = lowered(run.data)
    starts, ends, rows = words(run, data)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(run.rows, np.int64)
    # The words of all rows with one space after each.
    lengths = ends - starts + 1
    to = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) + np.repeat(starts - to, lengths)
    spaced = data[np.minimum(place, len(data) - 1)]
    spaced[to + lengths - 1] = 32
    counts = np.bincount(rows, minlength=run.rows)
    first = np.cumsum(counts) - counts
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
    end = np.minimum(begin + size, np.repeat(first + counts, n)) - 1
    raw, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(to[begin].tolist(), (to + lengths - 1)[end].tolist())),
                         np.uint64, len(begin))
    return hashes, n


def run_fingerprints(run: Run, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprint of each row as a signed 64-bit number."""
    result = np.zeros(run.rows, np.int64)
    hashes, n = shingle_hashes(run, size)
    if not len(hashes):
        return result
    full = n > 0
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    set_ = np.add.reduceat(bits, (np.cumsum(n) - n)[full], axis=0, dtype=np.int64)
    packed = np.packbits(2 * set_ > n[full][:, None], axis=1)
    result[full] = packed.reshape(-1).view(">u8").astype(np.uint64).view(np.int64)
    return result


def fingerprints(df: DataFrame, text: str = "text", keep: list[str] | None = None, name: str = "fingerprint",
                 size: int = SHINGLE_WORDS) -> DataFrame:
    """The columns `keep` (default: all) and the fingerprint as a long."""
    keep = [c for c in (df.columns if keep is None else keep) if c != name]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"`{name}` long"])

    def work(run: Run, fields: dict[str, pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*fields.values(), pa.array(run_fingerprints(run, size))],
                                          names=[*keep, name])

    return map_runs(df, text, keep, schema, work)


def ball(radius: int) -> list[int]:
    """All masks that flip at most `radius` of 64 bits, as signed numbers."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def link_fingerprints(distinct: DataFrame, radius: int = RADIUS, name: str = "fingerprint") -> DataFrame:
    """Pairs (a, b) of distinct fingerprints whose chains join all that are within `radius` bits."""
    if radius % 2 or radius < 0:
        raise ValueError("the radius must be even, so that both sides go half of it")
    fp = F.col(name)
    masks = F.array(*[F.lit(m).cast("long") for m in ball(radius // 2)])
    variants = distinct.select(fp.alias("b"), F.explode(F.transform(masks, lambda m: fp.bitwiseXOR(m))).alias("variant"))
    pairs = variants.select("b", F.lag("b").over(Window.partitionBy("variant").orderBy("b")).alias("a"))
    return pairs.where(F.col("a").isNotNull() & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))


def fingerprint_components(table: DataFrame, member: str, name: str = "fingerprint", radius: int = RADIUS) -> DataFrame:
    """(fingerprint, component): the smallest `member` of the linked fingerprints. Runs jobs when called.

    `table` is read several times and should be a written one.
    """
    distinct = materialize(table.groupBy(name).agg(F.min(member).alias("least")), "fingerprints")
    links = link_fingerprints(distinct.select(name), radius, name)
    return smallest_members(distinct, links, name, "least")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS,
                    size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row. Runs jobs when called."""
    table = materialize(fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")),
                                     "__text", ["doc_id"], size=size), "simhash")
    groups = fingerprint_components(table, "doc_id", radius=radius)
    # Copies share a fingerprint, so their rows are dealt out within it.
    return spread_join(table, groups, ["fingerprint"], ["doc_id"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS,
                size: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of `df` with one row of each component: the one of the smallest doc_id, or of any if it repeats."""
    tagged = df.select("*", F.monotonically_increasing_id().alias("__row"))
    table = materialize(fingerprints(tagged, text, name="__fingerprint", size=size), "simhash-rows")
    ranked = table.select("__fingerprint", F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"),
                                                    F.col("__row").alias("row")).alias("rank"))
    groups = fingerprint_components(ranked, "rank", "__fingerprint", radius)
    kept = groups.select(F.col("component.row").alias("__row")).distinct()
    return table.join(kept, "__row", "left_semi").select(*df.columns)
