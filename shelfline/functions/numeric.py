"""Numeric column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def no_nan(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def right_closed_band(c: Column, floor: float, bands: list[tuple[float, str]]) -> Column:
    """Label of the interval (previous edge, edge] that holds the value; null outside all."""
    expr = F.when(~(c > floor), None)
    for edge, label in bands:
        expr = expr.when(c <= edge, label)
    return expr


def band_ordinal(c: Column, labels: list[str]) -> Column:
    """Position of a band label, so that bands sort by value and not by text."""
    found = F.array_position(F.array(*[F.lit(x) for x in labels]), c)
    return F.when(found > 0, (found - 1).cast("int"))


def min_max_scaled(c: Column, low: Column, high: Column) -> Column:
    """Position of the value between low and high; 0.5 throughout for a constant column."""
    return F.when(high > low, (c - low) / (high - low)).otherwise(0.5)


def present(df: DataFrame, places: int = 4) -> DataFrame:
    """Round every floating column for reports; the operators themselves keep full precision."""
    return df.select([
        F.bround(f.name, places).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def with_scalar(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Add the single value of a one-row table to every row, as one scalar subquery.

    Referring to the new column, rather than to the subquery, keeps the plan to a single copy of it.
    """
    return df.withColumn(name, one_row.scalar())


def share_pct(part: Column, whole: Column) -> Column:
    """Share rounded to 4 places and then scaled to percent, the order reports use."""
    return F.bround(part / whole, 4) * 100.0


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], spread: list[str], how: str = "inner",
                salts: int = 16) -> DataFrame:
    """Join rows to facts that `small` has once per key, so that no key's rows meet in one task.

    Rows of `big` are dealt out by a hash of their columns `spread` within each key, and the facts repeated
    for each part. A key that owns a third of the rows then spans `salts` tasks at any size.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_salt", salt).join(repeated, [*keys, "_salt"], how).drop("_salt")


def sized_join(rows: DataFrame, facts: DataFrame, keys: list[str], spread: list[str], how: str = "inner", sizes: DataFrame | None = None,
               hot_keys: int = 1000) -> DataFrame:
    """Join rows to facts that `facts` has once per key, each key in as many parts as its rows call for.

    A key that owns more than one in `hot_keys` of all rows gets a part for each such share, its rows dealt out by a hash of
    the columns `spread` and its facts repeated for each part. There are fewer than `hot_keys` such keys, which are broadcast, and
    less than twice as many repeated facts at any table size; the other facts travel once. `sizes` has the rows of each key in
    `_n`, for callers that know them; otherwise they are counted.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if sizes is None else sizes.select(*keys, "_n")
    share = F.col("_n") * F.lit(float(hot_keys)) / F.col("_all")
    shares = with_scalar(sizes, sizes.agg(F.sum("_n").alias("n")), "_all")
    hot = F.broadcast(shares.where(share > 1).select(*keys, F.ceil(share).cast("int").alias("_parts")))

    def parted(df: DataFrame, salt: Column) -> DataFrame:
        return df.join(hot, keys, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1))).withColumn("_salt", salt).drop("_parts")

    dealt = parted(rows, F.pmod(F.xxhash64(*spread), F.col("_parts")).cast("int"))
    repeated = parted(facts, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")


def counted_join(rows: DataFrame, facts: DataFrame, key: str, size: str, hot_keys: int = 1000, how: str = "inner") -> DataFrame:
    """Inner or left join of rows to facts that `facts` has once per key, with the number of rows of the key in `size`.

    A key that owns more than one in `hot_keys` of all rows joins where its rows lie: there are fewer than
    `hot_keys` such keys at any table size, so their facts are broadcast. No other key brings more than that
    share to a task. `rows` and `facts` are each read twice, so both should be written tables.
    """
    hot = F.col(size) * F.lit(hot_keys) > facts.agg(F.sum(size).alias("n")).scalar()
    few = facts.where(hot)
    near = rows.join(F.broadcast(few), key)
    far = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(facts.where(~hot), key, how)
    return near.unionByName(far)
