"""Bounded samples by seeded priorities: repeatable, mergeable, and weighted on request."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.numeric import with_scalar
from shelfline.schema import MEASURES


def hashed_unit(key: str, seed: int) -> Column:
    """A number in (0, 1] that depends on the key and the seed only."""
    digits = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 1.0) / float(1 << 52)


def priority_sample(df: DataFrame, n: int, key: str = "product_id", weight: str | None = None, by: list[str] = (),
                    seed: int = 42) -> DataFrame:
    """The columns of `df`, `priority` and `estimate`: at most n rows of each group `by`, those of the highest priorities.

    A row's priority is its weight (1 without one) over a hash of its key in (0, 1]. `estimate` is the weight that it
    stands for: its own or, if that is more, the highest priority left out; sums of it over any part of the
    sample are unbiased estimates of the part's weight. Rows without a positive weight or a key aren't sampled. Map tasks
    keep n + 1 rows of a group, and of a large group only rows whose priority is high enough among all, so its
    task gets little more than n rows, however many tasks read it. The sample is the same for every layout of the rows.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.where(F.col(key).isNotNull() & (w > 0)).withColumn("priority", w / hashed_unit(key, seed))
    return _cut(_promising(rows, n, by).withColumn("_weight", w).withColumn("_bar", F.lit(0.0)), n, key, by)


LARGE_GROUPS = 1000
_STEPS = 8  # classes of priorities for each power of two
_ENDLESS = 1 << 20  # the class of infinite weights, above all others


def _promising(rows: DataFrame, n: int, by: list[str]) -> DataFrame:
    """`rows` without those of large groups that can't be among the n + 1 highest priorities of their group.

    Priorities are counted by classes that are 9 % wide; a group needs its classes from the highest down to the one
    that completes n + 1 rows. Only groups that own more than one in `LARGE_GROUPS` of the rows are cut, so what is
    broadcast has fewer rows than that; all others bring less to a task by themselves.
    """
    known = F.col("priority") < float("inf")
    level = F.when(known, F.floor(F.log2("priority") * F.lit(float(_STEPS))).cast("int")).otherwise(_ENDLESS)
    keys = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)] or [F.lit(0).alias("_by0")]
    names = [f"_by{i}" for i in range(len(keys))]
    counts = rows.groupBy(*keys, level.alias("_level")).agg(F.count(F.lit(1)).alias("_n"))
    # Logarithms of doubles have a few thousand classes at most.
    own = Window.partitionBy(*names)
    above = F.sum("_n").over(own.orderBy(F.desc("_level")))
    placed = counts.withColumn("_above", above).withColumn("_group", F.sum("_n").over(own))
    placed = with_scalar(placed, counts.agg(F.sum("_n").alias("n")), "_all")
    large = placed.where((F.col("_group") * F.lit(LARGE_GROUPS) > F.col("_all")) & (F.col("_above") > n)).groupBy(*names).agg(
        F.max("_level").alias("_least"))
    same = [F.col(c).eqNullSafe(F.col(name)) for c, name in zip(by, names)]
    told = rows.join(F.broadcast(large), reduce(Column.__and__, same), "left") if by else with_scalar(
        rows, large.select("_least"), "_least")
    return told.where(F.col("_least").isNull() | (level >= F.col("_least"))).select(*rows.columns)


def _cut(rows: DataFrame, n: int, key: str, by: list[str]) -> DataFrame:
    """The n highest priorities; `_bar` is the highest priority that parts of the rows have left out before."""
    window = Window.partitionBy(*(by or [F.lit(0)]))
    place = F.row_number().over(window.orderBy(F.desc("priority"), key))
    top = rows.withColumn("_place", place).where(F.col("_place") <= n + 1)
    bar = F.greatest(F.max("_bar").over(window), F.coalesce(F.max(F.when(F.col("_place") == n + 1, F.col("priority"))).over(window), F.lit(0.0)))
    kept = top.withColumn("_bar", bar).where(F.col("_place") <= n)
    return kept.withColumn("estimate", F.greatest("_weight", "_bar")).drop("_place")


def merge_samples(samples: list[DataFrame], n: int, key: str = "product_id", by: list[str] = ()) -> DataFrame:
    """The sample of all rows from samples of parts of them that share no row, each of at least n or of all its rows."""
    return _cut(reduce(DataFrame.unionByName, samples).drop("estimate"), n, key, by)


def public(sample: DataFrame) -> DataFrame:
    """A sample without the columns that only merging needs."""
    return sample.drop("_weight", "_bar")


def scatter_panels(df: DataFrame, n: int, columns: list[str] = MEASURES, key: str = "product_id", hue: str | None = None,
                   size: str | None = None, seed: int = 42) -> DataFrame:
    """(x, y, x_value, y_value, key, hue, size): the points of all panels of a pair plot, drawn from one sample of n rows.

    A row is in all panels in which both of its values are known, so points can be followed from panel to panel.
    """
    kept = priority_sample(df.select(*dict.fromkeys([key, *columns, *[c for c in (hue, size) if c]])), n, key, seed=seed)
    panels = F.inline(F.array(*[F.struct(
        F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(x).cast("double").alias("x_value"), F.col(y).cast("double").alias("y_value"))
        for x, y in combinations(columns, 2)]))
    extra = [F.col(c).alias(name) for name, c in (("hue", hue), ("size", size)) if c]
    return kept.select(key, *extra, panels).where("x_value is not null and y_value is not null")
