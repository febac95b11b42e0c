"""How well two labelings of the same rows agree, and how stable K-Means is over its seeds."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.segments import train_many


def labeling_cells(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(first, second, a, b, n): how many rows have which labels, for each pair of label columns.

    Rows without one of the two labels are left out. Counts combine before the shuffle, so a pair of labelings
    sends no more rows than it has pairs of labels.
    """
    both = F.inline(F.array(*[F.struct(
        F.lit(x).alias("first"), F.lit(y).alias("second"), F.col(x).cast("string").alias("a"), F.col(y).cast("string").alias("b"))
        for x, y in pairs]))
    return (df.select(both).where("a is not null and b is not null")
            .groupBy("first", "second", "a", "b").agg(F.count(F.lit(1)).alias("n")))


def agreement(cells: DataFrame) -> DataFrame:
    """(first, second, rows, rand, adjusted_rand, variation_of_information) from cell counts alone.

    Pairs of rows are counted, never formed. The adjusted index is 1 where both labelings have the same groups and about
    0 for unrelated ones; the variation is in nats and 0 for the same groups.
    """
    keys = ["first", "second"]

    def pairs_of(c: Column) -> Column:
        c = c.cast("double")
        return c * (c - 1) / 2.0

    def margin(side: str) -> DataFrame:
        m = cells.groupBy(*keys, side).agg(F.sum("n").alias("m"))
        return m.groupBy(*keys).agg(F.sum(pairs_of(F.col("m"))).alias(f"pairs_{side}"),
                                    F.sum(F.col("m") * F.ln("m")).alias(f"log_{side}"))

    whole = cells.groupBy(*keys).agg(F.sum("n").alias("rows"), F.sum(pairs_of(F.col("n"))).alias("pairs"),
                                     F.sum(F.col("n") * F.ln("n")).alias("log"))
    # One row per pair of labelings.
    table = whole.join(margin("a"), keys).join(margin("b"), keys).withColumn("all", pairs_of(F.col("rows")))
    expected = F.try_divide(F.col("pairs_a") * F.col("pairs_b"), F.col("all"))
    most = (F.col("pairs_a") + F.col("pairs_b")) / 2.0
    # Both labelings with one group, or with as many as rows, agree by definition.
    adjusted = F.coalesce(F.try_divide(F.col("pairs") - expected, most - expected), F.lit(1.0))
    rand = F.coalesce(F.try_divide(F.col("all") + 2 * F.col("pairs") - F.col("pairs_a") - F.col("pairs_b"), F.col("all")), F.lit(1.0))
    variation = (F.col("log_a") + F.col("log_b") - 2 * F.col("log")) / F.col("rows")
    return table.select(*keys, "rows", rand.alias("rand"), adjusted.alias("adjusted_rand"),
                        F.greatest(variation, F.lit(0.0)).alias("variation_of_information"))


def labeling_agreement(df: DataFrame, labels: list[str]) -> DataFrame:
    """`agreement` of every pair of the label columns."""
    return agreement(labeling_cells(df, list(combinations(labels, 2))))


def cluster_stability(vectors: DataFrame, k: int, seeds: list[int], max_iter: int = 300, parallelism: int = 8) -> DataFrame:
    """(first, second, cost_first, cost_second, ...): agreement of the K-Means fits of every pair of seeds.

    All fits label the rows in one pass. `vectors` should be cached or written; fits run when called.
    """
    fits = train_many(vectors, k, seeds, max_iter, parallelism)
    labeled = vectors.select("features")
    for fit in fits:
        labeled = fit.model.copy({fit.model.predictionCol: f"seed_{fit.seed}"}).transform(labeled)
    spark = vectors.sparkSession
    costs = spark.createDataFrame([(f"seed_{f.seed}", f.cost) for f in fits], "seed string, cost double")
    found = labeling_agreement(labeled, [f"seed_{f.seed}" for f in fits])
    for side in ("first", "second"):
        found = found.join(F.broadcast(costs.withColumnsRenamed({"seed": side, "cost": f"cost_{side}"})), side)
    return found.select("first", "second", "cost_first", "cost_second", "rand", "adjusted_rand", "variation_of_information")
