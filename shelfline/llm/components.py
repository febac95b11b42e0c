"""Connected components of an edge table, without gathering edges or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numeric import spread_join
from shelfline.session import materialize


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node of an edge, component being the smallest node reachable.

    Edges point from a node to a smaller one. Rounds of two steps: every node hangs its larger, then
    its smaller neighbours below the smallest node it knows. Each step is a grouped minimum, combined
    before its shuffle, and a join on the node; a hub is a skewed probe side, which adaptive execution
    splits. A round's edges are written to the shared folder, so lost executors cost no earlier round,
    and the number of rounds grows with the logarithm of the component sizes. Loops and nulls are
    ignored; no edges give no rows. Runs jobs when called.
    """
    a, b = F.col(left), F.col(right)
    current = materialize(edges.where(a.isNotNull() & b.isNotNull() & (a != b))
                          .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    seen = _summary(current)
    while seen[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        wide = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = wide.groupBy("u").agg(F.min("v").alias("m"))
        near = (wide.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(least.select("u", F.col("m").alias("v"))).distinct())
        current = materialize(near, "links")
        before, seen = seen, _summary(current)
        if seen == before:
            break
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _summary(edges: DataFrame) -> tuple:
    """The number of edges and two order-free sums of their hashes."""
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))).first()
    return tuple(row)


def smallest_members(nodes: DataFrame, edges: DataFrame, node: str, least: str, name: str = "component") -> DataFrame:
    """(node, `name`): for each of the distinct `nodes`, the smallest `least` of the nodes that `edges` (a, b) join it to.

    `nodes` is read several times and should be a written table. Runs jobs when called.
    """
    linked = connected_components(edges).withColumnsRenamed({"node": "__n", "component": "__c"})
    known = linked.join(nodes.select(F.col(node).alias("__n"), F.col(least).alias("__l")), "__n")
    joint = known.groupBy("__c").agg(F.min("__l").alias("__joint"))
    found = spread_join(known, joint, ["__c"], ["__n"]).select(F.col("__n").alias(node), "__joint")
    return nodes.join(found, node, "left").select(node, F.coalesce("__joint", least).alias(name))
