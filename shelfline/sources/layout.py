"""A catalog laid out so that ranges of two columns each read few row groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numeric import with_scalar

BITS = 8


def _cell(value: Column, cuts: Column) -> Column:
    """How many of the cuts lie below the value; null counts as below all."""
    return F.coalesce(F.size(F.filter(cuts, lambda c: c < value)), F.lit(0))


def interleaved(cells: list[Column], bits: int = BITS) -> Column:
    """One number that takes the bits of the cells in turn, the highest first."""
    out = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for c in cells:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1).cast("long")))
    return out


def clustered_layout(df: DataFrame, columns: list[str], bits: int = BITS, accuracy: int = 10_000) -> DataFrame:
    """`df` in ranges of the interleaved cells of `columns`, each column cut into 2 ** bits cells of about equal rows.

    Cuts are approximate quantiles, which only decide where rows lie. Rows of one cell are dealt out by a hash, so that
    a cell that owns much of the table fills as many files as it needs.
    """
    parts = [(i + 1) / (1 << bits) for i in range((1 << bits) - 1)]
    cuts = df.agg(F.struct(*[F.percentile_approx(F.col(c).cast("double"), parts, accuracy).alias(c) for c in columns]).alias("cuts"))
    found = with_scalar(df, cuts, "_cuts")
    place = interleaved([_cell(F.col(c).cast("double"), F.coalesce(F.col(f"_cuts.{c}"), F.array().cast("array<double>"))) for c in columns], bits)
    placed = found.withColumn("_place", place).drop("_cuts")
    spread = F.xxhash64(*[c for c in df.columns if dict(df.dtypes)[c] in ("string", "double", "bigint", "int")])
    placed = placed.withColumn("_spread", spread)
    return placed.repartitionByRange("_place", "_spread").sortWithinPartitions("_place", *columns).drop("_place", "_spread")


def write_clustered(df: DataFrame, path: str, columns: list[str] = ("discounted_price", "discount_percentage"),
                    row_group_bytes: int = 32 << 20) -> None:
    """Parquet whose row groups span small ranges of each of `columns`, so filters on either or both skip most of them."""
    clustered_layout(df, list(columns)).write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)
