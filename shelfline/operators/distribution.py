"""Exact order statistics from a compressed distribution, without a single-task sort.

A distribution is a table (keys..., value, n) with one row per distinct value. Counting happens
before the shuffle, so a value that owns a large share of the rows costs one row per map task.
Ranks come from a hierarchy of prefixes: a value's code is a whole number of 64 bits in the order of the
values, and each level orders what shares all but 16 further bits. So no window holds more than 65,536
rows, however the values lie. Codes depend on nothing but the value, so no boundaries are sampled and a
recomputed task repeats its answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bits that a prefix leaves out, from the coarsest to the finest; the values themselves come last.
PREFIX_SHIFTS = [48, 32, 16]


def long_values(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """(by..., column, value): the non-null values of every column in long form.

    Rows with a null grouping key are left out, as grouped reports do.
    """
    for key in by:
        df = df.where(F.col(key).isNotNull())
    narrow = df.select(*by, *[F.col(c).cast("double").alias("v_" + c) for c in columns])
    named = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("v_" + c).alias("value")) for c in columns]))
    return narrow.select(*by, named).where("value is not null and not isnan(value)")


def value_counts(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """(by..., column, value, n): how often each distinct value occurs."""
    return long_values(df, columns, by).groupBy(*by, "column", "value").agg(
        F.count(F.lit(1)).alias("n"))


def value_code(value: Column) -> Column:
    """A long that grows with a double and is different for every one: its exponent, then its mantissa, then the sign.

    Powers of two and products with them are exact, so no step rounds. Null and NaN have the code 0.
    """
    size = F.abs(value)
    near = F.floor(F.log2(size))
    power = F.pow(F.lit(2.0), near.cast("double"))
    # The logarithm may round to the wrong side of a power of two.
    exponent = near - F.when(power > size, 1).otherwise(0) + F.when(power * 2.0 <= size, 1).otherwise(0)
    mantissa = (size / F.pow(F.lit(2.0), exponent.cast("double")) - 1.0) * float(1 << 52)
    normal = (exponent + 1023) * (1 << 52) + mantissa.cast("long")
    tiny = (size * 2.0 ** 537 * 2.0 ** 537).cast("long")
    code = (F.when(size == float("inf"), F.lit(2047 << 52)).when(size >= 2.0 ** -1022, normal).otherwise(tiny)).cast("long")
    signed = F.when(value > 0, code).when(value < 0, -code)
    # Never null, so join keys need no null filter and equal inputs keep equal plans.
    return F.coalesce(signed, F.lit(0).cast("long"))


def _running(keys: list[str], order: str) -> Column:
    """Rows strictly before this one in `order`, within `keys`."""
    window = (Window.partitionBy(*keys).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.sum("n").over(window) - F.col("n")


def _prefix(shift: int) -> str:
    return f"prefix_{shift}"


def _levels(counts: DataFrame, keys: list[str]) -> list[DataFrame]:
    """Rows per prefix, from the coarsest level to the finest; each level is summed from the next finer one.

    Each also has the prefix of the level above it, the coarsest only the keys.
    """
    levels, source, code = [], counts.withColumn("code", value_code(F.col("value"))), "code"
    for shift, above in zip(reversed(PREFIX_SHIFTS), [*reversed(PREFIX_SHIFTS[:-1]), None]):
        taken = 0 if code == "code" else int(code.rpartition("_")[2])
        source = source.groupBy(*keys, F.shiftright(code, shift - taken).alias(_prefix(shift))).agg(F.sum("n").alias("n"))
        code = _prefix(shift)
        levels.append(source if above is None else source.withColumn(_prefix(above), F.shiftright(code, above - shift)))
    return levels[::-1]


def _top(level: DataFrame, keys: list[str]) -> DataFrame:
    """The coarsest prefixes with the rows below each and the rows of its key; at most 65,536 of a key."""
    return level.select(*keys, _prefix(PREFIX_SHIFTS[0]), "n", _running(keys, _prefix(PREFIX_SHIFTS[0])).alias("below"),
                        F.sum("n").over(Window.partitionBy(*keys)).alias("total"))


def _descend(found: DataFrame, level: DataFrame, keys: list[str], prefix: str, order: str, extra: list[str] = ()) -> DataFrame:
    """The entries of the next finer level below the prefixes `found`, with the rows below each."""
    known = found.select(*keys, prefix, F.col("below").alias("_below"), "total")
    below = F.col("_below") + _running([*keys, prefix], order)
    return level.join(known, [*keys, prefix]).select(*keys, order, "n", below.alias("below"), "total", *extra)


def with_ranks(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Add `below` (rows with a smaller value) and `total` (rows of the key) to a distribution."""
    return _walk(counts, keys, lambda level: level)


def _walk(counts: DataFrame, keys: list[str], choose) -> DataFrame:
    """From the coarsest prefixes down to the values, through the entries of each level that `choose` keeps."""
    levels = _levels(counts, keys)
    found = choose(_top(levels[0], keys))
    for above, shift, level in zip(PREFIX_SHIFTS, PREFIX_SHIFTS[1:], levels[1:]):
        found = choose(_descend(found, level, keys, _prefix(above), _prefix(shift)))
    last = PREFIX_SHIFTS[-1]
    values = counts.withColumn(_prefix(last), F.shiftright(value_code(F.col("value")), last))
    extra = [c for c in counts.columns if c not in (*keys, "value", "n")]
    return choose(_descend(found, values, keys, _prefix(last), "value", extra))


def _hits(wanted: Column) -> Column:
    """The wanted positions that fall on this row."""
    return F.filter(wanted, lambda i: (i >= F.col("below")) & (i < F.col("below") + F.col("n")))


def _interpolation(total: Column, p: float) -> tuple[Column, Column, Column]:
    position = (total - 1) * F.lit(float(p))
    low = F.floor(position)
    return low, F.ceil(position), position - low


def quantiles(counts: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    """(keys..., total, q): exact linearly interpolated quantiles, `q` in the order asked for.

    Only prefixes that hold a wanted position are looked into.
    """
    wanted = F.array_distinct(F.flatten(F.array(*[
        F.array(*_interpolation(F.col("total"), p)[:2]) for p in probabilities])))
    found = (_walk(counts, keys, lambda level: level.where(F.size(_hits(wanted)) > 0))
             .select(*keys, "total", F.explode(_hits(wanted)).alias("i"), "value"))
    picked = found.groupBy(*keys).agg(
        F.first("total").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("i", "value"))).alias("at"))

    def interpolated(p: float) -> Column:
        low, high, fraction = _interpolation(F.col("total"), p)
        a, b = F.element_at("at", low), F.element_at("at", high)
        return a + (b - a) * fraction

    return picked.select(*keys, "total", F.array(*[interpolated(p) for p in probabilities]).alias("q"))


def grouped_quantiles(df: DataFrame, columns: list[str], probabilities: list[float],
                      by: list[str] = ()) -> DataFrame:
    """(by..., column, total, q) straight from rows."""
    return quantiles(value_counts(df, columns, by), [*by, "column"], probabilities)


def quantile_row(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """One row holding a struct of quantile arrays, one field per column, for use as a scalar."""
    found = grouped_quantiles(df, columns, probabilities)
    lookup = F.map_from_entries(F.collect_list(F.struct("column", "q")))
    return found.agg(lookup.alias("m")).select(
        F.struct(*[F.element_at("m", F.lit(c)).alias(c) for c in columns]).alias("medians"))


def modes(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., mode): the most frequent value, the smallest of several."""
    best = F.max(F.struct(F.col("n"), (-F.col("value")).alias("negated")))
    return counts.groupBy(*keys).agg((-best.getField("negated")).alias("mode"))


def cumulative(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Distribution with `cumulative_n` and `cumulative_pct` up to and including each value."""
    ranked = with_ranks(counts, keys)
    upto = F.col("below") + F.col("n")
    return ranked.select(*keys, "value", "n", upto.alias("cumulative_n"),
                         (upto / F.col("total") * 100.0).alias("cumulative_pct"))
