"""Best candidates within a price interval, for every target at once.

For each target: the k best candidates of the same partition, by one fixed order, whose price lies
in [low, high]. Nothing is compared pair by pair:

1. Prices fall into cells, so an interval is a span of whole cells plus a part of each end cell. An open end has no cell.
2. Each cell keeps its k best candidates. They climb a ladder of dyadic blocks of cells, and a span is
   answered once for all targets that share it, by two blocks per level at most.
3. Inside an end cell only candidates count that can still enter an answer: those not behind the k best of every span
   that the cell bounds. They are cut to the k best per exact price.
4. The part of an end cell is open to one side, so the k best up to an end are running minima along the cell.
5. Intervals within one cell, which are narrower than it, take dyadic blocks of positions in that cell.
6. A target merges the k best of its span and its end cells. Products of equal price are one target.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.numeric import sized_join

# Price cells are 1/256 of ln(price) wide, 0.4 %. Prices outside e^-8 .. e^56 share the end cells.
CELLS_PER_LN = 256
LOWEST_LN = -8
CELL_LEVELS = 14
# Cells of no candidate, which stand for open ends, and of NaN, which sorts behind all prices.
BELOW_ALL, ABOVE_ALL, NAN_CELL = -1, 1 << CELL_LEVELS, (1 << CELL_LEVELS) + 1


@dataclass(frozen=True)
class Order:
    """Candidate order: (numeric column, descending) pairs; the id column settles ties, ascending.

    Nulls come last either way.
    """
    by: tuple[tuple[str, bool], ...]
    id: str = "product_id"

    def struct(self) -> Column:
        """The order as one struct that sorts ascending."""
        def ascending(c: str, desc: bool) -> Column:
            v = F.col(c).cast("double")
            return F.coalesce(-v if desc else v, F.lit(float("inf")))
        keys = [ascending(c, desc).alias(f"s{i}") for i, (c, desc) in enumerate(self.by)]
        return F.struct(*keys, F.col(self.id).alias("id"))

    def fields(self) -> list[str]:
        return [f"sort.s{i}" for i in range(len(self.by))] + ["sort.id"]


def _cut(df: DataFrame, keys: list[str], order: Order, k: int) -> DataFrame:
    """The k best rows per key by their `sort` struct. Spark limits each map partition to k rows per
    key before the shuffle, so a key that owns most rows sends k of them per map task."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order.fields()))
    return df.withColumn("_n", position).where(F.col("_n") <= k).drop("_n")


def _gather(df: DataFrame, keys: list[str], order: Order, k: int) -> DataFrame:
    """(keys..., best): the k best rows per key as an array of (sort, row), best first."""
    best = F.sort_array(F.collect_list(F.struct("sort", "row")))
    return _cut(df, keys, order, k).groupBy(*keys).agg(best.alias("best"))


def best_per_key(candidates: DataFrame, keys: list[str], order: Order, k: int) -> DataFrame:
    """(keys..., best): the k best whole candidate rows of each key, best first."""
    rows = candidates.select(*keys, order.struct().alias("sort"), F.struct(*candidates.columns).alias("row"))
    return _gather(rows, keys, order, k).withColumn("best", F.col("best.row"))


def _cell(price: Column) -> Column:
    """Cell number of a price, never decreasing in it: 0 .. 2^14 - 1 of a number, and one behind them of NaN."""
    position = (F.ln(price) - LOWEST_LN) * CELLS_PER_LN
    inside = F.least(F.greatest(position, F.lit(0.0)), F.lit(2.0 ** CELL_LEVELS - 1))
    numbered = F.coalesce(F.when(price > 0, F.floor(inside)), F.lit(0).cast("long"))
    return F.when(F.isnan(price), F.lit(NAN_CELL).cast("long")).otherwise(numbered)


def _levels(positions: Column) -> Column:
    """Levels of blocks needed for this many positions; an upper bound is enough."""
    return F.ceil(F.log2(positions + 1)).cast("int")


def _level_size(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def _run_blocks(runs: DataFrame) -> DataFrame:
    """Replace each run start <= position < stop by the blocks that exactly cover it.

    Going up the levels, an odd first block and an odd end block are the ones to take.
    """
    fixed = [c for c in runs.columns if c not in ("start", "stop", "levels")]
    size = _level_size(F.col("level"))
    spread = (runs.where("start < stop")
              .withColumn("level", F.explode(F.sequence(F.lit(0), F.col("levels"))))
              .select(*fixed, "level", F.ceil(F.col("start") / size).alias("a"),
                      F.floor(F.col("stop") / size).alias("b")).where("a < b"))
    taken = F.array(F.when(F.col("a") % 2 == 1, F.col("a")), F.when(F.col("b") % 2 == 1, F.col("b") - 1))
    return spread.select(*fixed, "level", F.explode(taken).alias("block")).where("block is not null")


def _blocks(placed: DataFrame, keys: list[str], order: Order, k: int) -> DataFrame:
    """(keys..., scope, level, block, best): the k best of every dyadic block of positions within a scope, up to level `top`."""
    spread = (placed.withColumn("level", F.explode(F.sequence(F.lit(0), F.col("top"))))
              .withColumn("block", F.floor(F.col("position") / _level_size(F.col("level")))))
    address = [*keys, "scope", "level", "block"]
    return _gather(spread.select(*address, "sort", "row"), address, order, k)


def _merged(lists: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.flatten(lists)), 1, k)


def _run_best(runs: DataFrame, blocks: DataFrame, keys: list[str], fixed: list[str], k: int) -> DataFrame:
    """(keys..., fixed..., best): the k best of the blocks of each run, at most two per level; none for an empty run."""
    return (_run_blocks(runs).join(blocks, [*keys, "scope", "level", "block"])
            .groupBy(*keys, *fixed).agg(_merged(F.collect_list("best"), k).alias("best")))


def _span_best(usable: DataFrame, located: DataFrame, keys: list[str], order: Order, k: int) -> DataFrame:
    """(keys..., low_cell, high_cell, span_best): the k best between the end cells, null if there is none, once per pair of
    different end cells."""
    whole = _cut(usable.select(*keys, "cell", "sort", "row"), [*keys, "cell"], order, k)
    blocks = _blocks(whole.select(*keys, "sort", "row", F.lit(0).alias("scope"), F.col("cell").alias("position"),
                                  F.lit(CELL_LEVELS).alias("top")), keys, order, k)
    ends = ["low_cell", "high_cell"]
    spans = located.where("low_cell < high_cell").select(*keys, *ends).distinct()
    runs = spans.select(*keys, *ends, F.lit(0).alias("scope"), (F.col("low_cell") + 1).alias("start"),
                        F.col("high_cell").alias("stop"), F.lit(CELL_LEVELS).alias("levels"))
    return spans.join(_run_best(runs, blocks, keys, ends, k), [*keys, *ends], "left").withColumnRenamed("best", "span_best")


def _cell_bounds(spans: DataFrame, located: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(keys..., cell, bound, narrow): for every end cell the last `sort` that can enter an answer, null if any can;
    and whether an interval lies within the cell."""
    last = F.when(F.size("span_best") == k, F.element_at("span_best", k)["sort"])
    ends = spans.select(*keys, F.explode(F.array("low_cell", "high_cell")).alias("cell"), last.alias("last"), F.lit(False).alias("narrow"))
    within = located.where("low_cell = high_cell").select(
        *keys, F.col("low_cell").alias("cell"), F.lit(None).cast(ends.schema["last"].dataType).alias("last"), F.lit(True).alias("narrow")).distinct()
    bound = F.when(F.count("last") == F.count(F.lit(1)), F.max("last"))
    return (ends.unionByName(within).where(~F.col("cell").isin(BELOW_ALL, ABOVE_ALL))
            .groupBy(*keys, "cell").agg(bound.alias("bound"), F.max("narrow").alias("narrow")))


def _running_best(near: DataFrame, ends: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(keys..., target_price, best): for each end, the k best candidates of its cell up to it.

    `ends` has `side` 1 for what closes an interval and -1, with the order of prices turned round, for what opens one.
    The least so far is the best. What a better candidate pushes out, or what is not better, goes on to the next place and
    meets the least so far there.
    """
    both = near.withColumn("side", F.explode(F.array(F.lit(1), F.lit(-1)))).select(
        *keys, "cell", "side", (F.col("at") * F.col("side")).alias("along"), F.lit(0).alias("is_end"), F.struct("sort", "row").alias("_x"))
    asking = ends.select(*keys, "cell", "side", (F.col("at") * F.col("side")).alias("along"), F.lit(1).alias("is_end"), "target_price")
    events = both.unionByName(asking, allowMissingColumns=True)
    before = (Window.partitionBy(*keys, "side", "cell").orderBy("along", "is_end")
              .rowsBetween(Window.unboundedPreceding, -1))
    places = [f"_b{i}" for i in range(k)]
    for place in places:
        known = F.col("_x").isNotNull() & F.col(place).isNotNull()
        events = (events.withColumn(place, F.min("_x").over(before))
                  .withColumn("_x", F.when(known, F.greatest("_x", place))))
    return events.where("is_end = 1").select(*keys, "target_price", F.array_compact(F.array(*places)).alias("best"))


def _within_cells(near: DataFrame, asked: DataFrame, keys: list[str], order: Order, k: int) -> DataFrame:
    """(keys..., target_price, best): for intervals inside one cell, by blocks of its positions.

    One ordering of the cell holds its candidates and the ends. An end sorts before an equal price when it opens an
    interval and after it when it closes one.
    """
    ends = asked.select(*keys, "cell", "target_price", F.inline(F.array(
        F.struct(F.col("low").alias("at"), F.lit(0).alias("kind")),
        F.struct(F.col("high").alias("at"), F.lit(2).alias("kind")))))
    events = near.select(*keys, "cell", "at", "sort", "row", F.lit(1).alias("kind")).unionByName(ends, allowMissingColumns=True)
    cell = Window.partitionBy(*keys, "cell")
    upto = cell.orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_price = (F.col("kind") == 1).cast("long")
    numbered = events.select(*keys, "target_price", "kind", "sort", "row", F.col("cell").alias("scope"), F.sum(is_price).over(upto).alias("upto"),
                             _levels(F.sum(is_price).over(cell)).alias("top"))
    blocks = _blocks(numbered.where("kind = 1").select(*keys, "sort", "row", "scope", (F.col("upto") - 1).alias("position"), "top"), keys, order, k)
    runs = numbered.where("kind <> 1").groupBy(*keys, "scope", "target_price").agg(
        F.max(F.when(F.col("kind") == 0, F.col("upto"))).alias("start"), F.max(F.when(F.col("kind") == 2, F.col("upto"))).alias("stop"),
        F.max("top").alias("levels"))
    return _run_best(runs, blocks, keys, ["target_price"], k)


def interval_topk(candidates: DataFrame, targets: DataFrame, keys: list[str], order: Order, k: int,
                  price: str = "discounted_price") -> DataFrame:
    """(keys..., target_price, best): an array of at most k candidates per distinct target.

    `targets` has the keys, `target_price` and the inclusive interval ends `low` and `high`, one row
    per distinct target; `low` or `high` null leaves that side open. `best` holds whole candidate
    rows, best first. Targets without a candidate have no row.
    """
    usable = candidates.where(F.col(price).isNotNull())
    for key in keys:
        usable = usable.where(F.col(key).isNotNull())
    usable = usable.select(*keys, F.col(price).alias("at"), _cell(F.col(price)).alias("cell"), order.struct().alias("sort"),
                           F.struct(*candidates.columns).alias("row"))
    infinity = float("inf")
    low, high = F.coalesce("low", F.lit(-infinity)), F.coalesce("high", F.lit(infinity))
    located = targets.select(*keys, "target_price", low.alias("low"), high.alias("high")).where("low <= high").withColumns({
        "low_cell": F.when(F.col("low") == -infinity, F.lit(BELOW_ALL).cast("long")).otherwise(_cell(F.col("low"))),
        "high_cell": F.when(F.col("high") == infinity, F.lit(ABOVE_ALL).cast("long")).otherwise(_cell(F.col("high")))})

    spans = _span_best(usable, located, keys, order, k)
    bounds = _cell_bounds(spans, located, keys, k)
    near = sized_join(usable, bounds, [*keys, "cell"], ["at", "sort"]).where("bound is null or sort <= bound")
    near = _cut(near, [*keys, "at"], order, k)

    # Ends in cells without such a candidate ask for nothing. The cells are fewer than 2^14 + 2 at any table size.
    ends = located.where("low_cell < high_cell").select(*keys, "target_price", F.inline(F.array(
        F.struct(F.col("low_cell").alias("cell"), F.col("low").alias("at"), F.lit(-1).alias("side")),
        F.struct(F.col("high_cell").alias("cell"), F.col("high").alias("at"), F.lit(1).alias("side")))))
    ends = ends.join(F.broadcast(near.select("cell").distinct()), "cell", "left_semi")
    narrow = located.where("low_cell = high_cell").select(*keys, "target_price", "low", "high", F.col("low_cell").alias("cell"))
    own = (_running_best(near, ends, keys, k).unionByName(_within_cells(near.where("narrow"), narrow, keys, order, k))
           .groupBy(*keys, "target_price").agg(_merged(F.collect_list("best"), k).alias("own_best")))
    span = ["low_cell", "high_cell"]
    both = (located.select(*keys, "target_price", *span)
            .join(spans, [*keys, *span], "left").join(own, [*keys, "target_price"], "left"))
    best = _merged(F.array_compact(F.array("span_best", "own_best")), k)
    return both.select(*keys, "target_price", best["row"].alias("best")).where(F.size("best") > 0)
