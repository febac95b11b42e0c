"""Profiles of missing values, duplicates, categories and features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.numeric import with_scalar
from shelfline.schema import ALL_MEASURES, DERIVED_MEASURES, FLAGS, MEASURES


def _per_column(df: DataFrame, fields: list[tuple[str, dict[str, Column]]]) -> DataFrame:
    """One aggregate over `df`, turned from one wide row into one row per column."""
    row = df.agg(F.array(*[
        F.struct(F.lit(name).alias("column"), *[e.alias(k) for k, e in exprs.items()])
        for name, exprs in fields]).alias("rows"))
    return row.select(F.inline("rows"))


def missing_values(df: DataFrame, columns: list[str] | None = None, only_missing: bool = False) -> DataFrame:
    """(column, dtype, total_rows, missing, missing_pct) for every column."""
    columns = columns or df.columns
    types = dict(df.dtypes)
    out = _per_column(df, [(c, {
        "dtype": F.lit(types[c]),
        "total_rows": F.count(F.lit(1)),
        "missing": F.count_if(F.col(c).isNull()),
    }) for c in columns])
    pct = F.bround(F.try_divide(F.col("missing"), F.col("total_rows")) * 100.0, 2)
    out = out.withColumn("missing_pct", F.coalesce(pct, F.lit(0.0)))
    return out.where("missing > 0") if only_missing else out


def total_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return missing_values(df, columns).agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("total_missing"))


def inspect(df: DataFrame, order: list[str] | None = None, head: int = 3, tail: int = 2) -> dict[str, DataFrame]:
    """Shape, column profile and sample rows. Head and tail need the file order."""
    shape = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
    out = {"shape": shape, "columns": missing_values(df)}
    if order:
        out["head"] = df.orderBy(*order).limit(head)
        out["tail"] = df.orderBy(*[F.desc(c) for c in order]).limit(tail)
    return out


def row_versions(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """(key, n): one row per distinct row of `df`, with how often it occurs.

    Rows are the same if their SHA-256 over all columns is; so one shuffle of digests counts them, combined
    before it, and wide text stays where it is.
    """
    columns = columns or df.columns
    digest = F.sha2(F.to_json(F.struct(*columns)), 256)
    return (df.select(F.col(key), digest.alias("_print")).groupBy("_print")
            .agg(F.count(F.lit(1)).alias("n"), F.first(key).alias(key)).select(key, "n"))


def duplicate_profile(df: DataFrame, key: str = "product_id", columns: list[str] | None = None) -> DataFrame:
    """Exact copies and repeated ids in one row.

    Rows are counted per distinct row first and those counts per id, so no id gathers its raw rows.
    """
    copies = row_versions(df, key, columns)
    per_id = copies.groupBy(key).agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("copied"),
        F.count_if(F.col("n") > 1).alias("groups"))
    known = F.col(key).isNotNull()
    repeated = F.col("rows") > 1
    zero = F.lit(0)
    return per_id.agg(
        F.coalesce(F.sum("copied"), zero).alias("exact_duplicate_rows"),
        F.coalesce(F.sum("groups"), zero).alias("exact_duplicate_groups"),
        F.count_if(repeated & known).alias("repeated_product_ids"),
        F.coalesce(F.sum(F.when(repeated, F.col("rows"))), zero).alias("rows_with_repeated_ids"),
        F.count_if(known).alias("unique_product_ids"),
        F.coalesce(F.sum("rows"), zero).alias("total_rows"),
        F.coalesce(F.max(F.when(known, F.col("rows"))), zero).alias("max_rows_per_product_id"))


def id_count_distribution(df: DataFrame, key: str = "product_id") -> DataFrame:
    """(rows_per_id, ids): how many ids have how many rows."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows_per_id"))
            .groupBy("rows_per_id").agg(F.count(F.lit(1)).alias("ids")))


def quality_summary(df: DataFrame, key: str = "product_id", measures: list[str] = MEASURES) -> DataFrame:
    """Final verification row: shape, residual nulls, extra copies, extra rows per id."""
    nulls = df.agg(sum((F.count_if(F.col(c).isNull()) for c in measures), F.lit(0)).alias("n"))
    per_id = row_versions(df, key).groupBy(key).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("versions"))
    zero = F.lit(0)
    counts = per_id.agg(
        F.coalesce(F.sum("rows"), zero).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.coalesce(F.sum(F.col("rows") - F.col("versions")), zero).alias("exact_duplicates"),
        F.coalesce(F.sum(F.col("rows") - 1), zero).alias("id_duplicates"))
    return with_scalar(counts, nulls, "residual_missing")


def category_counts(df: DataFrame, column: str = "main_category") -> DataFrame:
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("count")))


def category_profile(df: DataFrame, top: int = 10) -> dict[str, DataFrame]:
    """Distinct main categories, the depth distribution and the largest categories."""
    counts = category_counts(df)
    return {
        "distinct": counts.agg(F.count(F.lit(1)).alias("main_categories")),
        "depth": df.groupBy("category_depth").agg(F.count(F.lit(1)).alias("count")),
        "top": counts.orderBy(F.desc("count"), "main_category").limit(top),
    }


def feature_profile(df: DataFrame, flags: list[str] = FLAGS,
                    columns: list[str] = DERIVED_MEASURES) -> DataFrame:
    """True and false counts of flags, mean and sample deviation of numeric features."""
    def field(c: str) -> dict[str, Column]:
        flag = c in flags
        none = F.lit(None)
        v = F.col(c).cast("double")
        return {
            "true_count": F.count_if(F.col(c)) if flag else none.cast("long"),
            "false_count": F.count_if(~F.col(c)) if flag else none.cast("long"),
            "mean": none.cast("double") if flag else F.avg(v),
            "std": none.cast("double") if flag else F.stddev_samp(v),
        }
    return _per_column(df, [(c, field(c)) for c in [*flags, *columns] if c in df.columns])


def numeric_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """The wanted columns that exist and are numeric or boolean."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in (columns or ALL_MEASURES)
            if isinstance(types.get(c), (T.NumericType, T.BooleanType))]
