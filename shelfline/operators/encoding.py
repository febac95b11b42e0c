"""Label and one-hot encoding by a stored dictionary."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.numeric import counted_join
from shelfline.session import materialize

DICTIONARY_SCHEMA = T.StructType([T.StructField("value", T.StringType()), T.StructField("n", T.LongType()),
                                  T.StructField("code", T.LongType())])
_INDEX_BITS = 33  # of monotonically_increasing_id: the rest is the partition


def numbered(df: DataFrame, order: list, name: str, schema: dict | None = None) -> DataFrame:
    """`df` with its rows numbered from 0 in the given order, which should leave no ties. Writes the sorted rows once.

    Rows are sorted by ranges; each range's rows are numbered where they lie, behind the rows of the ranges before.
    """
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", _INDEX_BITS)
    index = F.col("_place").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    # One row per partition of the sort.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return (placed.withColumn("_part", part).join(F.broadcast(before), "_part")
            .withColumn(name, F.col("_before") + index).drop("_part", "_before", "_place"))


def fit_dictionary(df: DataFrame, column: str, least: int = 1) -> DataFrame:
    """(value, n, code): the values of a column by falling count and then by value, coded from 0.

    Nulls have no code, nor have values of fewer than `least` rows. Writes a table when called.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    return numbered(counts.where(F.col("n") >= least), [F.desc("n"), F.asc("value")], "code").select("value", "n", "code")


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    dictionary.write.mode("overwrite").parquet(path)


def read_dictionary(spark, path: str) -> DataFrame:
    return spark.read.schema(DICTIONARY_SCHEMA).parquet(path)


def encode(df: DataFrame, column: str, dictionary: DataFrame, name: str | None = None) -> DataFrame:
    """`df` with the code of `column` as `name` (default: `<column>_code`); null or unseen values get the rest code.

    The rest code is the size of the dictionary, so codes stay dense. Values that own much of the table are joined where
    their rows lie. `df` and the dictionary are read twice, so both should be written tables.
    """
    name = name or f"{column}_code"
    known = dictionary.select(F.col("value").alias("_value"), F.col("n").alias("_n"), F.col("code").alias("_code"))
    joined = counted_join(df.withColumn("_value", F.col(column).cast("string")), known, "_value", "_n", how="left")
    rest = F.coalesce(known.agg((F.max("_code") + 1).alias("m")).scalar(), F.lit(0).cast("long"))
    return joined.withColumn(name, F.coalesce("_code", rest)).select(*[c for c in df.columns if c != name], name)


def one_hot(df: DataFrame, code: str, size: int, name: str | None = None) -> DataFrame:
    """`df` with the code as a sparse vector of `size` + 1 places (default name: `<code>_vector`); the last is the rest's."""
    top = df.sparkSession.range(size, size + 1).select(F.col("id").cast("double").alias(code))
    model = OneHotEncoder(inputCol=code, outputCol=name or f"{code}_vector", dropLast=False).fit(top)
    return model.transform(df)


def encode_all(df: DataFrame, columns: list[str], dictionaries: dict[str, DataFrame]) -> DataFrame:
    """Codes and one-hot vectors of several columns. Counts the dictionaries when called."""
    out = df
    for c in columns:
        out = one_hot(encode(out, c, dictionaries[c]), f"{c}_code", dictionaries[c].count())
    return out
