"""A trigram index of product names that prefilters literal and regular-expression search."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.filters import search_products

BUCKETS = 64
#: Characters outside ASCII that match ASCII letters when case is ignored, and those letters.
FOLDED = ("ſKıİ", "skii")
#: The most trigrams of a term that are looked up; the rarest say the most.
LOOKED_UP = 4
_GRAM = re.compile(r"(?=([\x20-\x7e]{3}))")
# Parts of a regular expression behind which nothing is sure to occur as it is written.
_SPECIAL = re.compile(r"[\\()\[\]{}|^$.*+?]")


def folded(text: Column) -> Column:
    return F.lower(F.translate(text, *FOLDED))


def _grams(text: Column) -> Column:
    """The distinct trigrams of printable ASCII characters."""
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - 2, F.lit(1)))
    return F.array_distinct(F.filter(F.transform(at, lambda i: F.substring(text, i, 3)), lambda g: g.rlike(r"^[\x20-\x7e]{3}\z")))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def write_index(df: DataFrame, path: str, column: str = "product_name", key: str = "product_id") -> None:
    """Postings (gram, key) in folders by a hash of the trigram, sorted by it within files; and the number of keys per trigram."""
    text = folded(F.col(column))
    postings = df.where(F.col(column).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.explode(_grams(text)).alias("gram")).distinct().withColumn("bucket", _bucket(F.col("gram")))
    # Even ranges: a trigram of many names fills as many tasks as its keys need, and a file holds few trigrams.
    order = ["bucket", "gram", "key"]
    spread = postings.repartitionByRange(*order).sortWithinPartitions(*order)
    spread.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    stored = df.sparkSession.read.parquet(f"{path}/postings")
    stored.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).repartitionByRange("gram").sortWithinPartitions("gram").write.mode(
        "overwrite").parquet(f"{path}/grams")


def required_grams(term: str, literal: bool) -> list[str]:
    """Trigrams that every name with the term has, whatever the case; none if nothing is sure.

    Of a regular expression, only runs of plain characters outside groups, classes and alternatives count, without
    the last of a run that a quantifier follows.
    """
    if literal:
        runs = [term]
    elif "|" in term or "(" in term or "\\" in term or "[" in term:
        runs = []
        # Only what stands before the first of them, at the top level, is sure; with alternatives nothing is.
        if "|" not in term:
            runs = _plain_runs(re.split(r"[\\(\[]", term)[0], cut=re.split(r"[\\(\[]", term)[0] != term)
    else:
        runs = _plain_runs(term)
    found = []
    for run in runs:
        found += [m[1] for m in _GRAM.finditer(run.translate(str.maketrans(*FOLDED)).lower())]
    return list(dict.fromkeys(found))


def _plain_runs(term: str, cut: bool = False) -> list[str]:
    runs, at = [], 0
    for m in _SPECIAL.finditer(term):
        run = term[at:m.start()]
        # `x*`, `x?`, `x+` and `x{..}` speak of the last character only.
        runs.append(run[:-1] if m[0] in "*?+{" else run)
        at = m.end()
        if m[0] == "{":
            at = term.find("}", at) + 1 or len(term)
    return [*runs, term[at:]]


def search_indexed(df: DataFrame, path: str, term: str, category: str | None = None, literal: bool = False,
                   column: str = "product_name", key: str = "product_id") -> DataFrame:
    """The rows that `search_products` finds, by way of the index at `path`.

    Names that have the term's rarest trigrams are looked up in the postings, and the search itself decides among those;
    a term without a sure trigram is searched for without the index. Reads a few counts when called.
    """
    spark = df.sparkSession
    wanted = required_grams(term, literal)
    if not wanted:
        return search_products(df, term, category, literal, column)
    counts = spark.read.parquet(f"{path}/grams").where(F.col("gram").isin(wanted)).orderBy("n", "gram").limit(LOOKED_UP)
    # At most LOOKED_UP rows.
    chosen = [r["gram"] for r in counts.collect()]
    if len(chosen) < min(LOOKED_UP, len(wanted)):
        # No name has one of the trigrams.
        return df.where(F.lit(False))
    buckets = [r["b"] for r in spark.createDataFrame([(g,) for g in chosen], "gram string").select(_bucket(F.col("gram")).alias("b")).collect()]
    postings = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(buckets) & F.col("gram").isin(chosen))
    having = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(chosen)).select(F.col("key").alias(key))
    return search_products(df.join(having, key, "left_semi"), term, category, literal, column)
