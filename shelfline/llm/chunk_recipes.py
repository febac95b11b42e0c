"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text without its spaces is cut where its content says so: after a doubled character that comes at least
`LEAST` code points behind the last cut, or after `MOST` at the latest. A passage that several texts share
is therefore cut alike in all of them, wherever it stands. A chunk's identifier is a few 64-bit hashes
under different seeds. The distinct chunks, combined before their shuffle so that a chunk moves once per
map task however many texts hold it, show whether an identifier stands for two contents; if one does, all
identifiers get one more hash and are verified again. With verified identifiers two texts are equal if
and only if their recipes, the ordered lists of identifiers, are equal, so recipes of about a tenth of
the text take part in grouping, and the texts stay where they are.

Defined cases: a null text counts as an empty one; texts of spaces only have the empty recipe and are
equal. Of equal texts, the row with the most code points in the original text stays, then the one with the
smallest doc_id (null comes last), then any one of rows that agree in both. Every row of the input is
in the result, repeated rows too. An empty table gives an empty result. Other columns don't matter. Long
texts are cut into chunks like any other. Texts must be valid UTF-8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numeric import counted_join
from shelfline.session import materialize

LEAST, MOST = 128, 4096
#: Hashes in an identifier at first; two rarely fail the verification below 10**18 distinct chunks.
HASHES = 2


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a text in order; joined, they are the text."""
    cut = rf"(?s).{{{least - 2},{most - 2}}}?(.)\1|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def identifier(chunk: Column, hashes: int = HASHES, bits: int = 64) -> Column:
    """The chunk's hashes under as many seeds; `bits` narrows each of them, which tests use."""
    found = [F.xxhash64(F.lit(seed), chunk) for seed in range(hashes)]
    return F.array(*[h if bits == 64 else h.bitwiseAND(F.lit((1 << bits) - 1)) for h in found])


def recipe(text: Column, hashes: int = HASHES, bits: int = 64) -> Column:
    """The identifiers of a text's chunks, one after the other."""
    return F.flatten(F.transform(chunks(text), lambda c: identifier(c, hashes, bits)))


def chunk_store(df: DataFrame, text: str = "text", hashes: int = HASHES, bits: int = 64) -> DataFrame:
    """(chunk_id, chunk): every distinct chunk of the normalised texts."""
    cut = df.select(F.explode(chunks(normalized(F.col(text)))).alias("chunk"))
    # The identifier depends on the chunk alone, so the chunk is the only key of the combined rows.
    return cut.distinct().select(identifier(F.col("chunk"), hashes, bits).alias("chunk_id"), "chunk")


def clashes(store: DataFrame) -> DataFrame:
    """The identifiers that stand for more than one chunk."""
    return store.groupBy("chunk_id").agg(F.count("*").alias("n")).where("n > 1")


def verified_hashes(df: DataFrame, text: str = "text", hashes: int = HASHES, bits: int = 64) -> int:
    """The number of hashes, at least the given one, with which every chunk of `df` has its own identifier. Runs jobs."""
    while not clashes(chunk_store(df, text, hashes, bits)).isEmpty():
        hashes += 1
    return hashes


def recipes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", hashes: int = HASHES, bits: int = 64) -> DataFrame:
    """(doc_id, row, n_chars, recipe, text_sha256): n_chars of the original, the rest of the normalised text."""
    plain = df.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                      F.coalesce(F.char_length(F.col(text)), F.lit(0)).alias("n_chars"),
                      normalized(F.col(text)).alias("plain"))
    return plain.select("doc_id", "row", "n_chars", recipe(F.col("plain"), hashes, bits).alias("recipe"),
                        F.sha2("plain", 256).alias("text_sha256"))


def exact_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", hashes: int = HASHES,
                     bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row. Runs jobs when called.

    `df` is read twice: once for its chunks, once for its recipes.
    """
    table = materialize(recipes(df, doc_id, text, verified_hashes(df, text, hashes, bits), bits), "recipes")
    # Equal recipes have equal digests, so the digest may name the group to its rows if no two groups share one.
    first = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = materialize(table.groupBy("recipe").agg(
        F.count("*").alias("group_size"), first, F.min("text_sha256").alias("text_sha256")), "recipe-groups")
    alone = groups.groupBy("text_sha256").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    key = "text_sha256" if alone else "recipe"
    facts = groups.select(key, "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"))
    return counted_join(table, facts, key, "group_size").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")
