"""From raw documents to packed training batches, one operator a stage.

Each stage reads what its predecessor wrote and works on all of it. All but the last return the columns
of documents: language identification drops texts without a language, quality rules drop what the default
policy rejects, near-duplicate removal keeps one document of each group of linked SimHash fingerprints, personal data is masked in
the text, and packing assigns buckets and batches. Stages learn (language profiles, span
trees) from their own input only.

Nulls, empty texts, repeated rows, empty tables and further columns are treated as the operators state; columns
that share a name with an operator's own are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import language_id, packing, pii, quality_ledger, simhash
from shelfline.llm.arrays import sheltered
from shelfline.session import materialize

#: A text's letters agree with no learnt profile below this score.
LEAST_LANGUAGE_SCORE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are `und` or whose best language scores below `LEAST_LANGUAGE_SCORE`."""
    third = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 3 = 1"), F.lit(False))
    languages = language_id.Languages(language_id.learn_profiles(docs.where(~third)))
    given, names, back = sheltered(docs)
    found = language_id.identify(given, languages, given.columns, names["text"])
    return back(found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the default policy rejects."""
    given, names, back = sheltered(docs)
    ledger = quality_ledger.ledger(given, names["text"], keep=given.columns)
    return back(ledger.where(~quality_ledger.rejected(quality_ledger.DEFAULT_POLICY)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of fingerprints that operator 3 links."""
    given, names, back = sheltered(docs)
    return back(simhash.deduplicate(given, names["doc_id"], names["text"]))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the spans found by their kind; a changed text gets a new n_chars."""
    return pii.redact(docs, pii.train(docs))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("simhash_near_dedup", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("length_packing", pack_batches),
]

#: Fingerprints, language profiles and boosted trees are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
