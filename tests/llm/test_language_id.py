from collections import Counter

from pyspark.sql import functions as F

from shelfline.llm import language_id
from shelfline.llm.queries import QUERIES


def grams(text):
    """n-grams of one text, the plain way, as code points of a fixed width."""
    padded = [0] + [ord(c.lower()) if c.isalpha() else 0 for c in text] + [0]
    n = Counter()
    for i, c in enumerate(padded):
        if c:
            n[c << 42] += 1
        two = padded[i:i + 2]
        if len(two) == 2 and any(two):
            n[((two[0] or 1) << 42) | ((two[1] or 1) << 21)] += 1
        three = padded[i:i + 3]
        if len(three) == 3 and three[1]:
            n[((three[0] or 1) << 42) | (three[1] << 21) | (three[2] or 1)] += 1
    return n


def ranks(counts, size):
    ordered = sorted(counts, key=lambda g: (-counts[g], g))[:size]
    return {g: r for r, g in enumerate(ordered)}


def plain(text, profiles, size):
    own = ranks(grams(text or ""), size)
    if not own:
        return "und", 0.0
    distance = {l: sum(abs(p[g] - r) if g in p else size for g, r in own.items()) for l, p in profiles.items()}
    best = min(sorted(distance), key=distance.get)
    return best, 1 - distance[best] / (len(own) * size)


def test_agrees_with_plain_profiles(spark):
    rows = [(1, "The cat, the hat! élan", "en"), (2, "der Hund und die Katze", "de"), (3, "the dog", "en"),
            (4, None, "en"), (5, "", "de"), (6, "123 ###", "en"), (7, "Straße ÄÖ und", "de"), (8, "x", None),
            (9, "中文字符", "zh"), (1, "The cat, the hat! élan", "en"), (10, "thé " * 3000, "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.learn_profiles(df, size=20)
    profiles = {}
    for r in found.collect():
        profiles.setdefault(r["lang"], {})[r["gram"]] = r["rank"]
    expected = {}
    for lang in {r[2] for r in rows if r[2]}:
        total = Counter()
        for _, text, l in rows:
            if l == lang:
                total += grams(text or "")
        if total:
            expected[lang] = ranks(total, 20)
    assert profiles == expected
    languages = language_id.Languages(found, 20)
    got = language_id.identify(df.withColumn("score_", F.lit(1)), languages, ["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = plain(r["text"], expected, 20)
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-12


def test_nothing_learnt_and_empty_table(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    languages = language_id.Languages(language_id.learn_profiles(df))
    assert language_id.identify(df, languages, ["doc_id"]).collect() == [(1, "und", 0.0)]
    assert language_id.identify(df.where("false"), languages, ["doc_id"]).collect() == []


def test_held_out_accuracy(spark, folder):
    got = QUERIES["op1_language_id"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    right = got.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.95
    assert got.where("score < 0 or score > 1").isEmpty()
