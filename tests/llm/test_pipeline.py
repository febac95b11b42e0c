import re

import corpus_pipeline
from shelfline.llm import pii, quality_ledger
from shelfline.llm.queries import QUERIES

STAGE = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_on_documents_agree_with_plain_code(spark, folder):
    """Each stage on what its predecessor kept, against code that looks at one text or pair after the other."""
    from test_pii import plain as plain_spans
    from test_quality_ledger import plain as plain_measures
    from test_simhash import plain_components, plain_fingerprint

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = STAGE["language_id"](spark, docs, folder)
    kept = rows_of(found)
    assert kept == [r for r in rows_of(docs) if re.search(r"[^\W\d_]", r[1])]
    good = STAGE["quality_rules"](spark, found, folder)

    def fine(text):
        m = plain_measures(text)
        return not (m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
                    or not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"] or 10 * m["n_symbols"] > m["n_words"]
                    or 2 * m["n_dup_lines"] > m["n_lines"] >= 6 or 10 * m["n_alpha_words"] < 7 * m["n_words"])

    kept = [r for r in kept if fine(r[1])]
    assert rows_of(good) == kept and len(kept) > 100
    single = STAGE["simhash_near_dedup"](spark, good, folder)
    parts = plain_components([plain_fingerprint(r[1]) for r in kept], [r[0] for r in kept])
    kept = [r for r, p in zip(kept, parts) if r[0] == p]
    assert rows_of(single) == kept
    masked = STAGE["personal_data"](spark, single, folder)
    expected = [(r[0], pii.redacted(r[1], plain_spans(r[1])), *r[2:4], 0) for r in kept]
    got = rows_of(masked)
    assert [(*r[:4], 0) for r in got] == expected and all(r[4] == len(r[1]) or r[4] == s[4] for r, s in zip(got, kept))
    assert masked.columns == docs.columns
    packed = STAGE["length_packing"](spark, masked, folder).toPandas()
    assert dict(zip(packed.doc_id, packed.n_tokens)) == {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in got}
    whole = QUERIES["pipeline"](spark, folder).toPandas()
    assert sorted(map(str, whole.itertuples(index=False))) == sorted(map(str, packed.itertuples(index=False)))


def test_stages_take_hard_rows(spark, folder):
    clean = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} and" for i in range(200))
    rows = [(1, clean, "en", 1), (1, clean, "en", 1), (None, clean + " x@y.zz", None, 2), (2, None, "en", 3), (3, "", None, 4),
            (4, "12 34", "en", 5), (5, clean.upper(), "en", 6)]
    extra = ", ".join(f"`{x}` int" for x in ("lang_pred", "score", "failed", "__row", "__fingerprint", "masked"))
    df = spark.createDataFrame([(*r, *range(6)) for r in rows], f"doc_id long, text string, lang string, n_words int, {extra}")
    out = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, folder)
        assert out.columns == df.columns
        empty = stage(spark, df.where("false"), folder)
        assert empty.columns == df.columns and empty.isEmpty()
    got = out.collect()
    assert [r["doc_id"] for r in got if r["doc_id"]] == [1] and all(tuple(r[4:]) == tuple(range(6)) for r in got)
    assert all("x@y.zz" not in r["text"] for r in got)
    assert corpus_pipeline.STAGES[-1][1](spark, out, folder).count() == len(got)
    assert STAGE["length_packing"](spark, df.where("false"), folder).isEmpty()
    assert quality_ledger.DEFAULT_POLICY in quality_ledger.POLICIES
