import re
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfline.llm import quality_ledger as q
from shelfline.llm.arrays import runs


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
            "n_alpha_words": sum(any(c.isascii() and c.isalpha() or ord(c) > 127 for c in w) for w in words),
            "n_distinct_words": len(set(words))}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab# \n\t\x0bé", max_size=40), st.text(max_size=10)), max_size=8), st.integers(1, 60))
def test_measures_agree_with_plain_code(texts, limit):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["t"])
    got = []
    for run in runs(batch, "t", limit):
        found = q.measure(run)
        got += [{m: int(found[m][i]) for m in q.MEASURES} for i in range(run.rows)]
    assert got == [plain(t) for t in texts]


def test_policies_and_ablations(spark):
    texts = [None, "", "word " * 60, " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}#" for i in range(60)),
             " ".join(str(i) for i in range(100, 160)), "a b", "one line\n" * 7, "two\nlines\ntwo"]
    df = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    table = q.ledger(df)
    assert table.columns == ["doc_id", *q.MEASURES, "failed"]
    rows = {r["doc_id"]: r for r in q.apply_policies(table).collect()}
    for i, t in enumerate(texts):
        m = plain(t)
        failed = [name for name, test in [
            ("few_words", m["n_words"] < 50), ("repeated_windows", 100 * m["n_repeat_words"] > 50 * m["n_words"]),
            ("short_mean_word", m["word_chars"] < 2 * m["n_words"]), ("symbols", 10 * m["n_symbols"] > m["n_words"]),
            ("repeated_lines", 2 * m["n_dup_lines"] > m["n_lines"] >= 6), ("few_letters", 10 * m["n_alpha_words"] < 7 * m["n_words"]),
            ("few_distinct_words", 20 * m["n_distinct_words"] < m["n_words"] < 2000)] if test]
        assert rows[i]["failed"] == q.mask(tuple(failed))
        for p in q.POLICIES:
            bad = set(failed) & set(p.strict) or len(set(failed) & set(p.soft)) > p.allowed
            assert rows[i][f"kept_{p.version}"] == (not bad)
    effects = {(r["version"], r["rule"]): r for r in q.ablations(table).collect()}
    for p in q.POLICIES:
        for rule in (*p.strict, *p.soft):
            r = effects[p.version, rule]
            without = [x for x in rows.values() if set(names(x["failed"])) & (set(p.strict) - {rule})
                       or len(set(names(x["failed"])) & (set(p.soft) - {rule})) > p.allowed]
            assert (r["n_rows"], r["n_failed"], r["n_rejected"], r["n_rejected_without"]) == (
                len(texts), sum(rule in names(x["failed"]) for x in rows.values()),
                sum(not x[f"kept_{p.version}"] for x in rows.values()), len(without))
    empty = q.ablations(q.ledger(df.where("false"))).collect()
    assert empty and all(r["n_rows"] == r["n_rejected"] == 0 for r in empty)


def names(bits):
    return [r.name for k, r in enumerate(q.RULES) if bits >> k & 1]
