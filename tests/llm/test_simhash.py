import re
from collections import Counter

import pytest
import xxhash

from shelfline.llm import simhash
from shelfline.llm.components import connected_components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    n = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        n.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * n[b] > len(shingles))


def plain_components(fingerprints, ids, radius=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fingerprints[i] ^ fingerprints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    members = {}
    for i in range(len(ids)):
        members.setdefault(find(i), []).append(ids[i])
    return [min((x for x in members[find(i)] if x is not None), default=None) for i in range(len(ids))]


TEXTS = [None, "", " \n", "a", "A", "a b", "a b c", "a b c d", "x y z " * 50, "X y z " * 50, "é ü\x0bß one", "long " + "w " * 20000]


def test_agrees_with_brute_force(spark, folder):
    base = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").toPandas()
    texts = [*TEXTS, *base.text, base.text[3] + " tail", base.text[5]]
    ids = [None if i == 4 else i if i != 7 else 6 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in zip(ids, texts)],
                               "doc_id long, text string, component_id int, fingerprint string")
    got = sorted(((r["doc_id"] is None, r["doc_id"], r["fingerprint"], r["component_id"])
                  for r in simhash.near_duplicates(df).collect()), key=str)
    prints = [plain_fingerprint(t) for t in texts]
    parts = plain_components(prints, ids)
    assert got == sorted(((i is None, i, f"{f:016x}", c) for i, f, c in zip(ids, prints, parts)), key=str)


def test_links_at_every_distance(spark):
    """Chains and balls of fingerprints, distances 0 to 4, bit 63 included."""
    base = 0x0123456789ABCDEF
    flips = [(), (0,), (0, 63), (5, 6, 7), (5, 6, 7, 8), (5, 6), (40, 41, 42), (40, 41, 42, 43, 44), (10, 11, 12, 13)]
    values = [base ^ sum(1 << b for b in f) for f in flips] + [(1 << 64) - 1, 0, 3]
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    got = {r["fingerprint"]: r["component"] for r in simhash.fingerprint_components(df, "doc_id").collect()}
    expected = plain_components(values, list(range(len(values))))
    assert [got[r[1]] for r in rows] == expected
    with pytest.raises(ValueError):
        simhash.link_fingerprints(df, 3)


def test_deduplicate_keeps_one_of_each_component(spark):
    texts = ["a b c", "A b c", "d e f g", None, "", "d e f g"]
    df = spark.createDataFrame([(9 - i, t, i) for i, t in enumerate(texts)] + [(None, "q r s", 7), (None, "q r s", 8)],
                               "doc_id long, text string, __row int")
    got = simhash.deduplicate(df.withColumnRenamed("__row", "extra"))
    assert got.columns == ["doc_id", "text", "extra"]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got.collect()) == [(0, "q r s"), (4, "d e f g"), (5, ""), (8, "A b c")]
    assert simhash.deduplicate(df.where("false").drop("__row")).collect() == []


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(400)}}
    assert connected_components(df.where("false")).collect() == []
