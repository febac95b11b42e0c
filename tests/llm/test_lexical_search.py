import math
import random
import re
from collections import Counter

import pytest

from shelfline.llm import lexical_search as search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def plain(docs, items, top=50):
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            m = 50 + 50 * sum(c.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(words(text)) if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def tables(seed, n_docs, n_items):
    rng = random.Random(seed)
    known = [f"{a}{b}" for a in "abcdéZ" for b in ("", "1", "漢", "xy", "Q")]
    def text(most):
        return rng.choice([" ", "-", "\n", "\x7f"]).join(known[min(int(rng.expovariate(0.15)), len(known) - 1)] for _ in range(rng.randint(0, most)))
    docs = [(i, text(40)) for i in range(n_docs)]
    docs += [docs[3]] * 60 + [(None, docs[5][1]), (None, docs[5][1]), (9000, None), (9001, ""), (9002, "! ?"), (9003, "rare " + "a1 " * 3000)]
    return docs, [(i, text(12)) for i in range(n_items)] + [(None, "a b a1"), (77, None), (78, ""), (79, "nowhere"), (2, "Q1 aQ"), (2, "Q1 aQ")]


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS terms", "2 AS n", "3 AS score").repartition(5),
            spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 AS rank"))


@pytest.mark.parametrize("block", [(256, 16_384), (4, 16_384), (256, 10)])
def test_search_agrees_with_plain_code(spark, monkeypatch, block):
    docs, items = tables(block[0] + block[1], 400, 15)
    every = list(search.blocks(frames(spark, docs, items)[1], most_items=block[0], most_terms=block[1]))
    assert sum(len(b.ids) for b in every) == len(items) and (len(every) > 1) == (block != (256, 16_384))
    cut = search.blocks
    monkeypatch.setattr(search, "blocks", lambda items, *names: cut(items, *names, most_items=block[0], most_terms=block[1]))
    got = search.search(*frames(spark, docs, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


@pytest.mark.parametrize("tree_docs, top", [(1, 3), (7, 50), (1024, 5)])
def test_tree_size_does_not_matter(spark, tree_docs, top):
    docs, items = tables(5, 300, 10)
    d, i = frames(spark, docs, items)
    (block,) = search.blocks(i)
    got = search.search_block(d, block, top=top, tree_docs=tree_docs).collect()
    assert sorted(((block.ids[r["item"]], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == plain(docs, items, top)


def test_empty_tables(spark):
    docs, items = frames(spark, *tables(1, 9, 2))
    assert search.search(docs.where("false"), items).isEmpty() and search.search(docs, items.where("false")).isEmpty()


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = (" ".join(f"Wörd{i}é" for i in range(500)) + "漢" * 100).encode()
    whole = [t for piece in search.terms(text) for t in piece]
    monkeypatch.setattr(search, "PIECE_BYTES", 37)
    assert [t for piece in search.terms(text) for t in piece] == whole == [w.encode() for w in words(text.decode())]


def test_bounds_hold_and_spare_nodes():
    """A node's bound is no less than any score below it, and equals it for a single document."""
    import numpy as np
    rng = np.random.default_rng(3)
    places = [np.unique(rng.integers(0, 40, rng.integers(1, 12))) for _ in range(300)]
    tf = [rng.integers(1, 9, len(p)) for p in places]
    m = rng.integers(50, 300, 300)
    weights = np.where(rng.random((40, 30)) < 0.1, rng.integers(1, 5000, (40, 30)), 0).astype(float)
    tree, every = search.Tree(places, tf, m, weights), np.arange(30)
    exact = np.array([[sum(int(weights[p, i]) * int(search.value(np.int64(t), m[d])) for p, t in zip(places[d], tf[d]))
                       for i in range(30)] for d in tree.documents])
    stack = [(0, 300)]
    while stack:
        low, high = stack.pop()
        starts = tree.children(low, high)
        ends = np.append(starts[1:], high)
        for a, b, bound in zip(starts, ends, tree.bounds(starts, high, every)):
            assert (bound >= exact[a:b].max(axis=0)).all() and (b - a > 1 or (bound == exact[a]).all())
            if b - a > 1:
                stack.append((a, b))
    best = search.Best(30, 5)
    def settle():
        best.settle(np.arange(300))
    met = tree.search(best, 0, settle)
    settle()
    for i in range(30):
        expected = sorted(((-s, d) for s, d in zip(exact[:, i], tree.documents) if s > 0))[:5]
        assert [(-s, r) for it, s, r in zip(*best.kept) if it == i] == expected
    again = tree.search(best, 0, lambda: None)
    assert again < met
