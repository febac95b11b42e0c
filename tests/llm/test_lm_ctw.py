import math
import re
from collections import Counter, defaultdict
from functools import cache

from shelfline.llm import lm_ctw
from shelfline.llm.queries import QUERIES

DEPTH = lm_ctw.DEPTH


def log_kt(a, b):
    """Log probability of a zeros and b ones, one bit after the other."""
    return sum(math.log((i + 0.5) / (i + 1)) for i in range(a)) + sum(math.log((i + 0.5) / (a + i + 1)) for i in range(b))


def plain_scores(training, texts):
    """Context-tree weighting by its definition: a recursion over contexts for every bit of every byte."""
    def lowered(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode() + b"\xff"

    counts = defaultdict(lambda: [0, 0])
    below = defaultdict(set)
    for t in training:
        data = b"\xff" * DEPTH + lowered(t)
        for i in range(DEPTH, len(data)):
            for bit in range(8):
                node = (data[i] | 256) >> (8 - bit)
                for d in range(DEPTH + 1):
                    context = data[i - d:i]
                    counts[node, context][data[i] >> (7 - bit) & 1] += 1
                    if d:
                        below[node, context[1:]].add(context)

    @cache
    def weighted(node, context):
        own = log_kt(*counts[node, context])
        if len(context) == DEPTH:
            return own
        rest = sum(weighted(node, c) for c in below[node, context])
        return math.log(0.5 * (1 + math.exp(rest - own))) + own if own > rest else math.log(0.5 * (1 + math.exp(own - rest))) + rest

    def one(node, path):
        """Probability of a one, mixing along a context from its shortest part on."""
        context = path[0]
        a, b = counts[node, context] if (node, context) in counts else (0, 0)
        mine = (b + 0.5) / (a + b + 1)
        if len(path) == 1:
            return mine
        share = 0.5 * math.exp(log_kt(a, b) - (weighted(node, context) if a + b else 0.0))
        return share * mine + (1 - share) * one(node, path[1:])

    out = []
    for t in texts:
        data, total = b"\xff" * DEPTH + lowered(t), 0.0
        for i in range(DEPTH, len(data)):
            for bit in range(8):
                p = one((data[i] | 256) >> (8 - bit), [data[i - d:i] for d in range(DEPTH + 1)])
                total += math.log10(p if data[i] >> (7 - bit) & 1 else 1 - p)
        out.append(total)
    return out


def plain_base(training, text):
    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    c = Counter(w for t in training for w in tokens(t))
    n, v = sum(c.values()), len(c)
    own = tokens(text)
    return len(own), sum(c[w] > 0 for w in own), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)


ROWS = [(1, "the cat The CAT"), (2, "a hat\nthe"), (3, None), (4, ""), (20, "the bat é"), (21, "zzz the cat"), (None, "no id"),
        (1, "the cat The CAT"), (22, "ab" * 30)]


def check(spark, rows, held, monkeypatch=None):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")
    got = lm_ctw.score_documents(df, f"doc_id in ({','.join(map(str, held))})").collect()
    training = [t for i, t in rows if i not in held]
    expected = {}
    for (i, t), s in zip(rows, plain_scores(training, [t for _, t in rows])):
        expected[i] = (*plain_base(training, t), s)
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, r["doc_id"] in held)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert math.isclose(r["score"], score, rel_tol=1e-5, abs_tol=1e-5)


def test_agrees_with_the_definition(spark):
    check(spark, ROWS, [20, 21, 22])


def test_shards_and_rare_words_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(lm_ctw, "SHARD_GRAMS", 40)
    monkeypatch.setattr(lm_ctw, "HEAVY_WORDS", 10)
    check(spark, ROWS, [20, 21, 22])


def test_nothing_to_learn_from(spark):
    check(spark, [(1, "ab c"), (2, None)], [1, 2])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lm_ctw.score_documents(df, "doc_id = 0").collect() == []


def test_held_out_texts_score_above_the_base(spark):
    got = QUERIES["op7_lm_scoring"](spark, "/root/testdata/sf0.1").where("held_out").selectExpr("sum(score) AS s", "sum(base_score) AS b").first()
    assert got["s"] > 0.97 * got["b"]


def test_probabilities_of_a_context_sum_to_one(spark, folder):
    got = QUERIES["op7_lm_scoring"](spark, folder).toPandas()
    assert got.score.lt(0).all() and got.bits_per_byte[got.n_bytes > 500].mean() < 3.5
