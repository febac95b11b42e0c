from collections import Counter
from fractions import Fraction
from math import isclose

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfline.llm import piece_sampling as p
from shelfline.llm.arrays import runs


@pytest.fixture(scope="module")
def vocabulary():
    return p.vocabulary_of(p.read_model(p.MODEL))


def coverings(segment, vocabulary):
    """All ways to cover a segment, with their weights."""
    if not segment:
        return [((), 1.0)]
    out = []
    for stop in range(1, len(segment) + 1):
        part = segment[:stop]
        if part in vocabulary.ids:
            out += [((vocabulary.ids[part], *rest), vocabulary.weights[part] * w) for rest, w in coverings(segment[stop:], vocabulary)]
        elif stop == 1:
            out += [((p._FALLBACK + ord(part), *rest), vocabulary.rare * w) for rest, w in coverings(segment[1:], vocabulary)]
    return out


@pytest.mark.parametrize("segment", [" the", "hello", " a", "▁x", "é中", " \U0001F600b"])
def test_draws_follow_the_lattice(vocabulary, segment):
    ways = coverings(segment, vocabulary)
    total = sum(w for _, w in ways)
    n = 40_000
    lattices = p.Lattices(["hello", segment, " other", "x"], vocabulary)
    pieces, counts = lattices.sample(np.ones(n, np.int64), np.full(n, len(segment)), p.mixed(np.arange(n, dtype=np.uint64)) << np.uint64(8))
    ends = np.cumsum(counts)
    seen = Counter(tuple(pieces[e - c:e].tolist()) for e, c in zip(ends, counts))
    assert set(seen) <= {w for w, _ in ways}
    for way, weight in ways:
        share = weight / total
        assert isclose(seen[way] / n, share, abs_tol=5 * (share * (1 - share) / n) ** 0.5 + 1e-4)


@pytest.mark.parametrize("segment", ["     ", "   the", "hello", "é中", "aaaaaaa"])
def test_long_path_follows_the_lattice(vocabulary, segment):
    ways = coverings(segment, vocabulary)
    total = sum(w for _, w in ways)
    n = 20_000
    lattice = p.LongLattice(segment, vocabulary)
    seen = Counter(tuple(lattice.sample(int(k))) for k in p.mixed(np.arange(n, dtype=np.uint64)) << np.uint64(8))
    assert set(seen) <= {w for w, _ in ways}
    for way, weight in ways:
        share = weight / total
        assert isclose(seen[way] / n, share, abs_tol=5 * (share * (1 - share) / n) ** 0.5 + 1e-4)


def test_spaces_and_unspaced_text_use_the_whole_lattice(vocabulary):
    """Shares of the pieces drawn, against forward and backward sums over the whole uncut text in exact fractions."""
    text = "if  x:\n        return" + " " * 5 + "https://example.com/" + "abcdefgh" * 25 + "中文字符" * 20
    weight = {w: Fraction(v) for w, v in vocabulary.weights.items()}
    n, longest = len(text), vocabulary.longest
    edges = [(i, j) for j in range(1, n + 1) for i in range(max(0, j - longest), j) if text[i:j] in weight or j == i + 1]
    mass = {e: weight.get(text[slice(*e)], Fraction(vocabulary.rare)) for e in edges}
    forward, backward = [Fraction(1)] + [Fraction(0)] * n, [Fraction(0)] * n + [Fraction(1)]
    for i, j in edges:
        forward[j] += forward[i] * mass[i, j]
    for i, j in sorted(edges, reverse=True):
        backward[i] += backward[j] * mass[i, j]
    wanted = {e: float(forward[e[0]] * mass[e] * backward[e[1]] / forward[n]) for e in edges}
    rows = 3000
    batch = pa.RecordBatch.from_arrays([pa.array([text] * rows)], names=["t"])
    drawn = Counter()
    for run in runs(batch, "t", 1 << 20):
        ids, counts = p.encode_run(run, np.arange(run.first, run.first + run.rows, dtype=np.uint64), vocabulary)
        for own in np.split(ids, np.cumsum(counts)[:-1]):
            ends = np.cumsum([len(vocabulary.bytes_[i]) for i in own])
            drawn.update(zip([0, *ends[:-1].tolist()], ends.tolist()))
    place = np.cumsum([0] + [len(c.encode()) for c in text]).tolist()
    assert any(text[i:j] == "        " and wanted[i, j] > 0.01 for i, j in edges)
    for (i, j), share in wanted.items():
        if text[i:j] in weight:
            assert isclose(drawn[place[i], place[j]] / rows, share, abs_tol=5.5 * (share * (1 - share) / rows) ** 0.5 + 5e-4)


def test_cuts_are_where_no_piece_can_cross(vocabulary):
    for text in ["  a  b \n\n  c", "x" * 300 + " " * 40 + "é中" * 60, "https://a.example/" + "q9-" * 50, " ", ""]:
        cut = vocabulary.segments(text)
        assert "".join(cut) == text and all(cut)
        assert all(a[-1] + b[0] not in vocabulary.joined for a, b in zip(cut, cut[1:]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text("ab ▁\n", max_size=80)), max_size=6), st.integers(1, 50))
def test_round_trip_and_independence(vocabulary, texts, limit):
    keys = np.arange(len(texts), dtype=np.uint64)

    def encoded(limit):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["t"])
        out = []
        for run in runs(batch, "t", limit):
            ids, counts = p.encode_run(run, keys[run.first:run.first + run.rows], vocabulary)
            out += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        return out

    got = encoded(limit)
    assert [p.decode_ids(ids, vocabulary) for ids in got] == [t or "" for t in texts]
    assert got == encoded(1 << 20)


def test_tables(spark, folder):
    rows = [(1, "Some text here", "k"), (1, "Some text here", "k"), (2, "Some text here", "k"), (3, None, "k"), (4, "", "k"),
            (None, "x" * 5000 + " \U0001F600\u2581", "k"), (5, "word " * 20000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece_ids string")
    got = p.decode(p.encode(df, keep=["doc_id", "text"])).collect()
    assert len(got) == len(rows) and all(r["decoded"] == (r["text"] or "") for r in got)
    assert all(r["ok"] for r in p.encode(df, verified="ok").collect())
    same = [r["piece_ids"] for r in got if r["doc_id"] == 1]
    assert same[0] == same[1]
    again = p.encode(df.repartition(5), keep=["doc_id"]).collect()
    assert sorted(map(str, ((r["doc_id"], r["piece_ids"]) for r in got))) == sorted(map(str, ((r["doc_id"], r["piece_ids"]) for r in again)))
    other = {r["doc_id"]: r["piece_ids"] for r in p.encode(df, seed=6).collect()}
    assert other[5] != {r["doc_id"]: r["piece_ids"] for r in got}[5]
    assert p.encode(df.where("false")).collect() == []


def test_shares_do_not_depend_on_other_segments(spark, folder, vocabulary):
    """The same draws whether a run holds one row or all of them."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(40)
    texts = pa.RecordBatch.from_arrays([pa.array(docs.toPandas().text, pa.string())], names=["t"])
    keys = np.arange(40, dtype=np.uint64)
    whole, single = ([p.encode_run(r, keys[r.first:r.first + r.rows], vocabulary)[0] for r in runs(texts, "t", limit)]
                     for limit in (1 << 20, 1))
    assert len(whole) == 1 and np.concatenate(whole).tolist() == np.concatenate(single).tolist()


def test_columns_with_the_names_of_results(spark):
    df = spark.createDataFrame([(1, "ein  Text", "a", "b", "c", True)], "doc_id long, text string, piece_ids string, decoded string, __key string, lossless boolean")
    encoded = p.encode(df, keep=["doc_id", "piece_ids", "decoded", "__key", "lossless"], verified="lossless")
    assert encoded.columns == ["doc_id", "decoded", "__key", "piece_ids", "lossless"]
    r = p.decode(encoded).first()
    assert (r["decoded"], r["__key"], r["lossless"]) == ("ein  Text", "c", True)


def test_model_comes_from_the_driver(tmp_path, spark, monkeypatch):
    copy = tmp_path / "pieces.model"
    copy.write_bytes(p.read_model(p.MODEL))
    encoded = p.encode(spark.createDataFrame([(1, "one two")], "doc_id long, text string"), model=str(copy))
    copy.write_bytes(b"")  # tasks don't read the file
    assert p.decode(encoded).first()["decoded"] == "one two"
    monkeypatch.setattr(p, "MODEL_BYTES", 10)
    with pytest.raises(ValueError):
        p.read_model(p.MODEL)
