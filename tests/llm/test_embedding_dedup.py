import numpy as np
import pandas as pd

from shelfline.llm import embedding_dedup as e


def plain(df, threshold=0.93):
    vectors = np.stack(df.embedding.values).astype(float)
    norms = np.linalg.norm(vectors, axis=1)
    hit = (vectors @ vectors.T / np.outer(norms, norms) >= threshold) & (df.label.values[:, None] == df.label.values)
    np.fill_diagonal(hit, False)
    root = df.vec_id.values.copy()
    while True:
        new = np.array([min(root[i], root[hit[i]].min()) if hit[i].any() else root[i] for i in range(len(root))])
        if (new == root).all():
            return hit.sum(axis=1), root
        root = new


def clusters(rng, n, size, dim, noise):
    centres = rng.standard_normal((n, dim))
    return np.concatenate([c + noise * rng.standard_normal((size, dim)) for c in centres]).astype(np.float32)


def test_recall_and_components_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = np.concatenate([clusters(rng, 40, 12, 32, 0.2), clusters(rng, 3, 150, 32, 0.02), rng.standard_normal((500, 32)).astype(np.float32)])
    df = pd.DataFrame({"vec_id": rng.permutation(len(vectors)), "embedding": list(vectors), "label": rng.integers(0, 3, len(vectors))})
    src = spark.createDataFrame([(int(i), [float(x) for x in v], int(l), 1) for i, v, l in zip(df.vec_id, df.embedding, df.label)],
                                "vec_id long, embedding array<float>, label int, n_links int")
    links, root = plain(df)
    for block in (4096, 64):
        got = e.near_duplicates(src, block_rows=block).toPandas().set_index("vec_id").loc[df.vec_id]
        assert (got.n_links.values <= links).all()
        assert got.n_links.sum() >= 0.999 * links.sum()
        assert (got.kept.values == (got.index.values == got.component_id.values)).all()
        if (got.n_links.values == links).all():
            assert (got.component_id.values == root).all()


def test_calibration_reaches_its_recall():
    rng = np.random.default_rng(0)
    for rows in (10, 5000, 200_000):
        plan = e.calibrate(rows)
        a = rng.standard_normal((2000, 64))
        a /= np.linalg.norm(a, axis=1)[:, None]
        b = rng.standard_normal((2000, 64))
        b -= (a * b).sum(axis=1)[:, None] * a
        b /= np.linalg.norm(b, axis=1)[:, None]
        b = 0.93 * a + np.sqrt(1 - 0.93 ** 2) * b
        pa, la = e._signatures(a, plan)
        pb, lb = e._signatures(b, plan)
        hits = ((pa == pb) & (np.abs(la - lb) <= plan["window"])).sum(axis=1)
        assert (hits >= plan["needed"]).mean() > 0.995


def test_unfit_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, None, 1), (4, [nan, 1.0], 1), (5, [0.0, 0.0], 1),
            (6, [1.0, None], 1), (7, [1.0, 0.0], None), (8, [inf, 0.0], 1), (None, [1.0, 0.0], 1), (9, [], 1), (10, [5.0, 0.1], 1),
            (11, [1.0, 0.0, 0.0], 1), (12, [-0.0, 1.0], 1), (13, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in e.near_duplicates(df).collect()), key=str)
    expected = [(0, 0, None, None), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (10, 3, 1, False), (12, 1, 12, True),
                (13, 1, 12, False), (11, 0, 11, True)] + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted(expected, key=str)
    assert e.near_duplicates(df.where("false")).collect() == []


def test_size_of_vectors_does_not_matter(spark):
    rows = [(i, [a * size, b * size], 1) for i, (a, b, size) in enumerate([
        (1.0, 0.0, 1e300), (1.0, 0.1, 1e-300), (2.0, 0.1, 1e160), (0.0, 1.0, 1e308), (0.0, 1.0, 5e-324), (-1.0, 0.0, 1e-170)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in e.near_duplicates(df).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (1, 3), 4: (1, 3), 5: (0, 5)}
