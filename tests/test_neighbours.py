"""Neighbour graphs, weights, layouts and mixtures against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import neighbours as N
from lodestone.operators import tree


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")


def test_recall_of_the_neighbour_graph(vectors):
    k = 10
    data = sorted(vectors.collect())
    ids, x = np.array([r["vec_id"] for r in data]), np.array([r["embedding"] for r in data], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cosine = x @ x.T
    np.fill_diagonal(cosine, -np.inf)
    want = np.argsort(-cosine, axis=1)[:, :k]
    got: dict = {}
    for r in N.neighbour_graph(vectors, "vec_id", "embedding", k).collect():
        got.setdefault(r["id"], []).append((r["other"], r["cosine"]))
    assert len(got) == len(ids) and all(len(v) == k == len({o for o, _ in v}) for v in got.values())
    right = sum(len({o for o, _ in got[i]} & set(ids[w].tolist())) for i, w in zip(ids.tolist(), want, strict=True))
    assert right / (k * len(ids)) >= 0.9, right / (k * len(ids))
    place = {i: n for n, i in enumerate(ids.tolist())}
    assert all(abs(c - cosine[place[i], place[o]]) < 1e-6 for i, v in list(got.items())[:50] for o, c in v)


def test_copies_and_small_tables(spark):
    df = spark.createDataFrame([(k, [1.0, 0.0] if k < 400 else [0.0, float(k)]) for k in range(420)] + [(999, None)], "i long, v array<double>")
    got = N.neighbour_graph(df, "i", "v", 3)
    assert got.where("id < 400 and other >= 400").count() == 0 and got.groupBy("id").count().where("count <> 3").count() == 0
    assert N.neighbour_graph(df.limit(1), "i", "v", 3).count() == 0


def test_fuzzy_weights(spark):
    d = np.sort(np.random.default_rng(1).random((50, 15)), axis=1)
    w = N.fuzzy(d)
    assert np.allclose(w[:, 0], 1) and np.allclose(w.sum(1), np.log2(15), atol=1e-4) and (np.diff(w, axis=1) <= 1e-12).all()
    graph = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.5), (2, 1, 0.9), (2, 3, 0.8), (3, 2, 0.8), (3, 1, 0.5)], "id long, other long, cosine double")
    one = {1: N.fuzzy(np.array([[0.1, 0.5]]))[0], 2: N.fuzzy(np.array([[0.1, 0.2]]))[0], 3: N.fuzzy(np.array([[0.2, 0.5]]))[0]}
    both = lambda a, b: a + b - a * b
    want = {(1, 2): both(one[1][0], one[2][0]), (1, 3): both(one[1][1], one[3][1]), (2, 3): both(one[2][1], one[3][0])}
    got = {(r["src"], r["dst"]): r["weight"] for r in N.fuzzy_edges(graph).collect()}
    assert got.keys() == want.keys() and all(abs(got[e] - want[e]) < 1e-6 for e in want)


def test_layout_keeps_neighbourhoods():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 24)) * 3
    x = np.concatenate([c + rng.normal(size=(40, 24)) for c in centres])
    z = N.layout(x, 15, 3, 7)
    assert np.array_equal(z, N.layout(x, 15, 3, 7)) and np.isfinite(z).all()
    far = ((z[:, None] - z) ** 2).sum(-1)
    np.fill_diagonal(far, np.inf)
    own = np.arange(160) // 40
    assert (own[np.argsort(far, axis=1)[:, :10]] == own[:, None]).mean() > 0.95
    labels = tree.mixture_labels(x)
    assert len(set(labels)) >= 2 and all((labels[own == c] == np.bincount(labels[own == c]).argmax()).mean() > 0.85 for c in range(4))


def test_mixture_in_aggregates_is_the_plain_one(spark):
    rng = np.random.default_rng(3)
    long = rng.normal(size=(200, 2)) * [5, 0.3] @ np.array([[0.8, 0.6], [-0.6, 0.8]])
    z = np.concatenate([long, long @ np.array([[0, 1], [-1, 0]]) + [0, 14]])
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(z)], "i long, v array<double>").repartition(3)
    found, bics = N.mixture(df, "i", "v", most=3)
    # The same steps in one table, from the same rows.
    order = [r["i"] for r in df.orderBy(F.xxhash64("i", F.lit(224)), "i").limit(3).collect()]
    plain, labels = [], []
    for k in range(1, 4):
        parts = (np.full(k, 1 / k), z[order[:k]], np.stack([np.cov(z.T, bias=True) + 1e-6 * np.eye(2)] * k))
        before = -np.inf
        for _ in range(100):
            likes, p = N._memberships(z, parts)
            if likes.sum() - before < 1e-6 * len(z):
                break
            before, w = likes.sum(), p.sum(0) + 1e-9
            means = (p.T @ z) / w[:, None]
            parts = (w / w.sum(), means, np.stack([((p[:, c, None] * z).T @ z) / w[c] - np.outer(means[c], means[c]) + 1e-6 * np.eye(2) for c in range(k)]))
        plain.append((k * 3 + k * 2 + k - 1) * np.log(len(z)) - 2 * likes.sum())
        labels.append((N._memberships(z, parts)[1] > 0.1).argmax(1))
    assert np.allclose(bics, plain, rtol=1e-6) and int(np.argmin(bics)) == int(np.argmin(plain)) == 1
    got = np.array([r["cluster"] for r in found.orderBy("id").collect()])
    assert (got == labels[1]).all()


def test_pairs_below_a_floor_are_not_sent(spark):
    """A row that has its k best sends no pair that is worse than all of them; floats stay floats on the way."""
    members = [(k, [float(k == 0), float(k == 1), 1.0 + k], True, 0.99 if k == 2 else -2.0) for k in range(5)]
    lists = spark.createDataFrame([(members,)], "members array<struct<id: long, v: array<float>, new: boolean, floor: double>>")
    got = [tuple(r) for r in N._pairs(lists, "long", 4).collect()]
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    cosine = {(a[0], b[0]): float(unit(a[1]) @ unit(b[1])) for a in members for b in members if a is not b}
    assert {(a, b) for a, b, _ in got} == {p for p, c in cosine.items() if p[0] != 2 or c >= 0.99} and len(got) < len(cosine)
