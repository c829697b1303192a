"""Neighbour graphs of vectors, their fuzzy weights, layouts in few dimensions, and Gaussian mixtures of any number of rows.

``neighbour_graph`` is neighbour descent (Dong, Moses and Li 2011) in joins: rows are dealt to small buckets by the signs of
random projections, several times over, which gives first neighbours; then neighbours of neighbours are compared until few
lists change. A list has k entries, a row is in the lists of others as often as it may, of which the k best and a share
drawn by hash take part in a round, so that a hub is no task of its own. It is approximate; the tests measure its recall.

``fuzzy_edges`` turns distances into weights that fall from the nearest neighbour on, at a pace that makes each row's weights
add up to log2(k), and unites both directions. ``layout`` places rows so that such weights are met (UMAP's cross entropy,
McInnes, Healy and Melville 2018) by seeded stochastic steps, for the rows of one bucket.

``mixture`` is expectation-maximisation with full covariances: a round is one scan that sends the sums of its batches, k
matrices of the dimension, and never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored

#: The curve of the layout for a least distance of 0.1.
CURVE_A, CURVE_B = 1.577, 0.895
BUCKET = 128


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _pairs(lists: DataFrame, kind: str, k: int) -> DataFrame:
    """(id, other, cosine): for each list of rows (``members``: id, v, new, and floor) the k best others of each row in it, of the
    pairs of which one at least is new. What lies below a row's floor, the least of the k that it has, can't be one of its k best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for members in batch.column(0):
                m = members.values
                if len(m) < 2:
                    continue
                v = m.field("v")
                x = _unit(v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(m), -1))
                score, new = x @ x.T, m.field("new").to_numpy(zero_copy_only=False).astype(bool)
                score[~(new[:, None] | new)] = -np.inf
                np.fill_diagonal(score, -np.inf)
                n = min(k, len(m) - 1)
                best = np.argpartition(-score, n - 1, axis=1)[:, :n]
                which = np.repeat(np.arange(len(m)), n)
                got, floor = score[which, best.ravel()], m.field("floor").to_numpy(zero_copy_only=False)
                there = (got > -np.inf) & (got >= floor[which] - 1e-9)  # cosines are rounded where they are compared
                for column, values in zip(out, (m.field("id").take(pa.array(which[there])), m.field("id").take(pa.array(best.ravel()[there])), pa.array(got[there])), strict=True):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in out], names=["id", "other", "cosine"])

    return lists.select("members").mapInArrow(run, f"id {kind}, other {kind}, cosine double")


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """(id, near): the k best different others of each row."""
    found = pairs.where("id <> other").groupBy("id", "other").agg(F.max(F.round("cosine", 12)).alias("cosine"), F.min("old").alias("old"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "other"))
    return found.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def neighbour_graph(df: DataFrame, id_col: str, vec: str, k: int = 15, breadth: int = 3, trees: int = 4, rounds: int = 8, settled: float = 0.01, seed: int = 1) -> DataFrame:
    """(id, other, cosine): about the k nearest of every row; ids are different and not null. The lists of the search are
    ``breadth`` times as long, which is what its recall comes from."""
    wanted, k = k, k * breadth
    kind = dict(df.dtypes)[id_col]
    form = "array<float>" if dict(df.dtypes)[vec] == "array<float>" else "array<double>"
    rows = stored(df.select(F.col(id_col).alias("id"), F.col(vec).cast(form).alias("v")).where("id is not null and size(v) > 0"), "near-rows")
    first = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    n, dims = first[0], first[1] or 1
    planes = int(np.ceil(np.log2(max(1.0, n / (BUCKET / 2)))))
    normal = np.random.default_rng(seed).normal(size=(trees, max(planes, 1), dims))

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            for t in range(trees):
                bits = (x @ normal[t].T > 0) @ (1 << np.arange(max(planes, 1))) if planes else np.zeros(len(x))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.full(len(x), t, np.int32)), pa.array(bits.astype(np.int64))], names=["id", "v", "tree", "bits"])

    dealt = stored(rows.mapInArrow(signs, f"id {kind}, v {form}, tree int, bits long"), "near-dealt")
    sizes = dealt.groupBy("tree", "bits").agg(F.count("*").alias("_n"))
    # A bucket that many rows fall into is dealt on by hash.
    parted = dealt.join(sizes, ["tree", "bits"]).withColumn("part", F.pmod(F.xxhash64("id", "tree"), F.ceil(F.col("_n") / BUCKET)))
    member = F.struct("id", "v", F.lit(True).alias("new"), F.lit(-2.0).alias("floor"))
    buckets = parted.groupBy("tree", "bits", "part").agg(F.collect_list(member).alias("members"))
    now = stored(_best(_pairs(buckets, kind, k).withColumn("old", F.lit(0)), k), "near")
    for step in range(rounds):
        both = now.select("id", "other", "cosine", (F.col("old") == 0).alias("new"))
        back = both.select(F.col("other").alias("id"), F.col("id").alias("other"), "cosine", "new")
        # Of the lists that a row is in, the k best and k drawn: a hub's neighbourhood is as large as another's.
        drawn = F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("id", "other", F.lit(step))))
        closest = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "other"))
        back = back.withColumn("_d", drawn).withColumn("_c", closest).where((F.col("_d") <= k) | (F.col("_c") <= k)).select("id", "other", "new")
        around = both.select("id", "other", "new").unionByName(back).groupBy("id", "other").agg(F.max("new").alias("new"))
        floors = now.groupBy("id").agg(F.when(F.count("*") >= k, F.min("cosine")).alias("_f"))
        known = rows.join(floors, "id", "left").select(F.col("id").alias("other"), "v", F.coalesce("_f", F.lit(-2.0)).alias("floor"))
        lists = around.join(known, "other").groupBy("id").agg(F.collect_list(F.struct(F.col("other").alias("id"), "v", "new", "floor")).alias("members"))
        found = _pairs(lists, kind, k).withColumn("old", F.lit(0))
        fresh = stored(_best(now.withColumn("old", F.lit(1)).unionByName(found).groupBy("id", "other").agg(F.max("cosine").alias("cosine"), F.max("old").alias("old")), k), "near")
        changed = fresh.where("old = 0").count()
        now = fresh
        if changed <= settled * n * k:
            break
    return _best(now, wanted).select("id", "other", "cosine")


def fuzzy(distances: np.ndarray, rounds: int = 64) -> np.ndarray:
    """Weights of the ascending distances (a row a point): 1 for the nearest, adding up to log2 of their number."""
    near, want = distances[:, :1], np.log2(max(2, distances.shape[1]))
    low, high, scale = np.zeros(len(distances)), np.full(len(distances), np.inf), np.ones(len(distances))
    over = np.maximum(distances - near, 0.0)
    for _ in range(rounds):
        much = np.exp(-over / scale[:, None]).sum(1) > want
        high, low = np.where(much, scale, high), np.where(much, low, scale)
        scale = np.where(np.isinf(high), scale * 2, (low + high) / 2)
    least = 1e-3 * np.maximum(distances.mean(1), 1e-12)
    return np.exp(-over / np.maximum(scale, least)[:, None])


def fuzzy_edges(graph: DataFrame) -> DataFrame:
    """(src, dst, weight), src < dst, of a neighbour graph (id, other, cosine): a + b - ab of both directions' weights."""
    lists = graph.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((1 - F.col("cosine")).alias("d"), "other"))).alias("near"))  # k entries

    @F.pandas_udf("array<double>")
    def weights(near: pd.Series) -> pd.Series:
        out: dict[int, list[float]] = {}
        sizes = near.map(len)
        for n in sizes.unique():
            at = np.flatnonzero(sizes.to_numpy() == n)
            w = fuzzy(np.stack([np.asarray(near.iloc[i], float) for i in at])) if n else np.zeros((len(at), 0))
            out |= dict(zip(at.tolist(), w.tolist(), strict=True))
        return pd.Series([out[i] for i in range(len(near))])

    one = lists.select("id", F.explode(F.arrays_zip(F.col("near.other").alias("other"), weights(F.col("near.d")).alias("w"))).alias("x")).select("id", "x.other", "x.w")
    ends = one.groupBy(F.least("id", "other").alias("src"), F.greatest("id", "other").alias("dst"))
    return ends.agg((1 - F.product(1 - F.col("w"))).alias("weight"))


def layout(x: np.ndarray, k: int, dims: int, seed: int, epochs: int = 150, negatives: int = 5) -> np.ndarray:
    """Places of the rows in ``dims`` dimensions, by their k nearest of cosine. Seeded: the same rows give the same places."""
    n, k = len(x), min(k, len(x) - 1)
    u, rng = _unit(x.astype(float)), np.random.default_rng(seed)
    far = np.maximum(1 - u @ u.T, 0.0)
    np.fill_diagonal(far, np.inf)
    near = np.argsort(far, axis=1, kind="stable")[:, :k]
    w = np.zeros((n, n))
    w[np.arange(n)[:, None], near] = fuzzy(np.take_along_axis(far, near, 1))
    w = w + w.T - w * w.T
    a, b = np.nonzero(np.triu(w, 1))
    weight = w[a, b]
    c = u - u.mean(0)
    left, spread, _ = np.linalg.svd(c, full_matrices=False)
    z = np.zeros((n, dims))
    z[:, : min(dims, left.shape[1])] = (left * spread)[:, :dims]
    z = 10 * z / max(np.abs(z).max(), 1e-12) + rng.normal(0, 1e-4, (n, dims))
    draws, share = min(len(a), 10 * n), weight / weight.sum()
    for epoch in range(epochs):
        rate = 1 - epoch / epochs
        at = rng.choice(len(a), draws, p=share)
        i, j = a[at], b[at]
        gap = z[i] - z[j]
        d2 = (gap**2).sum(1)
        pull = np.where(d2 > 0, -2 * CURVE_A * CURVE_B * np.maximum(d2, 1e-12) ** (CURVE_B - 1) / (1 + CURVE_A * d2**CURVE_B), 0)
        step = np.clip(pull[:, None] * gap, -4, 4) * rate
        move = np.zeros_like(z)
        np.add.at(move, i, step)
        np.add.at(move, j, -step)
        i = np.repeat(i, negatives)
        j = rng.integers(n, size=len(i))
        gap = z[i] - z[j]
        d2 = (gap**2).sum(1)
        push = np.where(i != j, 2 * CURVE_B / ((0.001 + d2) * (1 + CURVE_A * d2**CURVE_B)), 0)
        np.add.at(move, i, np.clip(push[:, None] * gap, -4, 4) * rate)
        z += move / max(1.0, draws / n)
    return z


def mixture(df: DataFrame, id_col: str, vec: str, most: int = 10, seed: int = 224, rounds: int = 100, threshold: float = 0.1) -> tuple[DataFrame, list[float]]:
    """(id, cluster) by a Gaussian mixture with full covariances of 1..most parts, the number by least BIC, and the BICs. For
    vectors of few dimensions and tables of any length: a round is a scan whose batches send their sums."""
    kind = dict(df.dtypes)[id_col]
    rows = stored(df.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v")), "mixture-rows")
    spark = df.sparkSession
    size = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    n, d = size[0], size[1]
    if not n:
        return rows.select("id", F.lit(0).alias("cluster")), []

    def totals(parts: tuple | None) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """The likelihood and the sums of memberships, of rows and of their squares by part; of all rows alike without parts."""
        shared = spark.sparkContext.broadcast(parts)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = 1 if shared.value is None else len(shared.value[0])
            likelihood, weight, first, second = 0.0, np.zeros(k), np.zeros((k, d)), np.zeros((k, d, d))
            for batch in batches:
                z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                likes, p = _memberships(z, shared.value) if shared.value is not None else (np.zeros(len(z)), np.ones((len(z), 1)))
                likelihood += float(likes.sum())
                weight += p.sum(0)
                first += p.T @ z
                second += np.einsum("nk,ni,nj->kij", p, z, z)
            flat = np.concatenate([[likelihood], weight, first.ravel(), second.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], names=["i", "x"])

        got = rows.select("v").mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()  # k (1 + d + d^2) numbers
        flat = np.array([x for _, x in sorted(map(tuple, got))])
        k = 1 if parts is None else len(parts[0])
        return float(flat[0]), flat[1 : k + 1], flat[k + 1 : k + 1 + k * d].reshape(k, d), flat[k + 1 + k * d :].reshape(k, d, d)

    ridge = 1e-6 * np.eye(d)
    _, _, first, second = totals(None)
    spread = second[0] / n - np.outer(first[0] / n, first[0] / n) + ridge
    drawn = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(most).select("v").collect()
    fits, bics = [], []
    for k in range(1, min(most, len(drawn)) + 1):
        parts = (np.full(k, 1 / k), np.array([r["v"] for r in drawn[:k]], float), np.stack([spread] * k))
        before = -np.inf
        for _ in range(rounds):
            likelihood, weight, first, second = totals(parts)
            if likelihood - before < 1e-6 * n:
                break
            before, weight = likelihood, weight + 1e-9
            means = first / weight[:, None]
            parts = (weight / weight.sum(), means, second / weight[:, None, None] - np.einsum("ki,kj->kij", means, means) + ridge)
        fits.append(parts)
        bics.append((k * d * (d + 1) // 2 + k * d + k - 1) * np.log(n) - 2 * likelihood)
    best = spark.sparkContext.broadcast(fits[int(np.argmin(bics))])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((_memberships(z, best.value)[1] > threshold).argmax(1).astype(np.int32))], names=["id", "cluster"])

    return rows.mapInArrow(label, f"id {kind}, cluster int"), bics


def _memberships(z: np.ndarray, parts: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Each row's log likelihood and its memberships."""
    share, means, covariance = parts
    logs = np.empty((len(z), len(share)))
    for c in range(len(share)):
        low = np.linalg.cholesky(covariance[c])
        far = np.linalg.solve(low, (z - means[c]).T)
        logs[:, c] = np.log(share[c]) - 0.5 * ((far**2).sum(0) + z.shape[1] * np.log(2 * np.pi)) - np.log(np.diag(low)).sum()
    top = logs.max(1, keepdims=True)
    p = np.exp(logs - top)
    total = p.sum(1, keepdims=True)
    return (top + np.log(total))[:, 0], p / total
