"""Summary trees over chunk vectors: Ward clusters, Gaussian mixtures by BIC, and rank-ordered pair merging.

Trees are built in groups: a document's chunks are one group. For Ward clusters and mixtures a group of more than ``BUCKET``
rows is parted into buckets of near vectors first, so that no task holds more, and its clusters are those of its buckets. The
Psi tree of a larger group is exact: its spanning tree is found in blocks. Models that summarise are plugged
in; the stand-in is the medoid's first sentence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import neighbours
from .graph import components
from .scratch import stored

BUCKET, FAN_OUT = 2_000, 32
#: Clusters of a Ward cut at most.
MOST = 64
#: Digits of a cosine that count: those behind them depend on how a product of matrices is cut.
DIGITS = 10


def unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def ward_merges(x: np.ndarray) -> list[tuple[int, int, float]]:
    """Ward's merges, nearest pair first, over Lance-Williams distances: (a, b, height); new clusters count on from n. Each
    row remembers its nearest neighbour, so that a step looks at a row and not at all pairs."""
    n = len(x)
    square = (x * x).sum(1)
    d = np.maximum(square[:, None] + square - 2 * (x @ x.T), 0.0)
    np.fill_diagonal(d, np.inf)
    size, name, live = np.ones(n), np.arange(n), np.ones(n, bool)
    near = d.argmin(1)
    best = d[np.arange(n), near]
    found = []
    for _ in range(n - 1):
        i = int(np.argmin(best))
        j = int(near[i])
        i, j = min(i, j), max(i, j)
        h = d[i, j]
        found.append((int(name[i]), int(name[j]), float(np.sqrt(max(0.0, h)))))
        live[j] = False
        k = np.flatnonzero(live)
        k = k[k != i]
        d[i, k] = ((size[i] + size[k]) * d[i, k] + (size[j] + size[k]) * d[j, k] - size[k] * h) / (size[i] + size[j] + size[k])
        d[k, i] = d[i, k]
        d[j], d[:, j] = np.inf, np.inf
        best[j] = np.inf
        size[i] += size[j]
        name[i] = n + len(found) - 1
        for r in (i, *k[(near[k] == i) | (near[k] == j)].tolist()):
            near[r] = d[r].argmin()
            best[r] = d[r, near[r]]
        closer = k[d[k, i] < best[k]]
        near[closer], best[closer] = i, d[closer, i]
    return found


def ward_labels(x: np.ndarray, most: int = MOST, refinements: int = 5) -> np.ndarray:
    """Clusters cut at the largest gap between merge heights, ``most`` of them at most, then moved to the nearest centroid a
    few times. Two rows are two clusters."""
    n = len(x)
    if n <= 2:
        return np.arange(n)
    merges = ward_merges(x)
    gap = int(np.argmax(np.diff([h for *_, h in merges])))
    clusters = max(1, min(n - gap - 1, most))
    if clusters == 1:
        return np.zeros(n, int)
    parent = list(range(2 * n))
    for k, (a, b, _) in enumerate(merges[: n - clusters]):
        parent[a] = parent[b] = n + k

    def root(v: int) -> int:
        while parent[v] != v:
            v = parent[v]
        return v

    _, labels = np.unique([root(v) for v in range(n)], return_inverse=True)
    for _ in range(refinements):
        centers = np.stack([x[labels == c].mean(0) for c in range(labels.max() + 1)])
        moved = np.argmin(((x[:, None] - centers[None]) ** 2).sum(-1), axis=1)
        _, moved = np.unique(moved, return_inverse=True)
        if np.array_equal(moved, labels):
            break
        labels = moved
    return labels


def _fit(z: np.ndarray, k: int, seed: int, rounds: int = 100) -> tuple[float, np.ndarray]:
    """The log likelihood and the memberships of a Gaussian mixture of k parts with full covariances, by EM."""
    n, d = z.shape
    rng = np.random.default_rng(seed)
    means, ridge = z[rng.choice(n, k, replace=False)], 1e-6 * np.eye(d)
    covariance, share, before = np.stack([np.cov(z.T, bias=True).reshape(d, d) + ridge] * k), np.full(k, 1 / k), -np.inf
    for _ in range(rounds):
        logs = np.empty((n, k))
        for c in range(k):
            low = np.linalg.cholesky(covariance[c])
            far = np.linalg.solve(low, (z - means[c]).T)
            logs[:, c] = np.log(share[c]) - 0.5 * ((far**2).sum(0) + d * np.log(2 * np.pi)) - np.log(np.diag(low)).sum()
        top = logs.max(1, keepdims=True)
        p = np.exp(logs - top)
        total = p.sum(1, keepdims=True)
        p /= total
        likelihood = float((top + np.log(total)).sum())
        if likelihood - before < 1e-3 * n * 1e-3:
            break
        before, weight = likelihood, p.sum(0) + 1e-9
        share, means = weight / weight.sum(), (p.T @ z) / weight[:, None]
        covariance = np.stack([((p[:, c, None] * (z - means[c])).T @ (z - means[c])) / weight[c] + ridge for c in range(k)])
    return likelihood, p


def mixture_bics(z: np.ndarray, most: int, seed: int) -> list[float]:
    """The BIC of mixtures of 1..most parts."""
    n, d = z.shape
    return [(k * d * (d + 1) // 2 + k * d + k - 1) * np.log(n) - 2 * _fit(z, k, seed)[0] for k in range(1, most + 1)]


def mixture_labels(x: np.ndarray, most: int = 10, seed: int = 224, components: int = 12, threshold: float = 0.1, layout: bool = True) -> np.ndarray:
    """Gaussian mixtures of 1..most parts with full covariances, over a layout of the rows' neighbourhoods (or, without it,
    their principal components); the number by least BIC, the label the first part with a probability over the threshold."""
    x = x - x.mean(0) if not layout else x
    if len(x) < 3:
        return np.zeros(len(x), int)
    if layout:
        z = neighbours.layout(x, max(2, int((len(x) - 1) ** 0.8)), min(components, len(x) - 2), seed)
    else:
        _, _, axes = np.linalg.svd(x, full_matrices=False)
        z = x @ axes[: min(components, len(x) - 1)].T
    k = 1 + int(np.argmin(mixture_bics(z, min(most, len(z) - 1), seed)))
    return (_fit(z, k, seed)[1] > threshold).argmax(1)


def psi_parents(x: np.ndarray, max_children: int = 4) -> list[tuple[int, int]]:
    """(node, parent) of the tree that merges leaf pairs by falling cosine; parents of too many children are split.

    Pairs of equal cosine merge by index, so the tree doesn't depend on the order of work.
    """
    n = len(x)
    u = unit(x)
    i, j = np.triu_indices(n, 1)
    cosine = np.round(u @ u.T, DIGITS)[i, j]
    order = np.lexsort((j, i, -cosine))
    return psi_of_edges(n, zip(i[order].tolist(), j[order].tolist(), strict=True), max_children)


def psi_of_edges(n: int, edges: Iterable[tuple[int, int]], max_children: int = 4) -> list[tuple[int, int]]:
    """``psi_parents`` of pairs in the order of their merging; those of a greatest spanning tree are enough."""
    if n == 1:
        return [(0, -1)]
    root_of, top, children = list(range(n)), list(range(n)), {}

    def find(v: int) -> int:
        while root_of[v] != v:
            root_of[v] = root_of[root_of[v]]
            v = root_of[v]
        return v

    for i, j in edges:
        a, b = find(i), find(j)
        if a != b:
            node = n + len(children)
            children[node] = [top[a], top[b]]
            root_of[b] = a
            top[a] = node
            if len(children) == n - 1:
                break
    final = top[find(0)]

    def flat(node: int) -> list[int]:
        """Children with inner nodes opened while they fit."""
        kids = list(children.get(node, []))
        while True:
            inner = [c for c in kids if c in children and len(kids) - 1 + len(children[c]) <= max_children]
            if not inner:
                return kids
            kids.remove(inner[0])
            kids += children[inner[0]]

    out, todo = [(final, -1)], [final]
    while todo:
        node = todo.pop()
        for c in flat(node):
            out.append((c, node))
            if c in children:
                todo.append(c)
    return sorted(out)


def spanning_trees(df: DataFrame, group: str, id_col: str, vec: str, block: int = 1024, keep: int = 16) -> DataFrame:
    """(group, a, b, cosine, ordinals as numbers): the edges of each group's greatest spanning tree of cosines, where pairs of
    equal cosine go by their rows' order of ids. a < b are numbers that rise with the ids of all rows.

    Boruvka's rounds: every component takes its best edge to another one. A row knows its ``keep`` best rows outside its
    component; as components only grow, the first of them that is still outside is its best. A row that has none left is held
    against the group's blocks again. So all pairs are looked at once, as products of blocks, and little more.
    """
    parts = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.col(group).alias("g"), F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v")).repartitionByRange(parts, "g", "id").sortWithinPartitions("g", "id")
    rows = stored(rows.withColumn("num", F.monotonically_increasing_id()), "psi-rows")
    sizes = stored(rows.groupBy("g").agg(F.count("*").alias("n"), F.ceil(F.count("*") / block).alias("blocks")), "psi-sizes")
    placed = rows.join(sizes, "g").withColumn("b", F.pmod(F.xxhash64("num"), F.col("blocks")))
    data = stored(placed.groupBy("g", "b", "blocks").agg(F.collect_list("num").alias("nums"), F.collect_list("v").alias("vs")), "psi-blocks")
    labels = stored(rows.select("g", "num", F.col("num").alias("comp")), "psi-labels")

    def best_outside(asked: DataFrame) -> DataFrame:
        """(g, num, near): for the rows asked, the ``keep`` best of other components, best first."""
        own = placed.select("num", "v", "b", "blocks").join(asked.select("num"), "num").join(labels, "num")
        own = own.groupBy("g", "b", "blocks").agg(F.collect_list(F.struct("num", "comp", "v")).alias("mine"))
        own = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("g", F.col("other").alias("b"), "mine")
        comps = placed.select("num", "b").join(labels, "num").groupBy("g", "b").agg(F.map_from_entries(F.collect_list(F.struct("num", "comp"))).alias("comps"))
        sides = data.join(comps, ["g", "b"]).select("g", "b", "nums", "vs", F.transform("nums", lambda n: F.col("comps")[n]).alias("comps"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = lambda x: np.array(x.to_pylist(), float)
            for batch in batches:
                for mine, nums, vs, comps in zip(*(batch.column(n) for n in ("mine", "nums", "vs", "comps")), strict=True):
                    m, num, comp = mine.values, nums.values.to_numpy(), comps.values.to_numpy()
                    me, my = m.field("num").to_numpy(), m.field("comp").to_numpy()
                    score = np.round(unit(table(m.field("v"))) @ unit(table(vs.values)).T, DIGITS)
                    score[my[:, None] == comp] = -np.inf
                    k = min(keep, len(num))
                    # Of equal cosines the pair of the lesser numbers is first: for one row, the lesser other.
                    order = np.lexsort((np.broadcast_to(num, score.shape), -score), axis=1)[:, :k]
                    which = np.repeat(np.arange(len(me)), k)
                    got = score[which, order.ravel()]
                    there = got > -np.inf
                    yield pa.RecordBatch.from_arrays([pa.array(me[which][there]), pa.array(got[there]), pa.array(num[order.ravel()][there])], names=["num", "cosine", "other"])

        found = own.join(sides, ["g", "b"]).select("mine", "nums", "vs", "comps").mapInArrow(run, "num long, cosine double, other long")
        one = F.struct((-F.col("cosine")).alias("less"), F.col("other").alias("other"))
        return stored(found.groupBy("num").agg(F.slice(F.array_sort(F.collect_list(one)), 1, keep).alias("near")), "psi-near")

    near, edges, k = best_outside(rows), None, 0
    while True:
        k += 1
        opened = near.select("num", F.explode("near").alias("x")).select("num", "x.less", "x.other")
        ends = opened.join(labels.select("num", "comp", "g"), "num").join(labels.select(F.col("num").alias("other"), F.col("comp").alias("there")), "other").where("comp <> there")
        order = F.struct("less", F.least("num", "other").alias("a"), F.greatest("num", "other").alias("b"), "there")
        best = stored(ends.groupBy("g", "comp", "num").agg(F.min(order).alias("x")), "psi-best")
        many = stored(labels.select("g", "comp").distinct().groupBy("g").count().where("count > 1").select("g"), "psi-open")  # groups in several components
        if many.isEmpty():
            break
        dry = labels.join(many, "g", "left_semi").join(best.select("num"), "num", "left_anti")
        if not dry.isEmpty():
            again = best_outside(dry)
            near = stored(near.join(again.select("num"), "num", "left_anti").unionByName(again), "psi-near")
            continue
        chosen = stored(best.groupBy("g", "comp").agg(F.min("x").alias("x")).select("g", "comp", "x.a", "x.b", "x.there", (-F.col("x.less")).alias("cosine")), "psi-chosen")
        step = chosen.select("g", "a", "b", "cosine").distinct()
        edges = stored(step if edges is None else edges.unionByName(step).distinct(), "psi-edges")
        joined = components(chosen.select(F.col("comp").alias("src"), F.col("there").alias("dst")))
        labels = stored(labels.join(joined.select(F.col("id").alias("comp"), F.col("component").alias("_to")), "comp", "left").select("g", "num", F.coalesce("_to", "comp").alias("comp")), "psi-labels")
    if edges is None:
        edges = rows.select("g", F.col("num").alias("a"), F.col("num").alias("b"), F.lit(0.0).alias("cosine")).limit(0)
    ids = rows.select("num", "id")
    return edges.join(ids.select(F.col("num").alias("a"), F.col("id").alias("a_id")), "a").join(ids.select(F.col("num").alias("b"), F.col("id").alias("b_id")), "b").select(F.col("g").alias(group), "a", "b", "a_id", "b_id", "cosine")


def spherical_buckets(x: np.ndarray, size: int, fan_out: int = 32, rounds: int = 5) -> np.ndarray:
    """Bucket of each row by spherical k-means with evenly spaced seeds."""
    k = min(fan_out, max(1, -(-len(x) // size)))
    u = unit(x)
    centers = u[np.linspace(0, len(u) - 1, k).astype(int)]
    label = np.zeros(len(u), int)
    for _ in range(rounds):
        label = (u @ centers.T).argmax(1)
        centers = unit(np.stack([u[label == c].sum(0) if (label == c).any() else centers[c] for c in range(k)]))
    return label


def psi_tree(x: np.ndarray, bucket: int = 512, max_children: int = 4) -> list[tuple[int, int]]:
    """psi_parents, beyond the bucket size over buckets and then over their roots; leaves keep their numbers."""
    n = len(x)
    if n <= bucket:
        return psi_parents(x, max_children)
    label = spherical_buckets(x, bucket)
    out, roots, means, fresh = [], [], [], n
    for c in np.unique(label):
        rows = np.flatnonzero(label == c)
        tree = psi_tree(x[rows], bucket, max_children) if len(rows) < n else psi_parents(x[rows], max_children)
        m = len(rows)
        number = {v: (int(rows[v]) if v < m else fresh + v - m) for v, _ in tree}
        fresh += max((v - m + 1 for v, _ in tree if v >= m), default=0)
        for v, p in tree:
            if p == -1:
                roots.append(number[v])
                means.append(x[rows].mean(0))
            else:
                out.append((number[v], number[p]))
    if len(roots) == 1:
        return sorted([*out, (roots[0], -1)])
    above = psi_parents(np.stack(means), max_children)
    m = len(roots)
    number = {v: (roots[v] if v < m else fresh + v - m) for v, _ in above}
    return sorted([*out, *((number[v], -1 if p == -1 else number[p]) for v, p in above)])


def in_buckets(df: DataFrame, group: str, id_col: str, vec: str, size: int = BUCKET) -> DataFrame:
    """``df`` with ``_bucket``: groups of more than ``size`` rows are parted by the nearest of FAN_OUT seeded pivots at a time
    until no bucket has more; what pivots don't part (equal vectors) is dealt by hash. Pivots are the rows of the least hashes,
    and only they are broadcast or joined, a row a bucket."""
    from ..functions.values import dot, norm
    from .graph import cut

    place = F.xxhash64(F.col(group), F.col(id_col))
    rows, before = df.withColumn("_bucket", F.lit("")), None
    while True:
        counts = rows.groupBy(group, "_bucket").agg(F.count("*").alias("_n")).where(F.col("_n") > size)
        total = counts.agg(F.count("*"), F.coalesce(F.max("_n"), F.lit(0))).first()
        if not total[0]:
            return rows
        if tuple(total) == before:
            big = rows.join(F.broadcast(counts) if total[0] <= 100_000 else counts, [group, "_bucket"], "left")
            dealt = F.concat(F.col("_bucket"), F.lit("/"), F.pmod(place, F.ceil(F.col("_n") / F.lit(size))).cast("string"))
            return big.withColumn("_bucket", F.coalesce(dealt, F.col("_bucket"))).drop("_n")
        before = tuple(total)
        chosen = rows.join(counts, [group, "_bucket"]).withColumn("_place", place)
        # The least hashes of a bucket: those under a threshold that leaves some 4 x FAN_OUT, then the first of them.
        few = chosen.where(F.pmod(F.xxhash64("_place"), F.col("_n")) < 4 * FAN_OUT)
        pivots = few.groupBy(group, "_bucket").agg(F.slice(F.array_sort(F.collect_list(F.struct("_place", F.col(vec).alias("v")))), 1, FAN_OUT).alias("_pivots"))
        near = F.transform("_pivots", lambda p, i: F.struct(F.coalesce(F.try_divide(dot(F.col(vec), p["v"]), norm(p["v"])), F.lit(0.0)).alias("s"), (-i).alias("i")))
        step = rows.join(pivots, [group, "_bucket"], "left")
        rows = cut(step.withColumn("_bucket", F.when(F.col("_pivots").isNull(), F.col("_bucket")).otherwise(F.concat_ws("/", "_bucket", (-F.array_max(near)["i"]).cast("string")))).drop("_pivots"), "buckets")


def clusters(df: DataFrame, group: str, id_col: str, vec: str, method: str = "ward", size: int = BUCKET) -> DataFrame:
    """(group, id, cluster) by group; ``ward`` or ``mixture``, in buckets of at most ``size`` rows."""
    f = {"ward": ward_labels, "mixture": mixture_labels}[method]
    kinds = dict(df.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(id_col)
        return pd.DataFrame({group: pdf[group], "_bucket": pdf["_bucket"], id_col: pdf[id_col], "_c": f(np.stack(pdf[vec]).astype(float))})

    rows = in_buckets(df.select(group, id_col, vec), group, id_col, vec, size)
    found = rows.groupBy(group, "_bucket").applyInPandas(run, f"{group} {kinds[group]}, _bucket string, {id_col} {kinds[id_col]}, _c int")
    # Buckets count on from one another.
    ends = found.groupBy(group, "_bucket").agg((F.max("_c") + 1).alias("_k"))
    order = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_from", F.coalesce(F.sum("_k").over(order), F.lit(0)))
    return found.join(ends, [group, "_bucket"]).select(group, id_col, (F.col("_c") + F.col("_from")).cast("int").alias("cluster"))


def psi(df: DataFrame, group: str, id_col: str, vec: str, max_children: int = 4, small: int = BUCKET) -> DataFrame:
    """(group, node, parent, id): leaves carry their row's id. The tree merges pairs of a group by falling cosine.

    Groups of ``small`` rows at most are merged in one task each. Of a larger group the greatest spanning tree is found in
    blocks (``spanning_trees``), which merges alike, and a task holds the tree's edges: three numbers a row, no vectors."""
    kinds = dict(df.dtypes)
    number = kinds[id_col] in ("bigint", "int")
    schema = f"{group} {kinds[group]}, node int, parent int, {id_col} {kinds[id_col]}"
    rows = df.select(group, id_col, vec)
    large = stored(rows.groupBy(group).count().where(F.col("count") > small).select(group), "psi-large")  # a row a large group

    def table(g, ids: list, tree: list[tuple[int, int]]) -> pd.DataFrame:
        named = pd.array([ids[v] if v < len(ids) else None for v, _ in tree], dtype="Int64" if number else "object")
        return pd.DataFrame({group: [g] * len(tree), "node": [v for v, _ in tree], "parent": [p for _, p in tree], id_col: named})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(id_col).reset_index(drop=True)
        return table(pdf[group].iloc[0], pdf[id_col].tolist(), psi_parents(np.stack(pdf[vec]).astype(float), max_children))

    def of_edges(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["cosine", "a", "b"], ascending=[False, True, True])
        ends = dict(zip(pdf["a"], pdf["a_id"], strict=True)) | dict(zip(pdf["b"], pdf["b_id"], strict=True))
        place = {n: k for k, n in enumerate(sorted(ends))}
        tree = psi_of_edges(len(place), zip(pdf["a"].map(place), pdf["b"].map(place), strict=True), max_children)
        return table(pdf[group].iloc[0], [ends[n] for n in sorted(ends)], tree)

    if large.isEmpty():
        return rows.groupBy(group).applyInPandas(whole, schema)
    few = rows.join(large, group, "left_anti").groupBy(group).applyInPandas(whole, schema)
    return few.unionByName(spanning_trees(rows.join(large, group, "left_semi"), group, id_col, vec).groupBy(group).applyInPandas(of_edges, schema))


def medoid_summary(df: DataFrame, keys: list[str], text: str, vec: str) -> DataFrame:
    """The first sentence of the row nearest to its cluster's mean: the stand-in of a summarising model."""
    dims = df.select(F.posexplode(vec).alias("i", "x"), *keys).groupBy(*keys, "i").agg(F.avg("x").alias("m"))
    mean = dims.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("_mean"))
    from ..functions.values import cosine

    scored = df.join(mean, keys).withColumn("_s", cosine(F.col(vec), F.col("_mean")))
    sentence = F.regexp_extract(text, "(?s)^\\s*(.*?[.!?。！？]|.+)", 1)
    return scored.groupBy(*keys).agg(F.max_by(F.trim(sentence), F.struct("_s", text)).alias("summary"), F.first("_mean").alias("vec"))


def raptor(df: DataFrame, id_col: str, text: str, vec: str, *, group: str = "doc_id", method: str = "ward", layers: int = 3, summarise: Callable[[DataFrame, list[str], str, str], DataFrame] = medoid_summary) -> DataFrame:
    """Layers of summaries: rows (group, layer, cluster, text, vec), from the leaves (layer 0) up until one is left."""
    level = df.select(F.col(group), F.lit(0).alias("layer"), F.col(id_col).cast("int").alias("cluster"), F.col(text).alias("text"), F.col(vec).cast("array<double>").alias("vec"))
    out = level
    for k in range(1, layers + 1):
        labels = clusters(level.select(group, F.col("cluster").alias("_id"), F.col("vec")), group, "_id", "vec", method)
        parts = level.join(labels.withColumnRenamed("cluster", "_c"), (level[group] == labels[group]) & (level["cluster"] == labels["_id"])).select(level[group], F.col("_c"), "text", "vec")
        from .graph import cut

        level = cut(summarise(parts, [group, "_c"], "text", "vec").select(group, F.lit(k).alias("layer"), F.col("_c").alias("cluster"), F.col("summary").alias("text"), F.col("vec")), "layer")
        out = out.unionByName(level)
        if level.groupBy(group).count().where("count > 1").isEmpty():
            break
    return out
