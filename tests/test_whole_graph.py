"""Graph queries without SQL, on every row of a small lineitem."""

import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from lodestone import queries as Q
from lodestone.operators import graph


def test_communities_of_the_whole_graph(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(rnd.randint(1, 40), rnd.randint(1, 12), float(rnd.randint(1, 50))) for _ in range(90)]
    spark.createDataFrame(rows, "l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    links = defaultdict(Counter)
    for p, s, _ in rows:
        links[f"p{p}"][f"s{s}"] += 1
        links[f"s{s}"][f"p{p}"] += 1
    labels = {x: x for x in links}
    for _ in range(4):
        fresh = {}
        for x, around in links.items():
            votes = Counter()
            for y, w in around.items():
                votes[labels[y]] += w
            fresh[x] = min(labels[x], min(votes, key=lambda k: (-votes[k], k)))
        labels = fresh
    got = {r["id"]: r["label"] for r in Q.QUERIES["communities"](spark, str(tmp_path)).collect()}
    assert got == labels


def test_communities_leave_no_work_tables(spark):
    """Of the rounds nothing is left but the labels; ids of any kind, a hub, a loop, a null end; ties go to the least id."""
    import os

    from lodestone.operators.scratch import folder

    rows = [(f"n{k}", "hub", 1.0) for k in range(20)] + [("n1", "n2", 5.0), ("n10", "n9", 5.0), ("x", "x", 1.0), (None, "n3", 1.0), (None, None, 1.0)]
    at = folder(spark).removeprefix("file:")
    before = set(os.listdir(at))
    got = {r["id"]: r["label"] for r in graph.label_propagation(spark.createDataFrame(rows, "src string, dst string, weight double"), 6).collect()}
    assert [x.rpartition("-")[0] for x in set(os.listdir(at)) - before] == ["labels"]
    assert set(got) == {f"n{k}" for k in range(20)} | {"hub", "x"} and got["x"] == "x" and got["n1"] == got["n2"]
    one = graph.label_propagation(spark.createDataFrame([(10, 2, 1.0), (2, 9, 1.0)], "src long, dst long, weight double"), 1)
    assert {tuple(r) for r in one.collect()} == {(10, 2), (9, 2), (2, 2)}


def test_hierarchical_communities(spark):
    """Planted groups of groups are found, connected, named by their least node, and no worse than label propagation."""
    from lodestone.operators import graph

    rnd = random.Random(5)
    rows = []
    for big in range(3):
        for group in range(3):
            nodes = [f"n{big}{group}{k}" for k in range(6)]
            rows += [(a, b, 4.0) for i, a in enumerate(nodes) for b in nodes[i + 1 :]]
        rows += [(f"n{big}{g}{rnd.randrange(6)}", f"n{big}{(g + 1) % 3}{rnd.randrange(6)}", 1.5) for g in range(3) for _ in range(5)]
    rows += [("n000", "n100", 0.2), ("n111", "n211", 0.2)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    found = graph.hierarchical_communities(edges, max_size=8).collect()
    assert {r["id"] for r in found if r["level"] == 0} == {x for r in rows for x in r[:2]}
    final = {r["id"]: r["community"] for r in found if r["final"]}
    assert all(final[f"n{b}{g}{k}"] == f"n{b}{g}0" for b in range(3) for g in range(3) for k in range(6))
    for r in found:
        if r["level"]:
            assert r["parent"] == next(x["community"] for x in found if x["id"] == r["id"] and x["level"] == r["level"] - 1)
    quality = lambda labels, c: graph.modularity(edges, labels, c).first()[0]
    top = spark.createDataFrame([(r["id"], r["community"]) for r in found if r["level"] == 0], "id string, community string")
    assert quality(top, "community") >= quality(graph.label_propagation(edges, 4), "label") - 1e-9


def test_path_sums_of_a_multigraph(spark):
    """Sums over paths that aren't made equal those of the paths, with parallel edges and loops."""
    rng = np.random.default_rng(3)
    rows = [(f"v{a}", f"v{b}", float(w)) for a, b, w in rng.integers(0, 9, (40, 3))] + [("v0", "v0", 2.0), ("v1", "v2", 1.0), ("v1", "v2", 4.0), ("x", "x", 1.0), ("y", "z", 3.0)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    paths = graph.nhop_paths(edges, 2)
    total = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    want = paths.groupBy("src").agg(F.count("*").alias("paths"), F.sum(F.size("path")).alias("nodes"), F.round(F.sum(total), 6).alias("weight"))
    got = graph.two_hop_sums(edges).withColumn("weight", F.round("weight", 6))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    sims = spark.createDataFrame([("v0", 0.5), ("v1", 1.0), ("v5", 0.25), ("y", 1.0), ("x", 3.0)], "id string, similarity double")
    stored = paths.join(sims, F.col("src") == F.col("id")).select("similarity", F.array(F.struct("path", "weights")).alias("paths"))
    rounded = lambda df: sorted(map(tuple, df.select("src", "dst", F.round("sim", 6), "weight").collect()))
    assert rounded(graph.two_hop_path_scores(edges, sims)) == rounded(graph.nhop_scores(stored))
