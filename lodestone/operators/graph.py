"""Knowledge graphs as tables of vertices (id, ...) and edges (src, dst, weight, ...)."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import token_count
from .scratch import place, remove, shuffles_dropped, stored, stored_for

DAMPING, ITERATIONS = 0.85, 100
#: Links of a node that lie in one row, about, votes of a task, and tasks that share a node's votes.
NEAR, VOTES, SLOTS = 4096, 4_000_000, 8


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """Write an iteration's table to the folder that executors share, and go on from there."""
    return stored(df, name)


def undirected(edges: DataFrame) -> DataFrame:
    """(src, dst, weight) with src <= dst and the weights of parallel edges summed."""
    return edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "weight").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def both_ways(edges: DataFrame) -> DataFrame:
    back = edges.where("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return edges.select("src", "dst", "weight").unionByName(back)


def cooccurrence(members: DataFrame, group: str, item: str, max_items: int | None = None) -> DataFrame:
    """Edges between items of a group, weighted by the number of groups they share.

    Pairs are made inside a group's sorted array of distinct items: a group (a chunk's entities) is bounded by its text.
    """
    sets = members.groupBy(group).agg(F.array_sort(F.collect_set(item)).alias("_x"))
    pairs = F.flatten(F.transform("_x", lambda a, i: F.transform(F.slice("_x", i + 2, F.size("_x")), lambda b: F.struct(a.alias("src"), b.alias("dst")))))
    return sets.where(F.size("_x") > 1).select(F.explode(pairs).alias("p")).groupBy("p.src", "p.dst").agg(F.count("*").cast("double").alias("weight"))


def term_frequency_weights(mentions: DataFrame, group: str, item: str) -> DataFrame:
    """Share of each item's mentions among those of its group."""
    n = mentions.groupBy(group, item).agg(F.count("*").alias("n"))
    return n.withColumn("tf", F.col("n") / F.sum("n").over(Window.partitionBy(group)))


def subgraph(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges both of whose ends are vertices."""
    ids = vertices.select("id")
    return edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")


def tidy(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without a description or source go, and edges without ends."""
    v = vertices.dropna(subset=["description", "source_id"])
    return v, subgraph(v, edges.dropna(subset=["description", "source_id"]))


def merge_vertices(vertices: DataFrame) -> DataFrame:
    """One row an id: the most common type, distinct sorted descriptions joined, distinct sources."""
    return vertices.groupBy("id").agg(
        F.mode("entity_type", True).alias("entity_type"),
        F.array_join(F.array_sort(F.collect_set("description")), "<SEP>").alias("description"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("source_id")))).alias("source_id"),
    )


def merge_edges(edges: DataFrame) -> DataFrame:
    """One row a pair: weights summed, descriptions, keywords and sources distinct."""
    return (
        edges.withColumns({"_a": F.least("src", "dst"), "_b": F.greatest("src", "dst")})
        .groupBy(F.col("_a").alias("src"), F.col("_b").alias("dst"))
        .agg(
            F.sum("weight").alias("weight"),
            F.array_join(F.array_sort(F.collect_set("description")), "<SEP>").alias("description"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("keywords")))).alias("keywords"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("source_id")))).alias("source_id"),
        )
    )


def compose(a: tuple[DataFrame, DataFrame], b: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Two graphs as one; vertices get their degree as rank."""
    v, e = merge_vertices(a[0].unionByName(b[0], True)), merge_edges(a[1].unionByName(b[1], True))
    return v.join(degrees(e), "id", "left").withColumn("rank", F.coalesce("degree", F.lit(0)).cast("int")).drop("degree"), e


def degrees(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))


def pagerank(edges: DataFrame, *, iterations: int = 20, damping: float = DAMPING, tolerance: float | None = None, cut_every: int = 5) -> DataFrame:
    """(id, pagerank) by power iteration on an undirected weighted graph; the rank of nodes without edges is spread.

    The transitions, with one of weight 0 from each node to itself so that every node is summed, are dealt by source once and
    kept; a round meets them with the ranks, which lie as the round before has summed them, and shuffles sums by target. With
    ``tolerance`` the rounds end when the summed change is below tolerance x nodes.
    """
    w = both_ways(edges)
    out = w.groupBy("src").agg(F.sum("weight").alias("_out"))
    share = cut(w.join(out, "src").select("src", "dst", (F.col("weight") / F.col("_out")).alias("p")), "transitions")
    nodes = share.select(F.col("src").alias("id")).distinct()
    held = share.unionByName(nodes.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("p"))).repartition("src").persist(StorageLevel.MEMORY_AND_DISK)
    n = held.select("src").distinct().count()
    ranks = held.select(F.col("src").alias("id")).distinct().withColumn("pagerank", F.lit(1.0 / n if n else 0.0))
    for k in range(iterations):
        got = held.join(ranks, held["src"] == ranks["id"]).groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("pagerank") * F.col("p")).alias("_in"))
        fresh = got.select("id", (F.lit((1 - damping) / n if n else 0.0) + damping * F.col("_in")).alias("pagerank"))
        if tolerance is not None or (k + 1) % cut_every == 0 or k + 1 == iterations:
            fresh = cut(fresh, "ranks")
        change = fresh.join(ranks.withColumnRenamed("pagerank", "_before"), "id").agg(F.sum(F.abs(F.col("pagerank") - F.col("_before")))).first()[0] if tolerance is not None else None
        ranks = fresh
        if change is not None and change < n * tolerance:
            break
    held.unpersist()
    return ranks


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): least id reachable, by large-star and small-star rounds (logarithmic in the longest chain)."""
    now = cut(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = cut(small, "edges")
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    roots = now.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def contract(vertices: DataFrame, edges: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices of a group (id, component) become the component's; parallel edges are summed, loops go."""
    to = groups.select(F.col("id").alias("_i"), F.col("component").alias("_c"))
    v = vertices.join(to, vertices["id"] == to["_i"], "left").withColumn("id", F.coalesce("_c", "id")).drop("_i", "_c")
    e = edges.join(to, edges["src"] == to["_i"], "left").withColumn("src", F.coalesce("_c", "src")).drop("_i", "_c")
    e = e.join(to, e["dst"] == to["_i"], "left").withColumn("dst", F.coalesce("_c", "dst")).drop("_i", "_c")
    return merge_vertices(v), merge_edges(e.where("src <> dst"))


def nhop_paths(edges: DataFrame, hops: int = 2) -> DataFrame:
    """Simple paths of up to ``hops`` edges: rows (src, path, weights)."""
    w = both_ways(edges)
    paths = w.select("src", F.array("src", "dst").alias("path"), F.array("weight").alias("weights"), F.col("dst").alias("_end"))
    out = paths
    step = w.select(F.col("src").alias("_end"), F.col("dst").alias("_next"), F.col("weight").alias("_w"))
    for _ in range(hops - 1):
        paths = paths.join(step, "_end").where(~F.array_contains("path", F.col("_next"))).select("src", F.array_append("path", F.col("_next")).alias("path"), F.array_append("weights", F.col("_w")).alias("weights"), F.col("_next").alias("_end"))
        out = out.unionByName(paths)
    return out.drop("_end")


def _multiples(edges: DataFrame) -> DataFrame:
    """A row for all parallel edges (src, dst), both ways: how many they are, the sum of their weights, and the largest."""
    w = both_ways(edges)
    return w.groupBy("src", "dst").agg(F.count("*").alias("n"), F.sum("weight").alias("total"), F.max("weight").alias("weight"))


def two_hop_sums(edges: DataFrame) -> DataFrame:
    """(src, paths, nodes, weight): number, nodes and weights in all of a node's ``nhop_paths`` of one and two edges, without
    making the paths.

    A path a, m, b goes on over each edge from m that ends neither in m nor in a; so an edge (a, m) begins as many paths of
    two edges as m has edges, less its loops and those to a. This costs the edges, not their pairs.
    """
    w = stored(_multiples(edges), "multiples")
    away = w.where("src <> dst").groupBy(F.col("src").alias("dst")).agg(F.sum("n").alias("_n"), F.sum("total").alias("_total"))
    back = F.col("src") != F.col("dst")  # the edges from m back to a are those from a to m
    on = F.coalesce("_n", F.lit(0)) - F.when(back, F.col("n")).otherwise(0)
    weight = F.coalesce("_total", F.lit(0.0)) - F.when(back, F.col("total")).otherwise(0.0)
    two = w.join(away, "dst", "left").select("src", "n", "total", on.alias("_on"), weight.alias("_weight"))
    return two.groupBy("src").agg(
        F.sum(F.col("n") * (1 + F.col("_on"))).alias("paths"),
        F.sum(F.col("n") * (2 + 3 * F.col("_on"))).alias("nodes"),
        F.sum(F.col("total") * (1 + F.col("_on")) + F.col("n") * F.col("_weight")).alias("weight"),
    )


def nhop_scores(entities: DataFrame) -> DataFrame:
    """Edges on the paths of scored entities (similarity, paths array<struct<path, weights>>): (src, dst, sim, weight).

    An edge i steps along a path adds similarity / (2 + i); its weight is the largest met.
    """
    rows = entities.select("similarity", F.explode("paths").alias("p"))
    steps = F.transform(F.sequence(F.lit(0), F.size("p.path") - 2), lambda i: F.struct(F.get("p.path", i).alias("src"), F.get("p.path", i + 1).alias("dst"), i.alias("i"), F.coalesce(F.get("p.weights", i), F.lit(0.0)).alias("w")))
    edges = rows.where(F.size("p.path") > 1).select("similarity", F.explode(steps).alias("e"))
    return edges.groupBy("e.src", "e.dst").agg(F.sum(F.col("similarity") / (F.lit(2.0) + F.col("e.i"))).alias("sim"), F.max("e.w").alias("weight"))


def two_hop_scores(edges: DataFrame, scored: DataFrame) -> DataFrame:
    """nhop_scores of all paths of one and two edges around scored entities (id, similarity), without making the paths;
    parallel edges are one edge, loops are left out.

    In such a graph the edge (f, t) is the first step of deg(t) paths from f, one of them of one edge, and the second step of
    the paths over f from each neighbour of f but t. So sums of neighbours give the score, at the cost of the edges, not of
    their pairs.
    """
    w = both_ways(undirected(edges).where("src <> dst"))
    sims = scored.groupBy("id").agg(F.sum("similarity").alias("_sim"))
    degree = w.groupBy(F.col("src").alias("dst")).agg(F.count("*").alias("_deg"))
    around = w.join(sims.withColumnRenamed("id", "dst"), "dst").groupBy("src").agg(F.sum("_sim").alias("_around"))
    out = w.join(degree, "dst").join(around, "src", "left").join(sims.select(F.col("id").alias("src"), F.col("_sim").alias("_f")), "src", "left").join(sims.select(F.col("id").alias("dst"), F.col("_sim").alias("_t")), "dst", "left")
    none = F.lit(0.0)
    first, second = F.coalesce("_f", none) * F.col("_deg") / 2, (F.coalesce("_around", none) - F.coalesce("_t", none)) / 3
    others = F.coalesce("_around", none) > F.coalesce("_t", none) * (1 + 1e-12)
    return out.where(F.col("_f").isNotNull() | others).select("src", "dst", (first + F.when(others, second).otherwise(none)).alias("sim"), "weight")


def two_hop_path_scores(edges: DataFrame, scored: DataFrame) -> DataFrame:
    """nhop_scores of the ``nhop_paths`` of one and two edges from scored entities (id, similarity; a row a path's owner),
    without making the paths: every parallel edge makes paths of its own, and loops theirs.

    Of the n edges (f, t), f <> t, each is the first step of a path of one edge and of one path for every edge from t but
    those to t and f; and the second step of a path over every edge into f but those from t, loops of f among them. A loop is
    a first step only.
    """
    w = stored(_multiples(edges), "multiples")
    sims = scored.groupBy("id").agg(F.sum("similarity").alias("_sim"))
    away = w.where("src <> dst").groupBy(F.col("src").alias("dst")).agg(F.sum("n").alias("_on"))
    into = w.join(sims.withColumnRenamed("id", "dst"), "dst").groupBy("src").agg(F.sum(F.col("n") * F.col("_sim")).alias("_around"), F.sum("n").alias("_owners"))
    out = w.join(away, "dst", "left").join(into, "src", "left").join(sims.select(F.col("id").alias("src"), F.col("_sim").alias("_f")), "src", "left").join(sims.select(F.col("id").alias("dst"), F.col("_sim").alias("_t")), "dst", "left")
    zero, none, loop = F.lit(0), F.lit(0.0), F.col("src") == F.col("dst")
    first = F.coalesce("_f", none) * (1 + F.coalesce("_on", zero) - F.when(loop, zero).otherwise(F.col("n"))) / 2
    others = ~loop & (F.coalesce("_owners", zero) > F.when(F.col("_t").isNotNull(), F.col("n")).otherwise(zero))
    second = (F.coalesce("_around", none) - F.col("n") * F.coalesce("_t", none)) / 3
    return out.where(F.col("_f").isNotNull() | others).select("src", "dst", (F.col("n") * (first + F.when(others, second).otherwise(none))).alias("sim"), "weight")


def fused_relations(relations: DataFrame, hops: DataFrame, typed: DataFrame) -> DataFrame:
    """Relations (src, dst, sim, pagerank) with their n-hop score, and +1 for each end among typed entities (id); n-hop
    edges without a relation become relations."""
    r = relations.select("src", "dst", F.col("sim").alias("_rs"), F.col("pagerank").alias("_rp"))
    h = hops.select("src", "dst", F.col("sim").alias("_hs"), F.col("weight").alias("_hp"))
    both = r.join(h, ["src", "dst"], "full_outer")
    for end in ("src", "dst"):
        both = both.join(typed.select(F.col("id").alias(end), F.lit(1).alias(f"_{end}")).distinct(), end, "left")
    s = F.coalesce("_src", F.lit(0)) + F.coalesce("_dst", F.lit(0))
    sim = F.when(F.col("_rs").isNotNull(), F.col("_rs") * (F.coalesce("_hs", F.lit(0.0)) + s + 1)).otherwise(F.col("_hs") * (s + 1))
    return both.select("src", "dst", sim.alias("sim"), F.coalesce("_rp", "_hp").alias("pagerank"))


def kg_retrieve(entities: DataFrame, relations: DataFrame, typed: DataFrame, *, edges: DataFrame | None = None, threshold: float = 0.3, top: int = 6, budget: int = 8196) -> DataFrame:
    """Entities found by text (id, similarity, pagerank, description, and paths stored with them or ``edges`` of the graph),
    doubled where their type fits too; relations fused with n-hop edges; the best of both within a token budget: rows (kind,
    name, score, description)."""
    hit = entities.where(F.coalesce("similarity", F.lit(0.0)) >= threshold)
    boosted = hit.join(typed.select("id", F.lit(2.0).alias("_x")).distinct(), "id", "left").withColumn("similarity", F.col("similarity") * F.coalesce("_x", F.lit(1.0))).drop("_x")
    best = boosted.select(F.lit("entity").alias("kind"), F.col("id").alias("name"), (F.col("similarity") * F.col("pagerank")).alias("score"), "description").orderBy(F.desc("score"), "name").limit(top)
    fused = fused_relations(relations, nhop_scores(hit) if edges is None else two_hop_scores(edges, hit), typed)
    described = fused.join(relations.select("src", "dst", "description"), ["src", "dst"], "left")
    rel = described.select(F.lit("relation").alias("kind"), F.concat_ws(" -> ", "src", "dst").alias("name"), (F.col("sim") * F.col("pagerank")).alias("score"), F.coalesce("description", F.lit("")).alias("description")).orderBy(F.desc("score"), "name").limit(top)
    both = best.unionByName(rel)  # at most 2 x top rows
    line = F.concat_ws(",", "name", F.format_number("score", 2), "description")
    running = F.sum(token_count(line)).over(Window.partitionBy(F.lit(0)).orderBy("kind", F.desc("score"), "name").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return both.withColumn("_used", running).where(F.col("_used") < budget).drop("_used")


def community_retrieve(communities: DataFrame, entities: list[str], top: int = 1) -> DataFrame:
    return communities.where(F.arrays_overlap("entities_kwd", F.array(*map(F.lit, entities)))).orderBy(F.desc("weight_flt"), "id").limit(top)


def resolution_links(entities: DataFrame, name: str, kind: str, block: int = 512) -> DataFrame:
    """Pairs (a, b, kind), a < b, of different names of a type that are similar: no pair is lost.

    Similar names have the same letter pairs with a digit, so names meet by type and these. Beyond that the rule knows no
    bound by which most pairs needn't be looked at (half of the shorter name may differ), so all that meet are, but evenly:
    names are dealt to blocks of about ``block``, a task is a pair of blocks, and only similar names leave it. What the rule
    needs of a name is made once a name.
    """
    rows = entities.select(F.col(name).alias("n"), F.col(kind).alias("k")).where("n is not null").distinct()
    rows = rows.select("n", F.coalesce("k", F.lit("")).alias("k"), F.col("k").isNull().alias("_none"), digit_pairs(F.col("n")).alias("d"), is_english(F.col("n")).alias("e"), _characters(F.col("n")).alias("c"))
    met = ["k", "_none", "d"]
    blocks = rows.groupBy(*met).agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("nb"))
    rows = rows.join(blocks, met).withColumn("i", F.pmod(F.xxhash64("n"), F.col("nb")).cast("int"))
    every = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.least("i", j).alias("x"), F.greatest("i", j).alias("y")))
    left = rows.select(*met, F.col("n").alias("a"), F.col("e").alias("ea"), F.col("c").alias("ca"), F.explode(every).alias("t")).select(*met, "t.x", "t.y", "a", "ea", "ca")
    right = left.withColumnsRenamed({"a": "b", "ea": "eb", "ca": "cb"})
    pairs = left.join(right, [*met, "x", "y"]).where((F.col("a") < F.col("b")) & _close(*map(F.col, ("a", "b", "ea", "eb", "ca", "cb"))))
    return pairs.select("a", "b", F.when(~F.col("_none"), F.col("k")).alias("kind")).distinct()


def resolution(entities: DataFrame, name: str, kind: str, block: int = 512) -> DataFrame:
    """A row a name of a type: (name, kind, links, component): how many names it is similar to, and the least name that
    such links reach."""
    links = cut(resolution_links(entities, name, kind, block), "name-links")
    of = lambda c: F.concat_ws("\u0001", F.coalesce("kind", F.lit("")), F.col(c))
    roots = components(links.select(of("a").alias("src"), of("b").alias("dst")))
    counts = links.select("kind", F.explode(F.array("a", "b")).alias("name")).groupBy("kind", "name").agg(F.count("*").alias("links"))
    rows = entities.select(F.col(name).alias("name"), F.col(kind).alias("kind")).where("name is not null").distinct()
    rows = rows.join(counts.withColumnRenamed("kind", "_k").withColumnRenamed("name", "_n"), F.col("name").eqNullSafe(F.col("_n")) & F.col("kind").eqNullSafe(F.col("_k")), "left")
    rows = rows.join(roots, of("name") == F.col("id"), "left")
    return rows.select("name", "kind", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce(F.get(F.split("component", "\u0001"), F.lit(1)), F.col("name")).alias("component"))


def is_english(c: Column) -> Column:
    """Over 80 % of the characters are letters, digits or marks of English text."""
    return F.regexp_count(c, F.lit("[`a-zA-Z0-9.,':;/\"?<>!()-]")) / F.length(c) > 0.8


def digit_pairs(c: Column) -> Column:
    """The different letter pairs with a digit, in order, as one text."""
    pairs = F.when(F.length(c) > 1, F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(pairs, lambda x: x.rlike("[0-9]")))), "\u0001")


def _characters(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, ""), lambda y: y != ""))


def _close(a: Column, b: Column, a_english: Column, b_english: Column, a_characters: Column, b_characters: Column) -> Column:
    half = F.floor(F.least(F.length(a), F.length(b)) / 2)
    common, most = F.size(F.array_intersect(a_characters, b_characters)), F.greatest(F.size(a_characters), F.size(b_characters))
    other = F.when(most < 4, common > 1).otherwise(common / most >= 0.8)
    return F.when(a_english & b_english, (F.abs(F.length(a) - F.length(b)) <= half) & (F.levenshtein(a, b) <= half)).otherwise(other)


def similar_names(a: Column, b: Column) -> Column:
    """Never where a digit is in a letter pair that only one name has; English names by edit distance, at most half the
    shorter (rounded down); others by their different characters: two or more in common where both have under four, else
    80 % of the larger set."""
    return F.coalesce((digit_pairs(a) == digit_pairs(b)) & _close(a, b, is_english(a), is_english(b), _characters(a), _characters(b)), F.lit(False))


def _numbered(links: DataFrame) -> DataFrame:
    """(id, n) of the nodes of links (src, dst): numbers in the order of the ids."""
    ids = links.select(F.col("src").alias("id")).union(links.select("dst")).where("id is not null").distinct()
    return ids.orderBy("id").withColumn("n", F.monotonically_increasing_id())


def label_propagation(edges: DataFrame, rounds: int = 8, cut_every: int = 1) -> DataFrame:
    """(id, label) of communities: each node takes the heaviest label around it, the least of equals. Cheaper than
    ``hierarchical_communities``, and without levels.

    Nodes go by number, in the order of their ids. Links lie by one end, ``NEAR`` or so in a row, so a round shuffles these
    rows and one vote a link; what a round has read is gone when the next one ends."""
    spark = edges.sparkSession
    with shuffles_dropped(spark), ExitStack() as held:
        with stored_for(undirected(edges), "links") as plain:
            names = held.enter_context(stored_for(_numbered(plain), "names"))
            ends = plain.join(names.select(F.col("id").alias("src"), F.col("n").alias("_src")), "src").select("_src", "dst", "weight")
            with stored_for(ends, "ends") as ends:
                pairs = ends.join(names.select(F.col("id").alias("dst"), F.col("n").alias("_dst")), "dst")
                both = both_ways(pairs.select(F.col("_src").alias("src"), F.col("_dst").alias("dst"), "weight"))
                degree = ends.select("_src").union(pairs.where("_src <> _dst").select("_dst")).groupBy(F.col("_src").alias("dst")).agg(F.ceil(F.count("*") / NEAR).alias("_parts"))
                near = both.join(degree, "dst").groupBy("dst", F.pmod(F.xxhash64("src"), F.col("_parts"))).agg(F.sort_array(F.collect_list(F.struct("src", "weight"))).alias("_near"))
                near = held.enter_context(stored_for(near.select("dst", F.col("_near.src").alias("src"), F.col("_near.weight").alias("weight"), F.size("_near").alias("links")), "near"))
        votes = near.agg(F.sum("links")).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-votes // VOTES))
        labels = names.select(F.col("n").alias("id"), F.col("n").alias("label"))
        before: list[str] = []
        for k in range(rounds):
            told = near.join(labels.withColumnRenamed("id", "dst"), "dst").select("label", F.explode(F.arrays_zip("src", "weight")).alias("_l")).select(F.col("_l.src").alias("src"), "label", F.col("_l.weight").alias("weight"))
            # Dealt by node and a slot of labels: the sums need no other shuffle, and the best of a node one of few rows.
            told = told.withColumn("slot", F.pmod("label", F.lit(SLOTS))).repartition(parts, "src", "slot")
            tally = told.groupBy("src", "slot", "label").agg(F.sum("weight").alias("_v"))
            best = tally.groupBy(F.col("src").alias("id")).agg(F.min_by("label", F.struct((-F.col("_v")).alias("v"), "label")).alias("_new"))
            labels = labels.join(best, "id").select("id", F.least("label", "_new").alias("label"))
            if (k + 1) % cut_every == 0:
                path = place(spark, "labels")
                labels.write.parquet(path)
                labels = spark.read.schema(labels.schema).parquet(path)
                for old in before:
                    remove(spark, old)
                before = [path]
        named = names.select(F.col("n").alias("label"), F.col("id").alias("_name"))
        out = stored(labels.join(named, "label").select(F.col("id").alias("n"), F.col("_name").alias("label")).join(names, "n").select("id", "label"), "labels")
        for old in before:
            remove(spark, old)
    return out


def _moved(w: DataFrame, nodes: DataFrame, resolution: float, rounds: int, seed: int) -> DataFrame:
    """Communities of nodes (id, top, k) by local moves of greatest modularity gain: rows (id, c). ``w`` has an edge both ways
    and a loop once, with twice its weight; a graph of several ``top`` parts is several graphs."""
    total = nodes.groupBy("top").agg(F.sum("k").alias("_m"))
    known = cut(nodes.join(total, "top").select("id", "k", "_m"), "nodes")
    c = known.select("id", F.col("id").alias("c"))
    for r in range(rounds):
        now = known.join(c, "id")
        sums = now.groupBy("c").agg(F.sum("k").alias("_sum"))
        votes = w.where("src <> dst").join(c.select(F.col("id").alias("dst"), "c"), "dst").groupBy(F.col("src").alias("id"), "c").agg(F.sum("weight").alias("_w"))
        own = now.select("id", "k", "_m", F.col("c").alias("_own"))
        choices = votes.join(own, "id").unionByName(own.select("id", F.col("_own").alias("c"), F.lit(0.0).alias("_w"), "k", "_m", "_own"))
        choices = choices.groupBy("id", "c", "k", "_m", "_own").agg(F.sum("_w").alias("_w")).join(sums, "c")
        stay = F.col("c") == F.col("_own")
        gain = F.col("_w") - F.lit(resolution) * F.col("k") * (F.col("_sum") - F.when(stay, F.col("k")).otherwise(0.0)) / F.col("_m")
        best = choices.groupBy("id", "_own").agg(F.max(F.when(stay, gain)).alias("_now"), F.max_by("c", F.struct(F.round(gain, 9), F.xxhash64("c", F.lit(seed)))).alias("_to"), F.max(gain).alias("_gain"))
        # Half of the nodes move in a round, as neighbours that move at once would swap places.
        turn = F.pmod(F.xxhash64("id", F.lit(seed + r)), F.lit(2)) == 0
        fresh = cut(best.select("id", "_own", F.when(turn & (F.col("_gain") > F.col("_now") + 1e-9), F.col("_to")).otherwise(F.col("_own")).alias("c")), "moves")
        c = fresh.select("id", "c")
        if r % 2 and fresh.where("c <> _own").isEmpty():
            break
    return c


def _partition(edges: DataFrame, tops: DataFrame, resolution: float, rounds: int, levels: int, seed: int) -> DataFrame:
    """Communities (id, c) of a graph of parts (id, top): moves, refinement to connected pieces, aggregation, and again."""
    members = cut(tops.select("id", F.col("id").alias("node")), "members")
    plain = cut(undirected(edges), "plain")
    graph = plain
    for level in range(levels):
        loops = graph.where("src = dst").select("src", "dst", (2 * F.col("weight")).alias("weight"))
        w = cut(both_ways(graph.where("src <> dst")).unionByName(loops), "links")
        of = members.join(tops, "id").groupBy("node").agg(F.first("top").alias("top"))
        nodes = of.withColumnRenamed("node", "id").join(w.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("k")), "id", "left").withColumn("k", F.coalesce("k", F.lit(0.0)))
        c = _moved(w, nodes.where("k > 0"), resolution, rounds, seed + 100 * level)
        # A community is a connected piece: its edges alone say which nodes it has.
        inside = graph.join(c.select(F.col("id").alias("src"), F.col("c").alias("_a")), "src").join(c.select(F.col("id").alias("dst"), F.col("c").alias("_b")), "dst").where("_a = _b and src <> dst")
        pieces = cut(components(inside.select("src", "dst")), "pieces")
        if pieces.isEmpty():
            break
        name = pieces.select(F.col("id").alias("node"), "component")
        members = cut(members.join(name, "node", "left").select("id", F.coalesce("component", "node").alias("node")), "members")
        ends = [members.select(F.col("id").alias(x), F.col("node").alias(f"_{x}")) for x in ("src", "dst")]
        graph = cut(undirected(plain.join(ends[0], "src").join(ends[1], "dst").select(F.col("_src").alias("src"), F.col("_dst").alias("dst"), "weight")), "graph")
    return members.select("id", F.col("node").alias("c"))


def hierarchical_communities(edges: DataFrame, *, max_size: int = 12, resolution: float = 1.0, rounds: int = 8, levels: int = 6, depth: int = 8, seed: int = 0xDEADBEEF) -> DataFrame:
    """Communities in the manner of hierarchical Leiden: rows (id, level, community, parent, final). Level 0 is the whole
    graph's; communities of more than ``max_size`` nodes are parted again on the level below, by their own edges alone, until
    none is larger or none parts; ``final`` marks a node's last. Communities are connected and named by their least node.

    Each round of moves joins edges to labels and sums by node before anything is ranked; tables are written between rounds.
    Moves go by seeded halves of the nodes, so results are those of a parallel version, not of a sequential one.
    """
    plain = cut(undirected(edges), "graph")
    tops = cut(plain.select(F.explode(F.array("src", "dst")).alias("id")).distinct().withColumn("top", F.lit("")), "tops")
    out, now = [], plain
    for level in range(depth):
        found = _partition(now, tops, resolution, rounds, levels, seed + 10_000 * level)
        least = found.groupBy("c").agg(F.min("id").alias("community"), F.count("*").alias("_n"))
        rows = cut(tops.join(found, "id").join(least, "c").select("id", F.lit(level).alias("level"), "community", F.nullif(F.col("top"), F.lit("")).alias("parent"), "_n"), "level")
        out.append(rows)
        parted = rows if level == 0 else rows.join(tops.groupBy(F.col("top").alias("parent")).agg(F.count("*").alias("_all")), "parent").where("_n < _all")
        tops = cut(parted.where(F.col("_n") > max_size).select("id", F.col("community").alias("top")), "tops")
        if tops.isEmpty():
            break
        ends = [tops.select(F.col("id").alias(x), F.col("top").alias(f"_{x}")) for x in ("src", "dst")]
        now = cut(now.join(ends[0], "src").join(ends[1], "dst").where("_src = _dst").select("src", "dst", "weight"), "graph")
    every = reduce(DataFrame.unionByName, out).drop("_n")
    last = every.groupBy("id").agg(F.max("level").alias("_last"))
    return every.join(last, "id").select("id", "level", "community", "parent", (F.col("level") == F.col("_last")).alias("final"))


def modularity(edges: DataFrame, labels: DataFrame, label: str = "community", resolution: float = 1.0) -> DataFrame:
    """One row: the share of weight inside communities less what chance would put there."""
    w = both_ways(undirected(edges)).unionByName(undirected(edges).where("src = dst"))
    a, b = labels.select(F.col("id").alias("src"), F.col(label).alias("_a")), labels.select(F.col("id").alias("dst"), F.col(label).alias("_b"))
    total = w.agg(F.sum("weight").alias("_m"))
    inside = w.join(a, "src").join(b, "dst").groupBy(F.col("_a").alias("c")).agg(F.sum("weight").alias("_k"), F.sum(F.when(F.col("_a") == F.col("_b"), F.col("weight")).otherwise(0.0)).alias("_in"))
    return inside.crossJoin(F.broadcast(total)).agg(F.sum(F.col("_in") / F.col("_m") - resolution * F.pow(F.col("_k") / F.col("_m"), 2)).alias("modularity"))


def community_weights(labels: DataFrame, vertices: DataFrame) -> DataFrame:
    """Sum of rank x weight of a community's members, over the largest such sum."""
    sums = labels.join(vertices.select("id", (F.col("rank") * F.coalesce("weight", F.lit(1.0))).alias("_w")), "id").groupBy("label").agg(F.sum("_w").alias("weight"), F.count("*").alias("size"))
    top = sums.agg(F.max("weight").alias("_top"))
    return sums.crossJoin(F.broadcast(top)).select("label", "size", F.try_divide("weight", "_top").alias("weight"))


def walks(edges: DataFrame, length: int = 10, per_node: int = 2, seed: int = 7) -> DataFrame:
    """Random walks (id, walk): at each step the neighbour with the least seeded hash, weighted by exponential clocks."""
    w = cut(both_ways(edges), "links")
    nodes = w.select(F.col("src").alias("id")).distinct()
    paths = nodes.select("id", F.explode(F.sequence(F.lit(1), F.lit(per_node))).alias("n"), F.array("id").alias("walk"), F.col("id").alias("_at"))
    for k in range(length - 1):
        u = (F.pmod(F.xxhash64(F.lit(seed + k), "id", "n", "dst"), F.lit(1 << 30)) + 1) / float(1 << 30)
        step = paths.join(w, paths["_at"] == w["src"]).groupBy("id", "n", "walk").agg(F.min_by("dst", -F.log(u) / F.col("weight")).alias("_at"))
        paths = step.withColumn("walk", F.array_append("walk", F.col("_at")))
        if k % 3 == 2:
            paths = cut(paths, "walks")
    return paths.select("id", F.transform("walk", lambda x: x.cast("string")).alias("walk"))


def node_embeddings(edges: DataFrame, dimensions: int = 32, **options) -> DataFrame:
    """Vectors of nodes by skip-gram over random walks: rows (word, vector)."""
    from pyspark.ml.feature import Word2Vec

    return Word2Vec(vectorSize=dimensions, minCount=1, inputCol="walk", outputCol="v", seed=7).fit(walks(edges, **options)).getVectors()


def extract_with(chunks: DataFrame, extractor: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Entities and relations by a plugged model: ``extractor`` gets the chunks and returns (vertices, edges)."""
    vertices, edges = extractor(chunks)
    return tidy(merge_vertices(vertices), merge_edges(edges))
