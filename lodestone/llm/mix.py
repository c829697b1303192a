"""Mixing sources to target weights, with DataFrame operations only.

The mix is planned on blocks: a source's documents, ordered by a seeded hash, are cut into blocks of near-equal words.
Every source gets an exact quota of block copies. A splitting tree deals the quotas to the output shards: each node of
the tree splits its quota vector between its two halves by a multivariate hypergeometric draw, so a shard holds an
exact, random count of blocks of each source, and every block copy lies in exactly one shard. Shards then take their
counts from each source's permuted blocks, and rows are ordered by a hash inside the shard (``in_shards``).

To plan, only two tables are shuffled: sizes (four numbers a document) and block sums (at most ``blocks`` plus one a
source). A source's last pass stops inside a block, at the document that comes nearest to the target. ``blocks`` says how
finely sources are spread over shards; nothing of the size of a block is ever in one task.

Defined cases: null text counts no words; null source is a source of its own, last in order; a source without words has
target 0 and is not drawn; an empty table gives an empty mix; repeated rows are rows of their own with equal decisions;
further columns pass through untouched, and columns named like the plan's own are kept as the caller's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, broadcast_if, key, md5_long, stored

WEIGHTS = (3, 1, 2)
FINE = 4096


def sized(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str, *more: str) -> DataFrame:
    """Words, source key and place in the permuted order of every document."""
    out = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("_source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        *more,
    )
    return out.withColumn("_h", md5_long(F.lit(seed), F.col("doc_id"), F.col("size"))).withColumn("_sk", key("_source"))


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float, blocks: int) -> DataFrame:
    """One row a source: its words, target, whole passes, words of the last pass, number of blocks.

    Targets share ``share`` times all words by weight and stop at ``cap`` times the source's words. With the sources in
    order of cap / weight, the water level is the highest of (what is left) / (weights left) before each of them.
    """
    per = sizes.groupBy("_source", "_sk").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    order = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("_source"))
    per = per.withColumn("_rank", F.row_number().over(order) - 1)
    per = per.withColumn("_w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_rank") % len(weights) + 1).cast("int")))
    per = per.withColumn("_cap", F.col("source_size") * F.lit(float(cap))).withColumn("_total", F.sum("source_size").over(everything))
    before = Window.partitionBy(F.lit(0)).orderBy((F.col("_cap") / F.col("_w")).asc(), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_total") * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    per = per.withColumn("_level", left / weight).withColumn("_level", F.max("_level").over(everything))
    per = per.withColumn("target", F.least("_cap", F.col("_level") * F.col("_w")))
    per = per.withColumn("_passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    per = per.withColumn("_rest", F.col("target") - F.col("_passes") * F.col("source_size"))
    return per.withColumn("_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") * F.lit(float(blocks)) / F.col("_total"))).cast("long")).select(
        "_source", "_sk", "_rank", "source_size", "target", "_passes", "_rest", "_blocks"
    )


def block_of() -> Column:
    """The block of a document: an equal share of the range of the hash."""
    return F.least(F.floor(F.col("_h") / F.lit(float(1 << 60)) * F.col("_blocks")), F.col("_blocks") - 1).cast("long")


def split_quotas(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """Deal (_sk, quota) to ``shards`` by the splitting tree: rows (_sk, shard, n), n summing to the quota.

    A draw of L out of a node's slots, all equally likely, is the multivariate hypergeometric draw by definition; the
    slots carry only their source, so what is drawn is the vector of counts. The number of slots is bounded by the
    number of blocks, whatever the size of the data.
    """
    nodes = quotas.where("quota > 0").select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "_sk", F.col("quota").alias("n"), F.sum("quota").over(Window.partitionBy(F.lit(0))).alias("_all"))
    width = shards
    while width > 1:
        mid = F.floor((F.col("lo") + F.col("hi")) / 2)
        room = lambda at: F.floor(at * F.col("_all") / F.lit(shards))
        slots = nodes.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("_slot"))
        drawn = F.row_number().over(Window.partitionBy("lo", "hi").orderBy(md5_long(F.lit(seed), F.col("lo"), F.col("hi"), F.col("_sk"), F.col("_slot")), "_sk", "_slot"))
        slots = slots.withColumn("_left", (drawn <= room(mid) - room(F.col("lo"))) & (F.col("hi") - F.col("lo") > 1)).withColumn("_single", F.col("hi") - F.col("lo") <= 1)
        nodes = (
            slots.select(
                F.when(F.col("_single") | F.col("_left"), F.col("lo")).otherwise(mid).cast("long").alias("_lo"),
                F.when(F.col("_single") | ~F.col("_left"), F.col("hi")).otherwise(mid).cast("long").alias("_hi"),
                "_sk",
                "_all",
            )
            .groupBy(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), "_sk", "_all")
            .agg(F.count("*").alias("n"))
        )
        width = (width + 1) // 2
    return nodes.select("_sk", F.col("lo").cast("int").alias("shard"), "n")


def plan_blocks(sizes: DataFrame, sources: DataFrame, shards: int, seed: str) -> DataFrame:
    """One row a block: the shard of each of its copies; the last, partial pass may stop inside a block, at hash _cut."""
    placed = sizes.join(sources.drop("_source"), "_sk").withColumn("_block", block_of())
    blocks = placed.groupBy("_sk", "_block").agg(F.sum("size").alias("_words"), *(F.first(c).alias(c) for c in ("_rank", "source_size", "target", "_passes", "_rest", "_blocks")))
    permuted = Window.partitionBy("_sk").orderBy(md5_long(F.lit(seed), F.lit("block"), F.col("_sk"), F.col("_block")), "_block")
    blocks = blocks.withColumn("_at", F.row_number().over(permuted) - 1).withColumn("_end", F.sum("_words").over(permuted))
    blocks = blocks.withColumn("_n", F.count("*").over(Window.partitionBy("_sk")))
    whole = (F.col("_rest") > 0) & (F.col("_end") <= F.col("_rest"))
    stops = ~whole & (F.col("_end") - F.col("_words") < F.col("_rest"))
    blocks = stored(blocks.withColumn("_whole", whole).withColumn("_stops", stops), "mix-blocks")

    # Inside the one block of each source where the last pass stops: the hash up to which documents still come nearest.
    # Sums over FINE ranges of the hash find the one range where it lies, and only the documents of that range are ordered.
    stop = blocks.where("_stops").select("_sk", "_block", (F.col("_rest") - F.col("_end") + F.col("_words")).alias("_want"))
    inside = placed.join(F.broadcast(stop), ["_sk", "_block"])
    within = F.col("_h") / F.lit(float(1 << 60)) * F.col("_blocks") - F.col("_block")
    inside = inside.select("_sk", "_h", "size", "_want", F.floor(within * F.lit(float(FINE))).cast("long").alias("_fine"))
    ranges = inside.groupBy("_sk", "_fine").agg(F.sum("size").alias("_w"), F.max("_h").alias("_top"), F.first("_want").alias("_want"))
    ranges = stored(ranges.withColumn("_to", F.sum("_w").over(Window.partitionBy("_sk").orderBy("_fine"))), "mix-ranges")
    before = F.col("_to") - F.col("_w")
    partly = ranges.where((before <= F.col("_want")) & (F.col("_to") > F.col("_want"))).select("_sk", "_fine", before.alias("_before"))
    steps = inside.join(F.broadcast(partly), ["_sk", "_fine"]).groupBy("_sk", "_h").agg(F.sum("size").alias("_w"), F.first("_want").alias("_want"), F.first("_before").alias("_before"))
    steps = steps.withColumn("_upto", F.col("_before") + F.sum("_w").over(Window.partitionBy("_sk").orderBy("_h")))
    nearest = steps.where(F.col("_upto") - F.col("_w") / 2 <= F.col("_want")).select("_sk", "_h")
    cuts = ranges.where("_to <= _want").select("_sk", F.col("_top").alias("_h")).union(nearest).groupBy("_sk").agg(F.max("_h").alias("_cut"))

    blocks = blocks.join(cuts, "_sk", "left").withColumn("_cut", F.when(F.col("_stops"), F.coalesce("_cut", F.lit(-1).cast("long"))))
    blocks = blocks.withColumn("_copies", F.col("_passes") + (F.col("_whole") | F.col("_stops")).cast("int"))
    quotas = blocks.groupBy("_sk").agg(F.sum("_copies").cast("long").alias("quota"))
    dealt = split_quotas(quotas, shards, seed)
    upto = F.sum("n").over(Window.partitionBy("_sk").orderBy("shard"))
    spans = dealt.withColumn("_upto", upto)
    taken = spans.select("_sk", "shard", F.explode(F.sequence(F.col("_upto") - F.col("n"), F.col("_upto") - 1)).alias("_slot"))
    copies = blocks.where("_copies > 0").select("_sk", "_block", "_n", "_at", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("pass"))
    # Slots of a source: pass after pass, blocks in permuted order; the partial pass takes the first blocks of that order.
    copies = copies.withColumn("_slot", F.col("pass") * F.col("_n") + F.col("_at"))
    shards_of = copies.join(taken, ["_sk", "_slot"]).groupBy("_sk", "_block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("_shards"))
    out = blocks.join(shards_of, ["_sk", "_block"], "left")
    return out.select("_sk", "_block", "_blocks", "source_size", "target", "_passes", "_cut", F.coalesce("_shards", F.array().cast("array<struct<pass:int,shard:int>>")).alias("_shards"))


def plan(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, shards: int = 16, blocks: int = 4096, seed: str = "mix-1", broadcast_rows: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """(sources, blocks): the table of targets and the table of block copies, both far smaller than the corpus."""
    sources = broadcast_if(stored(targets(sizes, weights, share, cap, blocks), "mix-sources"), broadcast_rows)
    planned = stored(plan_blocks(sizes, sources, shards, seed), "mix-plan")
    return sources.select("_sk", "_blocks"), broadcast_if(planned.drop("_blocks"), broadcast_rows)


def placed_on(rows: DataFrame, sources: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` with _sk and _h, joined to the copies of their block."""
    return rows.join(sources, "_sk").withColumn("_block", block_of()).join(blocks, ["_sk", "_block"])


def copies_of() -> Column:
    """The copies a document is in: all of its block's, but for the partial pass beyond the cut."""
    return F.filter("_shards", lambda x: (x["pass"] < F.col("_passes")) | F.col("_cut").isNull() | (F.col("_h") <= F.col("_cut")))


def taken(docs: DataFrame, *, seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """A row a document: doc_id, size, source_size, target, taken, and the shards its copies lie in."""
    sizes = stored(sized(docs, seed, id_col, text_col, source_col), "mix-sizes")
    out = placed_on(sizes, *plan(sizes, seed=seed, **options)).withColumn("shards", F.transform(copies_of(), lambda x: x["shard"]))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).cast("long").alias("taken"), "shards")


def mix(docs: DataFrame, *, seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed rows: every column of ``docs``, a row for each copy, plus ``mix_pass``, ``mix_shard`` and ``mix_order``
    (the order inside the shard, by which ``in_shards`` writes). Where ``docs`` has such a name, ours gets a trailing ``_``."""
    sizes = stored(sized(docs, seed, id_col, text_col, source_col), "mix-sizes")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    rows = sized(docs.select(row, *(F.col(c).alias(n) for n, c in (("_id", id_col), ("_t", text_col), ("_s", source_col)))), seed, "_id", "_t", "_s", "_row")
    rows = placed_on(rows, *plan(sizes, seed=seed, **options)).select("_row", "doc_id", "_h", F.explode(copies_of()).alias("_copy"))
    order = md5_long(F.lit(seed), F.lit("order"), F.col("_copy.shard"), F.col("_copy.pass"), F.col("doc_id"), F.col("_h"))
    name = lambda n: name(f"{n}_") if n in docs.columns else n
    return rows.select("_row.*", F.col("_copy.pass").alias(name("mix_pass")), F.col("_copy.shard").alias(name("mix_shard")), order.alias(name("mix_order")))


def in_shards(mixed: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """The ``columns`` of mixed rows, shard behind shard and shuffled inside each: what is written has this order. A shard
    of more rows than one of ``parts`` partitions holds goes over several, each a run of its order."""
    shard, order = mixed.columns[-2:]
    return mixed.repartitionByRange(parts, shard, order).sortWithinPartitions(shard, order).select(*columns)
