"""Retrieval metrics over relevance tables and runs, and their averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def set_metrics(retrieved: Column, relevant: Column) -> dict[str, Column]:
    """precision, recall, f1, hit_rate and mrr of a ranked array of ids against a set."""
    hits = F.size(F.array_intersect(retrieved, relevant)).cast("double")
    p, r = F.coalesce(F.try_divide(hits, F.size(F.array_distinct(retrieved))), F.lit(0.0)), F.coalesce(F.try_divide(hits, F.size(F.array_distinct(relevant))), F.lit(0.0))
    first = F.array_min(F.filter(F.transform(retrieved, lambda x, i: F.when(F.array_contains(relevant, x), i + 1)), lambda i: i.isNotNull()))
    return {
        "precision": p,
        "recall": r,
        "f1": F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)),
        "hit_rate": (hits > 0).cast("double"),
        "mrr": F.coalesce(1.0 / first, F.lit(0.0)),
    }


def run_metrics(run: DataFrame, relevant: DataFrame, depth: int = 10) -> DataFrame:
    """set_metrics by query of the first ``depth`` of a run (query, chunk_id, score) against (query, chunk_id), however many
    are relevant: joins and counts, nothing is gathered."""
    top = ranked_run(run, depth)
    truth = relevant.select("query", "chunk_id").distinct()
    got = top.join(truth.withColumn("_rel", F.lit(1)), ["query", "chunk_id"], "left").groupBy("query").agg(F.count("*").alias("_got"), F.count("_rel").cast("double").alias("_hits"), F.min(F.when(F.col("_rel").isNotNull(), F.col("rank"))).alias("_first"))
    both = got.join(truth.groupBy("query").agg(F.count("*").alias("_all")), "query", "left")
    p, r = F.col("_hits") / F.col("_got"), F.coalesce(F.col("_hits") / F.col("_all"), F.lit(0.0))
    return both.select("query", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), (F.col("_hits") > 0).cast("double").alias("hit_rate"), F.coalesce(1.0 / F.col("_first"), F.lit(0.0)).alias("mrr"))


def averages(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Rows (metric, mean)."""
    means = df.agg(*(F.avg(m).alias(m) for m in metrics))
    return means.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("mean")) for m in metrics))).alias("x")).select("x.*")


def ranked_run(run: DataFrame, depth: int) -> DataFrame:
    """The first ``depth`` of each query: (query, chunk_id, rank)."""
    w = Window.partitionBy("query").orderBy(F.desc("score"), "chunk_id")
    return run.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= depth).select("query", "chunk_id", "rank")


def rank_metrics(run: DataFrame, qrels: DataFrame, ndcg_at: int = 10, map_at: int = 5, mrr_at: int = 10) -> DataFrame:
    """By query: nDCG, average precision and reciprocal rank at their depths."""
    depth = max(ndcg_at, map_at, mrr_at)
    hits = ranked_run(run, depth).join(qrels, ["query", "chunk_id"], "left").withColumn("rel", F.coalesce("rel", F.lit(0)))
    seen = F.sum((F.col("rel") > 0).cast("int")).over(Window.partitionBy("query").orderBy("rank"))
    hits = hits.withColumn("_seen", seen)
    gain = lambda rel, rank: rel / F.log2(rank + 1)
    got = hits.groupBy("query").agg(
        F.sum(F.when(F.col("rank") <= ndcg_at, gain(F.col("rel"), F.col("rank"))).otherwise(0.0)).alias("_dcg"),
        F.sum(F.when((F.col("rank") <= map_at) & (F.col("rel") > 0), F.col("_seen") / F.col("rank")).otherwise(0.0)).alias("_ap"),
        F.min(F.when((F.col("rank") <= mrr_at) & (F.col("rel") > 0), F.col("rank"))).alias("_first"),
    )
    w = Window.partitionBy("query").orderBy(F.desc("rel"), "chunk_id")
    ideal = qrels.where("rel > 0").withColumn("_r", F.row_number().over(w)).groupBy("query").agg(F.sum(F.when(F.col("_r") <= ndcg_at, gain(F.col("rel"), F.col("_r"))).otherwise(0.0)).alias("_ideal"), F.count("*").alias("_relevant"))
    both = ideal.join(got, "query", "left")
    zero = F.lit(0.0)
    return both.select("query", F.coalesce(F.try_divide("_dcg", "_ideal"), zero).alias("ndcg"), F.coalesce(F.col("_ap") / F.col("_relevant"), zero).alias("ap"), F.coalesce(1.0 / F.col("_first"), zero).alias("rr"))


def passages(msmarco: DataFrame) -> DataFrame:
    """MS MARCO rows with nested passages as (query, chunk_id, text, rel)."""
    pairs = msmarco.select("query", F.posexplode(F.arrays_zip(F.col("passages.is_selected").alias("sel"), F.col("passages.passage_text").alias("text"))).alias("i", "p"))
    return pairs.select("query", F.md5(F.concat_ws("|", "query", "i")).alias("chunk_id"), F.col("p.text").alias("text"), F.col("p.sel").alias("rel"))
