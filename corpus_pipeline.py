"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, encoding; each stage works on what the last one kept.

Counted as part of ``lodestone.llm``. A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import line_dedup, mix, near_copies, quality, sentencepieces
from lodestone.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the trusted target is the documents labelled as good."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a source repeats go; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs, F.col("source")).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word similarity of 0.8 or more, by SimHash over positional bytes
    and set minima beyond its bits, verified on exact sets."""
    return near_copies.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: a document is there once, twice or not at all. Written shard behind shard, each
    shuffled; null sources are one source, documents without words and tied hashes go by the plan's rule."""
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return mix.in_shards(mix.mix(docs), docs.columns, parts)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every copy of a document, checked against SentencePiece and decoded again."""
    return sentencepieces.tokenize(docs, keep_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", lines),
    ("near-dedup", near_duplicates),
    ("mixing sources", mixture),
    ("SentencePiece encoding", encoding),
]

#: SQL has neither the hashed n-gram scores nor the tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k}")
    return docs
