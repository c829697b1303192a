"""Conversational memory: recency, budgets, nesting, sizes, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import nest, recent, within_budget
from .search import bm25_columns, fuse, literal_vector
from ..functions.values import cosine

#: Kinds of memory as bits.
RAW, SEMANTIC, EPISODIC, PROCEDURAL = 1, 2, 4, 8


def has_kind(c: Column, kind: int) -> Column:
    return c.bitwiseAND(F.lit(kind)) == kind


def recent_messages(messages: DataFrame, memory: str, valid_at: str, n: int, tie: str) -> DataFrame:
    return recent(messages, memory, [F.desc(valid_at), F.desc(tie)], n)


def to_forget(messages: DataFrame, memory: str, size: str, budget: float, valid_at: str, tie: str, forget_at: str | None = None) -> DataFrame:
    """First in, first out until ``budget`` bytes are freed: those with a forget time first, by it, then by age."""
    order = ([F.asc_nulls_last(forget_at)] if forget_at else []) + [F.col(valid_at), F.col(tie)]
    return within_budget(messages, [memory], order, size, budget)


def sizes(messages: DataFrame, memory: str, content: str) -> DataFrame:
    return messages.groupBy(memory).agg(F.coalesce(F.sum(F.octet_length(content)), F.lit(0)).alias("bytes"))


def next_message_id(messages: DataFrame, memory: str, message_id: str) -> DataFrame:
    return messages.groupBy(memory).agg(F.coalesce(F.max(message_id), F.lit(1)).alias("max_id"))


def with_extracted(messages: DataFrame, kind: str, message_id: str, source_id: str, columns: list[str]) -> DataFrame:
    """Raw messages with what was extracted from them."""
    raw = messages.where(F.col(kind) == "raw")
    derived = messages.where(F.col(kind) != "raw")
    return nest(raw, derived, message_id, source_id, columns, "extracted")


def search(messages: DataFrame, id_col: str, text: str, vec: str, words: list[str], query: list[float], *, vector_weight: float = 0.3, threshold: float = 0.2, top: int = 10) -> DataFrame:
    """Messages that the text match lets through, by the weighted sum of scaled text score and cosine."""
    wanted = dict.fromkeys((t for q in words for t in q.lower().split()), 1.0)
    hits = bm25_columns(messages, {text: F.col(text)}, wanted).where("matched > 0").drop("matched").withColumn("cosine", cosine(F.col(vec), literal_vector(query))).where(F.col("cosine") >= threshold)
    return fuse(hits, "text_score", "cosine", (1 - vector_weight, vector_weight), "atan").orderBy(F.desc("score"), id_col).limit(top)


def history(turns: DataFrame, conversation: str, turn: str, window: int) -> DataFrame:
    """The last ``window`` exchanges (two rows each)."""
    return recent(turns, conversation, [F.desc(turn)], 2 * window)
