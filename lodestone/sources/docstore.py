"""The read operator: a search request over stored chunks compiled to one DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import condition
from ..operators.relational import gathered, order_by, terms_agg
from ..operators.search import bm25_columns, fuse, least_matches, literal_vector, rank_features, ranked
from ..functions.text import highlight
from ..functions.values import cosine


@dataclass
class Search:
    """select, condition, text and dense matches with fusion, order, paging, aggregates, highlight and rank features."""

    select: list[str] = field(default_factory=list)
    where: dict[str, Any] = field(default_factory=dict)
    text: tuple[str | list[str] | dict[str, float], list[str]] | None = None  # (column, columns or boosts by column; words)
    min_match: float = 0.0
    dense: tuple[str, list[float], int, float] | None = None  # (column, vector, top, threshold)
    weights: tuple[float, float] = (0.05, 0.95)
    fusion: str = "raw"
    order: list[tuple[str, bool]] = field(default_factory=list)
    offset: int = 0
    limit: int | None = None
    aggs: list[str] = field(default_factory=list)
    highlight: str | None = None
    tags: dict[str, float] = field(default_factory=dict)


class DocStore:
    """Chunks partitioned by dataset under a path; a request names datasets, and the scan prunes to them."""

    def __init__(self, spark: SparkSession, path: str | None = None, chunks: DataFrame | None = None, id_col: str = "id") -> None:
        self.spark, self.path, self.id = spark, path, id_col
        self._chunks = chunks

    def chunks(self, kb_ids: list[str] | None = None) -> DataFrame:
        df = self._chunks if self._chunks is not None else self.spark.read.option("mergeSchema", "true").parquet(self.path)
        return df.where(F.col("kb_id").isin(kb_ids)) if kb_ids else df

    def get(self, id_value: Any, kb_ids: list[str] | None = None) -> DataFrame:
        return self.chunks(kb_ids).where(F.col(self.id) == id_value).limit(1)

    def scan_after(self, last: Any, size: int, kb_ids: list[str] | None = None) -> DataFrame:
        """The next ``size`` rows by id after ``last``: a keyset page for deep scans."""
        df = self.chunks(kb_ids)
        return (df if last is None else df.where(F.col(self.id) > last)).orderBy(self.id).limit(size)

    def candidates(self, s: Search, kb_ids: list[str] | None = None) -> DataFrame:
        """The rows that condition, text and vector let through, scored; boosts by tags and pagerank are part of the score
        before the top is taken."""
        df = self.chunks(kb_ids)
        df = df.where(condition(df, s.where))
        if s.text:
            columns, words = s.text
            names = [columns] if isinstance(columns, str) else list(columns)
            wanted = dict.fromkeys((t for q in words for t in q.lower().split()), 1.0)
            df = bm25_columns(df, {n: F.col(n) for n in names}, wanted, None, columns if isinstance(columns, dict) else None)
            df = df.where(F.col("matched") >= least_matches(len(wanted), s.min_match)).drop("matched").withColumnRenamed("text_score", "score")
        if s.dense:
            column, vector, top, threshold = s.dense
            df = df.withColumn("_dense", cosine(F.col(column), literal_vector(vector))).where(F.col("_dense") >= threshold)
            df = fuse(df, "score", "_dense", s.weights, s.fusion) if s.text else df.withColumn("score", F.col("_dense"))
            df = self._boosted(df, s).drop("_dense")
            return df.orderBy(F.desc("score"), self.id).limit(top)
        return self._boosted(df, s)

    def _boosted(self, df: DataFrame, s: Search) -> DataFrame:
        if not s.tags or "score" not in df.columns:
            return df
        tags = F.col("tag_feas") if "tag_feas" in df.columns else F.create_map().cast("map<string,double>")
        return rank_features(df, "score", s.tags, tags, F.col("pagerank_fea") if "pagerank_fea" in df.columns else F.lit(0.0))

    def search(self, s: Search, kb_ids: list[str] | None = None) -> DataFrame:
        df = self.candidates(s, kb_ids)
        if s.highlight:
            df = df.withColumn("highlight", highlight(F.col(s.highlight), s.text[1] if s.text else []))
        if s.order:
            df = order_by(df, s.order, self.id)
        elif "score" in df.columns:
            df = df.orderBy(F.desc("score"), self.id)
        if s.offset:
            df = df.offset(s.offset)
        if s.limit is not None:
            df = df.limit(s.limit)
        keep = [*s.select, *[c for c in ("score", "highlight") if c in df.columns]] if s.select else df.columns
        return df.select(*keep)

    def total(self, s: Search, kb_ids: list[str] | None = None) -> int:
        return self.candidates(s, kb_ids).count()

    def aggregate(self, s: Search, kb_ids: list[str] | None = None) -> dict[str, DataFrame]:
        df = self.candidates(s, kb_ids)
        return {f: terms_agg(df, f) for f in s.aggs}


def scattered(stores: list[DocStore], s: Search, top: int) -> DataFrame:
    """The same request to several tables, gathered, ranked over all, with pagerank added."""
    both = gathered([st.candidates(s) for st in stores])
    both = both.withColumn("score", F.col("score") + F.coalesce("pagerank_fea", F.lit(0.0))) if "pagerank_fea" in both.columns else both
    return ranked(both.orderBy(F.desc("score"), stores[0].id).limit(top), "score", stores[0].id)
