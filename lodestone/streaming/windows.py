"""Event-time windows, an extension beyond polling ingestion: the same functions work on tables and on streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def with_watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withWatermark(ts, delay) if df.isStreaming else df


def windowed(df: DataFrame, ts: str, size: str, keys: list[str], aggs: list[Column], *, slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Tumbling, or with ``slide`` sliding windows: start, end, keys, aggregates."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return with_watermark(df, ts, delay).groupBy(w.alias("_w"), *keys).agg(*aggs).select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *keys, *[c for c in _names(df, aggs)])


def _names(df: DataFrame, aggs: list[Column]) -> list[str]:
    return df.limit(0).groupBy().agg(*aggs).columns if not df.isStreaming else df.sparkSession.createDataFrame([], df.schema).groupBy().agg(*aggs).columns


def sessions(df: DataFrame, ts: str, gap: str, keys: list[str], aggs: list[Column], *, delay: str = "10 minutes") -> DataFrame:
    return with_watermark(df, ts, delay).groupBy(F.session_window(ts, gap).alias("_w"), *keys).agg(*aggs).select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *keys, *[c for c in _names(df, aggs)])


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Count and sum of each key so far, by state that outlives batches: rows (key, n, total)."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for pdf in batches:
            n, total = n + len(pdf), total + float(pdf[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    kind = dict(stream.dtypes)[key]
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)
