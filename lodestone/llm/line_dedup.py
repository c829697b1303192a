"""Line dedup by site-relative frequency.

For each host (or source), the share of its pages that contain a line decides: above ``ratio`` the line is boilerplate
of that host and goes from all its pages, if at least ``min_holding`` of them have it. Exact copies of a page count as one
page, else a page copied often enough would lose all its text. The rule is the same for hosts of every size. The set of
boilerplate lines is small by construction: a host has at most (lines of its average page) / ``ratio`` of them. Lines are
told apart by 64-bit hashes, of which only those of one host ever meet.

Defined cases: null text stays null; a line without a word (nothing but the six ASCII spaces) is never boilerplate; a
null host is a host of its own; repeated rows are treated alike; very long texts are cut whole; an empty table gives an
empty table; other columns pass through, and ``n_lines`` and ``n_dropped`` get a trailing ``_`` where the table has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, join_hot, key, stored

RATIO, MIN_HOLDING = 0.01, 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host: Column, text_col: str = "text", *, ratio: float = RATIO, min_holding: int = MIN_HOLDING) -> DataFrame:
    """Rows (_host, _line): hashes of the lines on more than ``ratio`` of the host's different pages."""
    pages = docs.select(key(host).alias("_host"), F.xxhash64(text_col).alias("_page"), F.col(text_col).alias("_text")).where("_text is not null")
    totals = pages.select("_host", "_page").distinct().groupBy("_host").agg(F.count("*").alias("_pages"))
    hashed = F.array_distinct(F.transform(F.filter(_lines(F.col("_text")), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.xxhash64(x)))
    lines = pages.select("_host", "_page", F.explode(hashed).alias("_line")).distinct().groupBy("_host", "_line").agg(F.count("*").alias("_n"))
    return lines.where(F.col("_n") >= min_holding).join(totals, "_host").where(F.col("_n") > F.col("_pages") * F.lit(float(ratio))).select("_host", "_line")


def dedup_lines(docs: DataFrame, host: Column, text_col: str = "text", *, ratio: float = RATIO, min_holding: int = MIN_HOLDING, broadcast_lines: int = 1_000_000) -> DataFrame:
    """``docs`` with boilerplate lines cut from the text, plus ``n_lines`` and ``n_dropped`` (a trailing ``_`` on a clash)."""
    found = stored(boilerplate(docs, host, text_col, ratio=ratio, min_holding=min_holding), "boilerplate")
    sets = found.groupBy("_host").agg(F.collect_set("_line").alias("_lines"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    rows = docs.select(row, F.col(text_col).alias("_text"), key(host).alias("_host"))
    few = bounded(found, broadcast_lines)
    rows = rows.join(F.broadcast(sets), "_host", "left") if few else join_hot(rows, sets, "_host", F.col("_text"), "left")
    kept = F.filter(_lines(F.col("_text")), lambda x: ~F.array_contains("_lines", F.xxhash64(x)))
    rows = rows.withColumn("_kept", F.when(F.col("_lines").isNotNull() & F.col("_text").isNotNull(), kept))
    total = F.when(F.col("_text").isNull(), 0).otherwise(F.size(_lines(F.col("_text"))))
    name = lambda n: name(f"{n}_") if n in docs.columns else n
    same = [F.coalesce(F.array_join("_kept", "\n"), F.col("_text")).alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns]
    return rows.select(*same, total.alias(name("n_lines")), F.when(F.col("_kept").isNull(), 0).otherwise(total - F.size("_kept")).alias(name("n_dropped")))
