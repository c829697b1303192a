"""Documents without their periodic runs of words: a run keeps its first period.

Defined cases: a null text has no words and no runs; an empty one, or one of white space only, likewise; long texts are
worked on whole, in memory that grows with their words times the logarithm of their longest repeated stretch; repeated
rows have equal results; a null id is an id like any other; an empty table gives an empty result; columns beside the two
named are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, byte_texts, map_arrow
from .tandem import LEAST, runs_of_texts


def _without(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but for those that a run has after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    over = np.zeros(len(words) + 1, np.int64)
    np.add.at(over, runs[:, 0] + runs[:, 2], 1)
    np.add.at(over, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(over[:-1]) == 0).tolist()])


def collapse(docs: DataFrame, *, id_col: str = "doc_id", text_col: Column | str = "text", least: int = LEAST) -> DataFrame:
    """Rows doc_id, runs (start, length, period in words; by start, then period), text: the words that stay, joined by one
    space. A run has ``least`` words or more and is two periods long at least."""
    columns = "array<struct<start: long, length: long, period: long>>"

    def each(batch: pa.RecordBatch) -> dict:
        texts = [t.split() for t in byte_texts(batch.column(1))]  # of bytes: at the six ASCII spaces only
        found = runs_of_texts(texts, least)
        flat = np.concatenate([*found, np.zeros((0, 3), np.int64)])
        struct = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], ["start", "length", "period"])
        ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        kept = pa.array([_without(w, r) for w, r in zip(texts, found, strict=True)], pa.binary())
        return {"doc_id": batch.column(0), "runs": pa.ListArray.from_arrays(ends, struct), "text": kept.cast(pa.string())}

    text = F.col(text_col) if isinstance(text_col, str) else text_col
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    return map_arrow(rows, f"doc_id {dict(docs.dtypes)[id_col]}, runs {columns}, text string", each)


def planted(doc_id: Column, text: Column) -> Column:
    """The text with a stretch made periodic, for a tenth of the ids: with h the crc32 of the id's digits, h % 10 = 0 and n
    words, each word from a = (h // 10) % n on is the word a + (i - a) % p, where p = 1 + (n - a) // (3 + (h // 10) % 8).
    Those words are joined by one space; other texts, and those of a null id, stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, words = F.floor(h / 10), F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    parts = F.struct(words.alias("w"), a.alias("a"), p.alias("p"), n.alias("n"))
    again = lambda x: F.concat(
        F.slice(x["w"], F.lit(1), x["a"].cast("int")),
        F.transform(F.sequence(F.lit(0).cast("long"), x["n"] - x["a"] - 1), lambda k: F.get(x["w"], (x["a"] + k % x["p"]).cast("int"))),
    )
    # A transform over one element holds the parts, so that they are worked out once.
    changed = F.element_at(F.transform(F.array(parts), lambda x: F.array_join(again(x), " ")), 1)
    return F.when((h % 10 == 0) & text.rlike(WORD), changed).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """Of ``collapse``: number of runs, the longest one (ties: smallest start, then period) and digests of runs and text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("back"), (-r["period"]).alias("less"), r.alias("run"))))["run"]
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("collapsed_sha256"),
    )
