"""SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most two bits differ in at most two bytes,
so they share at least six positional bytes: that is the guaranteed minimum of matches. The index posts a fingerprint
under each choice of six positions with their bytes (28 postings), so the pairs that meet in a posting are exactly the
pairs whose tally of shared positional bytes reaches six, and no pair with a lower tally is ever formed. A posting holds
distinct fingerprints that agree but for two bytes, at most 65,536 of them, whatever the number of documents; within it
the two free bytes are verified (at most two differing bits) by bit-flip lookups in a table, and only a spanning
forest of the verified links is emitted, not the pairs.

Exact copies, and all documents with equal fingerprints, are one fingerprint in the index.

Defined cases: null or empty text, or text of white space only, has fingerprint zero and is linked like any other; fewer
than three words hash as one sequence; long texts are hashed whole; repeated rows have equal results; rows with a null id
take part, but a null is never a component's id unless its rows have no other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, byte_texts, in_arrow, join_hot, map_arrow, stored
from .components import components

SEED, SHINGLE, MAX_BITS = 42, 3, 2
_PIECE = 1 << 16
_FREE = [(p, q) for p, q in combinations(range(8), 2)]
_FEW = 128
_ONES = np.array([k.bit_count() for k in range(1 << 16)], np.uint8)
_FLIPS = np.array([0, *(1 << i for i in range(16)), *((1 << i) | (1 << j) for i, j in combinations(range(16), 2))], np.int64)


def fingerprint(text: bytes) -> int:
    """The fingerprint, as a signed 64-bit number, of a UTF-8 text."""
    w = text.lower().split()  # of bytes: A-Z only, and the six ASCII spaces only
    if not w:
        return 0
    shingles = map(b" ".join, zip(w, w[1:], w[2:], strict=False)) if len(w) >= SHINGLE else [b" ".join(w)]
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(s, SEED) for s in shingles), np.uint64, max(1, len(w) - SHINGLE + 1)))


def majority(h: np.ndarray) -> int:
    """The fingerprint of shingles' hashes: bits set in over half of them. Of none it is zero."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), _PIECE):
        ones += np.unpackbits(h[k : k + _PIECE].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def each(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "fp": [fingerprint(t) for t in byte_texts(batch.column(1))]}

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    return map_arrow(rows, f"doc_id {dict(docs.dtypes)[id_col]}, fp long", each)


def _forest(values: np.ndarray, p: int, q: int) -> np.ndarray:
    """For each of the fingerprints, equal but for bytes p and q, the place of its component's first in the posting."""
    free = ((values >> np.uint64(8 * p)) & np.uint64(255)).astype(np.int64) | (((values >> np.uint64(8 * q)) & np.uint64(255)).astype(np.int64) << 8)
    label = np.arange(len(values))
    if len(values) == 2:
        return label if bin(int(free[0] ^ free[1])).count("1") > MAX_BITS else np.zeros(2, np.int64)
    if len(values) <= _FEW:  # compare all, as a table of 65,536 cells costs more
        near = _ONES[free[:, None] ^ free] <= MAX_BITS
        while True:
            best = np.where(near, label, len(values)).min(axis=1)
            best = best[best]
            if np.array_equal(best, label):
                return label
            label = best
    none = len(values)
    while True:
        at = np.full(1 << 16, none, np.int64)
        at[free] = label
        best = label.copy()
        for flip in _FLIPS:
            np.minimum(best, at[free ^ flip], out=best)
        best = best[best]
        if np.array_equal(best, label):
            return label
        label = best


def postings(prints: DataFrame, named: str = "fp", max_bits: int = MAX_BITS) -> DataFrame:
    """Rows (named, free, shared): each fingerprint ``fp`` under every choice of 8 - ``max_bits`` positions with their bytes.
    Those of two fingerprints meet exactly if their tally of shared positional bytes is 8 - ``max_bits`` or more, as it is
    for all that differ in at most ``max_bits`` bits. ``free`` counts the choices of the other positions in order."""
    masks = [((1 << 64) - 1) ^ sum(255 << 8 * p for p in free) for free in combinations(range(8), max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return prints.select(named, F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed))).alias("free", "shared"))


def links(prints: DataFrame) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints which links of at most two bits connect."""
    parts = max(8, int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = postings(prints.select("fp").repartition(parts, "fp")).groupBy("free", "shared").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("free", "fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for free, fps in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fps = np.sort(np.array(fps, np.int64))
                first = _forest(fps.view(np.uint64), *_FREE[free])
                moved = np.flatnonzero(first != np.arange(len(fps)))
                u += fps[moved].tolist()
                v += fps[first[moved]].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return in_arrow(met, run, "u long, v long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows doc_id, fp (long), component_id: the smallest doc_id reachable over links of at most two differing bits."""
    fps = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    prints = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(links(prints))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("_n"))
    # Only fingerprints in components of two or more need the second join; for the others the id is their own least.
    linked = rooted.join(least.where("_n > 1"), "root").select("fp", "component_id")
    ids = prints.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    # Exact copies, and documents without words, share a fingerprint: their rows are dealt by id.
    return join_hot(fps, ids, "fp", F.col("doc_id")).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", broadcast_ids: int = 5_000_000) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id, one row of it. Rows without an id stay."""
    return keep_least(docs, near_duplicates(docs, id_col=id_col, text_col=text_col), id_col=id_col, broadcast_ids=broadcast_ids)


def keep_least(docs: DataFrame, found: DataFrame, *, id_col: str = "doc_id", broadcast_ids: int = 5_000_000) -> DataFrame:
    """``docs`` with one row of each component in ``found`` (doc_id, component_id). Rows without an id stay."""
    found = stored(found, "near-duplicates")
    gone = stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    twice = stored(found.where("doc_id is not null and doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    few = bounded(gone, broadcast_ids)
    out = docs.join(F.broadcast(gone) if few else gone, docs[id_col] == gone["doc_id"], "left_anti")
    if not twice.isEmpty():
        again = F.broadcast(twice) if bounded(twice, broadcast_ids) else twice
        rest = out.join(again, out[id_col] == again["doc_id"], "left_anti")
        out = rest.unionByName(out.join(again, out[id_col] == again["doc_id"], "left_semi").dropDuplicates([id_col]))
    return out
