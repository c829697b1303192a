"""Quality rules: base counts, then a hashed n-gram log-likelihood ratio of target against raw corpus.

Words and adjacent word pairs are hashed to ``BUCKETS`` buckets. Two multinomials over the buckets are counted: one over
the trusted target documents, one over all documents; both counts cover every document. A document's score is the sum of
log(target / raw) over its n-grams divided by their number, and it is kept when the base rules pass and the score is at
least the threshold.

The threshold is taken from the run's own trusted documents, as scores shrink towards 0 with the size of the corpus: each
of them that passes the base rules is scored with its own n-grams taken out of the target, and ``MARGIN`` below the
``LEAST`` quantile of these scores (counted over all of them, to a thousandth) is the line. So about one in 200 documents
like the trusted ones may come near it, and none is below by chance alone.

Defined cases: null or empty text has no words, fails the base rules and scores 0; very long texts are scored whole;
repeated rows score alike; no trusted document at all gives every document the score 0, and all that pass the base rules
are kept; an empty table gives an empty result; malformed UTF-8 is read as bytes; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if, byte_texts, in_arrow, map_arrow, sliced

BUCKETS = 1 << 17
LEAST, MARGIN = 0.005, 0.05
_BIN = 1000
SYMBOLS = b"#*$%&|<>"
_SPACE = bytes(range(9, 14)) + b" "
_CACHE_WORDS = 100_000


class Vocabulary:
    """Word numbers and hashes of one batch or task; forgets everything beyond a bound on its size."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.hashes: list[int] = []

    def numbered(self, words: list[bytes]) -> np.ndarray:
        ids = self.ids
        try:
            return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        except KeyError:
            for w in words:
                if w not in ids:
                    ids[w] = len(ids)
                    self.hashes.append(zlib.crc32(w))
            return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))


def numbered(texts: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All words of the batch as numbers, and the count of each text; equal words have equal numbers."""
    if len(vocabulary.ids) > _CACHE_WORDS:
        vocabulary.__init__()
    split = [t.split() for t in texts]  # bytes split at exactly the six ASCII spaces
    counts = np.fromiter(map(len, split), np.int64, len(split))
    return vocabulary.numbered([w for words in split for w in words]), counts


def buckets_of(numbers: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every n-gram (words, then pairs) of the batch."""
    h = np.array(vocabulary.hashes, np.uint64)[numbers] if len(numbers) else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(counts)), counts)
    pair = doc[1:] == doc[:-1]
    two = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))[pair] >> np.uint64(40)
    one = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return (np.concatenate([one, two]) % np.uint64(buckets)).astype(np.int64), np.concatenate([doc, doc[1:][pair]])


def repeated_words(numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: words inside a three-word window that the text has twice or more."""
    out = np.zeros(len(counts), np.int64)
    if len(numbers) < 4:
        return out
    doc = np.repeat(np.arange(len(counts)), counts)
    inside = np.flatnonzero(doc[2:] == doc[:-2])
    if not len(inside):
        return out
    small = np.unique(numbers, return_inverse=True)[1].astype(np.int64)
    wide = int(small.max()) + 1
    pairs = np.unique(small[inside] * wide + small[inside + 1], return_inverse=True)[1].astype(np.int64)
    three = np.unique(pairs * wide + small[inside + 2], return_inverse=True)[1].astype(np.int64)
    of = doc[inside]
    order = np.lexsort((three, of))
    t, d = three[order], of[order]
    same = (t[1:] == t[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(numbers), bool)
    at = inside[order[twice]]
    for k in range(3):
        hit[at + k] = True
    np.add.at(out, doc[hit], 1)
    return out


def base_counts(text: bytes) -> tuple[int, int, int]:
    """(word_chars, n_symbols, n_dup_lines) of a UTF-8 text."""
    solid = text.translate(None, _SPACE)
    chars = len(solid) if solid.isascii() else len(solid.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    return chars, symbols, len(lines) - len(set(lines))


def ngram_counts(docs: DataFrame, text_col: str = "text", trusted_col: str = "_trusted") -> DataFrame:
    """Rows (bucket, raw, target): counts over every document, and over those with ``trusted_col``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, vocabulary = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), Vocabulary()
        for batch in (b for whole in batches for b in sliced(whole)):
            bucket, doc = buckets_of(*numbered(byte_texts(batch.column(0)), vocabulary), vocabulary)
            raw += np.bincount(bucket, minlength=BUCKETS)
            good = np.array(batch.column(1).to_pylist(), bool)
            target += np.bincount(bucket[good[doc]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    parts = in_arrow(docs.select(text_col, F.coalesce(F.col(trusted_col), F.lit(False)).alias("_t")), run, "bucket int, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


class Model(NamedTuple):
    """What documents are judged by."""

    raw: np.ndarray  # counts a bucket, add-one smoothed
    target: np.ndarray
    threshold: float

    @property
    def ratios(self) -> np.ndarray:
        """log(target / raw) a bucket; 0 where there is no target."""
        if self.target.sum() == len(self.target):
            return np.zeros(len(self.target))
        return np.log(self.target / self.target.sum()) - np.log(self.raw / self.raw.sum())


def counted(counts: DataFrame) -> Model:
    """The counts as arrays; at most BUCKETS rows come to the driver."""
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for bucket, r, t in counts.collect():
        raw[bucket] += r
        target[bucket] += t
    return Model(raw, target, -MARGIN)


def left_out(texts: list[bytes], model: Model, vocabulary: Vocabulary) -> np.ndarray:
    """Scores of trusted texts against the target without them; NaN where the base rules fail."""
    numbers, counts = numbered(texts, vocabulary)
    bucket, doc = buckets_of(numbers, counts, vocabulary)
    n = np.bincount(doc, minlength=len(texts))
    _, where, own = np.unique(doc * BUCKETS + bucket, return_inverse=True, return_counts=True)
    target = np.log((model.target[bucket] - own[where]) / (model.target.sum() - n)[doc])
    weights = target - np.log(model.raw / model.raw.sum())[bucket]
    out = np.bincount(doc, weights=weights, minlength=len(texts)) / np.maximum(n, 1)
    out[(counts < 50) | (100 * repeated_words(numbers, counts) > 50 * counts)] = np.nan
    return out


def threshold_of(docs: DataFrame, model: Model, text_col: str = "text", trusted_col: str = "_trusted", least: float = LEAST, margin: float = MARGIN) -> float:
    """``margin`` under the ``least`` quantile of the trusted documents' left-out scores, by a histogram of thousandths."""
    shared, vocabulary = docs.sparkSession.sparkContext.broadcast(model), Vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for whole in batches for b in sliced(whole)):
            scores = left_out(byte_texts(batch.column(0)), shared.value, vocabulary)
            bins, n = np.unique(np.floor(scores[~np.isnan(scores)] * _BIN).astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(n)], names=["bin", "n"])

    bins = in_arrow(docs.where(F.col(trusted_col)).select(text_col), run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    total, seen = sum(r["n"] for r in bins), 0
    for r in sorted(bins):
        seen += r["n"]
        if seen > least * total:
            return r["bin"] / _BIN - margin
    return -margin


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean"


def verdicts(texts: list[bytes], ratios: np.ndarray, vocabulary: Vocabulary, threshold: float) -> dict[str, np.ndarray | list]:
    """The columns of SCHEMA for a batch of texts."""
    numbers, counts = numbered(texts, vocabulary)
    bucket, doc = buckets_of(numbers, counts, vocabulary)
    n = np.bincount(doc, minlength=len(texts))
    llr = np.round(np.bincount(doc, weights=ratios[bucket], minlength=len(texts)) / np.maximum(n, 1), 9)
    repeats = repeated_words(numbers, counts)
    failed = (counts < 50) | (100 * repeats > 50 * counts)
    base = [base_counts(t) for t in texts]
    return {
        "n_words": counts, "word_chars": [b[0] for b in base], "n_symbols": [b[1] for b in base], "n_dup_lines": [b[2] for b in base],
        "n_repeat_words": repeats, "base_failed": failed, "llr": llr, "kept": ~failed & (llr >= threshold),
    }


def judged(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    shared, vocabulary = docs.sparkSession.sparkContext.broadcast((model.ratios, model.threshold)), Vocabulary()

    def each(batch: pa.RecordBatch) -> dict:
        ratios, threshold = shared.value
        return {"doc_id": batch.column(0)} | verdicts(byte_texts(batch.column(1)), ratios, vocabulary, threshold)

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), f"doc_id {dict(docs.dtypes)[id_col]}, {SCHEMA}", each)


def passing(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are kept; no join is needed to drop the others."""
    shared = docs.sparkSession.sparkContext.broadcast((model.ratios, model.threshold))
    at, vocabulary = docs.columns.index(text_col), Vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios, threshold = shared.value
        for batch in (b for whole in batches for b in sliced(whole)):
            yield batch.filter(pa.array(verdicts(byte_texts(batch.column(at)), ratios, vocabulary, threshold)["kept"]))

    return in_arrow(docs, run, docs.schema)


def trust(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", broadcast_ids: int = 2_000_000) -> DataFrame:
    """``docs`` with _trusted: labelled as of good quality, and not as toxic."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").alias("_good")).where("_good is not null").distinct().withColumn("_trusted", F.lit(True))
    return docs.join(broadcast_if(good, broadcast_ids), docs[id_col] == F.col("_good"), "left").drop("_good")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Counts over every document, then the threshold over every trusted one."""
    trusted = trust(docs.select(id_col, text_col), labels, id_col)
    model = counted(ngram_counts(trusted, text_col))
    return model._replace(threshold=threshold_of(trusted, model, text_col))


def quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: the base counts, base_failed, the score llr, and kept."""
    return judged(docs, train(docs, labels, id_col, text_col), id_col, text_col)


def keep(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that the rules reject."""
    return passing(docs, train(docs, labels, id_col, text_col), text_col)
