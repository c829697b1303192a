"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document. Votes are counted by pattern over the whole corpus (a
table bounded by the number of patterns), and expectation-maximisation over the counts estimates each labeller's
accuracy for good and for bad documents, and the share of good ones. The posterior of each pattern labels a bounded
sample of documents (``SAMPLE``, those of the least hashes), on which a hashed linear scorer is fitted; it then scores
every document. The sample comes to the driver as bucket counts, at most BUCKETS numbers a document however long it is,
in the order of the hashes, so that reruns agree.

Documents are kept from a score of ``THRESHOLD``: the posterior's odds have to be 3 to 1 against a document, as a good one
lost costs more here than a bad one kept. The labellers' limits leave a band between the votes where they abstain.

Defined cases: null or empty text has no words and scores by its bias alone; very long texts are scored whole; repeated
rows score alike, and rows of equal id and text may take several places of the sample; an empty table gives an empty
result; with no votes at all every posterior is one half; malformed UTF-8 is read as bytes; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, map_arrow, md5_long
from .quality import Vocabulary, buckets_of, numbered, repeated_words

SAMPLE = 4_000
BUCKETS = 1 << 14
THRESHOLD = 0.25
_SPACE = bytes(range(9, 14)) + b" "
_UPPER = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_SYMBOLS = b"#*$%&|<>!"
_DIGITS = b"0123456789"


def _symbols(t: bytes, n: int, repeats: int) -> int:
    share = (len(t) - len(t.translate(None, _SYMBOLS))) / max(1, n)
    return -1 if share > 0.3 else 1 if share < 0.05 else 0


def _repeats(t: bytes, n: int, repeats: int) -> int:
    return -1 if repeats > 0.4 * n else 1 if repeats < 0.15 * n else 0


def _capitals(t: bytes, n: int, repeats: int) -> int:
    letters = len(t) - len(t.translate(None, _LETTERS))
    share = (len(t) - len(t.translate(None, _UPPER))) / max(1, letters)
    return -1 if share > 0.4 else 1 if share < 0.15 else 0


def _length(t: bytes, n: int, repeats: int) -> int:
    return -1 if n < 30 else 1 if n >= 60 else 0


def _word_size(t: bytes, n: int, repeats: int) -> int:
    size = len(t.translate(None, _SPACE)) / max(1, n)
    return -1 if size < 2.5 or size > 14 else 1 if 3.5 <= size <= 9 else 0


def _letters(t: bytes, n: int, repeats: int) -> int:
    solid = len(t.translate(None, _SPACE))
    share = (len(t) - len(t.translate(None, _LETTERS))) / max(1, solid)
    return -1 if share < 0.75 else 1 if share > 0.9 else 0


def _line_ends(t: bytes, n: int, repeats: int) -> int:
    lines = [x.strip(_SPACE) for x in t.split(b"\n") if x.strip(_SPACE)]
    if not lines:
        return -1
    share = sum(x.endswith((b".", b"?", b"!", b'"', b":")) and not x.endswith(b"!!") for x in lines) / len(lines)
    return -1 if share < 0.3 else 1 if share > 0.8 else 0


def _new_lines(t: bytes, n: int, repeats: int) -> int:
    lines = [x for x in t.split(b"\n") if x.strip(_SPACE)]
    share = 1 - len(set(lines)) / max(1, len(lines))
    return -1 if share > 0.3 else 1 if share < 0.05 and len(lines) > 1 else 0


#: Each takes the text, its number of words and of repeated words, and votes 1 (good), -1 (bad) or 0.
LABELLERS = (_symbols, _repeats, _capitals, _length, _word_size, _letters, _line_ends, _new_lines)


def votes_of(texts: list[bytes], vocabulary: Vocabulary) -> list[str]:
    """The pattern of votes on each text, a character a labeller: +, - or 0."""
    numbers, counts = numbered(texts, vocabulary)
    repeats = repeated_words(numbers, counts)
    return ["".join("0+-"[f(t, n, r)] for f in LABELLERS) for t, n, r in zip(texts, counts.tolist(), repeats.tolist(), strict=True)]


def voted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    vocabulary = Vocabulary()

    def each(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "votes": votes_of(byte_texts(batch.column(1)), vocabulary)}

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), f"doc_id {dict(docs.dtypes)[id_col]}, votes string", each)


def expectation_maximisation(counts: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], np.ndarray, float]:
    """Posteriors of the patterns, each labeller's chance of each vote given good and bad, and the share of good documents.

    Starts from the majority, and gives every chance a small prior, so that labellers that agree by rule stay apart from 0 and 1.
    """
    if not counts:
        return {}, np.zeros((2, len(LABELLERS), 3)), 0.5
    patterns = sorted(counts)
    weight = np.array([counts[p] for p in patterns], np.float64)
    vote = np.array([["0+-".index(c) for c in p] for p in patterns])
    balance = (vote == 1).sum(1) - 1.5 * (vote == 2).sum(1)
    good = 1 / (1 + np.exp(-balance))
    for _ in range(rounds):
        share = (good @ weight + 1) / (weight.sum() + 2)
        chance = np.empty((2, vote.shape[1], 3))
        for side, of in enumerate((good, 1 - good)):
            for v in range(3):
                chance[side, :, v] = ((of * weight) @ (vote == v) + 0.01 * weight.sum() / 3 + 1e-3) / ((of * weight).sum() + 0.01 * weight.sum() + 3e-3)
        logs = np.log(chance)
        at = np.arange(vote.shape[1])
        gap = np.log(share) - np.log(1 - share) + (logs[0, at, vote] - logs[1, at, vote]).sum(1)
        good = 1 / (1 + np.exp(-np.clip(gap, -30, 30)))
    return dict(zip(patterns, good.tolist(), strict=True)), chance, float(share)


def fit(buckets: list[np.ndarray], counts: list[np.ndarray], posterior: np.ndarray, rounds: int = 60, rate: float = 2.0, decay: float = 1e-4) -> np.ndarray:
    """Weights (BUCKETS + 1, the last the bias) of a logistic scorer of hashed n-gram shares, fitted to soft labels.

    A document is the buckets that it has, ascending, and how many of its n-grams are in each.
    """
    n = len(buckets)
    if not n:
        return np.zeros(BUCKETS + 1)
    bucket, times, doc = np.concatenate(buckets).astype(np.int64), np.concatenate(counts).astype(np.float64), np.repeat(np.arange(n), [len(b) for b in buckets])
    value = times / np.sqrt(np.maximum(np.bincount(doc, weights=times, minlength=n), 1))[doc]
    w = np.zeros(BUCKETS + 1)
    speed = np.zeros_like(w)
    balance = np.where(posterior > 0.5, 0.5 / max(1e-9, (posterior > 0.5).mean()), 0.5 / max(1e-9, (posterior <= 0.5).mean()))
    for _ in range(rounds):
        z = np.bincount(doc, weights=value * w[bucket], minlength=n) + w[-1]
        error = (1 / (1 + np.exp(-z)) - posterior) * balance / n
        g = np.append(np.bincount(bucket, weights=value * error[doc], minlength=BUCKETS), error.sum()) + decay * w
        speed = 0.9 * speed + g
        w -= rate * speed
    return w


def scored(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    vocabulary = Vocabulary()

    def each(batch: pa.RecordBatch) -> dict:
        texts = byte_texts(batch.column(1))
        bucket, doc = buckets_of(*numbered(texts, vocabulary), vocabulary, BUCKETS)
        n = np.bincount(doc, minlength=len(texts))
        z = np.bincount(doc, weights=weights[bucket], minlength=len(texts)) / np.sqrt(np.maximum(n, 1)) + weights[-1]
        return {"doc_id": batch.column(0), "score": np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 6)}

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), f"doc_id {dict(docs.dtypes)[id_col]}, score double", each)


def sampled(docs: DataFrame, id_col: str, text_col: str, sample: int) -> DataFrame:
    """Rows (_h, votes, buckets, counts) of the ``sample`` documents of the least hashes, in their order."""
    hashed = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("_text"), md5_long(F.col(id_col), F.xxhash64(text_col)).alias("_h"))
    # The sample's greatest hash first: numbers are ordered, and only the chosen texts are read again.
    cut = hashed.select("_h").orderBy("_h").limit(sample).agg(F.max("_h")).first()[0]
    vocabulary = Vocabulary()

    def each(batch: pa.RecordBatch) -> dict:
        texts = byte_texts(batch.column(0))
        bucket, doc = buckets_of(*numbered(texts, vocabulary), vocabulary, BUCKETS)
        found = [np.unique(bucket[doc == k], return_counts=True) for k in range(len(texts))]
        return {"_h": batch.column(1), "votes": votes_of(texts, vocabulary), "buckets": [b for b, _ in found], "counts": [n for _, n in found]}

    chosen = map_arrow(hashed.where(F.col("_h") <= F.lit(-1 if cut is None else cut)), "_h long, votes string, buckets array<int>, counts array<int>", each)
    return chosen.orderBy("_h", "votes", "buckets", "counts").limit(sample)  # ties at the cut are rows of equal id and text


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, dict[str, float]]:
    """The scorer's weights, and the posterior of each pattern of votes."""
    counts = {r["votes"]: r["n"] for r in voted(docs, id_col, text_col).groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior, _, _ = expectation_maximisation(counts)
    rows = sampled(docs, id_col, text_col, sample).collect()
    labels = np.array([posterior.get(r["votes"], 0.5) for r in rows])
    return fit([np.array(r["buckets"], np.int64) for r in rows], [np.array(r["counts"], np.float64) for r in rows], labels), posterior


def classify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Rows doc_id, score (chance of good quality), kept."""
    weights, _ = train(docs, id_col=id_col, text_col=text_col, sample=sample)
    return scored(docs, weights, id_col, text_col).withColumn("kept", F.col("score") >= F.lit(float(threshold)))
