"""Media columns: texts as lossless WebP images, and pixel arrays and features read back from the stored bytes.

Defined cases: null or empty text gives a payload of 576 bytes of 255; a payload beyond one image's 576 x 16,384 samples
is stored as several files one behind the other; repeated rows have equal media; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import webp
from .common import byte_texts, map_arrow

ROW = 576
_FRAME = ROW * webp.MAX_SIDE


def padded(text: bytes) -> bytes:
    return text + b"\xff" * (-len(text) % ROW or (0 if text else ROW))


def stored_form(payload: bytes) -> bytes:
    return b"".join(webp.encode_grey(payload[k : k + _FRAME], ROW) for k in range(0, len(payload), _FRAME))


def samples(media: bytes) -> bytes:
    """The 8-bit samples of the stored form; every channel of a grey pixel must agree."""
    out = []
    for image in webp.decode_file(media):
        green = image >> 8 & 255
        if (image & 0xFFFFFF != green * 0x010101).any():
            raise ValueError("not a grey image")
        out.append(green.astype(np.uint8).tobytes())
    return b"".join(out)


def feature(payload: bytes) -> str:
    """Mean, deviation and entropy of the samples, and a 64-bit hash of which eighths of the image are above the mean."""
    a = np.frombuffer(payload, np.uint8)
    counts = np.bincount(a, minlength=256)
    share = counts[counts > 0] / len(a)
    mean = float(counts @ np.arange(256)) / len(a)
    deviation = float(np.sqrt(max(0.0, counts @ (np.arange(256.0) ** 2) / len(a) - mean * mean)))
    cells = a.reshape(64, -1).astype(np.int64).sum(axis=1) * 64 > mean * len(a)
    return f"mean={mean:.4f};std={deviation:.4f};entropy={abs(float((share * np.log2(share)).sum())):.4f};hash={np.packbits(cells).tobytes().hex()}"


def to_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows doc_id, n_bytes, payload_bytes, media: the text as the bytes of lossless WebP."""

    def each(batch: pa.RecordBatch) -> dict:
        texts = byte_texts(batch.column(1))
        payloads = [padded(t) for t in texts]
        return {"doc_id": batch.column(0), "n_bytes": [len(t) for t in texts], "payload_bytes": [len(p) for p in payloads], "media": [stored_form(p) for p in payloads]}

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    return map_arrow(rows, f"doc_id {dict(docs.dtypes)[id_col]}, n_bytes long, payload_bytes long, media binary", each)


def from_media(media: DataFrame, *, keep_pixels: bool = False) -> DataFrame:
    """Decode the media column: digests of what is read back, features, and with ``keep_pixels`` the samples themselves."""
    schema = "doc_id {}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string".format(dict(media.dtypes)["doc_id"])

    def each(batch: pa.RecordBatch) -> dict:
        files = batch.column(3).to_pylist()
        read = [samples(f) for f in files]
        out = {
            "doc_id": batch.column(0), "n_bytes": batch.column(1), "payload_bytes": [len(p) for p in read],
            "payload_sha256": [hashlib.sha256(p).hexdigest() for p in read], "tail_crc32": [zlib.crc32(p[-32:]) for p in read],
            "media_bytes": [len(f) for f in files], "media_sha256": [hashlib.sha256(f).hexdigest() for f in files], "feature": [feature(p) for p in read],
        }
        return out | ({"pixels": read} if keep_pixels else {})

    return map_arrow(media.select("doc_id", "n_bytes", "payload_bytes", "media"), schema + ", pixels binary" * keep_pixels, each)
