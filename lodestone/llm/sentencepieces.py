"""SentencePiece encoding and decoding on a tokenizers-library backend.

The model's protobuf is read field by field (no generated classes), and the encoder is rebuilt from it: the normaliser
(character map, extra white space, dummy prefix), the metaspace marker, unigram scores or the merges that a BPE model's
scores imply, and byte fallback. Batches are encoded by the library's own threads.

No text may cross a marker: where no piece of the vocabulary has a marker after another character, the text is cut before
each run of markers. Merges and best paths can't cross such a cut, so the ids are those of the whole text, at a cost linear
in it. Without such a vocabulary the whole text is one cut.

``verify`` compares ids with the SentencePiece library's for every distinct piece between cuts that a task meets.

Control, unknown, byte and unused pieces of a unigram model have strings in the library's trie that no text has, as only
normal and user-defined pieces may match; user-defined ones get a score that always wins; what nothing matches is written
in bytes here, where the model falls back to them.

Defined cases: null or empty text has no ids; very long texts are encoded whole; repeated rows are alike; an empty table
gives an empty result; the strings of control pieces in a text are ordinary text; malformed UTF-8 is read with replacement
characters; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, map_arrow

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_ROW = 512


class Spec(NamedTuple):
    pieces: list[tuple[str, float, int]]
    model_type: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    strip_extra: bool
    escape: bool


def _fields(data: bytes) -> Iterator[tuple[int, Any]]:
    """(field number, value) of a protobuf message: ints for varints, bytes for the rest."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            n, at = varint(at)
            value, at = data[at : at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, value


def parse_model(data: bytes) -> Spec:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    flag = lambda of, n, default: bool(of.get(n, default))
    return Spec(pieces, trainer.get(3, UNIGRAM), flag(trainer, 35, 0), normalizer.get(2, b""), flag(normalizer, 3, 1), flag(normalizer, 4, 1), flag(normalizer, 5, 1))


def merges_of(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """The merges behind a BPE model's scores: every split of a piece into two pieces, best piece first."""
    rank = {p: k for k, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER, UNUSED)}
    found = []
    for p, score, kind in pieces:
        if kind in (NORMAL, USER, UNUSED):
            found += [(-score, rank[p[:k]], rank[p[k:]], p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in rank and p[k:] in rank]
    return [(left, right) for _, _, _, left, right in sorted(found)]


def model_of(spec: Spec):
    """The library's model: unigram scores as they are, or a BPE model's vocabulary and merges."""
    from tokenizers import models

    unk = next(k for k, (_, _, kind) in enumerate(spec.pieces) if kind == UNKNOWN)
    if spec.model_type == BPE:
        vocab = {p: k for k, (p, _, _) in enumerate(spec.pieces)}
        return models.BPE(vocab, merges_of(spec.pieces), unk_token=spec.pieces[unk][0], fuse_unk=True, byte_fallback=spec.byte_fallback)
    if spec.model_type == UNIGRAM:
        best = max((s for _, s, kind in spec.pieces if kind == NORMAL), default=0.0)
        score = {NORMAL: lambda p, s: s, USER: lambda p, s: len(p.encode()) * best - 0.1}
        # U+10FFFF is no character, so that pieces that nothing may match begin with it.
        return models.Unigram([(p, score[kind](p, s)) if kind in score else (f"\U0010ffff{k}", 0.0) for k, (p, s, kind) in enumerate(spec.pieces)], unk, False)
    raise ValueError("only unigram and BPE models are supported")


REMEMBER_CHARS = 16 << 20


class Backend:
    """Encodes and decodes as the SentencePiece model does, on the tokenizers library.

    Texts are normalised, cut at the markers, and the cuts not met before are encoded in one multithreaded batch; their
    ids are remembered: of the last ``remember`` cuts and REMEMBER_CHARS characters at most. With ``verify``, every cut is also encoded by SentencePiece when first met.
    """

    def __init__(self, model: bytes, verify: bool = True, remember: int = 200_000) -> None:
        from tokenizers import Tokenizer, decoders, normalizers

        self.spec = parse_model(model)
        self.tokenizer = Tokenizer(model_of(self.spec))
        self.tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        self.charsmap = normalizers.Precompiled(self.spec.charsmap) if self.spec.charsmap else None
        self.mark = MARK if self.spec.escape else " "
        inner = any(self.mark in p.lstrip(self.mark) for p, _, kind in self.spec.pieces if kind in (NORMAL, USER, UNUSED))
        self.cut = None if inner else re.compile(f"{self.mark}+[^{self.mark}]*|[^{self.mark}]+").findall
        self.byte_ids = {int(p[3:5], 16): k for k, (p, _, kind) in enumerate(self.spec.pieces) if kind == BYTE}
        self.unknown = next(k for k, (_, _, kind) in enumerate(self.spec.pieces) if kind == UNKNOWN)
        self.in_bytes = self.spec.model_type == UNIGRAM and self.spec.byte_fallback and len(self.byte_ids) == 256
        self.bytes_of = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in self.spec.pieces]
        self.begins = np.array([p.startswith(self.mark) for p, _, _ in self.spec.pieces])
        self.ids_of: dict[str, bytes] = {}  # little-endian 32-bit numbers
        self.older: dict[str, bytes] = {}
        self.wrong: set[str] = set()
        self.verify, self.remember, self.original, self.held = verify, remember, None, 0
        if verify:
            import sentencepiece

            self.original = sentencepiece.SentencePieceProcessor(model_proto=model)
            self.lead = array("i", self.original.encode("a")).tobytes()

    def normalised(self, text: str) -> str:
        if self.charsmap is not None:
            text = self.charsmap.normalize_str(text)
        if self.spec.strip_extra:
            text = " ".join(x for x in text.split(" ") if x)
        if text and self.spec.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.spec.escape else text

    def learn(self, cuts: list[str]) -> None:
        """Encode cuts not met before, and hold them against SentencePiece.

        Cuts of one marker and something behind it are encoded in rows of ``_ROW``, one behind the other as they stand in a
        text: no piece crosses a marker, so a row's ids fall apart at the pieces that begin with one. What can't be told apart
        so, and rows that SentencePiece encodes differently, go one by one.
        """
        mark, alone = self.mark, cuts
        if self.cut is not None and not self.in_bytes:
            plain = [c for c in cuts if c[0] == mark and c[1:2] not in ("", mark)]
            alone = [c for c in cuts if c[0] != mark or c[1:2] in ("", mark)] if len(plain) < len(cuts) else []
            rows = [plain[k : k + _ROW] for k in range(0, len(plain), _ROW)]
            joined = ["".join(row) for row in rows]
            for row, text, got in zip(rows, joined, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
                ids = np.array(got.ids, np.int32)
                packed, starts = ids.tobytes(), (4 * np.flatnonzero(self.begins[ids])).tolist()
                if len(starts) != len(row) or starts[0] or (self.original is not None and self._original(text) != packed):
                    alone += row
                else:
                    self.ids_of.update(zip(row, [packed[x:y] for x, y in zip(starts, [*starts[1:], len(packed)], strict=True)], strict=True))
        if alone:
            encode = self.tokenizer.encode_batch if self.in_bytes else self.tokenizer.encode_batch_fast  # the fast one has no offsets
            for cut, got in zip(alone, encode(alone, add_special_tokens=False), strict=True):
                self.ids_of[cut] = packed = array("i", self._spelt(cut, got) if self.in_bytes else got.ids).tobytes()
                if self.original is not None and self._original(cut) != packed:
                    self.wrong.add(cut)

    def _spelt(self, cut: str, got) -> list[int]:
        """The ids of an encoded cut, with bytes in place of what nothing matches."""
        if self.unknown not in got.ids:
            return got.ids
        return [x for k, (a, b) in zip(got.ids, got.offsets, strict=True) for x in ([self.byte_ids[y] for y in cut[a:b].encode()] if k == self.unknown else [k])]

    def _original(self, cut: str) -> bytes | None:
        """SentencePiece's ids behind a letter, as a text of nothing but the dummy prefix would have none; None if the letter's
        own ids change."""
        got = array("i", self.original.encode("a" + (cut.replace(MARK, " ") if self.spec.escape else cut))).tobytes()
        return got[len(self.lead) :] if got.startswith(self.lead) else None

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """The ids of each text (as packed 32-bit numbers), and whether all its cuts agree with SentencePiece."""
        cuts = [self.cut(t) if self.cut else [t] for t in map(self.normalised, texts)]
        if len(self.ids_of) > self.remember // 2 or self.held > REMEMBER_CHARS // 2:  # what wasn't met since the last time is forgotten
            self.older, self.ids_of, self.held = self.ids_of, {}, 0
            self.wrong &= self.older.keys()
        need = set(chain.from_iterable(cuts)) - self.ids_of.keys()
        self.held += sum(map(len, need))
        again = need & self.older.keys()
        self.ids_of.update(zip(again, map(self.older.__getitem__, again), strict=True))
        if unseen := need - again:
            self.learn(list(unseen))
        get, wrong = self.ids_of.__getitem__, self.wrong
        return [b"".join(map(get, cut)) for cut in cuts], [not wrong or wrong.isdisjoint(cut) for cut in cuts]

    def decode(self, packed: bytes) -> str:
        ids = array("i", packed)
        try:
            text = b"".join(map(self.bytes_of.__getitem__, ids)).decode()
        except UnicodeDecodeError:  # ids that no text has: broken byte runs become replacement characters
            text = self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        return text[1:] if self.spec.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def backend(model: bytes, verify: bool = True) -> Backend:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    os.environ.setdefault("RAYON_NUM_THREADS", "2")  # a task's threads; an executor runs a task a core as it is
    return Backend(model, verify)


def default_model() -> str:
    """The public 32k model; the path is a parameter everywhere else."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _model_bytes(model_path: str | None) -> bytes:
    with open(model_path or default_model(), "rb") as f:
        return f.read()


def tokenize(docs: DataFrame, *, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, verify: bool = True) -> DataFrame:
    """Rows doc_id, n_tokens, ids_sha256 (of little-endian 32-bit ids), decoded_sha256, round_trip, and parity.

    round_trip: the decoded text equals the text (its normal form may differ). parity: the ids equal SentencePiece's.
    ``keep_ids`` adds the ids themselves.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path))
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, parity boolean" + ", ids array<int>" * keep_ids

    def each(batch: pa.RecordBatch) -> dict:
        engine, out = backend(broadcast.value, verify), {n: [] for n in ("n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "parity", "ids")}
        piece = byte_texts(batch.column(1))
        if piece:
            ids, parity = engine.encode([t.decode("utf-8", "replace") for t in piece])
            decoded = [engine.decode(x).encode() for x in ids]
            out["n_tokens"] += (len(x) // 4 for x in ids)
            out["ids_sha256"] += (hashlib.sha256(x).hexdigest() for x in ids)
            out["decoded_sha256"] += (hashlib.sha256(x).hexdigest() for x in decoded)
            out["round_trip"] += (a == b for a, b in zip(piece, decoded, strict=True))
            out["parity"] += parity if verify else [None] * len(ids)
            if keep_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) // 4 for x in ids)]), pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
        return out | {"doc_id": batch.column(0)}

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), schema, each)
