"""Suffix-array dedup: every byte covered by a 200-byte string that also starts elsewhere in the corpus is removed.

One suffix array of 100 TB can't be built, so the corpus is cut into shards such that equal 200-byte strings meet:

1. Texts that are exact copies are one text (a copy of 200 bytes or more is removed whole).
2. Each 200-byte window picks an anchor in it, the least hash of its 32-byte grams. Equal windows pick equal anchors at
   equal places. Windows in a row with the same anchor are a context. Contexts whose anchor occurs once are done.
3. Contexts that are equal as a whole repeat all their windows. Contexts that share an anchor and differ go to the shard
   of the anchor, one copy of each: a suffix array by induced sorting and permuted common prefixes over the shard find
   the windows that repeat. Windows of different anchors can't be equal, so shards may hold many anchors.
4. An anchor with more than ``hot`` different contexts is dealt out further: its contexts are cut to parts of 21 windows,
   and parts meet by the 128-bit hash of the bytes that all windows of a part cover, so that again equal windows meet.
   Parts that many different ones meet even so (their ends differ, as where a common passage stops) are dealt out by the
   hash of each whole window, which is exact as well and needs no task to hold them.

Every step moves a few dozen bytes for each anchor (about one in 85 bytes), not texts, except for the final pass.
Anchors and contexts that occur over ``OFTEN`` times are met by broadcast, where these are few, or dealt out by text.

Equality of whole contexts is judged by 128-bit hashes of their bytes inside one anchor.

Defined cases: null text is empty; texts under 200 bytes keep everything; very long texts are worked through in
overlapping pieces; repeated rows, also of equal ids, are copies of each other; null or repeated ids are allowed (a row is
then told by the md5 of id and text); an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, broadcast_if, byte_texts, in_arrow, join_hot, map_arrow, sliced, stored
from .suffixes import permuted_lcp, suffix_array

SPAN, GRAM = 200, 32
HOT = 2_000
SHARD_BYTES = 1 << 18
OFTEN, OFTEN_ROWS, DEALT = 2_000, 200_000, 32
_WINDOW = SPAN - GRAM + 1
_PIECE = 1 << 20
_SHAPE = _WINDOW + 1  # a context's windows, and its anchor's place, are under this: both go into one short
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], have = 1, 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < n:
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, n), _powers(_INVERSE, n)
    return _TABLES["up"][:n], _TABLES["down"][:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def contexts(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(row, first window, last window, place of the anchor, anchor, two halves of the context's hash) of every context of
    the texts; windows are their start bytes."""
    out = []
    run, base, rows, size = [], [], [], 0

    def flush() -> None:
        if run:
            out.append(_contexts(b"".join(run), np.array([len(x) for x in run]), np.array(base), np.array(rows)))

    for row, text in enumerate(texts):
        for start in range(0, max(0, len(text) - SPAN + 1), _PIECE):
            piece = text[start : start + _PIECE + SPAN - 1]
            if size + len(piece) > 2 * _PIECE:
                flush()
                run, base, rows, size = [], [], [], 0
            run.append(piece)
            base.append(start)
            rows.append(row)
            size += len(piece)
    flush()
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64,) * 7)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _prefix_hash(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    t = np.frombuffer(data, np.uint8)
    up, down = _tables(len(t) + 1)
    total = np.zeros(len(t) + 1, np.uint64)
    np.cumsum((t.astype(np.uint64) + np.uint64(1)) * up[: len(t)], out=total[1:])
    return total, down


def _contexts(data: bytes, lengths: np.ndarray, base: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    n = len(data)
    total, down = _prefix_hash(data)
    gram = _mixed((total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1])
    # The least of each window, leftmost of equals: the hash's high bits above the place; grams of equal high bits are
    # told apart by place, the same in equal windows.
    packed = (gram & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(gram), dtype=np.uint64)
    blocks = -(-len(packed) // _WINDOW) + 1
    padded = np.full(blocks * _WINDOW, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(packed)] = packed
    square = padded.reshape(blocks, _WINDOW)
    ahead = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(square, axis=1).ravel()
    windows = n - SPAN + 1
    place = (np.minimum(ahead[:windows], behind[_WINDOW - 1 : _WINDOW - 1 + windows]) & np.uint64(0xFFFFFF)).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    piece = np.repeat(np.arange(len(lengths)), lengths)[:windows]
    inside = np.flatnonzero(np.arange(windows) + SPAN <= (starts + lengths)[piece])
    fresh = np.ones(len(inside), bool)
    fresh[1:] = (place[inside[1:]] != place[inside[:-1]]) | (piece[inside[1:]] != piece[inside[:-1]])
    first = inside[fresh]
    last = inside[np.append(np.flatnonzero(fresh)[1:] - 1, len(inside) - 1)]
    at = place[first]
    # Equal bytes have equal windows, but the same bytes may stand round the anchor's gram at another place.
    view, digest = memoryview(data), xxhash.xxh3_128_digest
    seeds = ((at - first) * _SHAPE + last - first).tolist()
    hashes = b"".join([digest(view[a:b], s) for a, b, s in zip(first.tolist(), (last + SPAN).tolist(), seeds, strict=True)])
    context, check = np.frombuffer(hashes, np.int64).reshape(-1, 2).T
    p = piece[first]
    return rows[p], first - starts[p] + base[p], last - starts[p] + base[p], at - first, gram[at].view(np.int64), context, check


def _kind(df: DataFrame) -> tuple[str, pa.DataType]:
    """Spark's and Arrow's type of the row ids."""
    return ("long", pa.int64()) if dict(df.dtypes)["rid"] == "bigint" else ("binary", pa.binary())


def _context_rows(docs: DataFrame) -> DataFrame:
    name, kind = _kind(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for whole in batches for b in sliced(whole)):
            row, first, last, place, anchor, context, check = contexts(byte_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(kind).take(pa.array(row)), pa.array(first.astype(np.int32)), pa.array((place * _SHAPE + last - first).astype(np.int16)), pa.array(anchor), pa.array(context), pa.array(check)],
                names=["rid", "first", "shape", "anchor", "context", "check"],
            )

    return in_arrow(docs.select("rid", "_text"), run, f"rid {name}, first int, shape short, anchor long, context long, check long")


def repeated_windows(segments: list[bytes]) -> list[np.ndarray]:
    """For each segment, its windows that also start elsewhere in the segments, by a suffix array of them all."""
    sizes = np.array([len(s) for s in segments])
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.int16) + 2
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 1
    text[-1] = 0
    order = suffix_array(text)
    prefix = permuted_lcp(text, order)
    hit = prefix >= SPAN
    both = hit.copy()
    both[order[:-1]] |= hit[order[1:]]
    starts = ends - sizes
    return [np.flatnonzero(both[a : a + n - SPAN + 1]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


def _runs(at: np.ndarray) -> list[tuple[int, int]]:
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.append(0, cut + 1)].tolist(), at[np.append(cut, len(at) - 1)].tolist(), strict=True))


def _sharded(segments: DataFrame) -> DataFrame:
    """Rows (rid, first, last) of repeated windows; ``segments`` are dealt by anchor, and sorted by it in each task."""
    name, kind = _kind(segments)

    def solve(rids: list, firsts: list, texts: list) -> pa.RecordBatch:
        r, a, b = [], [], []
        for rid, first, found in zip(rids, firsts, repeated_windows(texts), strict=True):
            for x, y in _runs(found):
                r.append(rid)
                a.append(first + x)
                b.append(first + y)
        return pa.RecordBatch.from_arrays([pa.array(r, kind), pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["rid", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rids, firsts, texts, size, anchor = [], [], [], 0, None
        for batch in batches:
            for key, rid, first, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= SHARD_BYTES and key != anchor:
                    yield solve(rids, firsts, texts)
                    rids, firsts, texts, size = [], [], [], 0
                anchor = key
                rids.append(rid)
                firsts.append(first)
                texts.append(text)
                size += len(text)
        if texts:
            yield solve(rids, firsts, texts)

    return in_arrow(segments, run, f"rid {name}, first int, last int")


def _cut_segments(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Fetch the bytes of the wanted contexts: rows (anchor, hot, rid, first, place, segment)."""
    lists = wanted.groupBy("rid").agg(F.collect_list(F.struct("anchor", "hot", "first", "shape")).alias("_wanted"))
    rows = docs.select("rid", "_text").join(lists, "rid")
    name, kind = _kind(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for whole in batches for b in sliced(whole)):
            out = [[], [], [], [], [], []]
            for rid, text, wanted in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                for w in wanted:
                    first, (place, more) = w["first"], divmod(w["shape"], _SHAPE)
                    for column, value in zip(out, (w["anchor"], w["hot"], rid, first, place, text[first : first + more + SPAN]), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.bool_(), kind, pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["anchor", "hot", "rid", "first", "place", "segment"])

    return in_arrow(rows.select("rid", "_text", "_wanted"), run, f"anchor long, hot boolean, rid {name}, first int, place int, segment binary")


PART = 21


def _parts(segments: DataFrame) -> DataFrame:
    """Rows (key, content, rid, first, segment): the segments' windows in parts of PART, on a grid fixed by the anchor.

    ``segments`` has the place of the anchor in the segment; the key is a hash of the bytes common to a part's windows.
    """
    name, kind = _kind(segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda b: hashlib.blake2b(b, digest_size=16).digest()
        for batch in batches:
            out = [[], [], [], [], []]
            for anchor, rid, first, place, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                windows = len(text) - SPAN + 1
                for k in range((place - windows + 1) // PART, place // PART + 1):
                    low = place - PART * k  # the last window of the cell; all of them cover [low, low + SPAN - PART + 1)
                    a, b = max(0, low - PART + 1), min(windows - 1, low)
                    key = digest(b"%d,%d," % (anchor, k) + text[low : low + SPAN - PART + 1])
                    part = text[a : b + SPAN]
                    for column, value in zip(out, (key, digest(part), rid, first + a, part), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.binary(), kind, pa.int32(), pa.binary()), strict=True)], names=["key", "content", "rid", "first", "segment"])

    return in_arrow(segments.select("anchor", "rid", "first", "place", "segment"), run, f"key binary, content binary, rid {name}, first int, segment binary")


def _window_rows(parts: DataFrame) -> DataFrame:
    """Rows (digest, rid, first) of every window of the parts."""
    name, kind = _kind(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rids, firsts = [], [], []
            for rid, first, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k in range(len(text) - SPAN + 1):
                    digests.append(hashlib.blake2b(text[k : k + SPAN], digest_size=16).digest())
                    rids.append(rid)
                    firsts.append(first + k)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(rids, kind), pa.array(firsts, pa.int32())], names=["digest", "rid", "first"])

    return in_arrow(parts, run, f"digest binary, rid {name}, first int")


def _met(rows: DataFrame, once: DataFrame, on: list[str], spread: tuple[str, ...] = ("rid", "first")) -> DataFrame:
    """``rows`` joined to ``once`` (a row a key, with how many rows ``n`` the key has), whatever a key's share of them; keys
    that are too many to be broadcast are dealt out by the columns ``spread``."""
    often = once.where(F.col("n") > OFTEN)
    if bounded(often, OFTEN_ROWS):
        rest = rows.join(F.broadcast(often.select(*on)), on, "left_anti").join(once.where(F.col("n") <= OFTEN), on)
        return rest.unionByName(rows.join(F.broadcast(often), on))
    parts = once.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    return rows.withColumn("_part", F.pmod(F.xxhash64(*spread), F.lit(DEALT)).cast("int")).join(parts, [*on, "_part"]).drop("_part")


def repeated_ranges(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Rows (rid, first, last): windows (start bytes, inclusive) of the texts (rid, _text), no two equal, that repeat."""
    parts = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    more = (F.col("shape") % _SHAPE).cast("int")
    rows = stored(_context_rows(docs), "contexts")
    told = F.struct("context", "check")
    met = rows.groupBy("anchor").agg(F.min(told).alias("_a"), F.max(told).alias("_b"), F.count("*").alias("n")).where("n > 1").select("anchor", "n", (F.col("_a") != F.col("_b")).alias("mixed"))
    shared = stored(_met(rows, stored(met, "met"), ["anchor"]).drop("n"), "shared")
    kinds = shared.groupBy("anchor", "context", "check", "mixed").agg(F.count("*").alias("n"), F.min(F.struct("rid", "first", "shape")).alias("one"))
    kinds = stored(kinds, "kinds")
    again = kinds.where("n > 1").select("anchor", "context", "check", "n")
    whole = _met(shared, again, ["anchor", "context", "check"]).select("rid", "first", (F.col("first") + more).alias("last"))
    # Anchors with a context that occurs once beside another one: these need the comparison.
    unsettled = kinds.where("mixed").groupBy("anchor").agg(F.min("n").alias("_least"), F.count("*").alias("_k")).where("_least = 1").select("anchor", F.col("_k").alias("n"), (F.col("_k") > hot).alias("hot"))
    wanted = _met(kinds.where("mixed").select("anchor", "one"), unsettled, ["anchor"], ("one",)).select("anchor", "hot", "one.*")
    segments = stored(_cut_segments(docs, wanted), "segments")
    cold = segments.where("not hot").select("anchor", "rid", "first", "segment").repartition(parts, "anchor").sortWithinPartitions("anchor")
    out = whole.unionByName(_sharded(cold))
    hot_ones = segments.where("hot")
    return out if hot_ones.isEmpty() else out.unionByName(_dealt_out(hot_ones, hot, parts))


def _dealt_out(segments: DataFrame, hot: int, parts: int) -> DataFrame:
    """The repeated windows of hot anchors' contexts, by parts and then by windows."""
    pieces = stored(_parts(segments), "parts")
    kinds = stored(pieces.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(F.struct("rid", "first", "segment")).alias("one")), "part-kinds")
    whole = _met(pieces, kinds.where("n > 1").select("key", "content", "n"), ["key", "content"]).select("rid", "first", (F.col("first") + F.length("segment") - SPAN).cast("int").alias("last"))
    unsettled = kinds.groupBy("key").agg(F.min("n").alias("_least"), F.count("*").alias("_k")).where("_least = 1 and _k > 1").select("key", F.col("_k").alias("n"), (F.col("_k") > hot).alias("hot"))
    left = stored(_met(kinds.select("key", "one"), unsettled, ["key"], ("one",)).select("key", "hot", "one.*"), "part-left")
    cold = left.where("not hot").select("key", "rid", "first", "segment").repartition(parts, "key").sortWithinPartitions("key")
    windows = _window_rows(left.where("hot").select("rid", "first", "segment"))
    twice = windows.groupBy("digest").agg(F.count("*").alias("_n")).where("_n > 1").select("digest")
    same = windows.join(twice, "digest", "left_semi").select("rid", "first")
    # Windows in a row become one range: the place less the rank is the same along them.
    along = F.col("first") - F.row_number().over(Window.partitionBy("rid").orderBy("first"))
    same = same.select("rid", "first", along.alias("_run")).groupBy("rid", "_run").agg(F.min("first").alias("first"), F.max("first").alias("last")).drop("_run")
    return whole.unionByName(_sharded(cold)).unionByName(same)


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, _text, and rid: the id itself where ids are unique whole numbers, else the md5 of id and text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    plain = dict(docs.dtypes)[id_col] in ("bigint", "int") and rows.where("doc_id is null").isEmpty() and rows.groupBy("doc_id").count().where("count > 1").isEmpty()
    told = F.concat_ws("|", F.coalesce(F.concat(F.lit("v"), F.col("doc_id").cast("string")), F.lit("n")), F.md5("_text"))
    return rows.withColumn("rid", F.col("doc_id").cast("long") if plain else F.unhex(F.md5(told)))


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, keep_text: bool = False) -> DataFrame:
    """A row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``keep_text`` also kept (bytes) and the
    removed spans as (start, end)."""
    rows = _identified(docs, id_col, text_col)
    digests = stored(rows.select("rid", F.unhex(F.md5("_text")).alias("_md5")), "digests")
    copied = digests.groupBy("_md5").agg(F.min("rid").alias("_rep"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    copies = stored(join_hot(digests, copied, "_md5", F.col("rid"), parts=DEALT).select("rid", (F.col("rid") == F.col("_rep")).alias("_first")).distinct(), "copies")
    copies = broadcast_if(copies, 1_000_000)
    texts = rows.join(copies.where("not _first").select("rid"), "rid", "left_anti")
    ranges = repeated_ranges(texts, hot).groupBy("rid").agg(F.collect_list(F.struct("first", "last")).alias("_ranges"))
    marked = rows.join(copies.select("rid", F.lit(True).alias("_copied")).distinct(), "rid", "left").join(ranges, "rid", "left")
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<struct<start:int,end:int>>" * keep_text

    def each(batch: pa.RecordBatch) -> dict:
        out = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans")}
        for text, copied, found in zip(byte_texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            spans = [[0, len(text)]] if copied and len(text) >= SPAN else []
            for a, b in sorted((x["first"], x["last"] + SPAN) for x in found or ()) if not spans else ():
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], b)
                else:
                    spans.append([a, b])
            edges = [0, *(x for s in spans for x in s), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            for name, value in (("n_bytes", len(text)), ("n_removed", len(text) - len(kept)), ("n_spans", len(spans)), ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("kept", kept), ("spans", [{"start": a, "end": b} for a, b in spans])):
                out[name].append(value)
        return out | {"doc_id": batch.column(0)}

    return map_arrow(marked.select("doc_id", "_text", "_copied", "_ranges"), schema, each)
