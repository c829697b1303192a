"""Documents packed into token sequences of a fixed length by swap-based local search.

A document's ids and an end id are cut into pieces only where they are more than a sequence holds: then all pieces but the
first have a sequence's length. Pieces of that length are sequences of their own. The others are dealt, in equal numbers
and without a key, to groups of ``GROUP`` sequences at most, and a task packs a group: best fit by falling length first,
then local search. It takes the emptiest sequence and moves its pieces into others, or exchanges one of its pieces for a
smaller one, two for one or one for two, whenever the other sequence has room for the difference. As that one is the
fuller, each step makes the sum of the squared fills grow, and sequences run empty. A search ends when what is free in all
sequences is less than one of them, which is the least number, or when no step is left. Sequences that stay underfull are
dealt to new groups and searched again, until they are few enough for one group or a round frees none.

Packing looks at the pieces' lengths only: ids are shuffled where they are asked for.

Defined cases: a null text is an empty one, which has its end id only; long texts are packed whole, piece by piece;
repeated rows are packed each; a null id is an id like any other; an empty table gives an empty result; columns beside
the two named are not looked at.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, in_arrow, map_arrow, stored

CAPACITY, END, GROUP = 1024, 2, 16_384
#: Pairs of one sequence's pieces are looked at in sequences of so many pieces; moves and single exchanges in all.
PAIRS = 32
#: Fixed value: how byte-level BPE parts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _bytes_of_letters() -> dict[str, int]:
    """The byte behind each letter of byte-level vocabularies: printable Latin-1 stands for itself, the others follow."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Packed little-endian 32-bit ids of texts, as the ``tokenizers`` definition has them.

    A byte-level BPE whose merges make the ids in order is a table of ranks, which tiktoken works with five times as fast:
    there the ids come from tiktoken, and from ``tokenizers`` for texts that hold one of its special tokens. Any other
    definition is left to ``tokenizers``. The tests hold both against each other.
    """

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))).search if special else lambda text: None
        self.ranked = self._ranked(json.loads(definition))

    @staticmethod
    def _ranked(spec: dict):
        import tiktoken

        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = spec.get("normalizer") is None and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or before.get("use_regex") is False or not plain:
            return None
        vocab, byte = model["vocab"], _bytes_of_letters()
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        ranks = {bytes(byte[c] for c in t): k for t, k in vocab.items()} if all(c in byte for t in vocab for c in t) else {}
        if made != list(range(256, 256 + len(made))) or len(ranks) != len(made) + 256 or sorted(ranks.values()) != list(range(len(ranks))):
            return None
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.ranked is None:
            return self.whole(texts)
        fast = lambda t: array("I", self.ranked.encode_ordinary(t)).tobytes()
        return [self.whole([t])[0] if self.special(t) else fast(t) for t in texts]


@lru_cache(maxsize=2)
def _encoder(definition: str) -> Encoder:
    return Encoder(definition)


def pieces(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32 of every piece of every document; with ``keep_ids`` the ids too."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    last = struct.pack("<I", end)
    names = ("row", "piece", "start", "length", "ids_crc32", "ids")

    def each(batch: pa.RecordBatch) -> dict:
        out: dict = {n: [] for n in names}
        for row, ids in enumerate(_encoder(definition.value).encode([t.decode("utf-8", "replace") for t in byte_texts(batch.column(1))])):
            ids += last
            n = len(ids) // 4
            cuts = [0, *range(n % capacity or capacity, n, capacity), n]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                part = ids[4 * a : 4 * b]
                for name, value in zip(names, (row, k, a, b - a, zlib.crc32(part), part), strict=True):
                    out[name].append(value)
        out["doc_id"] = batch.column(0).take(pa.array(out["row"], pa.int64()))
        if keep_ids:
            flat = pa.array(np.frombuffer(b"".join(out["ids"]), "<u4").astype(np.int32))
            out["ids"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *out["length"]]), pa.int32()), flat)
        return out

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    return map_arrow(rows, f"doc_id {dict(docs.dtypes)[id_col]}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids, each)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items by falling size, each into the fullest bin with room for it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    there = 0  # a bit for each room that some bin has
    for item in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        size = sizes[item]
        roomy = there >> size
        if roomy:
            room = size + (roomy & -roomy).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                there &= ~(1 << room)
            bins[b].append(item)
        else:
            room, b = capacity, len(bins)
            bins.append([item])
        by_room[room - size].append(b)
        there |= 1 << (room - size)
    return bins


class Search:
    """Local search over the underfull bins of a group; ``bins`` are lists of items.

    A step takes items out of bin a, which is there with the fill f, and puts them into bin b of the fill g, perhaps for
    some of its own. It is made if b has room for the gain d and d > f - g: then the sum of the squared fills grows.
    """

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int) -> None:
        self.sizes, self.capacity, self.bins = sizes, capacity, bins
        self.fill = np.array([sum(sizes[k] for k in b) for b in bins], np.int64)
        self.size = np.array(sizes, np.int64)
        self.bin_of = np.empty(len(sizes), np.int64)
        for b, items in enumerate(bins):
            self.bin_of[items] = b
        #: Items of underfull bins: a full bin has no more part in the search.
        self.items = np.flatnonzero(self.fill[self.bin_of] < capacity)
        self.pairs = np.zeros((0, 2), np.int64)

    def shift(self, a: int, b: int, out: list[int], back: list[int]) -> None:
        """Items ``out`` go from bin a to b, ``back`` from b to a."""
        for items, x, y in ((out, a, b), (back, b, a)):
            for k in items:
                self.bins[x].remove(k)
                self.bins[y].append(k)
                self.bin_of[k] = y
                self.fill[x] -= self.sizes[k]
                self.fill[y] += self.sizes[k]
        if self.fill[b] == self.capacity:
            self.items = self.items[self.fill[self.bin_of[self.items]] < self.capacity]

    def move(self, a: int) -> bool:
        """The largest item of a that another bin has room for goes to the fullest such bin."""
        fill = np.where(self.fill > 0, self.fill, self.capacity)
        fill[a] = self.capacity
        for k in sorted(self.bins[a], key=self.sizes.__getitem__, reverse=True):
            to = np.where(fill + self.sizes[k] <= self.capacity, fill, -1)
            b = int(to.argmax())
            if to[b] + self.sizes[k] > self.fill[a]:
                self.shift(a, b, [k], [])
                return True
        return False

    def exchange(self, a: int, groups: list[list[int]], others: np.ndarray) -> bool:
        """Items of a, of ``groups`` one, for another bin's, of the rows of ``others`` one: the step that gains most."""
        bins = self.bin_of[others[:, 0]]
        there = (bins != a) & (bins == self.bin_of[others[:, -1]])
        others, bins = others[there], bins[there]
        if not len(others):
            return False
        size, fill = self.size[others].sum(axis=1), self.fill[bins]
        room, least = self.capacity - fill, np.maximum(self.fill[a] - fill, 0)
        best, found = 0, None
        for group in groups:
            gain = sum(self.sizes[k] for k in group) - size
            gain[(gain > room) | (gain <= least)] = 0
            k = int(gain.argmax())
            if gain[k] > best:
                best, found = int(gain[k]), (group, k)
        if found is None:
            return False
        self.shift(a, int(bins[found[1]]), found[0], others[found[1]].tolist())
        return True

    def pairs_of(self, bins: list[int]) -> np.ndarray:
        rows = [(x, y) for b in bins if len(self.bins[b]) <= PAIRS for n, x in enumerate(self.bins[b]) for y in self.bins[b][:n]]
        return np.array(rows, np.int64).reshape(-1, 2)

    def drain(self, a: int, pairs: bool) -> int:
        """Steps that take from bin a until it is empty or none is left; how many."""
        steps = 0
        while self.bins[a] and self.fill[a] < self.capacity:
            one = [[k] for k in self.bins[a]]
            found = self.move(a) or self.exchange(a, one, self.items[:, None])
            if not found and pairs:
                found = self.exchange(a, self.pairs_of([a]).tolist(), self.items[:, None]) or self.exchange(a, one, self.pairs)
            if not found:
                break
            steps += 1
        return steps

    def underfull(self) -> np.ndarray:
        return np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))

    def done(self) -> bool:
        """Whether no bin can be saved any more, whatever the steps."""
        return int((self.capacity - self.fill[self.underfull()]).sum()) < self.capacity

    def run(self, passes: int = 40) -> list[list[int]]:
        """Passes over the underfull bins, emptiest first; those with two-for-one and one-for-two follow when the others
        find nothing. A pass that makes no step is the last, and so is the ``passes``-th."""
        pairs = False
        for _ in range(passes):
            if self.done():
                break
            bins = self.underfull()
            self.pairs = self.pairs_of(bins.tolist()) if pairs else self.pairs
            steps = 0
            for a in bins[np.argsort(self.fill[bins], kind="stable")].tolist():
                steps += self.drain(a, pairs)
            if not steps and pairs:
                break
            pairs = not steps
        return [b for b in self.bins if b]


def pack(sizes: list[int], bins: list[list[int]], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of the items with these sizes: from the fewer of the bins given and of best fit, by local search."""
    fitted = best_fit(sizes, capacity)
    return Search(sizes, [list(b) for b in (fitted if len(fitted) < len(bins) else bins)], capacity).run()


def _round(bins: DataFrame, count: int, capacity: int, group: int) -> DataFrame:
    """Deal ``bins`` (parts: an array of their pieces) to groups and pack each; a row a sequence again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        column = table.column(0).combine_chunks()
        column = column if isinstance(column, pa.ListArray) else column.chunk(0)
        flat, ends = column.flatten(), np.cumsum([0, *column.value_lengths().to_pylist()])
        sizes = flat.field("length").to_pylist()
        packed = pack(sizes, [list(range(a, b)) for a, b in zip(ends, ends[1:], strict=False)], capacity)
        order = pa.array([k for b in packed for k in b], pa.int64())
        starts = pa.array(np.cumsum([0, *map(len, packed)]), pa.int32())
        fills = [sum(sizes[k] for k in b) for b in packed]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(starts, flat.take(order)), pa.array(fills, pa.int64()), pa.array([part * (1 << 32) + k for k in range(len(packed))], pa.int64())], names=["parts", "fill", "number"]
        )

    parts = max(1, -(-count // group))
    kind = bins.schema["parts"].dataType.simpleString()
    return in_arrow(bins.select("parts").repartition(parts), run, f"parts {kind}, fill long, number long")


def pack_sequences(cut: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``cut`` (of ``pieces``; its columns are kept, the table is read several times) with sequence_id and offset."""
    part = F.struct(*cut.columns)
    alone = cut.where(F.col("length") == capacity).select("*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    bins = cut.where(F.col("length") < capacity).select(F.array(part).alias("parts"))
    done, count, k = [], bins.count(), 0
    while count:
        now = stored(_round(bins, count, capacity, group), f"packed-{k}")
        total, left = now.agg(F.count("*"), F.count_if(F.col("fill") < capacity)).first()
        number = (F.col("number") * 64 + k) * 2
        last = count <= group or left == 0 or (k > 0 and total == count) or k == 31
        full = now if last else now.where(F.col("fill") == capacity)
        done.append(full.select("parts", number.alias("sequence_id")))
        if last:
            break
        bins, count, k = now.where(F.col("fill") < capacity).select("parts"), left, k + 1
    if not done:
        return alone
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    lengths = F.transform("parts", lambda x: x["length"])
    offsets = F.transform(lengths, lambda x, k: F.aggregate(F.slice(lengths, F.lit(1), k), F.lit(0).cast("long"), lambda s, y: s + y))
    packed = rows.select("sequence_id", F.explode(F.arrays_zip(F.col("parts").alias("part"), offsets.alias("offset"))).alias("x"))
    return packed.select(*(F.col("x.part")[c].alias(c) for c in cut.columns), "sequence_id", F.col("x.offset").alias("offset")).unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, group: int = GROUP, keep_ids: bool = False) -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32, sequence_id, offset (and the ids) of all pieces."""
    cut = stored(pieces(docs, tokenizer_path, id_col=id_col, text_col=text_col, capacity=capacity, end=end, keep_ids=keep_ids), "pieces")
    return pack_sequences(cut, capacity=capacity, group=group)


def default_tokenizer() -> str:
    """The public 50k byte-level vocabulary; the path is a parameter everywhere else."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves, of ``pack_documents(..., keep_ids=True)``: sequence_id, ids, and doc_ids by place."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("x"))
    return rows.select("sequence_id", F.flatten(F.col("x.ids")).alias("ids"), F.col("x.doc_id").alias("doc_ids"))
