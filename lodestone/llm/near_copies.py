"""Near copies by exact similarity of word shingles: SimHash over an index of positional bytes with count filtering, an
index of set minima for what its bits can't show, and verification.

Two texts are near copies when the Jaccard similarity of their sets of five-word shingles is at least 0.8. The set's 64-bit
SimHash is posted by ``simhash.postings`` under each choice of four of its eight positional bytes (70): texts whose
fingerprints differ in at most four bits share four bytes or more and always meet, and pairs with a lower tally never do. No
bound on 64 bits reaches 0.8, where about ten bits differ and a tally of four is met by 14 % of the pairs. So the rest is met
in a second index: of 160 positions, each the least of one hash over the set, in 32 bands of five. A pair of similarity 0.8
meets in no band with probability 3e-6, a closer pair more rarely. Every link of either index is verified on the whole
sets, and pairs below 0.8 are never linked.

All pairs that meet are settled, but none are formed. The texts of a posting or band gather round a hub, the one that meets
most others over all of them, and a text is stored as its difference from the hub's set. The size of the difference settles
hub and text. Texts that this leaves in other components than the hub's are then held against all of the hub's texts by tallying
shared elements of their differences, in blocks of bounded size: the sizes of the two sets, of the hub's and the tally give
the exact similarity. Only links between components leave a block.

Equal sets are one node. Defined cases: null or empty text, or text of white space only, has the empty set and is linked
to its like only; fewer than five words are one shingle; repeated rows have equal results; rows with a null id take part,
but a null is never a component's id unless its rows have no other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import broadcast_if, byte_texts, in_arrow, join_hot, map_arrow, stored
from .components import components

SEED, SHINGLE, SIMILARITY = 42, 5, 0.8
#: Fingerprints with as many differing bits meet for certain.
MAX_BITS = 4
BANDS, ROWS = 32, 5
#: Elements of a block, and members of a hub that one task holds against it.
BLOCK, MEMBERS = 1 << 19, 512
_PIECE = 1 << 12
_draw = np.random.default_rng(SEED)
_ODD = _draw.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_MIX = _draw.integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)
_BAND = _draw.integers(0, 1 << 64, BANDS, np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a UTF-8 text's shingles."""
    w = text.lower().split()  # of bytes: A-Z only, and the six ASCII spaces only
    if not w:
        return np.zeros(0, np.uint64)
    runs = map(b" ".join, zip(*(w[k:] for k in range(SHINGLE)), strict=False)) if len(w) >= SHINGLE else [b" ".join(w)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in runs), np.uint64))


def bands(hashes: np.ndarray) -> np.ndarray:
    """A key a band, different from band to band."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), _PIECE):
        np.minimum(least, (hashes[k : k + _PIECE, None] * _ODD).min(axis=0), out=least)
    return ((least.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64) ^ _BAND).view(np.int64)


def node(hashes: np.ndarray) -> int:
    """The name of a set, as a signed 64-bit number."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row a document: doc_id, the hash of its text, the node of its set, and the node's fingerprint and bands."""

    def each(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t) for t in byte_texts(batch.column(2))]
        return {"doc_id": batch.column(0), "text_hash": batch.column(1), "node": [node(s) for s in sets], "fp": [simhash.majority(s) for s in sets], "bands": [bands(s) for s in sets]}

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(_text(text_col)).alias("text_hash"), F.col(text_col).alias("_text"))
    return map_arrow(rows, f"doc_id {dict(docs.dtypes)[id_col]}, text_hash long, node long, fp long, bands array<long>", each)


def meetings(nodes: DataFrame) -> DataFrame:
    """Rows (hub, node), different: every two nodes with a posting or band in common have a hub in common, or one is the
    other's."""
    printed = simhash.postings(nodes, "node", MAX_BITS).select("node", F.xxhash64("free", "shared").alias("key"))
    posted = printed.unionByName(nodes.select("node", F.explode("bands").alias("key")))
    sizes = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(posted.join(sizes, "key"), "met")
    weight = met.groupBy("node").agg(F.sum(F.col("n") - 1).alias("weight"))
    hubs = met.select("key", "node").join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("_hub"))
    pairs = met.select("key", "node").join(hubs.select("key", F.col("_hub.node").alias("hub")), "key")
    return pairs.where("hub <> node").select("hub", "node").distinct()


def node_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (node, hashes) of the nodes in ``wanted`` (doc_id, text_hash of one document of each): packed 64-bit numbers."""
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(_text(text_col)).alias("_hash"), _text(text_col).alias("_text"))
    wanted = broadcast_if(wanted, 2_000_000)
    texts = texts.join(wanted, texts["_id"].eqNullSafe(wanted["doc_id"]) & (texts["_hash"] == wanted["text_hash"]), "left_semi")
    texts = texts.groupBy("_hash").agg(F.min("_text").alias("_text"))

    def each(batch: pa.RecordBatch) -> dict:
        found = [shingles(t) for t in byte_texts(batch.column(0))]
        return {"node": [node(s) for s in found], "hashes": [s.tobytes() for s in found]}

    return map_arrow(texts.select("_text"), "node long, hashes binary", each)


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (hub, node, size, hub_size, missing, diff): the size of the sets, how many of the hub's elements the node's
    lacks, and the packed elements that only one of them has; hubs are nodes of their own with nothing in it."""
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(MEMBERS)).cast("int").alias("parts"))
    dealt = join_hot(pairs, parts, "hub", F.col("node")).select("hub", "node", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    hubs = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).withColumn("node", F.col("hub"))
    rows = dealt.unionByName(hubs).join(sets, "node").withColumn("other", F.col("hub") != F.col("node"))
    shuffles = max(8, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(shuffles, "hub", "part").sortWithinPartitions("hub", "part", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = own = None
        for batch in batches:
            out = [[], [], [], [], [], []]
            for h, p, n, packed in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                here = np.frombuffer(packed, np.uint64)
                if h == n:  # the hub's row is the first of its part
                    hub, own = h, here
                    if p:
                        continue
                assert hub == h
                diff = np.setxor1d(own, here, assume_unique=True)
                missing = (len(diff) + len(own) - len(here)) // 2
                for column, value in zip(out, (h, n, len(here), len(own), missing, diff.tobytes()), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["hub", "node", "size", "hub_size", "missing", "diff"])

    return in_arrow(rows.select("hub", "part", "node", "hashes"), run, "hub long, node long, size int, hub_size int, missing int, diff binary")


def similar(common: np.ndarray | Column, both: np.ndarray | Column, similarity: float):
    """Whether sets of ``both`` elements together have enough of them in common."""
    return common / (both - common) >= similarity


def tallied(us: list[tuple], ns: list[tuple], hub_size: int, similarity: float) -> list[tuple[int, int]]:
    """Links between rows (node, root, size, missing, diff) of different roots, as few as connect what they connect."""
    who = lambda rows: np.repeat(np.arange(len(rows)), [len(r[4]) for r in rows])
    left, right = np.concatenate([r[4] for r in us]), np.concatenate([r[4] for r in ns])
    shared = np.intersect1d(left, right)
    tally = np.zeros((len(us), len(ns)), np.float32)
    places = []
    for elements, rows in ((left, us), (right, ns)):
        inside = np.isin(elements, shared)
        places.append((np.searchsorted(shared, elements[inside]), who(rows)[inside]))
    for k in range(0, len(shared), 1024):
        sides = []
        for (element, owner), n in zip(places, (len(us), len(ns)), strict=True):
            here = (element >= k) & (element < k + 1024)
            side = np.zeros((n, min(1024, len(shared) - k)), np.float32)
            side[owner[here], element[here] - k] = 1
            sides.append(side)
        tally += sides[0] @ sides[1].T
    column = lambda rows, c: np.array([r[c] for r in rows], np.int64)
    common = hub_size - column(us, 3)[:, None] - column(ns, 3) + tally.astype(np.int64)
    both = column(us, 2)[:, None] + column(ns, 2)
    a, b = np.nonzero(similar(common, both, similarity) & (column(us, 1)[:, None] != column(ns, 1)))
    root, out = {}, []

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(us[i][1]), find(ns[j][1])
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((us[i][0], ns[j][0]))
    return out


def apart(parts: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Links (u, v) between nodes of one hub that are in different components so far."""
    rows = parts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    weight = F.length("diff") / 8 + 16
    roots = rows.groupBy("hub", "root").agg(F.sum(weight).alias("_w"), F.max(F.col("hub") == F.col("node")).alias("_hub"))
    sums = roots.groupBy("hub").agg(F.max(F.when(F.col("_hub"), F.col("root"))).alias("main"), F.sum("_w").alias("_all"), F.sum(F.when(~F.col("_hub"), F.col("_w"))).alias("_other"))
    blocks = lambda c: F.ceil(F.col(c) / F.lit(BLOCK)).cast("int")
    sums = sums.where("_other > 0").select("hub", "main", blocks("_all").alias("_nb"), blocks("_other").alias("_ub"))
    rows = join_hot(rows, sums, "hub", F.col("node")).withColumn("other", F.col("root") != F.col("main"))
    place = F.xxhash64("node", "hub")
    of = lambda n: F.pmod(place, F.col(n)).cast("int")
    as_other = F.when(F.col("other"), F.transform(F.sequence(F.lit(0), F.col("_nb") - 1), lambda j: F.struct(of("_ub").alias("i"), j.alias("j"), F.lit(True).alias("u"))))
    as_any = F.transform(F.sequence(F.lit(0), F.col("_ub") - 1), lambda i: F.struct(i.alias("i"), of("_nb").alias("j"), F.lit(False).alias("u")))
    tasks = F.concat(as_any, F.coalesce(as_other, F.array().cast("array<struct<i:int,j:int,u:boolean>>")))
    rows = rows.select("hub", "hub_size", "node", "root", "size", "missing", "diff", F.explode(tasks).alias("_t")).select("hub", "_t.*", "hub_size", "node", "root", "size", "missing", "diff")
    shuffles = max(8, int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(shuffles, "hub", "i", "j").sortWithinPartitions("hub", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, us, ns = None, [], []

        def solved(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(2)], names=["u", "v"])

        for batch in batches:
            for h, i, j, u, hub_size, *row, diff in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if task != (h, i, j, hub_size):
                    if us and ns:
                        yield solved(tallied(us, ns, task[3], similarity))
                    task, us, ns = (h, i, j, hub_size), [], []
                (us if u else ns).append((*row, np.frombuffer(diff, np.uint64)))
        if us and ns:
            yield solved(tallied(us, ns, task[3], similarity))

    return in_arrow(rows, run, "u long, v long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Rows doc_id, component_id: the smallest doc_id reachable over links of at least ``similarity``."""
    signed = stored(signatures(docs, id_col, text_col), "signatures")
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_hash")).alias("_one"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    nodes = stored(nodes.select("node", "least", "_one.doc_id", "_one.text_hash", "fp", "bands"), "nodes")
    pairs = stored(meetings(nodes), "meetings")
    named = pairs.select("node").union(pairs.select("hub")).distinct()
    wanted = nodes.select("node", "doc_id", "text_hash").join(named, "node", "left_semi").select("doc_id", "text_hash")
    sets = stored(node_sets(docs, wanted, id_col, text_col), "sets")
    parts = stored(differences(pairs, sets), "differences")
    links = parts.where(similar(F.col("hub_size") - F.col("missing"), F.col("hub_size") + F.col("size"), similarity) & (F.col("hub") != F.col("node"))).select(F.col("hub").alias("u"), F.col("node").alias("v"))
    links = stored(links, "links")
    links = links.unionByName(apart(parts, components(links), similarity))

    rooted = nodes.select("node", "least").join(components(links), "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    rooted = stored(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("_n"))
    # Only nodes in components of two or more need the second join; for the others the id is their own least.
    linked = rooted.join(least.where("_n > 1"), "root").select("node", "component_id")
    ids = rooted.join(linked, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id"))
    return join_hot(signed.select("doc_id", "node"), ids, "node", F.col("doc_id")).select("doc_id", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, broadcast_ids: int = 5_000_000) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id, one row of it. Rows without an id stay."""
    return simhash.keep_least(docs, near_duplicates(docs, id_col=id_col, text_col=text_col, similarity=similarity), id_col=id_col, broadcast_ids=broadcast_ids)
