"""Near copies against all pairs, and in the pipeline's stage."""

import itertools
import random
from collections import Counter

import corpus_pipeline
import numpy as np
from test_text_ops import DOC

from lodestone.llm import near_copies, simhash


def brute_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = sorted({brute_set(t) for _, t, *_ in rows}, key=sorted)
    root = {s: s for s in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if a & b and len(a & b) / len(a | b) >= 0.8:
            root[find(a)] = find(b)
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            r = find(brute_set(t))
            least[r] = min(i, least.get(r, i))
    return [(i, least.get(find(brute_set(t)))) for i, t, *_ in rows]


def planted():
    rnd = random.Random(3)
    vocab = ["".join(rnd.choices("abcdefghijé", k=rnd.randint(2, 8))) for _ in range(400)]
    base = rnd.choices(vocab, k=200)
    rows = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(5, 90))), "s", "n") for i in range(60)]
    rows += [(100, " ".join(base), "s", "n")]
    rows += [(101 + k, " ".join("new" if j in (20 + k, 120 + k) else w for j, w in enumerate(base)), "s", "n") for k in range(30)]  # two words of 200: 0.90
    rows += [(200 + k, " ".join(base[4 * k : 4 * k + 100]), "s", "n") for k in range(12)]  # a chain: only neighbours and the next are alike
    rows += [(300, " ".join("odd" if j % 20 == 3 else w for j, w in enumerate(base)), "s", "n")]  # far below 0.8
    rows += [(400, None, "s", "n"), (401, " \n", "s", "n"), (402, "one two", "s", "n"), (403, "ONE  two", "s", "n"), (404, "two one", "s", "n"), (None, rows[0][1], "s", "n"), rows[5]]
    return rows


def test_near_copies_against_all_pairs(spark):
    rows = planted()
    want = brute_components(rows)
    got = near_copies.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter(want)
    assert dict(want)[130] == 100 and dict(want)[211] == 200 and dict(want)[300] == 300


def test_pipeline_stage_drops_near_copies(spark, tmp_path):
    rows = [r for r in planted() if r[0] is not None]
    docs = spark.createDataFrame(rows, DOC)
    got = Counter(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect())
    assert got == Counter({c: 1 for _, c in brute_components(rows)})


def test_bands_meet_at_the_bound():
    rnd = np.random.default_rng(1)
    missed = 0
    for _ in range(300):
        h = rnd.integers(0, 1 << 64, 110, np.uint64)
        missed += not (near_copies.bands(h[:99]) == near_copies.bands(h[11:])).any()  # 88 of 110: 0.8
    assert missed == 0


def test_fingerprints_meet_by_their_tally(spark):
    """Fingerprints of at most four differing bits meet without a band in common; a tally under four never does."""
    rnd = np.random.default_rng(2)
    base = rnd.integers(0, 256, 8, np.uint8)
    near = []
    for _ in range(60):
        bits = np.unpackbits(base)
        bits[rnd.choice(64, 4, replace=False)] ^= 1
        near.append(np.packbits(bits))
    far = [np.concatenate([base[:3], base[3:] ^ 255]), np.concatenate([base[:5] ^ 255, base[5:]])]
    lucky = np.concatenate([base[:4], base[4:] ^ 255])  # 32 differing bits, and a tally of four
    prints = [int(x.view(np.int64)[0]) for x in [base, *near, *far, lucky]]
    rows = [(k, fp, [1000 + 32 * k + j for j in range(32)]) for k, fp in enumerate(prints)]
    met = {(r["hub"], r["node"]) for r in near_copies.meetings(spark.createDataFrame(rows, "node long, fp long, bands array<long>")).collect()}
    posted = {}
    for r in simhash.postings(spark.createDataFrame(rows, "node long, fp long, bands array<long>"), "node", 4).collect():
        posted.setdefault((r["free"], r["shared"]), set()).add(r["node"])
    shared = {p for group in posted.values() for p in itertools.combinations(sorted(group), 2)}
    byte = [np.frombuffer(np.int64(fp).tobytes(), np.uint8) for fp in prints]
    assert shared == {(a, b) for a, b in itertools.combinations(range(len(prints)), 2) if (byte[a] == byte[b]).sum() >= 4}
    around = {}
    for hub, n in met:
        around.setdefault(hub, {hub}).add(n)
    assert all(any({a, b} <= group for group in around.values()) for a, b in shared)
    assert all((0, k) in shared for k in range(1, 61)) and (0, 63) in shared and not {(0, 61), (0, 62)} & shared


def test_fingerprint_of_a_set():
    """Every set's bits are those of over half of its shingles, each once; no shingles, no bits."""
    h = near_copies.shingles(b"a b c d e f a b c d e f g")
    want = sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > len(h))
    assert simhash.majority(h) % (1 << 64) == want and simhash.majority(h[:0]) == 0


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOC)
    assert near_copies.near_duplicates(empty).count() == 0 and near_copies.keep_one(empty).columns == empty.columns


def test_blocks_of_a_hub_against_all_pairs(spark, monkeypatch):
    """Variants near and far from a common text, in many blocks and member parts."""
    monkeypatch.setattr(near_copies, "BLOCK", 400)
    monkeypatch.setattr(near_copies, "MEMBERS", 7)
    rnd = random.Random(8)
    vocab = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8))) for _ in range(500)]
    base, rows, texts = rnd.choices(vocab, k=150), [], []
    for k in range(90):
        text = list(rnd.choice(texts) if texts and k % 3 == 0 else base)
        for _ in range(rnd.choice([0, 1, 2, 3, 5, 7, 9])):
            text[rnd.randrange(150)] = rnd.choice(vocab)
        texts.append(text)
        rows.append((1000 - k, " ".join(text), "s", "n"))
    want = brute_components(rows)
    assert 3 < len({c for _, c in want}) < 80
    got = near_copies.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter(want)
