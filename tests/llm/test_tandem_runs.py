"""Periodic runs of words against a brute-force version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lodestone.llm import tandem, tandem_runs


def brute_runs(w, least):
    """Runs (start, length, period) by trying every period."""
    period = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q:
                period.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in period.items() if b - a >= max(least, 2 * q)), key=lambda r: (r[0], r[2]))


def plant(doc_id, w):
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_runs_of_words_over_small_alphabets():
    rnd = random.Random(5)
    for _ in range(1200):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            w = [rnd.choice("abcd"[: rnd.randint(1, 4)]) for _ in range(rnd.randint(0, 60))]
            if w and rnd.random() < 0.5:
                a = rnd.randrange(len(w))
                p = 1 + rnd.randrange(max(1, (len(w) - a) // 2))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            texts.append(w + w[rnd.randrange(len(w) + 1) :] + w if rnd.random() < 0.3 else w)
        for least in (0, 12):
            assert [[tuple(r) for r in x.tolist()] for x in tandem.runs_of_texts(texts, least)] == [brute_runs(w, least) for w in texts]


@pytest.mark.parametrize("word", ["a" * 1500, "ab" * 400 + "c" + "ab" * 400, "aab" * 200 + "abab" * 150])
def test_highly_periodic_texts(word):
    assert [tuple(r) for r in tandem.runs_of_texts([list(word)], 0)[0].tolist()] == brute_runs(word, 0)


def test_fibonacci_word():
    a, b = "a", "ab"
    while len(b) < 700:
        a, b = b, b + a
    assert [tuple(r) for r in tandem.runs_of_texts([list(b)], 0)[0].tolist()] == brute_runs(b, 0)


def test_long_texts_take_time_in_proportion():
    import time

    rnd = random.Random(1)
    text = [str(rnd.randrange(50)) for _ in range(150_000)] + ["x", "y", "z"] * 50_000
    t = time.time()
    assert (150_000, 150_000, 3) in [tuple(r) for r in tandem.runs_of_texts([text])[0].tolist()]
    assert time.time() - t < 20


def test_query_against_brute_force(spark):
    rnd = random.Random(6)
    vocab = ["".join(rnd.choices("abcé", k=rnd.randint(1, 3))) for _ in range(60)]
    rows = [(i, " \t\n"[i % 3].join(rnd.choices(vocab, k=rnd.randint(1, 300))), "x") for i in range(400)]
    rows += [(500, None, "x"), (501, "", None), (502, " \n\x0b", "y"), (503, rows[9][1], "y"), (503, rows[9][1], "y"), (None, "a b " * 20, "z"), (504, "ha " * 4000, "q"), (505, "\x85 　   " * 8, "q")]
    rows += [(i, "", "e") for i in range(600, 640)] + [(i, None, "e") for i in range(640, 680)] + [(i, "one", "e") for i in range(680, 720)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = tandem_runs.digests(tandem_runs.collapse(df.repartition(3), text_col=tandem_runs.planted(F.col("doc_id"), F.col("text")))).collect()
    want = []
    for doc_id, text, _ in rows:
        w = plant(doc_id, (text or "").encode().split())
        runs = brute_runs(w, 12)
        gone = {k for a, n, q in runs for k in range(a + q, a + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        digest = lambda x: hashlib.sha256(x).hexdigest()
        want.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join("%d,%d,%d\n" % r for r in runs).encode()), digest(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in want) > 20


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    out = tandem_runs.collapse(empty)
    assert out.count() == 0 and tandem_runs.digests(out).columns[-1] == "collapsed_sha256"
