"""Spelling variants against a version that tries every letter at every place."""

import random
import re
import zlib
from collections import Counter

import pytest

from lodestone.llm import spelling


def brute_words(rows, least_length=6, least_count=5):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= least_length:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= least_count}


def brute_variants(n, ratio=5):
    letters = sorted({x for w in n for x in w})
    near = {}
    for w in n:
        near[w] = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + x + w[i + j :] for x in letters for j in (0, 1) for i in range(len(w) + 1 - j)}
        near[w] = [x for x in near[w] if x != w and x in n]
    best = {w: min(near[w], key=lambda x: (-n[x], x)) if near[w] else None for w in n}
    form = {w: b if b and n[b] >= ratio * n[w] else None for w, b in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    base = ["".join(rnd.choices("abé", k=rnd.randint(5, 8))) for _ in range(80)] + ["Straße", "ÀÉÎõüÿ", "aaaaaaa", "abcdef", "fedcba", "abcedf", "x×÷yzab"]
    rows = []
    for i in range(600):
        words = [rnd.choice(base[: 1 + rnd.randrange(len(base))]) for _ in range(rnd.randint(0, 60))]
        for k in range(len(words)):
            if rnd.random() < 0.2:
                at, w = rnd.randrange(len(words[k])), words[k]
                words[k] = rnd.choice([w[:at] + w[at + 1 :], w[:at] + rnd.choice("abcé") + w[at:], w[:at] + rnd.choice("abcé") + w[at + 1 :], w.upper()])
        rows.append((i, "_ 1,\n"[i % 5].join(words), "x"))
    rows += [(700, None, "x"), (701, "", None), (702, " 12 \n", "x"), (703, rows[3][1], "x"), (703, rows[3][1], "x"), (None, rows[4][1], None), (704, "abcdef " * 30_000, "x"), (705, "z" * 5000, "x")]
    return rows


def test_words_and_variants(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, word string").repartition(3)
    words = spelling.altered_words(df)
    want = brute_words([r[:2] for r in rows])
    assert {r["word"]: r["n"] for r in words.collect()} == want
    got = spelling.variants(words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute_variants(want)
    assert sorted(map(tuple, got.collect())) == expected
    assert sum(r[1] is not None and r[2] != r[1] for r in expected) > 0 and max(r[4] for r in expected) > 5


def test_plain_counts(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, _raw string")
    want = brute_words([(None, r[1]) for r in rows], 4, 2)
    assert {r["word"]: r["n"] for r in spelling.word_counts(df, least_length=4, least_count=2).collect()} == want


def test_every_letter_and_long_chains(spark):
    rnd = random.Random(3)
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    n = {f"stand{x}": 5 for x in letters} | {"standx": 900, "standxy": 4500, "standx" + "y" * 9: 3}
    chain, count = "abcdefgh", 1
    for k in range(20):  # each five times the one before, one letter longer
        n[chain + "xyz"[k % 3] * k] = count
        chain, count = chain, count * 5
    n |= {"".join(rnd.choices("ab", k=6)): rnd.randint(1, 40) for _ in range(60)}
    n |= {"".join(rnd.sample("abcdefg", 7)): rnd.randint(1, 9) for _ in range(400)}  # one class of anagrams
    df = spark.createDataFrame(sorted(n.items()), "word string, n long")
    assert sorted(map(tuple, spelling.variants(df).collect())) == brute_variants(n)


def test_chain_of_forms(spark):
    words = [("abcdef" + "x" * k, 5 * 5**k) for k in range(20)]
    got = {r["word"]: r["root"] for r in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert set(got.values()) == {words[-1][0]}


def test_keys_are_sums_of_powers(spark):
    words = spark.createDataFrame([("abcé", 1), ("bacé", 2), ("abc", 3)], "word string, n long")
    key = {r["word"]: r["key"] for r in spelling.postings(words).where("place < 0").collect()}
    assert key["abcé"] == key["bacé"] == sum(ord(x) ** 5 for x in "abcé") and key["abcé"] - key["abc"] == ord("é") ** 5


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.altered_words(docs)).count() == 0
