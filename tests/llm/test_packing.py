"""Packing: ids against the tokenizers library, pieces against plain cutting, sequences against their bound."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lodestone.llm import packing

PATH = packing.default_tokenizer()


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_tokenizers(plain):
    with open(PATH, encoding="utf-8") as f:
        encoder = packing.Encoder(f.read())
    assert encoder.ranked is not None
    rnd = random.Random(2)
    texts = ["", " ", "a  b", "x \n y", "\n\n", " a", "a ", "a\tb  \tc d 　 e", "it's 12ab!! we'll", "<|endoftext|> a", "a  <|endoftext|>b", "a\x1c b \x1d c", "é́ ü", "a\r\n\r\n b", "x" * 20_000, " " * 9_000 + "y"]
    texts += ["".join(rnd.choices(" \n\tab1'!\x1f\x85é中s😀ſ'", k=rnd.randint(0, 40))) for _ in range(4000)]
    assert encoder.encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_other_definitions_are_left_to_the_library():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = packing.Encoder(f.read())
    assert encoder.ranked is None and encoder.encode(["Some words"]) == encoder.whole(["Some words"])


@pytest.mark.parametrize(("low", "high", "near"), [(1, 1023, 1.01), (300, 380, 1.03), (200, 300, 1.01), (1, 80, 1.001)])
def test_search_comes_near_the_bound(low, high, near):
    rnd = random.Random(3)
    sizes = [rnd.randint(low, high) for _ in range(2000)]
    bins = packing.pack(sizes, [[k] for k in range(len(sizes))])
    assert sorted(k for b in bins for k in b) == list(range(len(sizes)))
    assert all(sum(sizes[k] for k in b) <= 1024 for b in bins)
    bound = max(-(-sum(sizes) // 1024), sum(s > 512 for s in sizes))
    assert len(bins) <= bound * near + 1
    assert len(bins) <= len(packing.best_fit(sizes, 1024))


def test_search_saves_sequences_that_best_fit_does_not():
    rnd = random.Random(4)
    sizes = [rnd.randint(300, 380) for _ in range(1200)]
    assert len(packing.pack(sizes, [[k] for k in range(len(sizes))])) < 0.95 * len(packing.best_fit(sizes, 1024))


def test_every_step_makes_the_squares_grow():
    rnd = random.Random(5)
    sizes = [rnd.randint(150, 550) for _ in range(300)]
    search = packing.Search(sizes, packing.best_fit(sizes, 1024), 1024)
    shift, seen = search.shift, []
    search.shift = lambda *a: (shift(*a), seen.append(int((search.fill**2).sum())))
    start = int((search.fill**2).sum())
    search.run()
    assert len(seen) > 3 and all(b > a for a, b in zip([start, *seen], seen, strict=False))


@pytest.mark.parametrize("group", [packing.GROUP, 40])
def test_pieces_and_sequences(spark, plain, group):
    rnd = random.Random(7)
    vocab = ["".join(rnd.choices("abcdefghé", k=rnd.randint(1, 8))) for _ in range(300)]
    para = lambda n: " ".join(rnd.choices(vocab, k=n))
    rows = [(i, para(rnd.randint(1, 400)), "x") for i in range(150)] + [(200, None, "x"), (201, "", None), (202, " \n", "y"), (203, para(9000), "y"), (204, "a" * 1023 * 8, "y"), (205, rows_text := para(50), "y"), (205, rows_text, "y"), (None, para(30), "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)
    got = packing.pack_documents(df, PATH, group=group, keep_ids=True)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    out = got.collect()
    want = []
    for doc_id, text, _ in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        at = [0, *range(first, len(ids), 1024)]
        want += [(doc_id, k, a, len(part := ids[a : b]), zlib.crc32(np.array(part, "<u4").tobytes()), part) for k, (a, b) in enumerate(zip(at, [*at[1:], len(ids)], strict=True))]
    key = lambda r: (str(r[0]), r[1])
    assert sorted((tuple(r)[:6] for r in out), key=key) == sorted(want, key=key)
    by = defaultdict(list)
    for r in out:
        by[r["sequence_id"]].append((r["offset"], r["length"], r["ids"]))
    for parts in by.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(p[1] for p in parts[:k]) for k in range(len(parts))] and sum(p[1] for p in parts) <= 1024
    assert len(by) <= -(-sum(r["length"] for r in out) // 1024) + 1 + (group < 1000)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(got).collect()}
    assert sorted(whole.values()) == sorted([x for p in parts for x in p[2]] for parts in by.values())


def test_all_rows_alike_and_an_empty_table(spark):
    same = spark.createDataFrame([(None, "")] * 3000, "doc_id long, text string")
    out = packing.pack_documents(same, PATH, group=500).groupBy("sequence_id").agg({"length": "sum", "offset": "max"}).collect()
    assert len(out) == 3 and max(r["sum(length)"] for r in out) == 1024
    assert packing.pack_documents(spark.createDataFrame([], "doc_id int, text string"), PATH).count() == 0
