"""Dictionaries: segmentation and terms against brute force, and a small WordNet."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestone.functions import dictionary as D
from lodestone.functions import wordnet as W

WORDS = {"中国": 3000, "人民": 2500, "中国人": 900, "国人": 40, "民": 100, "人": 5000, "银行": 2000, "中国人民银行": 150, "研究": 3000, "研究生": 800, "生命": 1500, "命": 300, "起源": 700, "的": 90000, "科学": 2000, "科学研究": 60}


def test_best_path_is_the_best_of_all_paths():
    rnd = random.Random(1)
    for _ in range(400):
        words = {"".join(rnd.choices("中国人民", k=rnd.randint(1, 4))): rnd.choice([1, 50, 400, 3000, 90000, 5_000_000]) for _ in range(rnd.randint(0, 9))}
        trie = D.Trie({w: D.frequency(n) for w, n in words.items()})
        run = "".join(rnd.choices("中国人民银", k=rnd.randint(1, 9)))
        got = D.segment_run(run, trie)
        assert "".join(got) == run
        places = D.cuts(trie.edges(run))
        ends = [sum(map(len, got[: k + 1])) for k in range(len(got))]
        score = lambda w: D.FEWER / len(w) + sum(len(x) > 1 for x in w) / len(w) + sum(trie.words.get(x, D.UNKNOWN) for x in w)  # noqa: B023, E731
        for a, b in zip(places, places[1:], strict=False):
            mine = [w for w, e in zip(got, ends, strict=True) if a < e <= b]
            best = D.all_paths(run[a:b], trie)[0]
            assert "".join(mine) == run[a:b] and abs(score(mine) - score(best)) < 1e-6 and len(mine) == len(best)


def test_segmentation(spark):
    df = spark.createDataFrame([(1, "中国人民银行 Research研究生命的起源, 2024年!"), (2, None), (3, ""), (4, "plain Words_only")], "id long, text string")
    out = df.select("id", D.segmented(F.col("text"), WORDS, spark).alias("t"), D.segmented(F.col("text"), WORDS, spark, fine_grained=True).alias("f")).orderBy("id").collect()
    assert "".join(out[0]["t"]) == "中国人民银行research研究生命的起源2024年"
    assert out[0]["t"][0] == "中国人民银行" and "research" in out[0]["t"] and "2024" in out[0]["t"]
    assert len(out[0]["f"]) > len(out[0]["t"]) and "".join(out[0]["f"]) == "".join(out[0]["t"])
    assert [r["t"] for r in out[1:]] == [[], [], ["plain", "words", "only"]]


def test_long_runs_are_segmented_in_proportion():
    import time

    trie = D.Trie({w: D.frequency(n) for w, n in WORDS.items()})
    t = time.time()
    assert "".join(D.segment_run("中国人民银行的研究生命起源" * 3000, trie)) == "中国人民银行的研究生命起源" * 3000
    assert time.time() - t < 30


def brute_spans(text, terms):
    low, out, at = D._plain(text), [], 0
    while at < len(low):
        fits = [t for t in terms if low.startswith(t, at) and not (at and D._edge(low[at]) and D._edge(low[at - 1])) and not (at + len(t) < len(low) and D._edge(low[at + len(t) - 1]) and D._edge(low[at + len(t)]))]
        if fits:
            n = max(map(len, fits))
            out.append((at, at + n))
            at += n
        else:
            at += 1
    return out


def test_spans_are_leftmost_longest():
    rnd = random.Random(2)
    for _ in range(600):
        terms = {"".join(rnd.choices("ab 中", k=rnd.randint(1, 5))).strip() for _ in range(6)} - {""}
        text = "".join(rnd.choices("aAb  中İ.", k=rnd.randint(0, 30)))
        assert D.spans(text, D.automaton(sorted(terms))) == brute_spans(text, sorted(terms))


@pytest.mark.parametrize("most", [D.AUTOMATON, 3])
def test_terms_of_a_large_dictionary(spark, most):
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 5))) for _ in range(3000)]
    terms = [" ".join(rnd.choices(words, k=rnd.randint(1, 3))) for _ in range(100_000 if most > 3 else 4000)]
    rows = [(i, " ".join(rnd.choices(words, k=60)) + (" Zürich-West" if i % 9 == 0 else "")) for i in range(60)] + [(100, None), (101, ""), (None, terms[0] + " " + terms[0].upper())]
    terms += ["zürich-west", "zürich"]
    df, dictionary = spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([(t,) for t in terms], "term string")
    got = sorted((str(r["doc_id"]), r["start"], r["end"], r["term"], r["found"]) for r in D.find_terms(df, "id", "text", dictionary, most).collect())
    known = set(terms)
    want = []
    for i, text in rows:
        low, bounds = D._plain(text or ""), [m.span() for m in re.finditer(r"[^\W_]+", D._plain(text or ""))]
        at = 0
        for k, (a, _) in enumerate(bounds):
            fits = [bounds[j][1] for j in range(k, min(k + 6, len(bounds))) if low[a : bounds[j][1]] in known]
            if a >= at and fits:
                want.append((str(i), a, max(fits), low[a : max(fits)], text[a : max(fits)]))
                at = max(fits)
    assert got == sorted(want) and len(got) > 100


# --- WordNet ---------------------------------------------------------------------------------------------------------

INDEX = "  1 a licence line\ndog n 2 1 @ 2 1 00000010 00000020  \nwolf n 1 0 1 0 00000030\nman n 1 0 1 0 00000040  \ncanine n 1 1 @ 1 0 00000050\nhot_dog n 1 0 1 0 00000020\n"
DATA = (
    "  1 a licence line\n00000010 03 n 02 dog 0 domestic_dog 0 001 @ 00000050 n 0000 | a member of the genus\n00000020 03 n 02 hot_dog 0 dog 1 000 | a sausage\n"
    "00000030 03 n 01 wolf 0 001 @ 00000050 n 0000 | wild\n00000040 03 n 01 man 0 000 | adult\n00000050 03 n 01 canine 0 001 @ 00000060 n 0000 | mammal\n00000060 03 n 01 animal 0 000 | living\n"
)


@pytest.fixture(scope="module")
def net(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("net")
    for pos, name in W.FILES.items():
        (at / f"index.{name}").write_text(INDEX if pos == "n" else "run v 1 0 1 0 00000070\nrune v 1 0 1 0 00000070\n" if pos == "v" else "")
        (at / f"data.{name}").write_text(DATA if pos == "n" else "00000070 30 v 01 run 0 000 | move\n" if pos == "v" else "")
        (at / f"{name}.exc").write_text("ran run\n" if pos == "v" else "wolves wolf\n" if pos == "n" else "")
    return W.read(spark, f"file://{at}")


def test_morphy(spark, net):
    words = spark.createDataFrame([("Dogs",), ("wolves",), ("men",), ("ran",), ("runed",), ("nothing",), (None,), ("dogs",)], "w string")
    got = {(r["word"], r["pos"], r["form"]) for r in W.morphy(words, "w", net).collect()}
    assert got == {("dogs", "n", "dog"), ("wolves", "n", "wolf"), ("men", "n", "man"), ("ran", "v", "run"), ("runed", "v", "rune"), ("runed", "v", "run")}


def test_synsets_synonyms_and_closure(spark, net):
    words = spark.createDataFrame([("dogs",), ("wolves",)], "w string")
    assert {(r["word"], r["synset"], r["sense"]) for r in W.synsets(words, "w", net).collect()} == {("dogs", "n10", 1), ("dogs", "n20", 2), ("wolves", "n30", 1)}
    assert {r["word"]: r["synonyms"] for r in W.synonyms(words, "w", net).collect()} == {"dogs": ["domestic dog", "hot dog"]}
    walked = {(r["synset"], r["ancestor"], r["depth"]) for r in W.closure(W.synsets(words, "w", net), net).collect()}
    assert walked == {("n10", "n10", 0), ("n10", "n50", 1), ("n10", "n60", 2), ("n20", "n20", 0), ("n30", "n30", 0), ("n30", "n50", 1), ("n30", "n60", 2)}


def test_resume_fields(spark):
    from lodestone.sources import parsers

    rows = [(1, "Jo Doe, jo.doe@mail.org, +49 170 1234567, 7 years. Technical University of Munich, PhD; Java, javascript"), (2, None), (3, "Universities")]
    words = {"school": ["Technical University", "Technical University of Munich", "university"], "skill": ["java", "JavaScript", "c++"]}
    got = {r["doc_id"]: r for r in parsers.resume_fields(spark.createDataFrame(rows, "id long, text string"), "id", "text", words).collect()}
    assert got[1]["email"] == "jo.doe@mail.org" and got[1]["years"] == 7 and got[1]["school"] == ["technical university of munich"] and got[1]["skill"] == ["java", "javascript"]
    assert got[2]["school"] == [] and got[3]["school"] == []
