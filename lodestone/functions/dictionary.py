"""Work over dictionaries that the user gives: segmentation of text without blanks, and terms found with their spans.

Segmentation. A run of Han characters is parted where no word of the dictionary crosses; between such places the best of
all ways to cut it into words and single characters is taken. Of T tokens with the frequencies f its score is 30 / T, plus
the share of tokens of two characters or more, plus the sum of f; a character that is no word has f = -12. Frequencies are
logarithms, as a dictionary of counts is read: the nearest whole number to ln(count / 1,000,000). The best way for every T
comes from a dynamic programme over the words that end at each place, found in a trie. Ties go to fewer tokens, then to the
longer first word. The rest of a text is lower-cased runs of letters and digits.

Terms. Aho-Corasick finds every place of every term in one pass over a text; of those that overlap the leftmost stay, of
these the longest. A term that begins or ends with a letter or digit that isn't Han matches at the border of a word only.
The automaton is shipped once to each worker process; beyond ``AUTOMATON`` terms the dictionary is a table instead, and
terms meet the n-grams of the words of a text, for the lengths that the dictionary has, in a join.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the score.
FEWER, UNKNOWN, UNIT = 30.0, -12, 1_000_000
AUTOMATON = 1_000_000
_HAN = re.compile("[㐀-䶿一-鿿豈-﫿]+")
_PARTS = re.compile(f"({_HAN.pattern})|([^\\W_]+)")


def frequency(count: float) -> int:
    return int(math.floor(math.log(max(count, 1e-300) / UNIT) + 0.5))


class Trie:
    """Words with their frequencies, by character."""

    def __init__(self, words: dict[str, int]) -> None:
        self.root: dict = {}
        self.words = words
        for w, f in words.items():
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = f

    def ends(self, text: str, start: int) -> Iterator[tuple[int, int]]:
        """(end, frequency) of the words that start here."""
        node = self.root
        for k in range(start, len(text)):
            node = node.get(text[k])
            if node is None:
                return
            if "" in node:
                yield k + 1, node[""]

    def edges(self, run: str) -> list[list[tuple[int, int]]]:
        """For each place the (end, frequency) of the tokens that may start there."""
        out = []
        for k in range(len(run)):
            found = list(self.ends(run, k))
            out.append(found if found and found[0][0] == k + 1 else [(k + 1, UNKNOWN), *found])
        return out


def cuts(edges: list[list[tuple[int, int]]]) -> list[int]:
    """Places that no token crosses, from 0 to the end."""
    out, far = [0], 0
    for k, ends in enumerate(edges):
        far = max(far, ends[-1][0])
        if far == k + 1:
            out.append(k + 1)
    return out


def best_path(edges: list[list[tuple[int, int]]], start: int, stop: int) -> list[int]:
    """Ends of the tokens of the best way from ``start`` to ``stop``.

    Frequencies add up, the share of longer tokens is their number over T: for a given T both are a sum over tokens. So the
    table has, for each place and number of tokens, the ways that no other beats in both sums."""
    n = stop - start
    # table[place][tokens] = list of (sum of f, longer tokens, -first length, ends so far), none beaten by another
    table: list[dict[int, list[tuple[int, int, int, tuple[int, ...]]]]] = [{} for _ in range(n + 1)]
    table[0][0] = [(0, 0, 0, ())]
    for k in range(n):
        for t, ways in table[k].items():
            for end, f in edges[start + k]:
                at = table[end - start].setdefault(t + 1, [])
                for total, longer, first, ends in ways:
                    new = (total + f, longer + (end - start - k > 1), first or -(end - start), (*ends, end))
                    if any(x[0] >= new[0] and x[1] >= new[1] and x[2] <= new[2] for x in at):
                        continue
                    at[:] = [x for x in at if not (new[0] >= x[0] and new[1] >= x[1] and new[2] <= x[2])]
                    at.append(new)
        table[k] = {}
    score = lambda t, way: FEWER / t + way[1] / t + way[0]
    return list(min(((-round(score(t, w), 9), t, w[2], w[3]) for t, ways in table[n].items() for w in ways))[3])


def segment_run(run: str, trie: Trie) -> list[str]:
    edges = trie.edges(run)
    out, places = [], cuts(edges)
    for a, b in zip(places, places[1:], strict=False):
        at = a
        for end in best_path(edges, a, b) if b - a > 1 else [b]:
            out.append(run[at:end])
            at = end
    return out


def segment(text: str | None, trie: Trie) -> list[str]:
    """The tokens of a text: words of Han runs by the dictionary, lower-cased runs of other letters and digits."""
    out: list[str] = []
    for m in _PARTS.finditer(text or ""):
        if m[1]:
            out += segment_run(m[1], trie)
            continue
        at = 0
        for han in _HAN.finditer(m[2]):  # letters and Han characters side by side
            out += [m[2][at : han.start()].lower()] if at < han.start() else []
            out += segment_run(han[0], trie)
            at = han.end()
        out += [m[2][at:].lower()] if at < len(m[2]) else []
    return out


def all_paths(run: str, trie: Trie) -> list[list[str]]:
    """Every way to cut a short run, best first."""
    edges = trie.edges(run)

    def ways(at: int) -> list[list[tuple[str, int]]]:
        if at == len(run):
            return [[]]
        return [[(run[at:end], f), *rest] for end, f in edges[at] for rest in ways(end)]

    score = lambda w: FEWER / len(w) + sum(len(x) > 1 for x, _ in w) / len(w) + sum(f for _, f in w)
    return [[x for x, _ in w] for w in sorted(ways(0), key=lambda w: (-round(score(w), 9), len(w), -len(w[0][0]), [x for x, _ in w]))]


def fine(token: str, trie: Trie) -> list[str]:
    """A Han token of 3 to 10 characters cut by its second-best way, unless that is characters alone; others as they are."""
    if not 3 <= len(token) <= 10 or not _HAN.fullmatch(token):
        return [token]
    ways = all_paths(token, trie)
    return ways[1] if len(ways) > 1 and len(ways[1]) < len(token) else [token]


@lru_cache(maxsize=4)
def _trie(words: tuple[tuple[str, int], ...]) -> Trie:
    return Trie(dict(words))


def segmented(c: Column, words: dict[str, float], spark, fine_grained: bool = False) -> Column:
    """The tokens of a text column by a dictionary of words with counts (Arrow batches; the dictionary ships once)."""
    shared = spark.sparkContext.broadcast(tuple(sorted((w, frequency(n)) for w, n in words.items() if w)))

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        trie = _trie(shared.value)
        found = [segment(t, trie) for t in texts]
        return pd.Series([[y for x in tokens for y in fine(x, trie)] for tokens in found] if fine_grained else found)

    return run(c)


# --- terms ---------------------------------------------------------------------------------------------------------


def _plain(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _edge(c: str) -> bool:
    return c.isalnum() and not _HAN.match(c)


def automaton(terms: list[str]):
    """Of the terms' lower-cased forms; a form's value is its length."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for t in terms:
        if t:
            out.add_word(_plain(t), len(t))
    out.make_automaton()
    return out


def spans(text: str | None, machine) -> list[tuple[int, int]]:
    """(start, end) of the terms in a text: leftmost, then longest, no two overlapping."""
    if not text or not len(machine):
        return []
    low, found = _plain(text), []
    for last, n in machine.iter(low):
        a, b = last + 1 - n, last + 1
        if not (a and _edge(low[a]) and _edge(low[a - 1])) and not (b < len(low) and _edge(low[b - 1]) and _edge(low[b])):
            found.append((a, -b))
    out, free = [], 0
    for a, b in sorted(found):
        if a >= free:
            out.append((a, -b))
            free = -b
    return out


_MACHINES: dict[str, object] = {}


def find_terms(docs: DataFrame, id_col: str, text_col: str, terms: DataFrame, most: int = AUTOMATON) -> DataFrame:
    """Rows (doc_id, start, end, term, found) of the terms (column ``term``) in the texts; ``found`` is as it stands there.

    Up to ``most`` terms go to the workers as an automaton; more are joined by n-grams (``find_terms_joined``)."""
    few = [r["term"] for r in terms.select("term").distinct().limit(most + 1).collect()]
    if len(few) > most:
        return find_terms_joined(docs, id_col, text_col, terms)
    shared, name = docs.sparkSession.sparkContext.broadcast(sorted(t for t in few if t)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _MACHINES.get(name)
        if machine is None:  # a worker holds the one in use
            _MACHINES.clear()
            machine = _MACHINES[name] = automaton(shared.value)
        for batch in batches:
            rows = [(k, a, b, t[a:b]) for k, t in enumerate(batch.column(1).to_pylist()) for a, b in spans(t, machine)]
            which = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), pa.array([_plain(r[3]) for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.string())],
                names=["doc_id", "start", "end", "term", "found"],
            )

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, start int, end int, term string, found string")


def terms_in(c: Column, terms: list[str], spark) -> Column:
    """The different terms that a text column has, in lower case and in order."""
    shared, name = spark.sparkContext.broadcast(sorted({t for t in terms if t})), uuid.uuid4().hex

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        machine = _MACHINES.get(name)
        if machine is None:
            if len(_MACHINES) > 16:
                _MACHINES.clear()
            machine = _MACHINES[name] = automaton(shared.value)
        return pd.Series([sorted({_plain(t)[a:b] for a, b in spans(t, machine)}) for t in texts])

    return run(c)


_WORDS = re.compile("[㐀-䶿一-鿿豈-﫿]|(?:(?![㐀-䶿一-鿿豈-﫿])[^\\W_])+|[^\\w\\s]|_")


def _grams(text: str, sizes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(first word, start, end) of the n-grams of these numbers of words; a Han character or a sign is a word."""
    words = [m.span() for m in _WORDS.finditer(text)]
    for k in range(len(words)):
        for n in sizes:
            if k + n <= len(words):
                yield k, words[k][0], words[k + n - 1][1]


def find_terms_joined(docs: DataFrame, id_col: str, text_col: str, terms: DataFrame) -> DataFrame:
    """``find_terms`` for a dictionary of any size: the n-grams of a text's words meet the terms by key. Terms begin and end
    with a letter, a digit or a sign, not with a blank."""

    @F.pandas_udf("int")
    def size(texts: pd.Series) -> pd.Series:
        return pd.Series([len(_WORDS.findall(t or "")) for t in texts], dtype="int32")

    @F.pandas_udf("string")
    def plain(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else _plain(t))

    known = terms.where("term is not null").select(plain("term").alias("term")).distinct().withColumn("_n", size("term")).where("_n > 0")
    sizes = sorted(r["_n"] for r in known.select("_n").distinct().collect())  # as many as there are lengths in words
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column(1).to_pylist()):
                low = _plain(text or "")
                grams = [(a, b) for _, a, b in _grams(low, sizes)]
                if grams:
                    one = pa.array(np.zeros(len(grams), np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(k, 1).take(one), batch.column(2).slice(k, 1).take(one), pa.array([a for a, _ in grams], pa.int32()), pa.array([b for _, b in grams], pa.int32()), pa.array([low[a:b] for a, b in grams], pa.string()), pa.array([text[a:b] for a, b in grams], pa.string())],
                        names=["doc_id", "_row", "start", "end", "term", "found"],
                    )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("_row"))
    met = rows.mapInArrow(run, f"doc_id {kind}, _row long, start int, end int, term string, found string").join(known.select("term"), "term", "left_semi")
    # Of those that overlap the leftmost, then the longest: a row's matches in order, folded with the end of the last kept.
    span = F.struct("start", (-F.col("end")).alias("back"), "term", "found")
    found = met.groupBy("_row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(span)).alias("_all"))
    empty = F.filter("_all", lambda x: F.lit(False))
    kept = F.aggregate("_all", empty, lambda out, x: F.when((F.size(out) > 0) & (x["start"] < -F.element_at(out, -1)["back"]), out).otherwise(F.concat(out, F.array(x))))
    return found.select("doc_id", F.explode(kept).alias("x")).select("doc_id", "x.start", (-F.col("x.back")).alias("end"), "x.term", "x.found")

