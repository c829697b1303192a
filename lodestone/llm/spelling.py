"""Spelling variants grouped by anagram hashing (Reynaert 2011).

A word's key is the sum of the fifth powers of its letters' code points: anagrams share it, and adding, removing or
exchanging a letter changes it by the letters' values alone. A word is posted under its key and under the key less each
of its letters. Words that one addition or removal parts meet where nothing was taken from the shorter one; words that one
exchange parts meet where each has lost its own letter: their keys differ by an exchange value. These are joins of integers,
and a posting where only one key meets is dropped before any word is shuffled.

What meets may be in another order of letters. The order is verified by the rest of a word, what is left without the
letter: two words are one letter apart exactly if the rest of the one is the other word, or both have one rest with the
letter missing at one place. Words are grouped by posting and rest, so a class of anagrams is never paired with another.
A group of one rest and one place has a word for each letter at most, which bounds it by the alphabet.

Defined cases: a null or empty text has no words; long texts are counted whole; in ``altered_words`` a null id changes no
run; repeated rows count each; ties go to the smallest word in code-point order; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from math import ceil, log, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Letters of a run; only A-Z are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
POWER, LEAST_LENGTH, LEAST_COUNT, RATIO, EVERY = 5, 6, 5, 5, 199


def altered(doc_id: Column, run: Column) -> Column:
    """A lower-cased run, without one letter where EVERY divides h, the crc32 of ``<doc_id>:<run>``: that at h % length."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % EVERY == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def _counts(runs: DataFrame, word: Column, least_length: int, least_count: int) -> DataFrame:
    """Of rows with the runs of a text (``_raws``); ``word`` is made of ``_run``, the lower-cased run."""
    runs = runs.withColumn("_raw", F.explode("_raws"))
    # Most runs are of A-Z alone, which lower() does as well and faster.
    lowered = F.when(F.col("_raw").rlike("^[A-Za-z]+$"), F.lower("_raw")).otherwise(F.translate("_raw", UPPER, LOWER))
    words = runs.where(F.length("_raw") >= least_length).withColumn("_run", lowered).select(word.alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _runs(text_col: str) -> Column:
    return F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]+"), F.lit(0)).alias("_raws")


def word_counts(docs: DataFrame, *, text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """Rows word, n of the words of enough letters and occurrences."""
    return _counts(docs.select(_runs(text_col)), F.col("_run"), least_length, least_count)


def altered_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word_counts`` of runs changed by their document's id (``altered``)."""
    word = F.coalesce(altered(F.col("_id"), F.col("_run")), F.col("_run"))
    return _counts(docs.select(F.col(id_col).alias("_id"), _runs(text_col)), word, least_length, least_count)


def _value(letter: Column) -> Column:
    return F.pow(F.ascii(letter).cast("double"), F.lit(float(POWER))).cast("long")


def postings(words: DataFrame) -> DataFrame:
    """Rows posting, key, word, n, place, rest: a word under its key (place -1, the rest is all of it) and under the key
    less the letter at each place."""
    letters = F.split("word", "")
    keyed = words.select("word", "n", F.transform(letters, _value).alias("_values"))
    keyed = keyed.withColumn("key", F.aggregate("_values", F.lit(0).cast("long"), lambda s, v: s + v))
    places = keyed.select("word", "n", "key", F.posexplode(F.concat(F.array(F.lit(0).cast("long")), F.col("_values"))).alias("_at", "_value"))
    at = F.col("_at")
    rest = F.when(at == 0, F.col("word")).otherwise(F.concat(F.substring("word", F.lit(1), at - 1), F.substring(F.col("word"), at + 1, F.length("word"))))
    return places.select((F.col("key") - F.col("_value")).alias("posting"), "key", "word", "n", (at - 1).alias("place"), rest.alias("rest"))


def near(words: DataFrame) -> DataFrame:
    """Rows word, n_near, best: of each word that has near ones, their number and the one of largest n (-n and word)."""
    posted = stored(postings(words), "postings")
    met = posted.groupBy("posting").agg(F.min("key").alias("_a"), F.max("key").alias("_b")).where("_a <> _b").select("posting")
    kept = stored(posted.join(met, "posting", "left_semi"), "met")
    one = F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"))
    # One exchanged letter: the same rest, without the letter at the same place.
    groups = kept.where("place >= 0").groupBy("posting", "rest", "place").agg(F.sort_array(F.collect_list(one)).alias("_all")).where(F.size("_all") > 1)
    members = groups.select("_all", F.explode("_all").alias("_own"))
    first = F.col("_all")[0]
    exchanged = members.select(F.col("_own.word").alias("word"), (F.size("_all") - 1).cast("long").alias("n_near"), F.when(F.col("_own.word") == first["word"], F.col("_all")[1]).otherwise(first).alias("best"))
    # One letter more: the rest is the other word.
    longer = kept.where("place >= 0").select("posting", "rest", "word", "n").distinct()
    shorter = kept.where("place < 0").select("posting", F.col("word").alias("rest"), F.col("n").alias("_n"))
    pairs = longer.join(shorter, ["posting", "rest"]).select(
        F.explode(F.array(
            F.struct(F.col("word").alias("word"), F.struct((-F.col("_n")).alias("less"), F.col("rest").alias("word")).alias("best")),
            F.struct(F.col("rest").alias("word"), one.alias("best")),
        )).alias("x")
    )
    added = pairs.select("x.word", F.lit(1).cast("long").alias("n_near"), "x.best")
    return exchanged.unionByName(added).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """Rows word, root of words with a form, by pointer doubling: a form has ``ratio`` times the occurrences at least, which
    bounds the length of a chain, and its logarithm the rounds."""
    now = forms.select("word", F.col("form").alias("root"))
    longest = int(log(max(most, 2), ratio)) + 1
    for k in range(ceil(log2(longest)) if longest > 1 else 0):
        now = stored(now, f"roots-{k}")
        on = now.select(F.col("word").alias("_via"), F.col("root").alias("_on"))
        now = now.join(on, now["root"] == on["_via"], "left").select("word", F.coalesce("_on", "root").alias("root"))
    return now


def variants(words: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """Rows word, form, root, n, n_near, form_n of a table of words (word, n; each word once, ``ratio`` 2 at least).

    A word's near words differ from it by one letter added, removed or exchanged. Its form is the near word of largest n, if
    that is ``ratio`` times its own or more; the root follows the forms to the last one."""
    words = stored(words.select("word", "n"), "words")
    near_ = near(words)
    best = F.col("best.less")
    of = F.when(-best >= ratio * F.col("n"), F.col("best.word"))
    found = stored(words.join(near_, "word", "left").select("word", of.alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(of.isNotNull(), -best).alias("form_n")), "forms")
    most = found.agg(F.max("n")).first()[0] or 0
    roots = _roots(found.where("form is not null"), most, ratio)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
