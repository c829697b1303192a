"""Languages told by profiles of letter n-grams that labelled texts give (Bayes, with the languages' profiles as tables).

``train`` counts the n-grams of one to three letters of every word, over all texts: words are counted first, so that a
word's n-grams are made once. A profile is the ``per`` most frequent n-grams with their log shares, a few thousand rows in
all. ``detect`` adds up a text's n-grams under each profile; what a profile lacks counts as seen half a time.

Null texts and texts without letters have no language; equal sums go to the first name in order.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTHS, PER = (1, 2, 3), 1500
_WORD = "\\p{L}+"


def _grams(word: Column) -> Column:
    """The n-grams of a word between two blanks."""
    w = F.concat(F.lit(" "), word, F.lit(" "))
    one = lambda n: F.transform(F.sequence(F.lit(1), F.length(w) - n + 1), lambda i: F.substring(w, i, F.lit(n)))
    return F.concat(*(F.when(F.length(w) >= n, one(n)).otherwise(F.array().cast("array<string>")) for n in LENGTHS))


def train(texts: DataFrame, text_col: str, lang_col: str, per: int = PER) -> DataFrame:
    """Rows (lang, gram, weight): the profiles of the languages of the labelled texts; the gram '' holds what is missing."""
    words = texts.select(F.col(lang_col).alias("lang"), F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(_WORD), F.lit(0))).alias("word")).where("lang is not null")
    counted = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    grams = counted.select("lang", "n", F.explode(_grams(F.col("word"))).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A language's most frequent ones; its n-grams are bounded by its letters, not by its texts.
    kept = grams.groupBy("lang").agg(F.sum("n").alias("total"), F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "gram"))), 1, per).alias("top"))
    rows = kept.select("lang", "total", F.explode("top").alias("x")).select("lang", F.col("x.gram").alias("gram"), F.log(-F.col("x.less") / F.col("total")).alias("weight"))
    return rows.unionByName(kept.select("lang", F.lit("").alias("gram"), F.log(F.lit(0.5) / F.col("total")).alias("weight")))


def detect(text: Column, profiles: DataFrame) -> Column:
    """The language of a text column, by profiles of ``train`` (a few thousand rows, which ship once)."""
    spark = profiles.sparkSession
    rows = profiles.collect()
    names = sorted({r["lang"] for r in rows})
    place = {n: k for k, n in enumerate(names)}
    missing = np.zeros(len(names))
    table: dict[str, np.ndarray] = {}
    for r in rows:
        if r["gram"] == "":
            missing[place[r["lang"]]] = r["weight"]
    for r in rows:
        if r["gram"]:
            table.setdefault(r["gram"], missing.copy())[place[r["lang"]]] = r["weight"]
    shared = spark.sparkContext.broadcast((names, missing, table))

    @F.pandas_udf("string")
    def run(words: pd.Series) -> pd.Series:
        names, missing, table = shared.value
        known: dict[str, np.ndarray] = {}

        def score(word: str) -> np.ndarray:
            if word not in known:
                if len(known) > 200_000:
                    known.clear()
                w = f" {word} "
                known[word] = sum((table.get(w[i : i + n], missing) for n in LENGTHS for i in range(len(w) - n + 1)), np.zeros(len(names)))
            return known[word]

        out = []
        for found in words:
            if found is None or not len(found) or not names:
                out.append(None)
            else:
                out.append(names[int(sum(n * score(w) for w, n in Counter(found).items()).argmax())])
        return pd.Series(out, dtype="object")

    return run(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0)))
