"""A WordNet as tables: base forms by suffix rules and exception lists, synsets, and walks along their pointers.

Tables: lemmas (lemma, pos, synset, sense), one row a sense in order of frequency; exceptions (form, pos, lemma); synsets
(synset, pos, words, gloss); pointers (synset, kind, target). ``read`` makes them of the database's files; any tables of these
columns do. Words and parts of speech meet the tables in joins, so neither is bounded.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POS = ["n", "v", "a", "r"]
#: Suffixes that a rule takes away, and what it puts in their place.
DETACHED = {
    "n": [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")],
    "v": [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")],
    "a": [("er", ""), ("est", ""), ("er", "e"), ("est", "e")],
    "r": [],
}
FILES = {"n": "noun", "v": "verb", "a": "adj", "r": "adv"}
HYPERNYM, INSTANCE = "@", "@i"


class WordNet(NamedTuple):
    lemmas: DataFrame
    exceptions: DataFrame
    synsets: DataFrame
    pointers: DataFrame


def read(spark: SparkSession, folder: str) -> WordNet:
    """The files index.*, data.* and *.exc of a folder. A synset's id is its part of speech and offset."""
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(union(frames[1:]))

    def lines(name: str):
        return spark.read.text(f"{folder}/{name}").where(~F.col("value").startswith("  ") & (F.trim("value") != ""))

    def index(pos: str) -> DataFrame:
        f = F.split(F.trim("value"), " +")
        at = F.lit(4) + F.get(f, F.lit(3)).cast("int") + 2  # behind the pointer symbols and two counts
        offsets = F.slice(f, at + 1, F.get(f, F.lit(2)).cast("int"))
        rows = lines(f"index.{FILES[pos]}").select(F.lower(F.get(f, F.lit(0))).alias("lemma"), F.posexplode(offsets).alias("sense", "offset"))
        return rows.select("lemma", F.lit(pos).alias("pos"), F.concat(F.lit(pos), F.col("offset").cast("long").cast("string")).alias("synset"), (F.col("sense") + 1).alias("sense"))

    def data(pos: str) -> DataFrame:
        f = F.split(F.trim(F.element_at(F.split("value", " \\| "), 1)), " +")
        n = F.conv(F.get(f, F.lit(3)), 16, 10).cast("int")
        words = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.lower(F.regexp_replace(F.get(f, 4 + 2 * k), "\\(.*\\)$", "")))
        p = F.get(f, 4 + 2 * n).cast("int")
        start = 5 + 2 * n
        pointers = F.when(p > 0, F.transform(F.sequence(F.lit(0), p - 1), lambda k: F.struct(F.get(f, start + 4 * k).alias("kind"), F.concat(F.replace(F.get(f, start + 4 * k + 2), F.lit("s"), F.lit("a")), F.get(f, start + 4 * k + 1).cast("long").cast("string")).alias("target"))))
        gloss = F.trim(F.substring_index("value", " | ", -1))
        return lines(f"data.{FILES[pos]}").select(F.concat(F.lit(pos), F.get(f, F.lit(0)).cast("long").cast("string")).alias("synset"), F.get(f, F.lit(2)).alias("pos"), words.alias("words"), gloss.alias("gloss"), pointers.alias("_p"))

    def exceptions(pos: str) -> DataFrame:
        f = F.split(F.trim("value"), " +")
        return lines(f"{FILES[pos]}.exc").select(F.get(f, F.lit(0)).alias("form"), F.lit(pos).alias("pos"), F.explode(F.slice(f, F.lit(2), F.size(f))).alias("lemma"))

    rows = union([data(p) for p in POS])
    pointers = rows.select("synset", F.explode("_p").alias("x")).select("synset", "x.kind", "x.target")
    return WordNet(union([index(p) for p in POS]), union([exceptions(p) for p in POS]), rows.drop("_p"), pointers)


def candidates(words: DataFrame, word_col: str, exceptions: DataFrame) -> DataFrame:
    """Rows (word, pos, form, place): the word itself first, then its exceptions' base forms, or if it has none those of the
    suffix rules in their order."""
    asked = words.select(F.lower(word_col).alias("word")).where("word is not null").distinct()
    own = asked.select("word", F.explode(F.array(*map(F.lit, POS))).alias("pos"))
    rules = F.array(*(F.struct(F.lit(p).alias("pos"), F.lit(k + 1).alias("place"), F.lit(old).alias("old"), F.lit(new).alias("new")) for p in POS for k, (old, new) in enumerate(DETACHED[p])))
    ruled = asked.select("word", F.explode(rules).alias("r")).where(F.endswith("word", F.col("r.old")))
    ruled = ruled.select("word", "r.pos", F.concat(F.expr("left(word, length(word) - length(r.old))"), "r.new").alias("form"), "r.place")
    # A form's exceptions are a handful, as the files list them.
    listed = exceptions.groupBy("form", "pos").agg(F.sort_array(F.collect_set("lemma")).alias("_l")).select(F.col("form").alias("word"), "pos", "_l")
    excepted = own.join(listed, ["word", "pos"]).select("word", "pos", F.posexplode("_l").alias("place", "form")).select("word", "pos", "form", (F.col("place") + 1).alias("place"))
    ruled = ruled.join(listed.select("word", "pos"), ["word", "pos"], "left_anti")
    out = own.select("word", "pos", F.col("word").alias("form"), F.lit(0).alias("place")).unionByName(excepted).unionByName(ruled.select("word", "pos", "form", "place"))
    return out.groupBy("word", "pos", "form").agg(F.min("place").alias("place"))


def morphy(words: DataFrame, word_col: str, net: WordNet) -> DataFrame:
    """Rows (word, pos, form, place) of the base forms that the dictionary has."""
    known = net.lemmas.select(F.col("lemma").alias("form"), "pos").distinct()
    return candidates(words, word_col, net.exceptions).join(known, ["form", "pos"], "left_semi").select("word", "pos", "form", "place")


def synsets(words: DataFrame, word_col: str, net: WordNet) -> DataFrame:
    """Rows (word, synset, pos, form, sense) of the senses of a word's base forms; a synset that several forms reach is there
    once, by the first of them."""
    forms = morphy(words, word_col, net)
    found = forms.join(net.lemmas.withColumnRenamed("lemma", "form"), ["form", "pos"])
    one = F.struct("place", "sense", "form", "pos")
    return found.groupBy("word", "synset").agg(F.min(one).alias("x")).select("word", "synset", "x.pos", "x.form", "x.sense")


def synonyms(words: DataFrame, word_col: str, net: WordNet, top: int = 8) -> DataFrame:
    """Rows (word, synonyms): the other words of a word's synsets, those of the earlier senses first, at most ``top``."""
    rows = synsets(words, word_col, net).join(net.synsets.select("synset", "words"), "synset").select("word", "pos", "sense", "form", F.explode("words").alias("other"))
    rows = rows.withColumn("other", F.replace("other", F.lit("_"), F.lit(" "))).where("other <> word and other <> form")
    order = F.struct(F.array_position(F.array(*map(F.lit, POS)), F.col("pos")).alias("p"), "sense", "other")
    first = rows.groupBy("word", "other").agg(F.min(order).alias("o"))
    listed = F.slice(F.array_sort(F.collect_list(F.struct("o.p", "o.sense", "other"))), 1, top)  # a word's senses bound it
    return first.groupBy("word").agg(F.transform(listed, lambda x: x["other"]).alias("synonyms"))


def closure(starts: DataFrame, net: WordNet, kinds: tuple[str, ...] = (HYPERNYM, INSTANCE), most: int = 40) -> DataFrame:
    """Rows (synset, ancestor, depth): what a walk along pointers of these kinds reaches, by the fewest steps; the start at 0.

    A step is a join and a grouped minimum, and its lineage ends in a table; the walk is over when it reaches nothing new."""
    from ..operators.scratch import stored

    steps = net.pointers.where(F.col("kind").isin(*kinds)).select(F.col("synset").alias("ancestor"), "target").distinct()
    reached = stored(starts.select("synset").distinct().select("synset", F.col("synset").alias("ancestor"), F.lit(0).alias("depth")), "closure")
    fresh = reached
    for k in range(1, most + 1):
        ahead = fresh.select("synset", "ancestor").join(steps, "ancestor").select("synset", F.col("target").alias("ancestor")).distinct()
        fresh = stored(ahead.join(reached.select("synset", "ancestor"), ["synset", "ancestor"], "left_anti").withColumn("depth", F.lit(k)), "closure")
        if fresh.isEmpty():
            return reached
        reached = stored(reached.unionByName(fresh), "closure")
    raise RuntimeError(f"pointers go on beyond {most} steps")
