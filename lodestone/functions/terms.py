"""Term weights and token similarity as Columns over token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import tokens
from .values import let

# Fixed values of the weighting: corpus sizes, and frequencies where no dictionary has a term.
FREQ_CORPUS, DF_CORPUS = 10_000_000, 1_000_000_000
LETTER_FREQ, NUMBER_FREQ, NUMBER_DF, OTHER_FREQ, OTHER_DF = 300, 3, 5, 10, 3


def idf(s: Column, n: int | float) -> Column:
    return F.log10(F.lit(10.0) + (F.lit(float(n)) - s + 0.5) / (s + 0.5))


def raw_weight(t: Column) -> Column:
    """Weight of a term ahead of normalising; without dictionaries it depends on the term's shape alone."""
    number, letters = t.rlike("^[0-9. -]{2,}$"), t.rlike("^[a-z. -]+$")
    freq = F.when(number, NUMBER_FREQ).when(letters, LETTER_FREQ).otherwise(OTHER_FREQ).cast("double")
    df = F.when(number, NUMBER_DF).when(letters, LETTER_FREQ).otherwise(OTHER_DF).cast("double")
    kind = F.when(t.rlike("^[0-9,.]{2,}$"), 2.0).when(t.rlike("^[a-z]{1,2}$"), 0.01).otherwise(1.0)
    tag = F.when(t.rlike("^[0-9-]+"), 2.0).otherwise(1.0)
    return (0.3 * idf(freq, FREQ_CORPUS) + 0.7 * idf(df, DF_CORPUS)) * kind * tag


def weights(terms: Column) -> Column:
    """Array of (term, weight), weights summing to one."""

    def scaled(raw: Column) -> Column:
        total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x["w"])
        return let(total, lambda t: F.transform(raw, lambda x: F.struct(x["term"].alias("term"), (x["w"] / t).alias("w"))))

    return let(F.transform(terms, lambda t: F.struct(t.alias("term"), raw_weight(t).alias("w"))), scaled)


def bag(terms: Column) -> Column:
    """Array of (term, weight) of single terms (0.4 w) and neighbours glued together (0.6 of the larger w)."""

    def build(w: Column) -> Column:
        ones = F.transform(w, lambda x: F.struct(x["term"].alias("term"), (x["w"] * 0.4).alias("w")))
        pairs = F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda x, y: F.struct(F.concat(x["term"], y["term"]).alias("term"), (F.greatest(x["w"], y["w"]) * 0.6).alias("w")))
        return F.when(F.size(w) > 1, F.concat(ones, pairs)).otherwise(ones)

    return let(weights(terms), build)


def bag_terms(terms: Column) -> Column:
    """The terms of a bag: single ones, and neighbours glued together."""
    pairs = lambda t: F.zip_with(F.slice(t, F.lit(1), F.size(t) - 1), F.slice(t, F.lit(2), F.size(t) - 1), lambda x, y: F.concat(x, y))
    return let(terms, lambda t: F.when(F.size(t) > 1, F.concat(t, pairs(t))).otherwise(t))


def similarity(query: Column, doc_terms: Column) -> Column:
    """Share of the query bag's weight whose terms are among the document's; asymmetric. One pass over the document's terms
    leaves those of the query, and weights are summed over these few."""

    def share(q: Column) -> Column:
        met = F.array_intersect(F.transform(q, lambda x: x["term"]), doc_terms)
        hit = let(met, lambda known: F.aggregate(F.filter(q, lambda x: F.array_contains(known, x["term"])), F.lit(1e-9), lambda a, x: a + x["w"]))
        return hit / F.aggregate(q, F.lit(1e-9), lambda a, x: a + x["w"])

    return let(query, share)


def token_similarity(query_text: Column, doc_text: Column) -> Column:
    return similarity(bag(tokens(query_text)), bag_terms(tokens(doc_text)))


def pretoken(c: Column, stop_words: list[str] | None = None, keep_digits: bool = False) -> Column:
    """Tokens without stop words and single digits."""
    out = tokens(c)
    if stop_words:
        out = F.filter(out, lambda t: ~t.isin(stop_words))
    return out if keep_digits else F.filter(out, lambda t: ~t.rlike("^[0-9]$"))


def glued_words(c: Column) -> Column:
    """Words split at blanks, with runs of words that end in letters glued by a space."""
    words = F.filter(F.split(c, "\\s+"), lambda w: w != "")
    return F.aggregate(
        words,
        F.array().cast("array<string>"),
        lambda a, w: F.when(
            (F.size(a) > 0) & F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit("")).rlike("[a-zA-Z]$") & w.rlike("[a-zA-Z]$"),
            F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.concat_ws(" ", F.try_element_at(a, F.lit(-1)), w))),
        ).otherwise(F.concat(a, F.array(w))),
    )


def merged_short(terms: Column) -> Column:
    """Runs of two to four one-character (or 1-2 letter) terms joined by a space; longer runs are joined in twos."""
    short = lambda t: (F.length(t) == 1) | t.rlike("^[0-9a-z]{1,2}$")
    runs = F.aggregate(
        terms,
        F.array().cast("array<array<string>>"),
        lambda a, t: F.when(
            (F.size(a) > 0) & short(t) & F.coalesce(F.forall(F.try_element_at(a, F.lit(-1)), short), F.lit(False)),
            F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.concat(F.try_element_at(a, F.lit(-1)), F.array(t)))),
        ).otherwise(F.concat(a, F.array(F.array(t)))),
    )
    twos = lambda r: F.transform(F.sequence(F.lit(1), F.size(r), F.lit(2)), lambda i: F.array_join(F.slice(r, i, 2), " "))
    return F.flatten(F.transform(runs, lambda r: F.when(F.size(r) < 5, F.array(F.array_join(r, " "))).otherwise(twos(r))))


def synonyms(terms: Column, dictionary: dict[str, list[str]], top: int = 8) -> Column:
    """Up to ``top`` synonyms of each term, by a dictionary of bounded size that ships with the plan."""
    if not dictionary:
        return F.transform(terms, lambda t: F.struct(t.alias("term"), F.array().cast("array<string>").alias("synonyms")))
    table = F.create_map(*(F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x[:top])) for kv in dictionary.items() for x in kv))
    return F.transform(terms, lambda t: F.struct(t.alias("term"), F.coalesce(F.try_element_at(table, t), F.array().cast("array<string>")).alias("synonyms")))


def keywords(c: Column, top: int = 5) -> Column:
    """The heaviest terms of a text, a stand-in of model-made keywords."""
    w = F.array_distinct(F.transform(weights(tokens(c)), lambda x: F.struct((-x["w"]).alias("w"), x["term"].alias("term"))))
    return F.transform(F.slice(F.array_sort(w), 1, top), lambda x: x["term"])


def noun_phrases(c: Column) -> Column:
    """Runs of capitalised words, a stand-in of model-made noun phrases."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit("(\\p{Lu}\\p{Ll}+(?: \\p{Lu}\\p{Ll}+)*)"), 1))
