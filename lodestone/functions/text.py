"""String functions as Columns."""

from __future__ import annotations

import base64
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

# Question words, function words and fence patterns that queries are cleaned of.
QUESTION_ZH = "是*(怎么办|什么样的|哪家|一下|那家|请问|啥样|咋样了|什么时候|何时|何地|何人|是否|是不是|多少|哪里|怎么|哪儿|怎么样|如何|哪些|是啥|啥是|啊|吗|呢|吧|咋|什么|有没有|呀|谁|哪位|哪个)是*"
QUESTION_EN = "(^| )(what|who|how|which|where|why)('re|'s)? "
FUNCTION_EN = (
    "(^| )('s|'re|is|are|were|was|do|does|did|don't|doesn't|didn't|has|have|be|there|you|me|your|my|mine|just|please|may|i|should|would|wouldn't|will|won't"
    "|done|go|for|with|so|the|a|an|by|i'm|it's|he's|she's|they|they're|you're|as|by|on|in|at|up|out|down|of|to|or|and|if) "
)
QUERY_SPECIALS = "[ :|\\r\\n\\t,，。？?/`!！&^%()\\[\\]{}<>*~'\"\\\\]+"
ARABIC_INDIC, EXTENDED_INDIC, ASCII_DIGITS = "٠١٢٣٤٥٦٧٨٩", "۰۱۲۳۴۵۶۷۸۹", "0123456789"
HAN = "\\u4e00-\\u9fa5"


def tokens(c: Column) -> Column:
    """Array of lower-case runs of letters and digits."""
    return F.filter(F.split(F.trim(F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}]+", " ")), " "), lambda t: t != "")


def tokenize(c: Column) -> Column:
    return F.array_join(tokens(c), " ")


def fine_grained(c: Column) -> Column:
    """Tokens with Han runs cut to single characters."""
    return F.array_join(tokens(F.regexp_replace(c, "(\\p{IsHan})", " $1 ")), " ")


def half_width(c: Column) -> Column:
    """Full-width forms to their ASCII counterparts, ideographic space to space."""
    wide = "".join(chr(k + 0xFEE0) for k in range(0x21, 0x7F)) + "　"
    return F.translate(c, wide, "".join(map(chr, range(0x21, 0x7F))) + " ")


def simplified(c: Column, traditional: str = "", simple: str = "") -> Column:
    """Traditional to simplified characters by a given table of pairs; without one, the text as it is."""
    return F.translate(c, traditional, simple) if traditional else c


def is_chinese(c: Column) -> Column:
    """True of up to three words, or where 70 % of the words aren't plain letters."""
    words = F.split(c, "[ \\t]+", -1)
    odd = F.size(F.filter(words, lambda w: ~w.rlike("^[a-zA-Z]+$")))
    return (F.size(words) <= 3) | (odd / F.size(words) >= 0.7)


def without_question_words(c: Column) -> Column:
    out = F.regexp_replace(c, QUESTION_ZH, "")
    out = F.regexp_replace(F.regexp_replace(out, "(?i)" + QUESTION_EN, " "), "(?i)" + FUNCTION_EN, " ")
    return F.when(out == "", c).otherwise(out)


def spaced_scripts(c: Column) -> Column:
    """A space between Latin and Han runs."""
    for a, b in ((f"([A-Za-z]+[0-9]+)([{HAN}]+)", "$1 $2"), (f"([A-Za-z])([{HAN}]+)", "$1 $2"), (f"([{HAN}]+)([A-Za-z]+[0-9]+)", "$1 $2"), (f"([{HAN}]+)([A-Za-z])", "$1 $2")):
        c = F.regexp_replace(c, a, b)
    return c


def escaped(c: Column) -> Column:
    """Query specials escaped, single quotes dropped."""
    return F.trim(F.regexp_replace(F.replace(c, F.lit("'"), F.lit("")), "([:{}/\\[\\]\\-*?\"()|+~^])", "\\\\$1"))


def query_text(c: Column) -> Column:
    """A question made ready for the query builder."""
    clean = F.trim(F.regexp_replace(half_width(F.lower(spaced_scripts(c))), QUERY_SPECIALS, " "))
    return F.trim(without_question_words(without_question_words(clean)))  # twice, as each pass eats the blank that the next word needs


def no_redundant_spaces(c: Column) -> Column:
    """Spaces go but between two characters of Latin words or numbers."""
    keep = "a-z0-9A-Z.,!?;:)\\]}\"'"
    c = F.regexp_replace(c, f"([^{keep}]) +([^ ])", "$1$2")
    return F.regexp_replace(c, "([^ ]) +([^a-z0-9A-Z(\\[{\"'])", "$1$2")


def without_fence(c: Column) -> Column:
    """The inside of a fenced Markdown block."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), "^\\s*```(?:markdown|md)?\\s*\\n?", ""), "\\n?\\s*```\\s*$", ""))


def ascii_digits(c: Column) -> Column:
    """Arabic and extended Arabic-Indic digits as ASCII."""
    return F.translate(c, ARABIC_INDIC + EXTENDED_INDIC, ASCII_DIGITS * 2)


@F.pandas_udf(StringType())
def compatibility_form(s: pd.Series) -> pd.Series:
    """NFKC, which Spark has no function for; folds Arabic presentation forms."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def split_template(c: Column, delimiters: list[str]) -> Column:
    """Split at any of the delimiters, the longest first."""
    return F.split(c, "|".join("\\Q" + d + "\\E" for d in sorted(delimiters, key=len, reverse=True)), -1)


def merge_template(template: str, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def highlight(c: Column, keywords: list[str], english: bool = True) -> Column:
    """Sentences that hold a keyword, joined by ``...``, with the keywords in <em>; longest keywords first."""
    words = sorted({k for k in keywords if k}, key=lambda k: (-len(k), k))
    if not words:
        return F.lit("")
    any_of = "|".join("\\Q" + k + "\\E" for k in words)
    pattern = f"(?i)(^|[ .?/'\"()!,:;-])({any_of})(?=$|[ .?/'\"()!,:;-])" if english else f"(?i)()({any_of})"
    marked = F.transform(F.split(F.regexp_replace(c, "[\\r\\n]", " "), "(?<=[.?!;])\\s*"), lambda s: F.regexp_replace(s, pattern, "$1<em>$2</em>"))
    return F.array_join(F.filter(marked, lambda s: s.contains("<em>")), "...")


def clean_entity(c: Column) -> Column:
    """Entities unescaped, quotes and control characters dropped, trimmed."""
    for entity, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return F.regexp_replace(F.trim(c), '[\\"\\x00-\\x1f\\x7f-\\x9f]', "")


def split_markers(c: Column, markers: list[str]) -> Column:
    pieces = F.split(c, "|".join("\\Q" + m + "\\E" for m in markers), -1)
    return F.filter(F.transform(pieces, lambda p: F.trim(p)), lambda p: p != "")


def strip_tags(c: Column) -> Column:
    """Markup to spaces, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), "\\s+", " "))


def strip_table_tags(c: Column) -> Column:
    return F.regexp_replace(c, "</?(table|td|caption|tr|th)( [^<>]{0,12})?>", " ")


def language(c: Column) -> Column:
    """zh where over 30 % of the letters are Han, else en."""
    letters = F.regexp_count(c, F.lit("\\p{L}"))
    return F.when((letters > 0) & (F.regexp_count(c, F.lit("\\p{IsHan}")) / letters > 0.3), "zh").otherwise("en")


def token_count(c: Column) -> Column:
    """Words, as a proxy of model tokens; null counts none."""
    return F.coalesce(F.regexp_count(c, F.lit("\\S+")), F.lit(0))


def truncate_tokens(c: Column, n: int) -> Column:
    return F.array_join(F.slice(F.filter(F.split(c, "\\s+"), lambda w: w != ""), 1, max(0, n)), " ") if n > 0 else F.lit("")


# Fixed value: how the public byte-level vocabularies cut a text ahead of merging.
CUTS = r"""(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def _vocabulary(path: str, cuts: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=cuts, mergeable_ranks=ranks, special_tokens={})


def model_token_count(c: Column, path: str, cuts: str = CUTS) -> Column:
    """Tokens of a vocabulary (a file of base64 pieces and ranks, at the same path on all workers); special tokens' strings
    are ordinary text, and null has none. Once a worker has read the file it keeps it."""

    @F.pandas_udf(LongType())
    def count(s: pd.Series) -> pd.Series:
        encode = _vocabulary(path, cuts).encode_ordinary_batch
        return pd.Series([len(x) for x in encode(s.fillna("").tolist())], dtype="int64")

    return count(c)
