"""Chunkers: delimiter and token chunks, media windows, parents and children, title groups and hierarchies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import token_count
from ..functions.values import text_id

# Heading patterns by family, from the highest level down.
HEADING_FAMILIES = {
    "zh_legal": ["^第[零一二三四五六七八九十百0-9]+(分?编|部分)", "^第[零一二三四五六七八九十百0-9]+章", "^第[零一二三四五六七八九十百0-9]+节", "^第[零一二三四五六七八九十百0-9]+条", "^[(（][零一二三四五六七八九十百]+[)）]"],
    "zh_numbered": ["^第[0-9]+章", "^第[0-9]+节", "^[0-9]{1,2}[. 、]", "^[0-9]{1,2}\\.[0-9]{1,2}[^a-zA-Z/%~-]", "^[0-9]{1,2}\\.[0-9]{1,2}\\.[0-9]{1,2}"],
    "en": ["^PART (ONE|TWO|THREE|FOUR|FIVE|SIX|SEVEN|EIGHT|NINE|TEN)", "^Chapter (I+V?|VI*|XI|IX|X)", "^Section [0-9]+", "^Article [0-9]+"],
    "markdown": ["^#[^#]", "^##[^#]", "^###[^#]", "^####[^#]", "^#####[^#]", "^######[^#]"],
}


def delimiter_pattern(delimiters: list[str]) -> str:
    """Longest first, so that a delimiter inside a longer one doesn't cut it."""
    return "|".join("\\Q" + d + "\\E" for d in sorted(set(delimiters), key=lambda d: (-len(d), d)) if d)


def delimiter_split(c: Column, delimiters: list[str]) -> Column:
    """Pieces with their delimiter on the left piece; blank pieces are dropped."""
    marked = F.regexp_replace(c, f"({delimiter_pattern(delimiters)})", "$1\u0001")
    return F.filter(F.split(marked, "\u0001", -1), lambda x: x.rlike("\\S"))


def token_merge(pieces: Column, size: int, overlap_percent: float = 0.0, joint: str = "\n") -> Column:
    """Pieces packed until the chunk has over ``size`` tokens less the overlap's share; a new chunk begins with the last
    ``overlap_percent`` of the characters of the one before."""
    limit = size * (100.0 - overlap_percent) / 100.0
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit(0).alias("n"))

    def step(s: Column, x: Column) -> Column:
        last = F.coalesce(F.try_element_at(s["done"], F.lit(-1)), F.lit(""))
        n = token_count(x)
        keep = F.floor(F.length(last) * (100.0 - overlap_percent) / 100.0).cast("int")
        tail = F.when(F.lit(overlap_percent > 0), F.substring(last, keep + 1, F.length(last))).otherwise(F.lit(""))
        fresh = F.concat(tail, x)
        start = F.struct(F.concat(s["done"], F.array(fresh)).alias("done"), token_count(fresh).cast("int").alias("n"))
        whole = F.concat(F.slice(s["done"], F.lit(1), F.greatest(F.size(s["done"]) - 1, F.lit(0))), F.array(F.concat(last, F.lit(joint), x)))
        grown = F.struct(whole.alias("done"), (s["n"] + n).cast("int").alias("n"))
        return F.when((F.size(s["done"]) == 0) | (s["n"] > limit), start).otherwise(grown)

    return F.aggregate(pieces, empty, step, lambda s: s["done"])


def token_chunks(docs: DataFrame, id_col: str, text_col: str, *, size: int = 128, delimiters: tuple[str, ...] = ("\n",), overlap_percent: float = 0.0, mode: str = "token_size") -> DataFrame:
    """Rows (doc_id, position, content): by token size, one a delimiter piece, or the whole document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    pieces = F.filter(F.array(text), lambda x: x.rlike("\\S")) if mode == "one" else delimiter_split(text, list(delimiters))
    if mode == "token_size":
        pieces = token_merge(pieces, size, overlap_percent, "")
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(pieces).alias("position", "content"))


def media_context(blocks: DataFrame, tokens: int, id_col: str = "doc_id", position: str = "position", kind: str = "kind", content: str = "content") -> DataFrame:
    """Table and image blocks take up to ``tokens`` words of the text on either side, not beyond the next media block."""
    w = Window.partitionBy(id_col).orderBy(position)
    media = F.col(kind) != "text"
    runs = blocks.withColumn("_run", F.sum(media.cast("int")).over(w))
    words = lambda c: F.filter(F.split(c, "\\s+"), lambda x: x != "")
    texts = runs.where(~media).groupBy(id_col, "_run").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(position, content))), lambda x: words(x[content]))).alias("_words"))
    ahead = texts.select(id_col, (F.col("_run") + 1).alias("_run"), F.slice("_words", F.greatest(F.lit(1), F.size("_words") - tokens + 1), tokens).alias("_ahead"))
    behind = texts.select(id_col, "_run", F.slice("_words", 1, tokens).alias("_behind"))
    m = runs.where(media).join(ahead, [id_col, "_run"], "left").join(behind, [id_col, "_run"], "left")
    none = F.array().cast("array<string>")
    wide = F.trim(F.concat_ws(" ", F.array_join(F.coalesce("_ahead", none), " "), F.col(content), F.array_join(F.coalesce("_behind", none), " ")))
    return m.withColumn(content, wide).drop("_run", "_ahead", "_behind").unionByName(blocks.where(~media))


def parent_child(chunks: DataFrame, content: str, delimiters: list[str]) -> DataFrame:
    """Children of each chunk with the parent's text and id."""
    out = chunks.withColumn("mom", F.col(content)).withColumn("mom_id", text_id(F.col(content)))
    return out.select(*[c for c in out.columns if c != content], F.posexplode(delimiter_split(F.col(content), delimiters)).alias("child_order", content))


def mother_chunks(children: DataFrame) -> DataFrame:
    """Distinct parents as rows that a search doesn't show."""
    return children.groupBy("mom_id").agg(F.first("mom").alias("content"), F.min("doc_id").alias("doc_id")).select(F.col("mom_id").alias("id"), "doc_id", "content", F.lit(0).alias("available_int"))


# --- titles -----------------------------------------------------------------------------------------------------------


def heading_level(c: Column, family: str) -> Column:
    """The level (1 is the highest) of a line in a family of patterns, 0 for none."""
    out = F.lit(0)
    for level, pattern in reversed(list(enumerate(HEADING_FAMILIES[family], 1))):
        out = F.when(F.trim(c).rlike(pattern), level).otherwise(out)
    return out


def family_vote(lines: DataFrame, id_col: str, line: str, families: Sequence[str] = tuple(HEADING_FAMILIES)) -> DataFrame:
    """The family, of those that stand for election, with the most headings in each document; the first of equals."""
    hits = lines.groupBy(id_col).agg(*(F.count_if(heading_level(F.col(line), f) > 0).alias(f) for f in families))
    best = F.greatest(*families) if len(families) > 1 else F.col(families[0])
    pick = F.lit(None).cast("string")
    for f in reversed(families):
        pick = F.when((F.col(f) == best) & (best > 0), f).otherwise(pick)
    return hits.select(id_col, pick.alias("family"), best.alias("hits"))


def outline_match(a: Column, b: Column) -> Column:
    """Share of a's letter pairs that b has is over 0.8."""
    grams = lambda c: F.array_distinct(F.when(F.length(c) > 1, F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2)))).otherwise(F.array(c)))
    x, y = grams(a), grams(b)
    return F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y), F.lit(1)) > 0.8


def common_level(lines: DataFrame, id_col: str, level: str) -> DataFrame:
    """The most common level above 0, the lower of equals."""
    counts = lines.where(F.col(level) > 0).groupBy(id_col, level).count()
    return counts.groupBy(id_col).agg(F.max_by(level, F.struct("count", -F.col(level))).alias("level"))


def section_ids(lines: DataFrame, id_col: str, position: str, is_heading: Column) -> DataFrame:
    """The number of headings up to each line."""
    return lines.withColumn("section", F.sum(is_heading.cast("int")).over(Window.partitionBy(id_col).orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def group_title_chunks(lines: DataFrame, id_col: str, position: str, content: str, section: str, *, low: int = 32, high: int = 1024) -> DataFrame:
    """Lines merged while the chunk has under ``low`` tokens, or in the same section under ``high``."""
    packed = lines.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(section).alias("s"), F.col(content).alias("c")))).alias("_lines"))
    kind = "array<struct<s:bigint,n:int,c:string>>"

    def step(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        n = token_count(x["c"]).cast("int")
        one = F.struct(x["s"].cast("bigint").alias("s"), n.alias("n"), x["c"].alias("c"))
        joined = F.struct(x["s"].cast("bigint").alias("s"), (last["n"] + n).cast("int").alias("n"), F.concat_ws("\n", last["c"], x["c"]).alias("c"))
        grow = (F.size(done) > 0) & ((last["n"] < low) | ((last["s"] == x["s"]) & (last["n"] < high)))
        return F.when(grow, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(one)))

    merged = packed.select(id_col, F.posexplode(F.aggregate("_lines", F.array().cast(kind), step)).alias("position", "x"))
    return merged.select(id_col, "position", F.col("x.c").alias("content"), F.col("x.n").alias("tokens"))


def hierarchy_chunks(lines: DataFrame, id_col: str, position: str, content: str, level: str, depth: int = 6) -> DataFrame:
    """Text lines under the path of their headings: rows (doc_id, path, content), one a run of text with the same path."""
    w = Window.partitionBy(id_col).orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = lines.withColumn("_h", F.sum((F.col(level) > 0).cast("int")).over(w))
    for k in range(1, depth + 1):
        # The last heading of level k counts if no higher one came after it.
        heads = heads.withColumn(f"_l{k}", F.last(F.when(F.col(level) == k, F.struct(F.col(position).alias("p"), F.col(content).alias("c"))), ignorenulls=True).over(w))
    parts, above = [], F.lit(None).cast(lines.schema[position].dataType)
    for k in range(1, depth + 1):
        this = F.col(f"_l{k}")
        live = this.isNotNull() & (above.isNull() | (this["p"] > above))
        parts.append(F.when(live, this["c"]))
        above = F.greatest(above, this["p"])
    heads = heads.withColumn("_path", F.filter(F.array(*parts), lambda x: x.isNotNull()))
    text = heads.where(F.col(level) == 0).groupBy(id_col, "_h").agg(F.min(position).alias("position"), F.first("_path").alias("path"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(position, content))), lambda x: x[content]), "\n").alias("content"))
    return text.drop("_h")
