"""Document templates: a document (or table) to chunks, by the kind of document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokenize
from .chunkers import HEADING_FAMILIES, group_title_chunks, heading_level, section_ids, token_chunks

KINDS = ("int", "float", "text", "datetime", "bool")
# The words and signs of yes and no, in either case.
TRUE, FALSE = ("true", "yes", "是", "*", "✓", "✔", "☑", "✅", "√"), ("false", "no", "否", "⍻", "×")
#: Forms of dates, the first that fits counts; a text of digits alone is a number before it is a date.
DATES = (
    "yyyy-M-d[ H:m[:s]]", "yyyy/M/d[ H:m[:s]]", "yyyy.M.d", "yyyy-M-d'T'H:m[:s][.SSS][XXX]", "M/d/yyyy[ H:m[:s]]", "M-d-yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "yyyy-M", "MMM yyyy",
)
#: Columns that never become content.
INTERNAL = {"id", "_id", "index", "idx"}


def _date(c: Column) -> Column:
    return F.coalesce(*(F.try_to_timestamp(F.trim(c), F.lit(f)) for f in DATES))


def value_kind(c: Column) -> Column:
    """The kind a cell votes for: digits without a leading zero int; up to 19 digits and points, likewise, float; yes and no
    bool; dates datetime; else text. Whole numbers above 64 bits are ``big``, of which one makes the column float."""
    t = F.replace(c, F.lit("%%"), F.lit(""))
    led = ~t.startswith("0")
    whole, number = t.rlike("^[+-]?[0-9]+$") & led, t.try_cast("decimal(38,0)")
    return (
        F.when(whole & ~t.startswith("-") & (number.isNull() | (number > F.lit(str((1 << 63) - 1)).cast("decimal(38,0)"))), "big")
        .when(whole, "int")
        .when(t.rlike("^[+-]?[0-9.]{0,19}$") & led, "float")
        .when(F.lower(c).isin(*TRUE, *FALSE), "bool")
        .when(_date(c).isNotNull(), "datetime")
        .otherwise("text")
    )


def column_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, kind, votes): the kind with most votes among cells that aren't empty, ties by the order of KINDS; float
    where a whole number is beyond 64 bits. One aggregate for all columns."""
    every = (*KINDS, "big")
    cells = df.select(*(F.struct(value_kind(F.col(f"`{c}`").cast("string")).alias("k"), (F.trim(F.col(f"`{c}`").cast("string")) != "").alias("any")).alias(c) for c in columns))
    votes = cells.agg(*(F.count_if((F.col(f"`{c}`.k") == k) & F.col(f"`{c}`.any")).alias(f"{c}|{k}") for c in columns for k in every))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"`{c}|{k}`").alias(k) for k in every)) for c in columns))
    best = F.greatest(*KINDS)
    pick = F.lit("text")
    for k in reversed(KINDS):
        pick = F.when((F.col(k) == best) & (best > 0), k).otherwise(pick)
    return votes.select(F.explode(rows).alias("r")).select("r.*").select("column", F.when(F.col("big") > 0, "float").otherwise(pick).alias("kind"), best.alias("votes"))


def as_bool(c: Column) -> Column:
    """yes or no of the usual words and signs, else null."""
    t = F.lower(F.trim(c))
    return F.when(t.isin(*TRUE), "yes").when(t.isin(*FALSE), "no")


def as_datetime(c: Column) -> Column:
    return F.date_format(_date(c), "yyyy-MM-dd HH:mm:ss")


def coerced(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns cast to their kinds; what can't be cast is null."""
    cast = {"int": lambda c: c.try_cast("bigint"), "float": lambda c: c.try_cast("double"), "bool": as_bool, "datetime": as_datetime, "text": lambda c: c.cast("string")}
    return df.withColumns({n: cast[k](F.col(n).cast("string")) for n, k in kinds.items()})


def table_chunks(df: DataFrame, id_col: str, columns: list[str], roles: dict[str, str] | None = None) -> DataFrame:
    """A row a chunk: text ``- column: value`` of the columns for indexing, a map of those for metadata; role ``both`` is default."""
    roles, columns = roles or {}, [c for c in columns if c.lower() not in INTERNAL]
    role = lambda c: roles.get(c, "both")
    shown = [c for c in columns if role(c) in ("indexing", "vectorize", "both")]
    kept = [c for c in columns if role(c) in ("metadata", "both")]
    text = F.concat_ws("\n", *(F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.concat(F.lit(f"- {c}: "), F.col(c).cast("string"))) for c in shown))
    meta = F.map_filter(F.create_map(*(x for c in kept for x in (F.lit(c), F.col(c).cast("string")))), lambda k, v: v.isNotNull()) if kept else F.create_map().cast("map<string,string>")
    return df.select(F.col(id_col).cast("string").alias("doc_id"), text.alias("content"), meta.alias("chunk_data")).where("content <> ''").withColumn("content_ltks", tokenize(F.col("content")))


def qa_pairs(lines: DataFrame, id_col: str, position: str, line: str, delimiter: str = "\t") -> DataFrame:
    """Question and answer of delimited lines; a line without exactly one delimiter continues the answer before it."""
    w = Window.partitionBy(id_col).orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = F.split(line, delimiter, -1)
    starts = lines.withColumn("_pair", F.size(parts) == 2).withColumn("_n", F.sum(F.col("_pair").cast("int")).over(w)).where("_n > 0")
    rows = starts.groupBy(id_col, "_n").agg(
        F.max(F.when(F.col("_pair"), parts[0])).alias("question"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(position, F.when(F.col("_pair"), parts[1]).otherwise(F.col(line)).alias("a")))), lambda x: x["a"]), "\n").alias("answer"),
    )
    return rows.withColumnRenamed("_n", "pair")


def qa_markdown(lines: DataFrame, id_col: str, position: str, line: str) -> DataFrame:
    """Headings are questions (with the headings above them), the text below them the answer."""
    from .chunkers import hierarchy_chunks

    out = hierarchy_chunks(lines.withColumn("_level", heading_level(F.col(line), "markdown")), id_col, position, line, "_level")
    clean = F.transform("path", lambda x: F.trim(F.regexp_replace(x, "^#+", "")))
    return out.where(F.size("path") > 0).select(id_col, "position", F.array_join(clean, "\n").alias("question"), F.col("content").alias("answer"))


def tag_rows(df: DataFrame, content: str, tags: str) -> DataFrame:
    """Content with its comma-separated tags as an array."""
    return df.select(F.col(content).alias("content"), F.filter(F.transform(F.split(tags, ","), lambda x: F.replace(F.trim(x), F.lit("."), F.lit("_"))), lambda x: x != "").alias("tag_kwd"))


def content_tags(chunks: DataFrame, tagged: DataFrame, id_col: str, text: str, top: int = 3) -> DataFrame:
    """Tags of the labelled rows that share most words with a chunk: rows (id, tag, score), the ``top`` of each chunk.

    The word join is grouped by chunk and tag before anything is ranked.
    """
    from ..functions.text import tokens

    words = chunks.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(tokens(F.col(text)))).alias("w"))
    known = tagged.select("tag_kwd", F.explode(F.array_distinct(tokens(F.col("content")))).alias("w")).select("w", F.explode("tag_kwd").alias("tag")).groupBy("w", "tag").agg(F.count("*").alias("n"))
    spread = known.groupBy("w").agg(F.sum("n").alias("all"))
    scores = words.join(known.join(spread, "w"), "w").groupBy("id", "tag").agg(F.sum(F.col("n") / F.col("all")).alias("score"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "tag")))
    best = scores.groupBy("id").agg(F.slice(ordered, 1, top).alias("b"))  # a chunk has at most as many rows as there are tags
    return best.select("id", F.explode("b").alias("x")).select("id", "x.tag", (-F.col("x.s")).alias("score"))


# --- one function a template -------------------------------------------------------------------------------------------


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("position", "line")).where("trim(line) <> ''")


def naive(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    return token_chunks(docs, id_col, text_col, **options)


def one(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return token_chunks(docs, id_col, text_col, mode="one")


def titled(family: str, low: int = 32, high: int = 1024) -> Callable[[DataFrame, str, str], DataFrame]:
    """Sections of a heading family merged to chunks: books, laws and manuals."""

    def run(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        lines = _lines(docs, id_col, text_col)
        lines = section_ids(lines, "doc_id", "position", heading_level(F.col("line"), family) > 0)
        return group_title_chunks(lines, "doc_id", "position", "line", "section", low=low, high=high).drop("tokens")

    return run


def paper(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The abstract whole as the first chunk, then the sections."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    abstract = F.regexp_extract(text, "(?is)\\babstract\\b[:.\\s-]*(.*?)(?=\\n\\s*(?:[1I]\\.?\\s+)?introduction\\b|\\n\\s*\\n|$)", 1)
    first = docs.select(F.col(id_col).alias("doc_id"), F.lit(-1).alias("position"), F.trim(abstract).alias("content")).where("content <> ''")
    return first.unionByName(titled("markdown")(docs, id_col, text_col))


def presentation(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A chunk a page (form feeds part pages)."""
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\f")).alias("position", "content")).where("trim(content) <> ''")


def email(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Header block, then the body's chunks."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = F.split(F.regexp_replace(text, "\\r\\n", "\n"), "\\n\\n", 2)
    head = docs.select(F.col(id_col).alias("doc_id"), F.lit(-1).alias("position"), F.trim(parts[0]).alias("content")).where("content <> ''")
    body = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias(text_col))
    return head.unionByName(token_chunks(body, id_col, text_col))


def external(kind: str, model: Callable[[DataFrame, str, str], DataFrame] | None = None) -> Callable[[DataFrame, str, str], DataFrame]:
    """Pictures and audio need a model that the caller plugs in."""

    def run(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        if model is None:
            raise NotImplementedError(f"the {kind} template needs a model: external({kind!r}, model)")
        return model(docs, id_col, text_col)

    return run


REGISTRY: dict[str, Callable] = {
    "naive": naive, "general": naive, "one": one, "book": titled("zh_numbered"), "laws": titled("zh_legal"), "manual": titled("markdown"), "paper": paper,
    "presentation": presentation, "email": email, "picture": external("picture"), "audio": external("audio"), "table": table_chunks, "qa": qa_pairs, "tag": tag_rows,
}


def template(parser_id: str) -> Callable:
    """The template of a parser id; unknown ids are the general one."""
    return REGISTRY.get(parser_id.lower(), naive)


__all__ = ["HEADING_FAMILIES", "REGISTRY", "template", *KINDS]
