"""Chunk enrichment by plugged models: fields, tables of contents, citations, and decomposed questions.

A model is a function of a Column (or of a pandas Series, wrapped by ``F.pandas_udf``); without one, deterministic
stand-ins of built-in functions take its place. Answers are made once for each different text, and kept where a cache is
given.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.terms import keywords, noun_phrases
from .dml import Table

Model = Callable[[Column], Column]


def first_sentence(c: Column) -> Column:
    return F.trim(F.regexp_extract(c, "(?s)^\\s*(.*?[.!?。！？](?=\\s|$)|.+$)", 1))


#: Stand-ins by field: what a language model would be asked for.
STAND_INS: dict[str, Model] = {
    "important_kwd": lambda c: keywords(c, 5),
    "question_kwd": lambda c: F.transform(keywords(c, 3), lambda w: F.concat(F.lit("What about "), w, F.lit("?"))),
    "summary": first_sentence,
    "metadata": lambda c: F.create_map(F.lit("names"), F.array_join(F.slice(F.array_sort(noun_phrases(c)), 1, 5), ", "), F.lit("links"), F.regexp_count(c, F.lit("https?://\\S+")).cast("string")),
}


def enriched(chunks: DataFrame, field: str, text: str = "text", model: Model | None = None, cache: Table | None = None) -> DataFrame:
    """``chunks`` with the model's answer for ``field``. With a ``cache`` (a table of (digest, field, answer), answers as
    JSON), only texts that it hasn't are asked, once each, and their answers are added to it."""
    ask = model or STAND_INS[field]
    if cache is None:
        return chunks.withColumn(field, ask(F.col(text)))
    digest = F.md5(F.concat_ws("|", F.lit(field), F.coalesce(F.col(text), F.lit(""))))
    rows = chunks.withColumn("_digest", digest)
    kind = chunks.select(ask(F.col(text)).alias("a")).schema["a"].dataType
    asked = rows.groupBy("_digest").agg(F.first(text).alias("_text"))
    if cache.exists():
        asked = asked.join(cache.read().where(F.col("field") == field).select(F.col("digest").alias("_digest")), "_digest", "left_anti")
    answers = asked.select(F.col("_digest").alias("digest"), F.lit(field).alias("field"), F.to_json(F.struct(ask(F.col("_text")).alias("a"))).alias("answer"))
    cache.upsert(answers, "digest")
    known = cache.read().where(F.col("field") == field).select(F.col("digest").alias("_digest"), F.from_json("answer", f"a {kind.simpleString()}")["a"].alias(field))
    return rows.join(known, "_digest", "left").drop("_digest")


def table_of_contents(chunks: DataFrame, doc: str, position: str, chunk_id: str, heading: Column, title: Column) -> DataFrame:
    """Rows (doc, entry, title, ids): a document's headings in order, each with the chunks up to the next one; chunks ahead of
    the first heading belong to none."""
    order = Window.partitionBy(doc).orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = chunks.withColumn("_head", heading).withColumn("_title", title).withColumn("entry", F.sum(F.col("_head").cast("int")).over(order)).where("entry > 0")
    ids = F.transform(F.array_sort(F.collect_list(F.struct(position, chunk_id))), lambda x: x[chunk_id])
    return rows.groupBy(doc, "entry").agg(F.max(F.when(F.col("_head"), F.col("_title"))).alias("title"), ids.alias("ids"))


def with_document_metadata(chunks: DataFrame, documents: DataFrame, fields: list[str], doc: str = "doc_id") -> DataFrame:
    """Cited chunks with their documents' metadata as a map of the fields that have a value; a document that is gone gives
    an empty one."""
    pairs = F.map_filter(F.create_map(*(x for f in fields for x in (F.lit(f), F.col(f).cast("string")))), lambda k, v: v.isNotNull())
    found = documents.select(F.col(doc), pairs.alias("document_metadata"))
    return chunks.join(found, doc, "left").withColumn("document_metadata", F.coalesce("document_metadata", F.create_map().cast("map<string,string>")))


def json_schema(fields: dict[str, Any] | list[dict[str, Any]]) -> dict[str, Any]:
    """A list of metadata fields ({key, description, enum}) as JSON schema; a schema stays as it is, and what is neither is
    empty."""
    if isinstance(fields, dict):
        return fields if "$schema" in fields or (fields.get("type") == "object" and isinstance(fields.get("properties"), dict)) else {}
    text = lambda x: x is None or isinstance(x, str)
    valid = bool(fields) and all(isinstance(f, dict) and isinstance(f.get("key"), str) and f["key"] and isinstance(f.get("enum") or [], list) and text(f.get("description")) and text(f.get("descriptions")) for f in fields)
    if not valid:
        return {}
    properties = {f["key"]: {"description": f.get("description") or f.get("descriptions") or ""} | ({"enum": f["enum"], "type": "string"} if f.get("enum") else {}) for f in fields}
    return {"type": "object", "properties": properties, "additionalProperties": False}


def decomposed(question: str, retrieve: Callable[[str], DataFrame], split: Callable[[str, DataFrame], list[str]], depth: int = 3, chunk_id: str = "chunk_id") -> DataFrame:
    """Answers of a question and of the questions that ``split`` finds missing, down to ``depth``: the union of what they
    retrieve, each chunk once, from the first question that found it (columns ``question`` and ``level`` say which)."""
    asked: list[tuple[int, str]] = []

    def ask(q: str, level: int) -> None:
        if level > depth or q in [x for _, x in asked]:
            return
        asked.append((level, q))
        for more in split(q, retrieve(q)):
            ask(more, level + 1)

    ask(question, 1)
    found = [retrieve(q).withColumns({"question": F.lit(q), "level": F.lit(level), "_order": F.lit(k)}) for k, (level, q) in enumerate(asked)]
    every = reduce(DataFrame.unionByName, found)
    rest = F.struct(*every.columns)
    return every.groupBy(chunk_id).agg(F.min_by(rest, "_order").alias("_row")).select("_row.*").drop("_order")
