"""Row filters: conditions, availability, metadata buckets, routing."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALIASES = {"is": "=", "not is": "≠", "!=": "≠", ">=": "≥", "<=": "≤"}
OPERATORS = ("=", "≠", ">", "<", "≥", "≤", "in", "not in", "contains", "not contains", "start with", "end with", "empty", "not empty")
_DATE = "^\\d{4}-\\d{2}-\\d{2}$"


def all_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns, F.lit(True))


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns, F.lit(False))


def available(c: Column, value: int) -> Column:
    """0: below 1. Anything else: not below 1, so null counts as available."""
    return (c < 1) if value == 0 else ~F.coalesce(c < 1, F.lit(False))


def condition(df: DataFrame, where: dict[str, Any]) -> Column:
    """Equality and membership by column; falsy values are skipped, but for available_int; ``exists`` and
    ``must_not: {exists: column}`` test for null. List columns match if they share an element."""
    parts = []
    types = dict(df.dtypes)
    for name, value in where.items():
        if name == "available_int":
            parts.append(available(F.col(name), int(value or 0)))
        elif name == "exists":
            parts.append(F.col(value).isNotNull())
        elif name == "must_not":
            parts.append(F.col(value["exists"]).isNull())
        elif value:
            values = list(value) if isinstance(value, (list, tuple, set)) else [value]
            if types[name].startswith("array"):
                parts.append(F.arrays_overlap(F.col(name), F.array(*map(F.lit, values))))
            else:
                parts.append(F.col(name).isin(values) if len(values) > 1 else F.col(name) == values[0])
    return all_of(parts)


def csv_has(c: Column, tags: list[str]) -> Column:
    """Any of the tags is an element of a comma-separated text."""
    return F.arrays_overlap(F.split(c, ","), F.array(*map(F.lit, tags)))


def contains_text(c: Column, word: str) -> Column:
    return F.contains(F.lower(c), F.lit(word.lower()))


def between_days(c: Column, first: str, last: str) -> Column:
    """From the start of one day to the end of another."""
    return (c >= F.lit(first).cast("timestamp")) & (c < F.date_add(F.lit(last).cast("date"), 1))


def visible(owner: Column, permission: Column, status: Column, user: str, tenants: list[str]) -> Column:
    """Own rows, and team rows of joined tenants, if valid."""
    return ((owner == user) | ((permission == "team") & owner.isin(tenants))) & (status == "1")


def value_matches(v: Column, op: str, value: Any) -> Column:
    """Whether a metadata value meets a condition: a pure function of value, operator and operand.

    Dates compare with dates only. Two numbers compare as numbers, anything else as lower-case text. ``in`` takes members
    of a list (or of a comma-separated text) in either case.
    """
    op = ALIASES.get(op, op)
    if op not in OPERATORS:
        raise ValueError(f"operator {op}")
    if op in ("empty", "not empty"):
        return (v == "") if op == "empty" else (v != "")
    low = F.lower(v)
    if op in ("in", "not in"):
        items = value.split(",") if isinstance(value, str) else value
        hit = low.isin([str(x).strip().lower() for x in items])
        return hit if op == "in" else ~hit
    text = str(value).lower()
    if op in ("contains", "not contains", "start with", "end with"):
        hit = {"contains": F.contains, "not contains": F.contains, "start with": F.startswith, "end with": F.endswith}[op](low, F.lit(text))
        return ~hit if op == "not contains" else hit
    compare = {"=": Column.__eq__, "≠": Column.__ne__, ">": Column.__gt__, "<": Column.__lt__, "≥": Column.__ge__, "≤": Column.__le__}[op]
    import re

    if re.match(_DATE, str(value).strip()):
        return F.trim(v).rlike(_DATE) & compare(F.trim(v), F.lit(str(value).strip()))
    try:
        number = float(value)
    except (TypeError, ValueError):
        return compare(low, F.lit(text))
    return F.when(v.try_cast("double").isNotNull(), compare(v.try_cast("double"), F.lit(number))).otherwise(compare(low, F.lit(text)))


def buckets(df: DataFrame, doc_id: str, columns: dict[str, Column]) -> DataFrame:
    """Long metadata rows (key, value, doc_id): one a value; list values give a row each."""

    def paired(key: str, c: Column) -> Column:
        array = c if df.select(c.alias("x")).dtypes[0][1].startswith("array") else F.array(c)
        return F.transform(array, lambda x: F.struct(F.lit(key).alias("key"), x.cast("string").alias("value")))

    pairs = [paired(key, c) for key, c in columns.items()]
    rows = df.select(F.col(doc_id).alias("doc_id"), F.explode(F.concat(*pairs)).alias("p"))
    return rows.select("p.key", "p.value", "doc_id").where("value is not null")


def meta_filter(meta: DataFrame, conditions: list[dict[str, Any]], logic: str = "and") -> DataFrame:
    """doc_ids whose buckets meet all (or any) of the conditions {key, op, value}.

    One pass over the buckets: a row says which conditions it meets, and a grouped OR says which ones its document meets,
    however many conditions there are. A missing key meets nothing; a document of several values may meet both = and ≠.
    """
    if not conditions:
        return meta.select("doc_id").distinct()
    flags = [F.max(F.coalesce((F.col("key") == c["key"]) & value_matches(F.col("value"), c.get("op", "="), c.get("value")), F.lit(False))).alias(f"_{k}") for k, c in enumerate(conditions)]
    keys = sorted({c["key"] for c in conditions})
    met = meta.where(F.col("key").isin(keys)).groupBy("doc_id").agg(*flags)
    names = [F.col(f"_{k}") for k in range(len(conditions))]
    return met.where(all_of(names) if logic == "and" else any_of(names)).select("doc_id")


def manual_filter(meta: DataFrame, conditions: list[dict[str, Any]], logic: str = "and") -> DataFrame:
    """meta_filter whose empty result is the id -999, which no document has."""
    found = meta_filter(meta, conditions, logic)
    none = meta.sparkSession.range(1).select(F.lit("-999").alias("doc_id"))
    return found.select(F.col("doc_id").cast("string")).unionByName(none.join(found.limit(1).select(F.lit(1).alias("_x")), F.lit(True), "left_anti"))


def switch(conditions: list[dict[str, Any]], otherwise: str, columns: dict[str, Column]) -> Column:
    """The target of the first condition that holds: {logical_operator, items: [{cpn_id, operator, value}], to}.

    An item without cpn_id is skipped; a condition of no items never holds. Text operators ignore case.
    """
    out = None
    for c in conditions:
        parts = [_route(columns[i["cpn_id"]], i["operator"], i.get("value", "")) for i in c["items"] if i.get("cpn_id")]
        if not parts:
            continue
        test = F.coalesce(all_of(parts) if c.get("logical_operator") == "and" else any_of(parts), F.lit(False))
        out = F.when(test, F.lit(c["to"])) if out is None else out.when(test, F.lit(c["to"]))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))


def _route(v: Column, op: str, value: Any) -> Column:
    text = v.cast("string")
    if op in ("contains", "not contains", "start with", "end with"):
        hit = {"contains": F.contains, "not contains": F.contains, "start with": F.startswith, "end with": F.endswith}[op](F.lower(text), F.lit(str(value).lower()))
        return ~hit if op == "not contains" else hit
    if op in ("empty", "not empty"):
        empty = v.isNull() | (text == "")
        return empty if op == "empty" else ~empty
    compare = {"=": Column.__eq__, "≠": Column.__ne__, ">": Column.__gt__, "<": Column.__lt__, "≥": Column.__ge__, "≤": Column.__le__}.get(op)
    if compare is None:
        raise ValueError(f"Not supported operator: {op}")
    try:
        number = float(value)
    except (TypeError, ValueError):
        return compare(text, F.lit(str(value)))
    return F.when(text.try_cast("double").isNotNull(), compare(text.try_cast("double"), F.lit(number))).otherwise(compare(text, F.lit(str(value))))


def infinity_predicate(where: dict[str, Any]) -> str:
    """The same conditions as SQL text, quotes doubled."""
    quote = lambda v: "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)
    parts = []
    for name, value in where.items():
        if name == "exists":
            parts.append(f"{value} IS NOT NULL")
        elif name == "must_not":
            parts.append(f"{value['exists']} IS NULL")
        elif isinstance(value, (list, tuple, set)):
            if value:
                parts.append(f"{name} IN ({', '.join(map(quote, value))})")
        elif value or name == "available_int":
            parts.append((f"{name} < 1" if not value else f"NOT coalesce({name} < 1, false)") if name == "available_int" else f"{name} = {quote(value)}")
    return " AND ".join(parts) or "1=1"
