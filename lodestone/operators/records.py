"""Record operators: select, drop, rename, filter, update, evaluate and combine."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import text_matches
from .filters import all_of


def select_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The columns that exist, in the table's order."""
    return df.select(*(c for c in df.columns if c in keys))


def remove_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.drop(*keys)


def rename_keys(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Old to new names, in turn; blank, equal and missing names are skipped, and a new name replaces a column of that name."""
    for old, new in pairs:
        old, new = old.strip(), new.strip()
        if old and new and old != new and old in df.columns:
            df = df.drop(new).withColumnRenamed(old, new)
    return df


def filter_values(df: DataFrame, rules: list[dict[str, Any]]) -> DataFrame:
    """Rows that meet all rules {key, operator, value}, compared as text; a missing key meets nothing."""
    return df.where(all_of([text_matches(F.col(r["key"]), (r.get("operator") or "equals").lower(), str(r.get("value", ""))) if r.get("key") in df.columns else F.lit(False) for r in rules]))


def append_or_update(df: DataFrame, updates: dict[str, Any]) -> DataFrame:
    return df.withColumns({k.strip(): v if isinstance(v, Column) else F.lit(v) for k, v in updates.items() if k.strip()})


def literal_eval(c: Column) -> Column:
    """Texts that look like a literal as variants (numbers, booleans, lists, objects); others as text variants."""
    shaped = F.trim(c).rlike("^[\\[{('\"]") | F.lower(F.trim(c)).isin("true", "false", "none") | F.trim(c).rlike("^[0-9.]+$")
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "'", '"'), "\\bTrue\\b", "true"), "\\bFalse\\b", "false"), "\\bNone\\b", "null")
    body = F.when(F.startswith(F.trim(body), F.lit("(")), F.concat(F.lit("["), F.regexp_extract(F.trim(body), "^\\((.*?),?\\)$", 1), F.lit("]"))).otherwise(body)
    return F.coalesce(F.when(shaped, F.try_parse_json(body)), F.try_parse_json(F.to_json(F.struct(c.alias("t"))).substr(F.lit(6), F.length(F.to_json(F.struct(c.alias("t")))) - 6)))


def combine(df: DataFrame, order: str) -> DataFrame:
    """Records folded to (key, values): the values of each column in order."""
    columns = [c for c in df.columns if c != order]
    pairs = F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in columns))
    rows = df.select(F.col(order).alias("_o"), F.explode(pairs).alias("p")).select("_o", "p.key", "p.value").where("value is not null")
    return rows.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", "value"))), lambda x: x["value"]).alias("values"))
