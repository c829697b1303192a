"""SQL passthrough: statements over named tables, with text search on token columns."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LIKE = re.compile(r"\b([a-zA-Z_][\w.]*_l?tks)\s+(?:I?LIKE)\s+'([^']*)'", re.IGNORECASE)
_EQUAL = re.compile(r"\b([a-zA-Z_][\w.]*_l?tks)\s*=\s*'([^']*)'", re.IGNORECASE)


def text_predicates(sql: str) -> str:
    """LIKE and = on token columns as tests that all words of the pattern are among the column's tokens."""

    def rewrite(m: re.Match) -> str:
        words = re.findall(r"\w+", m[2].replace("%", " ").lower())
        tests = [f"array_contains(split({m[1]}, ' '), '{w}')" for w in words]
        return "(" + (" AND ".join(tests) or "true") + ")"

    return _EQUAL.sub(rewrite, _LIKE.sub(rewrite, sql))


def with_aliases(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """A table with its columns under the names that queries use."""
    return df.select(*(F.col(c).alias(aliases.get(c, c)) for c in df.columns))


def statements(sql: str) -> list[str]:
    """The statements between semicolons outside quotes; fences and comments go."""
    sql = re.sub(r"```(?:sql)?", "", sql)
    sql = re.sub(r"--[^\n]*", "", sql)
    return [s.strip() for s in re.split(r";(?=(?:[^']*'[^']*')*[^']*$)", sql) if s.strip()]


def presentable(df: DataFrame) -> DataFrame:
    """Decimals as doubles (NaN and infinities null), dates and times as texts."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("decimal") or kind in ("double", "float"):
            c = c.cast("double")
            c = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(name))
    return df.select(*out)


def execute(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None, max_records: int = 1024) -> Iterator[DataFrame]:
    """The results of the statements in turn, each at most ``max_records`` rows."""
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    for s in statements(sql):
        yield presentable(spark.sql(text_predicates(s)).limit(max_records))
