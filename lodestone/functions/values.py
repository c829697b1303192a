"""Numbers, dates, arrays, maps, JSON and hashes as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row; inside a lambda a plain Column would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- numbers ---


def to_float(c: Column) -> Column:
    """The number, or minus infinity."""
    return F.coalesce(c.try_cast("double"), F.lit(float("-inf")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays; 0 if either has no length."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.coalesce(F.try_divide(dot, norm(a) * norm(b)), F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def blend(title: Column, content: Column, title_weight: float = 0.1) -> Column:
    """Title and content vectors mixed by weight."""
    return F.zip_with(title, content, lambda x, y: x * title_weight + y * (1 - title_weight))


def pairwise_sum(a: Column) -> Column:
    """The sum of an array of numbers by halves, whose rounding error grows with the logarithm of their number: sums of 128
    in a row, then the sums of those."""
    doubles = F.transform(a, lambda x: x.cast("double"))
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    runs = lambda x: F.transform(F.sequence(F.lit(1), F.size(x), F.lit(128)), lambda i: total(F.slice(x, i, F.lit(128))))
    return F.when(F.size(a) <= 128, total(doubles)).otherwise(let(doubles, lambda x: total(runs(x))))


def arithmetic(op: str, a: Column, b: Column) -> Column:
    """``+= -= *= /=``; division by zero gives null."""
    return {"+=": a + b, "-=": a - b, "*=": a * b, "/=": F.try_divide(a, b)}[op]


def clamp(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


# --- dates ---


def from_epoch_ms(c: Column) -> Column:
    return F.date_format(F.timestamp_millis(c), "yyyy-MM-dd HH:mm:ss")


def to_epoch_ms(c: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(c))


def ymd_hms(c: Column) -> Column:
    """ISO text as ``YYYY-MM-DD HH:MM:SS``."""
    return F.date_format(F.try_to_timestamp(c), "yyyy-MM-dd HH:mm:ss")


def day_start(c: Column) -> Column:
    return F.date_trunc("day", c)


def day_end(c: Column) -> Column:
    return F.date_trunc("day", c) + F.expr("interval 86399 seconds")


def seconds_to(c: Column, now: Column | None = None) -> Column:
    return F.unix_timestamp(now if now is not None else F.current_timestamp()) - F.unix_timestamp(c)


# --- arrays ---


def head(a: Column, n: int) -> Column:
    return F.slice(a, 1, n) if n >= 1 else F.slice(a, 1, 0)


def tail(a: Column, n: int) -> Column:
    return F.slice(a, F.greatest(F.lit(1), F.size(a) - n + 1), F.lit(n)) if n >= 1 else F.slice(a, 1, 0)


def nth(a: Column, n: int) -> Column:
    """1-based, negative from the end; an array of the one element, or empty."""
    if n == 0:
        return F.slice(a, 1, 0)
    return F.when(F.size(a) >= abs(n), F.slice(a, n, 1)).otherwise(F.slice(a, 1, 0))


def strict(op: str, a: Column, n: int) -> Column:
    """nth, head or tail that raise outside the valid range."""
    f = {"nth": nth, "head": head, "tail": tail}[op]
    valid = (F.size(a) >= abs(n)) & F.lit(n != 0 if op == "nth" else n >= 1)
    return F.when(valid, f(a, n)).otherwise(F.raise_error(F.lit(f"{op} requires n to be within the valid range in strict mode, got {n}.")).cast("array<string>"))


_COMPARE = {
    "=": lambda v, x: v == x,
    "≠": lambda v, x: v != x,
    "contains": lambda v, x: F.contains(v, F.lit(x)),
    "start with": lambda v, x: F.startswith(v, F.lit(x)),
    "end with": lambda v, x: F.endswith(v, F.lit(x)),
}


def text_matches(v: Column, op: str, value: str) -> Column:
    """The string comparison of list and record filters; an operator it doesn't know matches nothing."""
    return _COMPARE[op](F.coalesce(v.cast("string"), F.lit("")), value) if op in _COMPARE else F.lit(False)


def list_filter(a: Column, op: str, value: str) -> Column:
    return F.filter(a, lambda x: text_matches(x, op, value))


def list_sort(a: Column, method: str = "asc") -> Column:
    return F.sort_array(a, asc=method != "desc")


def append(a: Column, x: Column) -> Column:
    return F.array_append(F.coalesce(a, F.array()), x)


def extend(a: Column, b: Column) -> Column:
    return F.concat(F.coalesce(a, F.array()), b)


def remove_first(a: Column) -> Column:
    return F.slice(a, 2, F.greatest(F.size(a), F.lit(1)))


def remove_last(a: Column) -> Column:
    return F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))


def cleared(c: Column, kind: str) -> Column:
    """The empty value of a type."""
    if kind.startswith(("array", "map")):
        return (F.array() if kind.startswith("array") else F.create_map()).cast(kind)
    return F.lit({"string": "", "boolean": False, "int": 0, "bigint": 0, "double": 0.0}.get(kind)).cast(kind)


def first_non_empty(*columns: Column) -> Column:
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def flat_unique(a: Column) -> Column:
    return F.array_distinct(F.flatten(a))


# --- maps and JSON ---


def tag_features(c: Column) -> Column:
    """Positive, finite weights of a JSON object or Python-literal dict of numbers; anything else is an empty map."""
    as_json = F.when(c.rlike("^\\s*\\{[^(){}]*\\}\\s*$"), F.regexp_replace(c, "'", '"'))
    parsed = F.from_json(as_json, "map<string,double>", {"mode": "PERMISSIVE"})
    valid = F.map_filter(parsed, lambda k, v: v.isNotNull() & (v > 0) & ~F.isnan(v) & (k != ""))
    return F.coalesce(valid, F.create_map().cast("map<string,double>"))


def json_path(c: Column, path: str) -> Column:
    """``a.b.0.c`` in a JSON text."""
    steps = "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))
    return F.get_json_object(c, "$" + steps)


def set_field(c: Column, path: str, value: Column) -> Column:
    """A struct column with a (nested) field set."""
    return c.withField(path, value)


def tag_cosine(query: dict[str, float], doc: Column) -> Column:
    """Cosine of a query's tag weights and a document's tag map, without pagerank."""
    q = {k: float(v) for k, v in query.items() if k != "pagerank_fea"}
    length = sum(v * v for v in q.values()) ** 0.5
    if not length:
        return F.lit(0.0)
    hit: Column = F.lit(0.0)
    for k, v in sorted(q.items()):
        hit = hit + F.coalesce(F.try_element_at(doc, F.lit(k)), F.lit(0.0)) * F.lit(v)
    own = F.sqrt(F.aggregate(F.map_values(doc), F.lit(0.0), lambda s, x: s + x * x))
    return F.coalesce(F.try_divide(hit, own * F.lit(length)), F.lit(0.0))


# --- hashes ---


def text_id(*parts: Column) -> Column:
    """A 64-bit hash of the parts as 16 hex digits (Spark's xxhash64, seed 42)."""
    return F.lpad(F.lower(F.hex(F.xxhash64(*parts))), 16, "0")


def args_digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *(p.cast("string") for p in parts)))


def hash_to_int(c: Column, mod: int = 100_000_000) -> Column:
    """sha1 of a text modulo a number."""
    return F.pmod(F.conv(F.substring(F.sha1(c), 26, 15), 16, 10).cast("long"), F.lit(mod))
