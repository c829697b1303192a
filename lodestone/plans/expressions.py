"""The boolean expression language of chunk conditions, compiled to Columns.

    expr  := and ("OR" and)*        and := not ("AND" not)*        not := "NOT" not | test
    test  := "(" expr ")" | operand [op operand]                   op  := = == != <> > < >= <=
    operand := 'text' | "text" | number | true | false | name

A bare name means ``name = true``. Names: has_url, has_image_url, has_video_url, has_media_url, length, language, and
metadata keys.
"""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import language

_TOKEN = re.compile(r"\s*(?:(\d+(?:\.\d+)?)|'([^']*)'|\"([^\"]*)\"|(==|!=|<>|>=|<=|=|>|<)|([()])|([A-Za-z_][\w.]*))")
URL = "https?://[^\\s]+"
IMAGE_URL = "(?i)https?://[^\\s]+\\.(png|jpe?g|gif|webp|bmp|svg)"
VIDEO_URL = "(?i)https?://[^\\s]+\\.(mp4|avi|mov|mkv|webm|flv)"


def variables(content: Column, metadata: Column | None = None) -> dict[str, Column]:
    return {
        "has_url": content.rlike(URL),
        "has_image_url": content.rlike(IMAGE_URL),
        "has_video_url": content.rlike(VIDEO_URL),
        "has_media_url": content.rlike(IMAGE_URL) | content.rlike(VIDEO_URL),
        "length": F.length(content),
        "language": language(content),
    }


def _lexed(text: str) -> list[tuple[str, Any]]:
    out, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"unexpected input at {at}: {text[at:]!r}")
        at = m.end()
        number, one, two, op, paren, name = m.groups()
        if number is not None:
            out.append(("value", float(number)))
        elif one is not None or two is not None:
            out.append(("value", one if one is not None else two))
        elif op:
            out.append(("op", {"==": "=", "<>": "!="}.get(op, op)))
        elif paren:
            out.append((paren, paren))
        elif name.upper() in ("AND", "OR", "NOT"):
            out.append((name.upper(), name))
        elif name.lower() in ("true", "false"):
            out.append(("value", name.lower() == "true"))
        else:
            out.append(("name", name))
    return out


def parse(text: str) -> tuple:
    """A tree of ("or"|"and", a, b), ("not", a), (op, left, right); operands are ("name", n) or ("value", v)."""
    tokens = _lexed(text)
    at = 0

    def peek() -> str:
        return tokens[at][0] if at < len(tokens) else "end"

    def take(kind: str) -> Any:
        nonlocal at
        if peek() != kind:
            raise ValueError(f"expected {kind}, found {peek()}")
        at += 1
        return tokens[at - 1][1]

    def either(word: str, inner) -> tuple:
        left = inner()
        while peek() == word:
            take(word)
            left = (word.lower(), left, inner())
        return left

    def negated() -> tuple:
        if peek() == "NOT":
            take("NOT")
            return ("not", negated())
        if peek() == "(":
            take("(")
            inside = either("OR", lambda: either("AND", negated))
            take(")")
            return inside
        left = operand()
        return (take("op"), left, operand()) if peek() == "op" else ("=", left, ("value", True))

    def operand() -> tuple:
        kind = peek()
        if kind not in ("value", "name"):
            raise ValueError(f"expected an operand, found {kind}")
        return (kind, take(kind))

    tree = either("OR", lambda: either("AND", negated))
    if peek() != "end":
        raise ValueError(f"unexpected {peek()} after the expression")
    return tree


def compile_expression(text: str, content: Column, metadata: Column | None = None) -> Column:
    names = variables(content)

    def operand(o: tuple) -> Column:
        if o[0] == "value":
            return F.lit(o[1])
        if o[1] in names:
            return names[o[1]]
        return F.try_element_at(metadata, F.lit(o[1])) if metadata is not None else F.lit(None).cast("string")

    def build(t: tuple) -> Column:
        if t[0] in ("or", "and"):
            a, b = build(t[1]), build(t[2])
            return a | b if t[0] == "or" else a & b
        if t[0] == "not":
            return ~build(t[1])
        a, b = operand(t[1]), operand(t[2])
        if any(o[0] == "value" and isinstance(o[1], str) for o in t[1:]):
            a, b = a.cast("string"), b.cast("string")
        elif any(o[0] == "value" and isinstance(o[1], bool) for o in t[1:]):
            a, b = a.cast("boolean"), b.cast("boolean")
        elif any(o[0] == "value" for o in t[1:]):
            a, b = a.try_cast("double"), b.try_cast("double")
        ops = {"=": Column.__eq__, "!=": Column.__ne__, ">": Column.__gt__, "<": Column.__lt__, ">=": Column.__ge__, "<=": Column.__le__}
        return F.coalesce(ops[t[0]](a, b), F.lit(False))

    return build(parse(text))
