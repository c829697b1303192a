"""The chunk DSL: a JSON pipeline preprocess -> split -> postprocess compiled to array expressions.

All steps work on one array column a document, so a pipeline is a projection and one explode: no shuffle, no Python.
Lengths are in characters throughout.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import language
from .expressions import compile_expression, parse

DEFAULT_BOUNDARIES = ["。", "！", "？", "\n"]
_STRATEGIES = ("sentence", "char", "paragraph")


# --- preprocess -------------------------------------------------------------------------------------------------------


def normalize_newlines(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "\\r\\n?", "\n"), "\\n{2,}", "\n")


def strip_lines(c: Column) -> Column:
    return F.array_join(F.transform(F.split(c, "\n", -1), lambda x: F.regexp_replace(x, "^\\s+|\\s+$", "")), "\n")


def remove_empty_lines(c: Column) -> Column:
    return F.array_join(F.filter(F.split(c, "\n", -1), lambda x: x.rlike("\\S")), "\n")


def merge_soft_breaks(c: Column) -> Column:
    """Lines joined by a space until one ends a sentence."""
    return F.regexp_replace(c, "(?<![.!?]\\s{0,9})\\n", " ")


# --- split ------------------------------------------------------------------------------------------------------------


def split_sentences(c: Column, boundaries: list[str] | None = None, keep: bool = False) -> Column:
    """Pieces between boundaries, the first boundary of the list that matches at a place wins; empty pieces are dropped."""
    any_of = "|".join("\\Q" + b + "\\E" for b in (boundaries or DEFAULT_BOUNDARIES) if b)
    if keep:
        marked = F.regexp_replace(c, f"({any_of})", "$1\u0001")
        return F.filter(F.split(marked, "\u0001", -1), lambda x: x != "")
    return F.filter(F.split(c, any_of, -1), lambda x: x != "")


def split_chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def split_paragraphs(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "\\n\\s*\\n", -1), lambda x: F.trim(x)), lambda x: x != "")


# --- postprocess ------------------------------------------------------------------------------------------------------


def greedy_merge(pieces: Column, target: int, joint: str = " ") -> Column:
    """Pieces packed to at most ``target`` characters; a piece of that length or more stands alone."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("buf"))

    def step(s: Column, x: Column) -> Column:
        full = F.array(s["buf"])
        flushed = F.when(s["buf"] != "", F.concat(s["done"], full)).otherwise(s["done"])
        alone = F.struct(F.concat(flushed, F.array(x)).alias("done"), F.lit("").alias("buf"))
        fresh = F.struct(flushed.alias("done"), x.alias("buf"))
        grown = F.struct(s["done"].alias("done"), F.concat(s["buf"], F.lit(joint), x).alias("buf"))
        fits = (s["buf"] != "") & (F.length(s["buf"]) + F.length(x) + len(joint) <= target)
        return F.when(F.length(x) >= target, alone).when(fits, grown).otherwise(fresh)

    return F.aggregate(pieces, empty, step, lambda s: F.when(s["buf"] != "", F.concat(s["done"], F.array(s["buf"]))).otherwise(s["done"]))


def _tail(previous: Column, size: Column, unit: str) -> Column:
    if unit == "sentence":
        parts = F.filter(F.transform(F.split(previous, "(?<=[.!?。！？])"), lambda x: F.trim(x)), lambda x: x != "")
        return F.when(F.size(parts) < size, previous).otherwise(F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - size + 1), F.greatest(size, F.lit(0))), " "))
    return F.when(size >= F.length(previous), previous).otherwise(F.substring(previous, F.length(previous) - size + 1, size))


def overlapped(pieces: Column, unit: str, conditions: list[tuple[str, int, str]], default: int) -> Column:
    """Each piece after the first begins with the end of the (already overlapped) one before it; size and unit are those of
    the first condition (expression, size, unit) that holds for the piece."""

    def tail_of(x: Column, last: Column) -> Column:
        def end(size: int, of: str) -> Column:
            return _tail(last, F.lit(size), of) if size > 0 else F.lit("")

        out = end(default, unit)
        for text, size, of in reversed(conditions):
            out = F.when(compile_expression(text, x), end(size, of)).otherwise(out)
        return out

    start = F.array().cast("array<string>")

    def step(done: Column, x: Column) -> Column:
        last = F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(""))
        return F.concat(done, F.array(F.when(F.size(done) > 0, F.concat(tail_of(x, last), x)).otherwise(x)))

    return F.aggregate(pieces, start, step)


def length_filter(pieces: Column, low: int = 0, high: int = 0) -> Column:
    return F.filter(pieces, lambda x: (F.length(x) >= low) & (F.lit(high <= 0) | (F.length(x) <= high)))


# --- the plan ---------------------------------------------------------------------------------------------------------


_PREPROCESS = {"normalize_newlines": normalize_newlines, "strip_whitespace": strip_lines, "remove_empty_lines": remove_empty_lines, "soft_line_break_merging": merge_soft_breaks}


@dataclass
class ChunkPlan:
    """A compiled pipeline: ``execute`` on a table, ``explain`` as text."""

    preprocess: dict[str, bool] = field(default_factory=dict)
    strategy: str | None = "sentence"  # None: a pipeline without operators, which makes no chunks
    boundaries: list[str] = field(default_factory=lambda: list(DEFAULT_BOUNDARIES))
    keep_separators: bool = False
    merge_target: int = 0
    overlap: tuple[str, list[tuple[str, int, str]], int] | None = None
    lengths: tuple[int, int] = (0, 0)
    include_index: bool = False
    custom: dict[str, str] = field(default_factory=dict)
    name: str = "No name"
    description: str = "No description"
    version: str = "1.0"
    operators: list[str] = field(default_factory=list)

    def pieces(self, text: Column) -> Column:
        if self.strategy is None:
            return F.array().cast("array<string>")
        for name, f in _PREPROCESS.items():
            if self.preprocess.get(name):
                text = f(text)
        out = split_chars(text) if self.strategy == "char" else split_paragraphs(text) if self.strategy == "paragraph" else split_sentences(text, self.boundaries, self.keep_separators)
        if self.merge_target:
            out = greedy_merge(out, self.merge_target)
        if self.overlap:
            out = overlapped(out, *self.overlap)
        return length_filter(out, *self.lengths) if any(self.lengths) else out

    def execute(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Rows (doc_id, index, content, size, metadata)."""
        rows = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(self.pieces(F.coalesce(F.col(text_col), F.lit("")))).alias("index", "content"))
        meta = [F.lit("language"), language(F.col("content"))]
        for k, v in (("index", F.col("index").cast("string")),) if self.include_index else ():
            meta += [F.lit(k), v]
        for k, v in self.custom.items():
            meta += [F.lit(k), F.lit(v)]
        return rows.select("doc_id", "index", "content", F.length("content").alias("size"), F.create_map(*meta).alias("metadata"))

    def explain(self) -> str:
        if self.strategy is None:
            return "no operators"
        lines = ["preprocess: " + (", ".join(k for k, v in self.preprocess.items() if v) or "none")]
        lines.append(f"split: strategy={self.strategy}" + (f" boundaries={self.boundaries} keep_separators={self.keep_separators}" if self.strategy == "sentence" else ""))
        post = [f"merge target_size={self.merge_target}"] if self.merge_target else []
        if self.overlap:
            post.append(f"overlap unit={self.overlap[0]} default={self.overlap[2]} conditions={len(self.overlap[1])}")
        if any(self.lengths):
            post.append(f"filter min_length={self.lengths[0]} max_length={self.lengths[1]}")
        if self.include_index or self.custom:
            post.append(f"add_metadata include_index={self.include_index} custom_fields={sorted(self.custom)}")
        return "\n".join([*lines, "postprocess: " + ("; ".join(post) or "none")])


def _known(where: str, d: dict[str, Any], *names: str) -> dict[str, Any]:
    """``d``, if it has no other keys than ``names``."""
    if not isinstance(d, dict):
        raise ValueError(f"{where}: expected object")
    if unknown := sorted(set(d) - set(names)):
        raise ValueError(f"{where}: unknown option {unknown[0]}")
    return d


def _operators(d: dict[str, Any]) -> tuple[list[tuple[str, str, dict[str, Any]]], bool]:
    """(where, operator, options) of a document in either form, and whether it is a pipeline."""
    if "pipeline" not in d and not {"preprocess", "split", "postprocess"} & set(d):
        _known("document", d, "name", "description", "version")
        return [], True
    if "pipeline" not in d:
        _known("document", d, "name", "description", "version", "preprocess", "split", "postprocess")
        return [(k, k, d[k] or {}) for k in ("preprocess", "split", "postprocess") if k in d], False
    _known("document", d, "name", "description", "version", "pipeline")
    out = []
    for i, x in enumerate(d["pipeline"]):
        if not isinstance(x, dict):
            raise ValueError(f"pipeline[{i}]: expected object")
        kind = x.get("operator", "")
        if kind not in ("preprocess", "split", "postprocess"):
            raise ValueError(f"pipeline[{i}]: unknown operator {kind}")
        if kind in (k for _, k, _ in out) or (out and kind == "preprocess") or (kind == "split" and out and out[-1][1] == "postprocess"):
            raise ValueError(f"pipeline[{i}]: operators come once each, in the order preprocess, split, postprocess")
        out.append((f"pipeline[{i}]", kind, {k: v for k, v in x.items() if k != "operator"}))
    return out, True


def compile_plan(dsl: str | dict[str, Any]) -> ChunkPlan:
    """Check a DSL document and compile it: ``{"name", "pipeline": [{"operator": "split", ...}, ...]}``, or the operators as
    keys of the document. Unknown operators and options are errors, and expressions are parsed here, so that mistakes show
    before anything runs. A pipeline that doesn't split makes no chunks."""
    d = json.loads(dsl) if isinstance(dsl, str) else dsl
    if not isinstance(d, dict):
        raise ValueError("document: expected object")
    steps, pipeline = _operators(d)
    plan = ChunkPlan(name=d.get("name") or "No name", description=d.get("description") or "No description", version=d.get("version") or "1.0", operators=[kind for _, kind, _ in steps])
    if pipeline and "split" not in plan.operators:
        plan.strategy = None
    for where, kind, x in steps:
        if kind == "preprocess":
            for k, v in _known(where, x, *_PREPROCESS).items():
                if not isinstance(v, bool):
                    raise ValueError(f"{where}: {k} must be bool")
            plan.preprocess = dict(x)
        elif kind == "split":
            _known(where, x, "strategy", "params")
            params = _known(f"{where}.params", x.get("params") or {}, "boundaries", "keep_separators")
            plan.strategy = x.get("strategy") or "sentence"
            if plan.strategy not in _STRATEGIES:
                raise ValueError(f"{where}: unknown strategy {plan.strategy}")
            plan.boundaries, plan.keep_separators = params.get("boundaries") or list(DEFAULT_BOUNDARIES), bool(params.get("keep_separators"))
        else:
            _known(where, x, "merge", "overlap", "filter", "add_metadata")
            if (merge := x.get("merge")) is not None:
                if _known(f"{where}.merge", merge, "target_size", "strategy").get("strategy", "greedy") != "greedy":
                    raise ValueError(f"{where}.merge: unknown strategy {merge['strategy']}")
                plan.merge_target = int(merge.get("target_size") or 500)
            if o := x.get("overlap"):
                unit = _known(f"{where}.overlap", o, "enabled", "unit", "conditions", "default").get("unit") or "char"
                conditions = []
                for c in o.get("conditions", []):
                    then = _known(f"{where}.overlap.then", _known(f"{where}.overlap.conditions", c, "name", "if", "then")["then"], "size", "unit")
                    parse(c["if"])
                    conditions.append((c["if"], int(then["size"]), then.get("unit") or unit))
                default = _known(f"{where}.overlap.default", o.get("default") or {}, "size")
                if unknown := sorted({unit, *(u for *_, u in conditions)} - {"char", "sentence"}):
                    raise ValueError(f"{where}.overlap: unknown unit {unknown[0]}")
                if o.get("enabled", True):
                    plan.overlap = (unit, conditions, int(default.get("size", 0)))
            limits = _known(f"{where}.filter", x.get("filter") or {}, "min_length", "max_length")
            extra = _known(f"{where}.add_metadata", x.get("add_metadata") or {}, "include_index", "custom_fields")
            plan.lengths = (int(limits.get("min_length") or 0), int(limits.get("max_length") or 0))
            plan.include_index, plan.custom = bool(extra.get("include_index")), {k: str(v) for k, v in (extra.get("custom_fields") or {}).items()}
    return plan
