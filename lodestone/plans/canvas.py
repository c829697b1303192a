"""Agent canvases: a JSON graph of components over tables.

    {"components": {"id": {"obj": {"component_name": "ListOperations", "params": {...}}, "downstream": [...]}},
     "globals": {"sys.query": ...}}

Values are addressed ``{component@variable}``, ``sys.x`` or ``env.x``, with paths behind. Tables stay lazy DataFrames from
component to component; Switch and Loop look at one value of a one-row table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import filters, records, relational
from . import sql as S

_REFERENCE = re.compile(r"^\{*\s*([\w:-]+@[\w.-]+|sys\.[\w.]+|env\.[\w.]+)\s*\}*$")
COMPONENTS: dict[str, Callable[[Canvas, dict], Any]] = {}


def component(name: str) -> Callable:
    """Register a component; users add theirs the same way."""

    def add(f: Callable) -> Callable:
        COMPONENTS[name.lower()] = f
        return f

    return add


class Canvas:
    def __init__(self, spark: SparkSession, dsl: str | dict, inputs: dict[str, Any] | None = None) -> None:
        d = json.loads(dsl) if isinstance(dsl, str) else dsl
        self.spark, self.components = spark, d["components"]
        self.globals = {**d.get("globals", {}), **(inputs or {})}
        self.outputs: dict[str, dict[str, Any]] = {}
        self.path: list[str] = []

    def value(self, reference: Any) -> Any:
        """What a reference stands for; other values are themselves."""
        m = _REFERENCE.match(reference) if isinstance(reference, str) else None
        if not m:
            return reference
        name = m[1]
        if "@" in name:
            cid, _, path = name.partition("@")
            first, _, rest = path.partition(".")
            found = self.outputs.get(cid, {}).get(first)
            return nested(found, rest) if rest else found
        if name in self.globals:
            return self.globals[name]
        parts = name.split(".")
        for k in range(len(parts) - 1, 1, -1):
            if ".".join(parts[:k]) in self.globals:
                return nested(self.globals[".".join(parts[:k])], ".".join(parts[k:]))
        return None

    def run(self, start: str = "begin", limit: int = 200) -> dict[str, dict[str, Any]]:
        """Components in waves; one runs when those upstream of it that were reached have run."""
        todo, count = [start], 0
        while todo:
            count += 1
            if count > limit:
                raise RuntimeError("the canvas doesn't end")
            cid = todo.pop(0)
            c = self.components[cid]
            name = c["obj"]["component_name"]
            f = COMPONENTS.get(name.lower())
            if f is None:
                raise ValueError(f"unknown component {name}")
            got = f(self, c["obj"].get("params", {}))
            following = got.pop("_next") if isinstance(got, dict) and "_next" in got else c.get("downstream", [])
            self.outputs[cid] = got if isinstance(got, dict) else {"result": got}
            self.path.append(cid)
            todo += [x for x in following if x not in todo]
        return self.outputs


def nested(value: Any, path: str) -> Any:
    """``a.b.0`` of nested dicts and lists, or a column of a table."""
    for step in path.split("."):
        if isinstance(value, DataFrame):
            value = value.select(step)
        elif isinstance(value, dict):
            value = value.get(step)
        elif isinstance(value, list) and step.lstrip("-").isdigit():
            value = value[int(step)] if -len(value) <= int(step) < len(value) else None
        else:
            return None
    return value


def set_nested(value: dict, path: str, item: Any) -> None:
    *above, last = path.split(".")
    for step in above:
        value = value.setdefault(step, {})
    value[last] = item


@component("Begin")
def _begin(canvas: Canvas, params: dict) -> dict:
    return dict(canvas.globals)


@component("DataOperations")
def _data(canvas: Canvas, params: dict) -> dict:
    df, op = canvas.value(params["query"]), params["operations"]
    run = {
        "select_keys": lambda: records.select_keys(df, params["select_keys"]),
        "remove_keys": lambda: records.remove_keys(df, params["remove_keys"]),
        "rename_keys": lambda: records.rename_keys(df, [(p["old_key"], p["new_key"]) for p in params["rename_keys"]]),
        "filter_values": lambda: records.filter_values(df, params.get("filter_values", [])),
        "append_or_update": lambda: records.append_or_update(df, {u["key"]: canvas.value(u["value"]) for u in params["updates"]}),
        "literal_eval": lambda: df.withColumns({c: records.literal_eval(F.col(c)) for c, k in df.dtypes if k == "string"}),
        "combine": lambda: records.combine(df, params["order"]),
    }
    return {"result": run[op]()}


@component("ListOperations")
def _list(canvas: Canvas, params: dict) -> dict:
    """On an array column of a table: the result, its first and its last element beside it."""
    df, column, op, n = canvas.value(params["query"]), params.get("column", "items"), params["operations"], int(params.get("n", 1))
    a = F.col(column)
    if op in ("nth", "head", "tail"):
        out = V.strict(op, a, n) if params.get("strict") in (True, "true", "1", "yes", "on") else {"nth": V.nth, "head": V.head, "tail": V.tail}[op](a, n)
    else:
        out = {
            "filter": lambda: V.list_filter(a, params["filter"]["operator"], params["filter"]["value"]),
            "sort": lambda: V.list_sort(a, params.get("sort_method", "asc")),
            "drop_duplicates": lambda: F.array_distinct(a),
        }[op]()
    return {"result": df.withColumn("result", out).withColumn("first", F.get("result", F.lit(0))).withColumn("last", F.try_element_at("result", F.lit(-1)))}


@component("VariableAssigner")
def _assign(canvas: Canvas, params: dict) -> dict:
    for v in params["variables"]:
        name, op, item = v["variable"].strip("{} "), v["operator"], canvas.value(v.get("parameter"))
        old = canvas.value(v["variable"])
        lists = isinstance(old, list) or old is None
        numbers = all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in (old, item))
        new = {
            "overwrite": lambda: item,
            "set": lambda: item,
            "clear": lambda: type(old)() if old is not None else None,
            "append": lambda: [*(old or []), item] if lists else "ERROR:VARIABLE_NOT_LIST",
            "extend": lambda: "ERROR:VARIABLE_NOT_LIST" if not lists else [*(old or []), *item] if isinstance(item, list) else "ERROR:PARAMETER_NOT_LIST",
            "remove_first": lambda: old[1:] if isinstance(old, list) else "ERROR:VARIABLE_NOT_LIST",
            "remove_last": lambda: old[:-1] if isinstance(old, list) else "ERROR:VARIABLE_NOT_LIST",
            "+=": lambda: old + item if numbers else "ERROR:VARIABLE_NOT_NUMBER or PARAMETER_NOT_NUMBER",
            "-=": lambda: old - item if numbers else "ERROR:VARIABLE_NOT_NUMBER or PARAMETER_NOT_NUMBER",
            "*=": lambda: old * item if numbers else "ERROR:VARIABLE_NOT_NUMBER or PARAMETER_NOT_NUMBER",
            "/=": lambda: ("ERROR:DIVIDE_BY_ZERO" if item == 0 else old / item) if numbers else "ERROR:VARIABLE_NOT_NUMBER or PARAMETER_NOT_NUMBER",
        }[op]()
        canvas.globals[name] = new
    return {}


@component("VariableAggregator")
def _aggregate(canvas: Canvas, params: dict) -> dict:
    """The first of each group's variables that isn't empty."""
    out = {}
    for g in params["groups"]:
        values = [canvas.value(v["value"] if isinstance(v, dict) else v) for v in g["variables"]]
        out[g["group_name"]] = next((v for v in values if isinstance(v, DataFrame) or v not in (None, "", [], {})), None)
    return out


@component("StringTransform")
def _string(canvas: Canvas, params: dict) -> dict:
    if params["method"] == "split":
        text = canvas.value(params["split_ref"]) or ""
        found = re.split("(" + "|".join(map(re.escape, sorted(params["delimiters"], key=len, reverse=True))) + ")", text)
        return {"result": [x for x in found[::2]]}
    script = params["script"]
    for ref in re.findall(r"\{[^{}]+\}", script):
        v = canvas.value(ref)
        v = params.get("delimiters", [","])[0].join(map(str, v)) if isinstance(v, list) else "" if v is None else str(v)
        script = script.replace(ref, v)
    return {"result": script}


@component("Switch")
def _switch(canvas: Canvas, params: dict) -> dict:
    """One row of the values compared decides; the conditions are the same Columns as on tables."""
    names = sorted({i["cpn_id"] for c in params["conditions"] for i in c["items"] if i.get("cpn_id")})
    row = canvas.spark.range(1).select(*(F.lit(canvas.value(n)).alias(n) for n in names)) if names else canvas.spark.range(1)
    indexed = [{**c, "to": str(k)} for k, c in enumerate(params["conditions"])]
    choice = row.select(filters.switch(indexed, "", {n: F.col(f"`{n}`") for n in names}).alias("to")).first()[0]
    targets = params["conditions"][int(choice)]["to"] if choice else params["end_cpn_ids"]
    return {"next": targets, "_next": list(targets)}


@component("Iteration")
def _iteration(canvas: Canvas, params: dict) -> dict:
    """An array column exploded, a component run on the items, and its result gathered per row again."""
    df, column, key = canvas.value(params["items_ref"]), params.get("column", "items"), params["key"]
    inner = Canvas(canvas.spark, {"components": {"body": {"obj": params["body"], "downstream": []}}}, {**canvas.globals, "sys.items": df.select(key, F.posexplode(column).alias("index", "item"))})
    got = inner.run("body")["body"]["result"]
    packed = got.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("index", "item"))), lambda x: x["item"]).alias("result"))
    return {"result": packed}


@component("Loop")
def _loop(canvas: Canvas, params: dict) -> dict:
    """A component run again on its own result until a condition on the globals holds, or ``maximum_loop_count`` times."""
    value = canvas.value(params.get("initial"))
    for n in range(int(params.get("maximum_loop_count", 10))):
        inner = Canvas(canvas.spark, {"components": {"body": {"obj": params["body"], "downstream": []}}}, {**canvas.globals, "sys.item": value, "sys.round": n})
        value = inner.run("body")["body"].get("result")
        canvas.globals.update({k: v for k, v in inner.globals.items() if k not in ("sys.item", "sys.round")})
        stop = params.get("stop")
        if stop and canvas.spark.range(1).select(filters.switch([{"logical_operator": "and", "items": [{**stop, "cpn_id": "v"}], "to": "y"}], "n", {"v": F.lit(canvas.value(stop["variable"]))})).first()[0] == "y":
            break
    return {"result": value}


@component("ExeSQL")
def _sql(canvas: Canvas, params: dict) -> dict:
    tables = {n: canvas.value(r) for n, r in params.get("tables", {}).items()}
    results = list(S.execute(canvas.spark, str(canvas.value(params["sql"])), tables, int(params.get("max_records", 1024))))
    return {"result": results[-1] if results else None, "results": results}


@component("ExcelProcessor")
def _excel(canvas: Canvas, params: dict) -> dict:
    tables = [canvas.value(r) for r in params["tables"]]
    return {"result": relational.outer_merge(tables, params["join_on"]) if params["operation"] == "merge" else relational.gathered(tables)}


@component("Retrieval")
def _retrieval(canvas: Canvas, params: dict) -> dict:
    from ..operators.search import retrieve

    options = {k: v for k, v in params.items() if k in ("top", "similarity_threshold", "vector_weight", "min_match", "id_col", "text_col", "vec_col")}
    return {"result": retrieve(canvas.value(params["chunks"]), canvas.value(params["query"]), canvas.value(params["vector"]), **options)}


@component("CodeExec")
def _code(canvas: Canvas, params: dict) -> dict:
    """A user's function of Arrow-backed pandas batches; what it may do is up to the worker's sandbox."""
    return {"result": canvas.value(params["query"]).mapInPandas(params["function"], params["schema"])}
