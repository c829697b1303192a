"""Channels: reducers of the values that writers send in a superstep.

Writes are rows (channel, step, writer, value); a channel's kind says how its values become one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_value(writes: DataFrame) -> DataFrame:
    """The value of the latest step; two writers in one step are an error, raised when the value is read."""
    steps = writes.groupBy("channel", "step").agg(F.count("*").alias("_n"), F.first("value").alias("value"))
    checked = steps.withColumn("value", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("more than one value in a step: "), "channel")).cast("string")).otherwise(F.col("value")))
    return checked.groupBy("channel").agg(F.max_by("value", "step").alias("value"))


def any_value(writes: DataFrame) -> DataFrame:
    """One of the values of the latest step (writers agree)."""
    return writes.groupBy("channel").agg(F.max_by("value", F.struct("step", "writer")).alias("value"))


def topic(writes: DataFrame, accumulate: bool = True) -> DataFrame:
    """All values in order of step and writer; without ``accumulate`` those of the latest step."""
    packed = writes.groupBy("channel", "step").agg(F.transform(F.array_sort(F.collect_list(F.struct("writer", "value"))), lambda x: x["value"]).alias("_v"))
    ordered = F.array_sort(F.collect_list(F.struct("step", "_v")))
    return packed.groupBy("channel").agg((F.flatten(F.transform(ordered, lambda x: x["_v"])) if accumulate else F.element_at(ordered, -1)["_v"]).alias("value"))


def folded(writes: DataFrame, how: str, overwrite: str | None = None) -> DataFrame:
    """sum, concat or max over all values in order; after a row whose boolean column ``overwrite`` is true, from there on."""
    rows = writes
    if overwrite:
        mark = writes.where(overwrite).groupBy("channel").agg(F.max(F.struct("step", "writer")).alias("_from"))
        rows = writes.join(mark, "channel", "left").where(F.col("_from").isNull() | (F.struct("step", "writer") >= F.col("_from")))
    if how == "sum":
        return rows.groupBy("channel").agg(F.sum("value").alias("value"))
    if how == "max":
        return rows.groupBy("channel").agg(F.max("value").alias("value"))
    if how == "concat":
        return rows.groupBy("channel").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "writer", "value"))), lambda x: x["value"].cast("string")), "").alias("value"))
    raise ValueError(how)


def ephemeral(writes: DataFrame, step: int) -> DataFrame:
    """Values of one step only."""
    return writes.where(F.col("step") == step).groupBy("channel").agg(F.max_by("value", "writer").alias("value"))


def barrier(writes: DataFrame, names: list[str]) -> DataFrame:
    """Whether all named writers have written: (channel, ready)."""
    return writes.where(F.col("writer").isin(names)).groupBy("channel").agg((F.count_distinct("writer") == len(names)).alias("ready"))


REDUCERS: dict[str, Column] = {}


def reduce_array(values: Column, how: str) -> Column:
    """The same folds over an array column."""
    return {
        "sum": lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x),
        "concat": lambda v: F.array_join(v, ""),
        "append": lambda v: F.flatten(v),
        "max": lambda v: F.array_max(v),
    }[how](values)
