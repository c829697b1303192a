"""User code: registered functions, pluggable models, and their deterministic stand-ins."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .text import tokens

TOOLS: dict[str, Callable[..., Any]] = {}


def tool(name: str) -> Callable:
    """Register a function under a name that canvases and SQL use."""

    def add(f: Callable) -> Callable:
        TOOLS[name] = f
        return f

    return add


def publish(spark: SparkSession, name: str, f: Callable, returns: str) -> None:
    """Make a pandas function of Series available to SQL."""
    spark.udf.register(name, F.pandas_udf(f, returns))


def embed(c: Column, dimensions: int = 64) -> Column:
    """Signed feature hashing of the tokens, of unit length: the stand-in of an embedding model, JVM-side."""
    hashed = F.transform(tokens(c), lambda t: F.struct(F.pmod(F.xxhash64(t), F.lit(dimensions)).alias("i"), F.when(F.xxhash64(t, F.lit(1)) % 2 == 0, 1.0).otherwise(-1.0).alias("s")))
    raw = F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda i: F.aggregate(F.filter(hashed, lambda x: x["i"] == i), F.lit(0.0), lambda a, x: a + x["s"]))
    length = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(raw, lambda x: F.coalesce(F.try_divide(x, length), F.lit(0.0)).cast("float"))


def embedded(df: DataFrame, text: str, model: Callable[[list[str]], np.ndarray] | None = None, out: str = "vec", batch: int = 16) -> DataFrame:
    """A vector column by a plugged model in batches, or by the stand-in."""
    if model is None:
        return df.withColumn(out, embed(F.col(text)))

    @F.pandas_udf(ArrayType(FloatType()))
    def run(s: pd.Series) -> pd.Series:
        texts = s.fillna("").tolist()
        parts = [np.asarray(model(texts[k : k + batch]), np.float32) for k in range(0, len(texts), batch)]
        return pd.Series(list(np.concatenate(parts)) if parts else [])

    return df.withColumn(out, run(F.col(text)))


def transform_with(df: DataFrame, f: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A user's function of pandas batches, in the workers."""
    return df.mapInPandas(lambda batches: (f(b) for b in batches), schema)
