"""Tables in the folder that the driver and all executors share, gone when the driver ends."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """What the cluster names in spark.checkpoint.dir, or a temporary folder where no other machine takes part."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='lodestone-')}"
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended: the folder is then the cluster's to clean
        return


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed at the end."""
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: its lineage ends there."""
    path = place(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files behind. Spark keeps them until the driver collects garbage, which a loop
    over tables larger than its memory can't wait for."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def stored_for(df: DataFrame, name: str, compression: str = "snappy", by: Iterable[str] = ()) -> Iterator[DataFrame]:
    """``stored`` for a while, in folders ``by`` these columns: the table is gone when the block ends, so nothing that reads it
    may be left."""
    path = place(df.sparkSession, name)
    try:
        df.write.option("compression", compression).partitionBy(*by).parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove(df.sparkSession, path)
