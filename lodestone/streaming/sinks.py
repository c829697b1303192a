"""Stream sources and sinks of ingestion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.dml import Table
from ..operators.relational import latest


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    """New Parquet files of a folder; the checkpoint remembers which were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def queue_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """A durable queue of messages by Kafka; offsets take the place of acknowledgements."""
    return spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic}).load()


def upsert_into(stream: DataFrame, table: Table, key: str, order: str, tie: str, checkpoint: str) -> StreamingQuery:
    """Last write wins by key: each batch keeps its latest rows, then replaces stored ones unless those are newer."""

    def write(batch: DataFrame, _: int) -> None:
        fresh = latest(batch, [key], order, tie)
        if table.exists():  # of the stored rows only those of the batch's keys matter, so that other partitions stay as they are
            stored = table.read().join(fresh.select(key), key, "left_semi")
            fresh = latest(stored.unionByName(fresh, True), [key], order, tie)
        table.upsert(fresh, key)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def each_batch(stream: DataFrame, run: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(lambda df, _: run(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changes(previous: DataFrame, current: DataFrame, key: str, fingerprint: str) -> tuple[DataFrame, DataFrame]:
    """(rows to write, keys to delete): what a full listing changes by fingerprint."""
    old = previous.select(key, F.col(fingerprint).alias("_old"))
    write = current.join(old, key, "left").where(F.col("_old").isNull() | (F.col("_old") != F.col(fingerprint))).drop("_old")
    return write, previous.select(key).join(current.select(key), key, "left_anti")
