"""Shared pieces of the training-data operators: scratch tables, byte-level words, Arrow plumbing."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: what the cluster names, or a temporary one where nothing is named and there is no
    other machine (tests). On a cluster that names none there is no such folder, and this raises."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='lodestone-')}"
    return named.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended: the folder is then the cluster's to clean
        return


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back: lineage ends here, lost executors don't matter."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def key(col: Column | str) -> Column:
    """A never-null join key for a nullable column: null and the text 'n' stay apart."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))


def md5_long(*parts: Column) -> Column:
    """60 bits of the md5 of the parts, as a non-negative long."""
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def sliced(batch: pa.RecordBatch, size: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``size`` bytes, by the bytes of all string and binary columns together: what a function
    builds from one run stays small, however wide the batch."""
    if not batch.num_rows:
        return
    step = max(1, batch.num_rows * size // max(1, batch.nbytes))
    wide = [c for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_binary(c.type)]
    if step >= batch.num_rows or not wide:
        for k in range(0, batch.num_rows, step):
            yield batch.slice(k, step)
        return
    ends = np.cumsum(sum(np.nan_to_num(pc.binary_length(c).to_numpy(zero_copy_only=False)).astype(np.int64) for c in wide)) // size
    cuts = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


BATCH_BYTES = 2 << 20
_BYTES, _BYTES_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: Any) -> DataFrame:
    """mapInArrow for rows of whole texts, in batches of BATCH_BYTES at most: by rows alone a batch holds tens of megabytes
    on either side of the pipe. The bound is a setting of the session, read when the plan runs; it is set where the session
    has Spark's default, and changes no result of any query."""
    conf = df.sparkSession.conf
    if conf.get(_BYTES) == _BYTES_DEFAULT:
        conf.set(_BYTES, str(BATCH_BYTES))

    def bounded_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return df.mapInArrow(bounded_run, schema)


def trim() -> None:
    """Give what a task has freed back to the system, as workers stay for the tasks and stages to come."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if give_back is not None:
        give_back(0)


def map_arrow(df: DataFrame, schema: str, each: Callable[[pa.RecordBatch], dict[str, Any]]) -> DataFrame:
    """Apply ``each`` to Arrow batches; it returns the columns of ``schema`` as lists or arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    spark_schema = _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(spark_schema)
        for whole in batches:
            for batch in sliced(whole):
                got = each(batch)
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) if not isinstance(got[f.name], pa.Array) else got[f.name].cast(f.type) for f in out], schema=out)

    return in_arrow(df, run, spark_schema)


def join_hot(rows: DataFrame, once: DataFrame, on: str, spread: Column, how: str = "inner", parts: int = 16) -> DataFrame:
    """Join ``rows``, of which many may have one key, to ``once``, which has a key at most once: every key of ``once`` is
    there ``parts`` times, and the rows of a key are dealt among these by the column ``spread``."""
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int"))
    return rows.join(once.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))), [on, "_part"], how).drop("_part")


def bounded(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most so many rows; looks at no more than that."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint behind a check of the size; beyond it the join shuffles."""
    return F.broadcast(df) if bounded(df, rows) else df
