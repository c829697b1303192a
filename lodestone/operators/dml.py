"""Changes of stored tables: upsert, update, delete, counters, metadata; and table management.

A table is a folder of row files and a folder of numbered versions; a version lists the row folders that it consists of.
A change writes new row folders, and only for the partitions that it touches, and then creates the next version's file,
which is one step of the file system and fails where another writer was first. So a change that breaks off anywhere leaves
the version before it, and readers of one of the last ``keep`` versions go on undisturbed.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .filters import condition
from .relational import latest


class Table:
    """A versioned table; ``partition_by`` keeps datasets apart, so that reads prune to theirs and changes rewrite theirs.

    A partition column's value must be the same for all rows of a key, or the key's row moves: upsert finds it wherever it
    is. Columns may be added by later rows; null partition values are a partition of their own.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: list[str] | None = None, keep: int = 5) -> None:
        self.spark, self.path, self.partition_by, self.keep = spark, path.rstrip("/"), partition_by or [], max(1, keep)

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm.org.apache.hadoop.fs.Path, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        path, fs = self._fs()
        at = path(f"{self.path}/versions")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(at) if f.getPath().getName().isdigit()) if fs.exists(at) else []

    def version(self) -> int | None:
        found = self.versions()
        return found[-1] if found else None

    def _contents(self, version: int) -> tuple[list[str], StructType]:
        """Row folders of a version, relative to the rows' folder, and its schema. The first line counts the folders, so that
        half a file is none."""
        text = self.spark.read.text(f"{self.path}/versions/{version:012d}", wholetext=True).first()[0]
        lines = text.split("\n")
        n = int(lines[0])
        return lines[1 : n + 1], StructType.fromJson(json.loads(lines[n + 1]))

    def exists(self) -> bool:
        return self.version() is not None

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the last version, or of one of those kept."""
        v = self.version() if version is None else version
        if v is None or v not in self.versions():
            raise FileNotFoundError(f"{self.path} {'' if version is None else version}")
        return self._rows(*self._contents(v))

    def _rows(self, folders: list[str], schema: StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(StructType([*schema.fields, StructField("batch__", StringType())])).option("basePath", f"{self.path}/rows")
        return reader.parquet(*(f"{self.path}/rows/{f}" for f in folders)).select(*schema.names)

    def _add(self, df: DataFrame) -> list[str]:
        """Write rows as folders of their own; the folders (none if there are no rows)."""
        batch, (path, fs) = uuid.uuid4().hex, self._fs()
        root = f"{self.path}/rows"
        df.withColumn("batch__", F.lit(batch)).write.mode("append").partitionBy(*self.partition_by, "batch__").parquet(root)
        found = fs.globStatus(path(root + "/*" * len(self.partition_by) + f"/batch__={batch}")) or []
        return sorted("/".join(str(f.getPath()).rstrip("/").split("/")[-1 - len(self.partition_by) :]) for f in found)

    def _commit(self, before: int | None, folders: list[str], schema: StructType) -> None:
        path, fs = self._fs()
        after = (before or 0) + 1
        mine, target = path(f"{self.path}/versions/_next-{uuid.uuid4().hex}"), path(f"{self.path}/versions/{after:012d}")
        stream = fs.create(mine, False)
        stream.write(bytearray("\n".join([str(len(folders)), *folders, schema.json()]).encode()))
        stream.close()
        if fs.exists(target) or not fs.rename(mine, target):
            fs.delete(mine, False)
            raise RuntimeError(f"{self.path}: version {after} was written by another writer")
        self._clean()

    def _clean(self) -> None:
        """Versions but the last ``keep`` go, and the row folders that only they list."""
        path, fs = self._fs()
        old = self.versions()[: -self.keep]
        if not old:
            return
        held = {f for v in self.versions()[-self.keep :] for f in self._contents(v)[0]}
        gone = {f for v in old for f in self._contents(v)[0]} - held
        for v in old:
            fs.delete(path(f"{self.path}/versions/{v:012d}"), False)
        for f in gone:
            fs.delete(path(f"{self.path}/rows/{f}"), True)

    def write(self, df: DataFrame) -> None:
        """Commit ``df`` as the whole table."""
        before = self.version()
        self._commit(before, self._add(df), df.schema)

    def drop(self) -> None:
        path, fs = self._fs()
        fs.delete(path(self.path), True)

    def _rewrite(self, touched: DataFrame, change) -> None:
        """Commit ``change`` (rows to rows) of the partitions in ``touched`` (partition columns); the others stay as they are."""
        before = self.version()
        folders, schema = self._contents(before)
        now, stay = self._rows(folders, schema), []
        if self.partition_by:
            # As many as there are datasets. A folder's name has its values, so that no other partition is looked at.
            names = {tuple(v or None for v in r) for r in touched.select(*(F.col(c).cast("string") for c in self.partition_by)).distinct().collect()}
            hit = [f for f in folders if self._values(f) in names]
            now, stay = self._rows(hit, schema), [f for f in folders if f not in set(hit)]
        rows = change(now)
        added = StructType([*schema.fields, *(f for f in rows.schema.fields if f.name not in schema.names)])
        self._commit(before, stay + self._add(rows), added)

    def _values(self, folder: str) -> tuple[str | None, ...]:
        """The partition values in a row folder's name; an empty string is stored as null."""
        found = [unquote(part.split("=", 1)[1]) for part in folder.split("/")[: len(self.partition_by)]]
        return tuple(None if v in ("", "__HIVE_DEFAULT_PARTITION__") else v for v in found)

    def upsert(self, rows: DataFrame, key: str = "id") -> None:
        if not self.exists():
            return self.write(rows)
        rows = rows.persist()
        try:
            touched = rows.select(*self.partition_by) if self.partition_by else rows
            if self.partition_by:
                touched = touched.unionByName(self.read().join(rows.select(key), key, "left_semi").select(*self.partition_by))
            self._rewrite(touched, lambda now: upserted(now, rows, key))
        finally:
            rows.unpersist()

    def update(self, where: dict[str, Any], changes: dict[str, Any]) -> None:
        now = self.read()
        self._rewrite(now.where(condition(now, where)), lambda rows: updated(rows, condition(rows, where), changes))

    def delete(self, where: dict[str, Any]) -> None:
        now = self.read()
        self._rewrite(now.where(condition(now, where)), lambda rows: deleted(rows, condition(rows, where)))


def upserted(stored: DataFrame, rows: DataFrame, key: str | list[str] = "id") -> DataFrame:
    """Stored rows with those of ``rows`` in place of equal keys (of one column or several); new columns are added."""
    return stored.join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def upsert_latest(events: DataFrame, key: str, order: str, tie: str) -> DataFrame:
    return latest(events, [key], order, tie)


def updated(df: DataFrame, where: Column, changes: dict[str, Any]) -> DataFrame:
    """Where the condition holds: set columns; ``add`` and ``remove`` list items {column: item}; ``remove`` of a column
    name sets it to null."""
    types = dict(df.dtypes)
    out: dict[str, Column] = {}
    now = lambda c: out.get(c, F.col(c))
    for name, value in changes.items():
        if name == "add":
            for c, item in value.items():
                out[c] = F.when(where, F.array_union(F.coalesce(now(c), F.array().cast(types[c])), F.array(F.lit(item)))).otherwise(now(c))
        elif name == "remove":
            for c, item in ({value: None} if isinstance(value, str) else value).items():
                gone = F.lit(None).cast(types[c]) if item is None else F.array_remove(now(c), item)
                out[c] = F.when(where, gone).otherwise(now(c))
        else:
            v = value if isinstance(value, Column) else F.lit(value)
            out[name] = F.when(where, v).otherwise(F.col(name) if name in types else F.lit(None))
    return df.withColumns(out)


def deleted(df: DataFrame, where: Column) -> DataFrame:
    return df.where(~F.coalesce(where, F.lit(False)))


def adjusted_pagerank(df: DataFrame, deltas: DataFrame, key: str = "id", column: str = "pagerank_fea") -> DataFrame:
    """Deltas (key, delta) added and clamped to 0..100; a value of 0 becomes null."""
    d = deltas.groupBy(key).agg(F.sum("delta").alias("_d"))
    value = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.coalesce(F.col(column), F.lit(0.0)) + F.col("_d")))
    return df.join(d, key, "left").withColumn(column, F.when(F.col("_d").isNull(), F.col(column)).otherwise(F.nullif(value, F.lit(0.0)))).drop("_d")


def metadata_set(meta: Column, values: dict[str, list[str]]) -> Column:
    """A map<string,array<string>> with keys inserted or replaced."""
    new = F.create_map(*(x for k, v in values.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    return F.map_concat(F.map_filter(meta, lambda k, v: ~k.isin(list(values))), new)


def metadata_delete(meta: Column, keys: list[str]) -> Column:
    return F.map_filter(meta, lambda k, v: ~k.isin(keys))


def without_task(chunks: DataFrame, ids: DataFrame) -> DataFrame:
    """Chunks but those of a task that failed."""
    return chunks.join(ids.select("id"), "id", "left_anti")
