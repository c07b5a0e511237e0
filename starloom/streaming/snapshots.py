"""A table of versioned partition folders under one small manifest.

``data/<merge>/<partition>/`` holds what one merge wrote, and is never
changed.  ``manifests/<version>.json`` names, for each partition, the merge
whose folder counts.  A merge writes its folders first and renames its manifest
into place last, so a reader sees the table before the merge or after it, a
merge that fails leaves nothing but folders that no manifest names, and of two
merges of one version the second one fails instead of hiding the first.

The manifest grows with partitions, not with rows; rows are merged by Spark,
and only the partitions that an increment touches are read and written.  Null
is a partition like any other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.streaming.incremental import upsert_latest

#: Folder column: a copy of the partition column, which itself stays in the files with its type and its nulls.
PART = "__part"


class Conflict(RuntimeError):
    """Another merge has made this version."""


class SnapshotTable:
    """``partition_col`` has to be a function of the key, so that all copies of
    a key meet in one partition."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order_col: str, partition_col: str,
                 extra_order: Sequence[Column] = ()):
        self.spark, self.root, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order_col, self.partition_col, self.extra_order = list(keys), order_col, partition_col, extra_order
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- manifests --------------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.root}/{folder}")
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("manifests") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict[str, str]:
        """Partition folder -> the merge that wrote it."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        if version == 0:
            return {}
        text = self.spark.read.text(f"{self.root}/manifests/{version}.json", wholetext=True).head()[0]
        return json.loads(text)

    def _commit(self, version: int, parts: dict[str, str]) -> None:
        place, fresh = self._path(f"{self.root}/manifests/{version}.json"), self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(fresh)
        out.write(json.dumps(parts, sort_keys=True).encode())
        out.close()
        if self._fs.exists(place) or not self._fs.rename(fresh, place):
            self._fs.delete(fresh, False)
            raise Conflict(f"version {version} of {self.root} is there already")

    # -- tables -----------------------------------------------------------------

    def _folders(self, parts: dict[str, str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.root}/data/{v}/{p}" for p, v in sorted(parts.items())))

    def read(self, version: int | None = None) -> DataFrame:
        """The table at ``version`` (the newest one if none is given)."""
        return self._folders(self.manifest(version))

    def _write(self, df: DataFrame, folder: str) -> list[str]:
        """Write ``df`` by partition; the partition folders made."""
        rows = df.select(*(F.col(f"`{f.name}`") if df.schema[f.name].dataType.simpleString() == f.dataType.simpleString()
                           else F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema.fields))
        rows.withColumn(PART, F.col(f"`{self.partition_col}`").cast("string")).write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        return [n for n in self._names(folder) if n.startswith(f"{PART}=")]

    def merge(self, increment: DataFrame) -> int:
        """Merge ``increment``, latest row per key; returns the new version."""
        known = self.versions()
        version, attempt = (known[-1] if known else 0) + 1, uuid.uuid4().hex
        parts = self.manifest()
        # The increment is laid out first: its folders say which partitions it touches.
        staged = f"staging/{attempt}"
        touched = self._write(increment, staged)
        if touched:
            news = self.spark.read.schema(self.schema).parquet(*(f"{self.root}/{staged}/{p}" for p in touched))
            old = self._folders({p: parts[p] for p in touched if p in parts})
            merged = upsert_latest(old, news, self.keys, self.order_col, self.extra_order)
            # Rows of one partition are dealt over tasks by key: a large one is many files.
            made = self._write(merged, f"data/{attempt}")
            parts = parts | {p: attempt for p in made}
        self._commit(version, parts)
        self._fs.delete(self._path(f"{self.root}/{staged}"), True)
        return version

    def expire(self, keep: int = 1) -> None:
        """Delete manifests but the last ``keep``, and folders that none of them names."""
        known = self.versions()
        for v in known[:-keep]:
            self._fs.delete(self._path(f"{self.root}/manifests/{v}.json"), False)
        named = {(made, p) for v in known[-keep:] for p, made in self.manifest(v).items()}
        for made in self._names("data"):
            for p in self._names(f"data/{made}"):
                if p.startswith(f"{PART}=") and (made, p) not in named:
                    self._fs.delete(self._path(f"{self.root}/data/{made}/{p}"), True)
