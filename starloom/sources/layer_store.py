"""Layers written once and shared by the queries that read them.

A table is stored under a key of its name, the files it derives from (path,
size and time of each) and the code that builds it, so a changed input or a
changed rule is another key and never meets an old result.  It is written
beside its place and renamed into it as the last step: readers see a whole
table or none, and of two writers the first one wins.

The store lies in the session's checkpoint folder and goes with the
application's scratch data; ``root`` names a folder that outlives it.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from starloom.session import scratch_root

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
#: Parts of the library whose code decides what a layer holds.
CODE = ("functions", "operators", "plans", "sources", "session.py")


@lru_cache(maxsize=1)
def code_version() -> str:
    digest = hashlib.sha256()
    for part in CODE:
        top = os.path.join(PACKAGE, part)
        files = [top] if os.path.isfile(top) else sorted(
            os.path.join(d, f) for d, _, names in os.walk(top) for f in names if f.endswith(".py"))
        for path in files:
            with open(path, "rb") as f:
                digest.update(os.path.relpath(path, PACKAGE).encode() + b"\0" + f.read() + b"\0")
    return digest.hexdigest()


def files_of(spark: SparkSession, paths: Iterable[str]) -> list[tuple[str, int, int]]:
    """(path, bytes, time) of every file under ``paths``, through the file system that holds it."""
    sc, found = spark.sparkContext, []
    for path in paths:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
        if fs.exists(at):
            each = fs.listFiles(at, True)
            while each.hasNext():
                f = each.next()
                found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


class LayerStore:
    """Tables of one input, each written when it is first asked for."""

    def __init__(self, spark: SparkSession, inputs: Iterable[str], root: str | None = None):
        self.spark = spark
        self.root = (root or f"{scratch_root(spark)}/layers").rstrip("/")
        self.inputs = files_of(spark, inputs)

    def path(self, name: str) -> str:
        key = hashlib.sha256(repr((name, code_version(), self.inputs)).encode()).hexdigest()
        return f"{self.root}/{name}-{key[:32]}"

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored table ``name``, built and written first if it isn't there."""
        path = self.path(name)
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = at(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(at(f"{path}/_SUCCESS")):
            fresh = f"{path}.{uuid.uuid4().hex}"
            build().write.option("compression", "zstd").parquet(fresh)
            # A folder that is there already belongs to a writer that was faster.
            if fs.exists(at(path)) or not fs.rename(at(fresh), at(path)):
                fs.delete(at(fresh), True)
        return self.spark.read.parquet(path)
