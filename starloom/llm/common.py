"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_root, ship_package

#: Code points that separate words: space and the ASCII controls 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


#: Most bytes of an Arrow batch between the JVM and Python.  Rows alone (10,000 by default) don't bound it: of long
#: texts such a batch is dozens of MB, held on both sides, and again as Python strings, in each of an executor's workers.
BATCH_BYTES = 4 << 20


def ready(spark: SparkSession) -> None:
    """Code importable in the Python workers, and batches of bounded size on the way to them."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given table; its code is made importable in the Python workers."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the checkpoint folder that the cluster shares."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Paths written in each open ``passing`` block, the innermost last.
_PASSING: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is ``written`` in the block goes at its end, but for what outlives
    it: of an operator's tables only those stay that its result reads."""
    paths: list[str] = []
    before = _PASSING.set((*_PASSING.get(), paths))
    try:
        yield
    finally:
        _PASSING.reset(before)
        for path in map(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    back: cuts the lineage at files that every executor can read, so a lost
    executor costs no recomputation of what lies before.  ``outlives``: it
    stays when the innermost ``passing`` block ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    for paths in _PASSING.get()[:-1 if outlives else None][-1:]:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id (long) and the text (null: empty) of each row, so that
    further columns, whatever their names, can't clash with an operator's."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def bounded_sample(df: DataFrame, rows: int, seed: int = 7) -> DataFrame:
    """At most ``rows`` rows for fitting: a seeded sample whose fraction follows
    the number of rows, so that no task gathers more than a few rows beyond them."""
    n = df.count()
    return df.sample(fraction=min(1.0, 1.2 * rows / max(n, 1)), seed=seed).limit(rows)


_KEPT: dict = {}


def kept(key, make):
    """The one helper that a worker keeps from task to task, with what it
    remembers.  Asked for another one, it lets go of the one before, so workers
    that serve several operators hold the memory of one."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Let go of what the worker keeps: the operator at hand remembers nothing."""
    _KEPT.clear()


def text_words(text: str) -> list[bytes]:
    """Words of a text as UTF-8: bytes.split() splits at exactly SPACES."""
    return text.encode("utf-8", "surrogatepass").split()


def frames(batches: Iterator, make) -> Iterator:
    """Apply ``make`` to each non-empty pandas batch."""
    for pdf in batches:
        if len(pdf):
            yield make(pdf)
