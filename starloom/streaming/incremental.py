"""Incremental loads: high-water mark, latest-wins upsert, streaming ingest.

* :func:`new_arrivals` keeps the rows that were ingested after a persisted
  mark.  The mark is on the ingest stamp, never on the data's own stamps, so
  rows that are late, undated or dated like the newest row are kept.
* :func:`upsert_latest` merges target and increment by business key,
  latest ``order_col`` winning (the same total order as silver dedup), so
  repeated application is idempotent and late rows lose or win by rule.
* :func:`upsert_partitions` rewrites only the partitions that an increment
  touches, next to the target, and swaps them in partition by partition (readers
  may see the swap half done; ``snapshots.SnapshotTable`` never shows that).
* :func:`ingest_stream` picks up only new raw files with Structured
  Streaming (the file source's checkpoint remembers what was read) and
  writes each micro-batch to its own ``batch_id=N`` folder with overwrite,
  so a replayed batch after a failure rewrites the same folder instead of
  duplicating rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.dedup import dedup_keep_latest


def new_arrivals(arrivals: DataFrame, mark, ingest_col: str = "_ingested_at") -> DataFrame:
    """Rows ingested after ``mark`` (a literal or a one-row scalar; null: all),
    and those without an ingest stamp."""
    stamp, mark = F.col(ingest_col), mark if isinstance(mark, Column) else F.lit(mark)
    return arrivals.where(mark.isNull() | stamp.isNull() | (stamp > mark))


def upsert_latest(target: DataFrame, increment: DataFrame, keys: Sequence[str], order_col: str,
                  extra_order: Sequence[Column] = ()) -> DataFrame:
    """New target = latest row per key over target and increment: one
    deduplication, whatever state either is in."""
    return dedup_keep_latest(target.unionByName(increment), keys, order_col, extra_order)


def upsert_partitions(spark: SparkSession, target_path: str, increment: DataFrame, keys: Sequence[str], order_col: str,
                      partition_col: str, staging_path: str, extra_order: Sequence[Column] = ()) -> None:
    """Merge ``increment`` into the table at ``target_path``, partitioned by
    ``partition_col`` (a function of the key): only partitions that the
    increment touches are read and rewritten.  The merged partitions are
    written to ``staging_path`` first, as a job must not overwrite what it
    reads, and then replace theirs (dynamic partition overwrite); a failed
    swap is repeated from the staging files."""
    touched = increment.select(F.col(f"`{partition_col}`").alias("__touched")).distinct()
    current = spark.read.schema(increment.schema).parquet(target_path)
    # Null is a partition like any other: the swap replaces it too.
    current = current.join(touched, current[partition_col].eqNullSafe(F.col("__touched")), "left_semi")
    merged = upsert_latest(current.select(*increment.columns), increment, keys, order_col, extra_order)
    merged.write.mode("overwrite").partitionBy(partition_col).parquet(staging_path)
    (spark.read.schema(increment.schema).parquet(staging_path).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(target_path))


def ingest_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str,
                  bronze_path: str, checkpoint: str, options: dict | None = None,
                  transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Process every not-yet-seen file under ``source_dir`` once and stop
    (``availableNow``); each micro-batch lands in ``bronze_path/batch_id=N``."""
    reader = spark.readStream.schema(schema).format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir).withColumn("_source_file", F.col("_metadata.file_path"))
    if transform is not None:
        stream = transform(stream)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("_ingested_at", F.current_timestamp())
              .write.mode("overwrite").parquet(f"{bronze_path.rstrip('/')}/batch_id={batch_id}"))

    query = (stream.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
