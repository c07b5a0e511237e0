"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard
transform) turns the direction of a vector; the signed axis nearest to the
result is its hash.  Several tables with rotations of their own hold every
vector; a query probes, in each table, the axes nearest to its own rotated
direction, best first.  Vectors of the probed buckets are ranked exactly, by
Euclidean distance of the original vectors in double precision.  Large tables
join several hashes to a bucket, so that buckets keep their size.

Equal vectors are hashed and ranked once: each keeps its k + 1 smallest ids,
which is all that a list of k neighbours can need.  Buckets are cut into
blocks of bounded size, so neither a frequent vector nor a dense region grows
a task; queries with fewer than k found probe all buckets of the first table,
which hold all vectors.

Defined results: rows whose id is null or whose vector is null, zero, or holds
null or non-finite components take no part, as query or candidate; vectors are
compared with vectors of equal length only; rows that repeat an id and vector
count once, and a query never finds its own id; ties go to the smaller id; an
empty table gives an empty result; further columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written

#: Tables, probes of one hash, vectors of a block, vectors that a bucket should hold.
TABLES, PROBES, BLOCK, BUCKET = 8, 24, 4096, 4096


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` (a power of two long) under the orthonormal Walsh-Hadamard transform."""
    rows, m = x.shape
    step = 1
    while step < m:
        x = x.reshape(rows, -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, m)
        step *= 2
    return x / math.sqrt(m)


def rotated(x: np.ndarray, table: int, k: int, seed: int) -> np.ndarray:
    """Directions of ``x``, padded with zeros, after hash ``k`` of ``table``'s pseudo-rotation."""
    m = 1 << max(0, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), m))
    y[:, :x.shape[1]] = x / np.abs(x).max(axis=1, keepdims=True)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    draw = np.random.default_rng([seed, table, k])
    for _ in range(3):
        y = hadamard(y * draw.choice([-1.0, 1.0], m))
    return y


def axis_scores(y: np.ndarray) -> np.ndarray:
    """How near each signed axis is: 2i is the positive axis i, 2i + 1 the negative one."""
    return np.stack([y, -y], axis=2).reshape(len(y), -1)


def buckets(x: np.ndarray, table: int, hashes: int, seed: int) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    for k in range(hashes):
        scores = axis_scores(rotated(x, table, k, seed))
        at = at * scores.shape[1] + scores.argmax(axis=1)
    return at


def probes(x: np.ndarray, table: int, hashes: int, per_hash: int, seed: int) -> np.ndarray:
    """The per_hash ** hashes buckets with the largest summed scores for each row."""
    best, total = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for k in range(hashes):
        scores = axis_scores(rotated(x, table, k, seed))
        axes = np.argsort(-scores, axis=1, kind="stable")[:, :min(scores.shape[1], per_hash * (1 if hashes == 1 else 2))]
        near = np.take_along_axis(scores, axes, 1)
        best = (best[:, :, None] * scores.shape[1] + axes[:, None, :]).reshape(len(x), -1)
        total = (total[:, :, None] + near[:, None, :]).reshape(len(x), -1)
        keep = np.argsort(-total, axis=1, kind="stable")[:, :per_hash ** (k + 1)]
        best, total = np.take_along_axis(best, keep, 1), np.take_along_axis(total, keep, 1)
    return best


def hashes_for(rows: int, length: int, bucket: int = BUCKET) -> int:
    """Hashes to a bucket, so that ``rows`` vectors leave about ``bucket`` in each."""
    axes = 2 << max(0, (max(length, 1) - 1).bit_length())
    return max(1, round(math.log(max(rows / bucket, 1)) / math.log(axes)))


def _by_length(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for length, some in pdf.groupby(pdf["vector"].map(len)):
        yield some, np.array(some["vector"].tolist(), np.float64).reshape(len(some), length)


def _hashed(hashes: int, tables: int, seed: int, per_hash: int | None):
    """Rows (slot, bucket, id, vector): a row per table, or per probe; vectors
    of different lengths never share a bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for some, x in _by_length(pdf):
                for t in range(tables):
                    at = probes(x, t, hashes, per_hash, seed) if per_hash else buckets(x, t, hashes, seed)[:, None]
                    n = at.shape[1]
                    yield pd.DataFrame({"slot": np.full(len(x) * n, t * (1 << 20) + x.shape[1]), "bucket": at.ravel(),
                                        "id": np.repeat(some["id"].to_numpy(), n),
                                        "vector": [v for v in some["vector"] for _ in range(n)]})
    return run


def _ranked(k: int):
    """The k + 1 nearest vectors of a block for each of its queries."""
    def run(key, block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(asked):
            return pd.DataFrame({"query": [], "id": [], "score": []}).astype({"query": np.int64, "id": np.int64, "score": float})
        x = np.array(block["vector"].tolist(), np.float64)
        ids = block["id"].to_numpy()
        out = []
        for query, vector in zip(asked["id"], asked["vector"]):
            score = np.sqrt(((x - np.asarray(vector, np.float64)) ** 2).sum(axis=1))
            near = np.lexsort((ids, score))[:k + 1]
            out.append(pd.DataFrame({"query": query, "id": ids[near], "score": score[near]}))
        return pd.concat(out)
    return run


def _found(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The k + 1 nearest of the vectors that share a bucket with a probe, by query."""
    size = index.groupBy("slot", "bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    blocks = index.join(size, ["slot", "bucket"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    spread = asked.join(size, ["slot", "bucket"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    at = ["slot", "bucket", "block"]
    spread = spread.toDF(*spread.columns)  # columns of its own beside those it shares with blocks
    near = blocks.groupBy(*at).cogroup(spread.groupBy(*at)).applyInPandas(_ranked(k), "query long, id long, score double")
    best = Window.partitionBy("query").orderBy("score", "id")
    return (near.groupBy("query", "id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k + 1).drop("rank"))


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           tables: int = TABLES, per_hash: int = PROBES, seed: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``is_query`` (a
    condition on the id column ``id``) its k nearest other rows."""
    v = F.col("vector")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].alias("vector")).filter(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    # Of equal vectors the k + 1 smallest ids; the smallest stands for all.
    same = Window.partitionBy("vector").orderBy("id")
    few = written(rows.withColumn("place", F.dense_rank().over(same)).withColumn(
        "first", F.min("id").over(same.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .filter(F.col("place") <= k + 1).dropDuplicates(["vector", "id"]), "ann-rows")
    each = few.filter("place = 1").select("id", "vector")
    queries = written(rows.filter(is_query).select("id", "vector").distinct().join(
        each.select(F.col("id").alias("first"), "vector"), "vector").select("id", "first", "vector"), "ann-queries")
    asked = queries.groupBy("first").agg(F.any_value("vector").alias("vector")).select(F.col("first").alias("id"), "vector")
    shape = each.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("length")).head()
    hashes = hashes_for(shape["n"], shape["length"] or 1)
    kind = dict(each.dtypes)["vector"]
    schema = f"slot long, bucket long, id long, vector {kind}"
    index = each.mapInPandas(_hashed(hashes, tables, seed, None), schema)
    found = written(_found(index, asked.mapInPandas(_hashed(hashes, tables, seed, per_hash), schema), k), "ann-found")

    # Ids of the found vectors, then of the queries that share a vector.
    ids = few.select(F.col("first").alias("stands"), F.col("id").alias("vec_id"))
    best = Window.partitionBy("query").orderBy("score", "vec_id")

    def listed(found: DataFrame) -> DataFrame:
        near = found.join(ids, found["id"] == ids["stands"]).select("query", "vec_id", "score")
        return near.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= k + 1).drop("at")

    near = written(listed(found), "ann-near")
    # Queries short of k + 1 (themselves included) probe everything.
    short = asked.join(near.groupBy("query").agg(F.count("*").alias("n")).filter(F.col("n") > k), F.col("id") == F.col("query"), "left_anti")
    short = written(short, "ann-short")
    if not short.isEmpty():
        single = index.filter(F.col("slot") < (1 << 20))
        everywhere = single.select("slot", "bucket").distinct().join(
            short.withColumn("slot", F.size("vector").cast("long")), "slot").select("slot", "bucket", "id", "vector")
        near = near.join(short.select(F.col("id").alias("query")), "query", "left_anti").unionByName(
            listed(_found(single, everywhere, k)))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (queries.select(F.col("id").alias("query_id"), F.col("first").alias("query")).distinct().join(near, "query")
            .filter("vec_id != query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
