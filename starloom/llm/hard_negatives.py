"""Hard negatives by Four-Russians scoring.

Components are whole numbers (floor of 256 x).  The index holds candidates in
blocks, as bit planes: for plane k and each group of eight dimensions one byte,
the k-th bits of these components in two's complement.  For a block of anchors
every group gets a table of the 256 subset sums of the anchors' components.  A
score is then, from the top plane down, twice the score so far plus the
looked-up sums of the plane's bytes (minus, for the sign plane): lookups, shifts
and additions only, and the full exact inner product.

The stated anchors meet all candidates block by block; a pair of blocks is one
group of a cogroup, so memory is bounded by two blocks and only the best few
rows of each anchor leave it.  Blocks are cut from rows ordered by label, so a
frequent label is many blocks, and the first pass (positives) meets only pairs
of blocks that share a label.

Defined results: rows whose id, label or vector is null or whose vector holds
null or non-finite components take no part; missing components of a shorter
vector count as zero; rows with the anchor's own id are never its positives or
negatives, other repeated rows each count; an anchor repeated whole counts
once; scores beyond 64 bits count as the largest or smallest long; an empty
table gives no rows; further columns are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written

#: Positives of an anchor, negatives of a pair, least and most negative score in percent of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
#: Candidates and anchors of a block; candidates scored at once; dimensions of a group.
CANDIDATES, ANCHORS, AT_ONCE, GROUP = 4096, 256, 1024, 8
LARGEST = (1 << 63) - 1


def whole(vectors) -> np.ndarray:
    """Components as whole numbers, rows padded with zeros to a multiple of
    eight; int64 where they fit, Python integers otherwise."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), -(-width // GROUP) * GROUP))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    scaled = np.floor(np.ldexp(out, 8)) if not len(out) or np.abs(out).max(initial=0) < 1e300 else None
    if scaled is not None and np.abs(scaled).max(initial=0) < 2 ** 53:
        return scaled.astype(np.int64)
    exact = np.empty(out.shape, object)
    for at, x in np.ndenumerate(out):
        up, down = float(x).as_integer_ratio()
        exact[at] = 256 * up // down
    return exact


def n_planes(q: np.ndarray) -> int:
    return 1 + max((int(x).bit_length() for x in (q.max(initial=0), ~q.min(initial=0))), default=0)


def bit_planes(q: np.ndarray) -> np.ndarray:
    """Bytes by plane (lowest first), group and row."""
    return np.stack([np.packbits(((q >> k) & 1).astype(np.uint8), axis=1, bitorder="little").T for k in range(n_planes(q))])


def subset_sums(q: np.ndarray) -> np.ndarray:
    """For each group, the 256 sums over subsets of its dimensions, by anchor."""
    tables = np.zeros((q.shape[1] // GROUP, 1 << GROUP, len(q)), q.dtype)
    for g, table in enumerate(tables):
        for j in range(GROUP):
            table[1 << j:2 << j] = table[:1 << j] + q[:, g * GROUP + j]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products by candidate and anchor."""
    groups = range(min(len(tables), planes.shape[1]))
    total = np.zeros((planes.shape[2], tables.shape[2]), tables.dtype)
    for k in range(len(planes) - 1, -1, -1):
        total <<= 1
        for g in groups:
            looked_up = tables[g].take(planes[k, g], axis=0)
            if k == len(planes) - 1:
                total -= looked_up
            else:
                total += looked_up
    return total


def block_scores(anchors: np.ndarray, planes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Scores of whole blocks, some candidates at a time, in the narrowest numbers that hold them."""
    bound = max(1, anchors.shape[1]) * max(1, *(abs(int(x)) for x in (anchors.max(initial=0), anchors.min(initial=0)))) << len(planes)
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 55 else object
    tables = subset_sums(anchors.astype(kind))
    for at in range(0, planes.shape[2], AT_ONCE):
        yield at, scores(tables, planes[:, :, at:at + AT_ONCE])


def _blocks(size: int, as_planes: bool):
    """Sorted rows (id, label, vector) packed into blocks of at most ``size``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, made = TaskContext.get().partitionId(), 0
        for pdf in batches:
            for at in range(0, len(pdf), size):
                some = pdf.iloc[at:at + size]
                q = whole(some["vector"].tolist())
                data = bit_planes(q) if as_planes else q
                yield pd.DataFrame({
                    "block": [(part << 32) + made], "labels": [np.unique(some["label"].to_numpy(np.int64))],
                    "ids": [some["id"].to_numpy(np.int64).tobytes()], "of": [some["label"].to_numpy(np.int64).tobytes()],
                    "width": [q.shape[1]], "data": [repr(data.tolist()).encode() if data.dtype == object else data.tobytes()],
                    "exact": [data.dtype == object]})
                made += 1
    return run


PACKED = "block long, labels array<long>, ids binary, of binary, width int, data binary, exact boolean"


def packed(rows: DataFrame, size: int, as_planes: bool, label: str) -> DataFrame:
    # Equal keys are dealt by ``spread``, so that no key is too frequent for a range.
    order = ["label", "id", "spread"]
    ranged = rows.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*order)
    # Neighbouring ranges share a task where they hold less than a block.
    ranged = ranged.coalesce(-(-max(1, rows.count()) // size)).sortWithinPartitions(*order)
    return written(ranged.select("id", "label", "vector").mapInPandas(_blocks(size, as_planes), PACKED), label)


def _numbers(block) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(block["ids"], np.int64), np.frombuffer(block["of"], np.int64)


def _anchors(block) -> np.ndarray:
    if block["exact"]:
        import ast
        return np.array(ast.literal_eval(block["data"].decode()), object).reshape(-1, block["width"])
    return np.frombuffer(block["data"], np.int64).reshape(-1, block["width"])


def _planes(block) -> np.ndarray:
    n = len(block["ids"]) // 8
    groups = block["width"] // GROUP
    return np.frombuffer(block["data"], np.uint8).reshape(-1, groups, n) if groups else np.zeros((1, 0, n), np.uint8)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def _clipped(score: np.ndarray) -> np.ndarray:
    return np.array([max(-LARGEST, min(LARGEST, int(x))) for x in score], np.int64) if score.dtype == object else score.astype(np.int64)


FOUND = "ablock long, slot int, anchor_id long, positive_id long, positive_score long"


def _positives(k: int):
    """The k best candidates of equal label for each anchor of a pair of blocks."""
    def run(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(c):
            a, c = a.iloc[0], c.iloc[0]
            (ids, labels), (others, their) = _numbers(a), _numbers(c)
            for at, score in block_scores(_anchors(a), _planes(c)):
                of, some = their[at:at + AT_ONCE], others[at:at + AT_ONCE]
                for label in np.intersect1d(labels, of):
                    rows = np.flatnonzero(of == label)
                    for slot in np.flatnonzero(labels == label):
                        mine = rows[some[rows] != ids[slot]]
                        own = score[mine, slot]
                        best = _best(own, some[mine], k)
                        if len(best):
                            out.append(pd.DataFrame({"ablock": a["block"], "slot": slot, "anchor_id": ids[slot],
                                                     "positive_id": some[mine][best], "positive_score": _clipped(own[best])}))
        return pd.concat(out) if out else pd.DataFrame(
            {x.split()[0]: np.zeros(0, np.int64) for x in FOUND.split(", ")})
    return run


MINED = "ablock long, slot int, place int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _negatives(k: int, low: int, high: int):
    """For each anchor and positive of a pair of blocks its k best candidates of
    another label between ``low`` and ``high`` percent of the positive's score."""
    def run(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(c):
            a, c = a.iloc[0], c.iloc[0]
            (ids, labels), (others, their) = _numbers(a), _numbers(c)
            wanted: dict[int, list] = {}
            for p in a["positives"]:
                wanted.setdefault(p["slot"], []).append(p)
            for at, score in block_scores(_anchors(a), _planes(c)):
                of, some = their[at:at + AT_ONCE], others[at:at + AT_ONCE]
                for slot, positives in wanted.items():
                    column = score[:, slot]
                    if column.dtype != object:
                        column = column.astype(np.int64)
                    most = max(p["positive_score"] for p in positives)
                    near = np.flatnonzero((column * 100 <= high * most) & (column >= 0) & (of != labels[slot]) & (some != ids[slot]))
                    if not len(near):
                        continue
                    own, names = column[near], some[near]
                    for p in positives:
                        fits = np.flatnonzero((own * 100 <= high * p["positive_score"]) & (own * 100 >= low * p["positive_score"]))
                        best = fits[_best(own[fits], names[fits], k)]
                        if len(best):
                            out.append(pd.DataFrame({
                                "ablock": a["block"], "slot": slot, "place": p["place"], "anchor_id": ids[slot],
                                "positive_id": p["positive_id"], "positive_score": p["positive_score"],
                                "negative_id": names[best], "negative_score": _clipped(own[best])}))
        return pd.concat(out) if out else pd.DataFrame(
            {x.split()[0]: np.zeros(0, np.int64) for x in MINED.split(", ")})
    return run


def _met(pairs: DataFrame, anchors: DataFrame, index: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` over every pair of blocks (ablock, cblock)."""
    n = max(1, pairs.count())
    spread = lambda blocks, own, other: blocks.withColumnRenamed("block", own).join(
        pairs.groupBy(own).agg(F.collect_list(other).alias("others")), own).withColumn(
        other, F.explode("others")).drop("others").withColumn("block", F.col(own)).repartition(n, "ablock", "cblock")
    return spread(anchors, "ablock", "cblock").groupBy("ablock", "cblock").cogroup(
        spread(index, "cblock", "ablock").groupBy("ablock", "cblock")).applyInPandas(run, schema)


def mine(vectors: DataFrame, label: Column, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         anchors_in_block: int = ANCHORS, candidates_in_block: int = CANDIDATES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.  ``label`` is an expression on the table's columns,
    ``is_anchor`` a condition on the column ``id``."""
    v = F.col("vector")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), label.cast("long").alias("label"),
                          vectors[vector_col].cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()
                       & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    index = packed(rows, candidates_in_block, True, "negatives-index")
    anchors = packed(rows.filter(is_anchor).distinct(), anchors_in_block, False, "negatives-anchors")

    of = lambda blocks, name: blocks.select(F.col("block").alias(name), F.explode("labels").alias("label"))
    alike = written(of(anchors, "ablock").join(of(index, "cblock"), "label").select("ablock", "cblock").distinct(), "negatives-alike")
    anchor = Window.partitionBy("ablock", "slot")
    found = _met(alike, anchors, index, _positives(positives), FOUND).withColumn(
        "place", F.row_number().over(anchor.orderBy(F.desc("positive_score"), "positive_id"))).filter(F.col("place") <= positives)
    known = found.groupBy(F.col("ablock").alias("block")).agg(
        F.collect_list(F.struct("slot", "place", "positive_id", "positive_score")).alias("positives"))
    asked = written(anchors.join(known, "block"), "negatives-asked")

    # Every block of anchors meets every block of the index: blocks are dealt
    # to slots, anchors go to each slot once.
    slots = max(1, index.count())
    pairs = asked.select(F.col("block").alias("ablock"), F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("at")).join(
        index.select(F.col("block").alias("cblock"), F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int").alias("at")), "at")
    pairs = written(pairs.select("ablock", "cblock"), "negatives-pairs")
    best = Window.partitionBy("ablock", "slot", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (_met(pairs, asked, index, _negatives(negatives, low, high), MINED)
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


#: The query's rows in DuckDB SQL.
SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS alike, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, b AS p, score AS ps FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.p AS positive_id, row_number() OVER (PARTITION BY p.a, p.p ORDER BY score DESC, b)::INT AS rank,
       b AS negative_id, ps AS positive_score, score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT alike AND 80 * ps <= 100 * score AND score <= ps
QUALIFY row_number() OVER (PARTITION BY p.a, p.p ORDER BY score DESC, b) <= 5
"""
