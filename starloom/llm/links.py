"""Components of links, for the operators that group near duplicates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written

#: Links that a task contracts at once.
AT_ONCE = 1 << 20


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node that each reaches) over the links (a, b), without
    the smallest nodes themselves: no more rows than nodes, the same components."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = np.minimum(new, new[label])
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]


def contracted(links: DataFrame) -> DataFrame:
    """The links (u > v) of spanning stars, made within each task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for pdf in batches:
            u, v = np.concatenate([u, pdf["u"].to_numpy(np.int64)]), np.concatenate([v, pdf["v"].to_numpy(np.int64)])
            if len(u) >= AT_ONCE:
                u, v = forest(u, v)
                if len(u) >= AT_ONCE // 2:  # little is left to contract
                    yield pd.DataFrame({"u": u, "v": v})
                    u, v = u[:0], v[:0]
        if len(u):
            u, v = forest(u, v)
            yield pd.DataFrame({"u": u, "v": v})
    return links.mapInPandas(run, "u long, v long")


def _settled(edges: DataFrame) -> bool:
    """Whether the links (u > v) are stars: no node is below one and above another, or below two."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    return ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")).filter(
        "below > 1 OR (below > 0 AND above > 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, part): every node of the links (a, b) with the smallest node it reaches.

    Links are contracted within tasks first.  Then alternating stars:
    neighbours above a node move to its smallest neighbour, then neighbours
    below it do; each round is written, so a lost executor costs one round at most."""
    edges = written(contracted(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v")), "links")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # A node's least neighbour is needed at both ends of its links: large
        # stars move the end above, small stars the other ends below.
        large = edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v")).filter("u > v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        edges = written(contracted(small.unionByName(least.select("u", F.col("m").alias("v")))).distinct(), "links")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("part")).unionByName(
        roots.select("node", F.col("node").alias("part")))
