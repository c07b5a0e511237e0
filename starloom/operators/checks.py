"""Integrity checks as aggregate jobs.

A check is ``(check_name, table_name, DataFrame with one row and a
'violations' column)``; :func:`run_checks` unions them into one result
``(check_name, table_name, violations, passed)`` so a whole suite is one
action with one branch per check instead of one driver job per check.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Check = tuple[str, str, DataFrame]


def run_checks(checks: Iterable[Check]) -> DataFrame:
    parts = [agg.select(F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
                        F.col("violations").cast("bigint").alias("violations"))
             for name, table, agg in checks]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("passed", F.col("violations") == 0)


def predicates_hold(one_row: DataFrame, table: str, predicates: dict[str, Column]) -> DataFrame:
    """(check_name, table_name, violations, passed): 1 violation of each
    predicate that isn't true of the single row."""
    told = [F.struct(F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
                     F.when(p, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("violations")) for name, p in predicates.items()]
    return one_row.select(F.inline(F.array(*told))).withColumn("passed", F.col("violations") == 0)


def survivor_is_latest(clean: DataFrame, survivors: DataFrame, keys: Sequence[str],
                       order_col: str) -> DataFrame:
    """Keys whose surviving row is not the latest ``order_col`` of the key."""
    latest = clean.groupBy(*keys).agg(F.max(order_col).alias("_latest"))
    j = survivors.select(*keys, F.col(order_col).alias("_kept")).join(latest, list(keys), "inner")
    bad = F.col("_latest").isNotNull() & (F.col("_kept").isNull() | (F.col("_kept") < F.col("_latest")))
    return j.agg(F.count_if(bad).alias("violations"))


def at_latest(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """All copies that share the latest ``order_col`` of their key."""
    top = df.groupBy(*keys).agg(F.max(order_col).alias("_top"))
    return df.join(top, list(keys)).where(F.col(order_col).eqNullSafe(F.col("_top"))).drop("_top")


def survivor_has(copies: DataFrame, survivors: DataFrame) -> DataFrame:
    """Keys of which some copy had a property but the survivor lacks it; both
    sides are (key, property)."""
    some = copies.toDF("k", "ok").groupBy("k").agg(F.bool_or(F.coalesce("ok", F.lit(False))).alias("ok"))
    kept = survivors.toDF("k", "has")
    return some.join(kept, "k").agg(F.count_if(F.col("ok") & ~F.coalesce("has", F.lit(False))).alias("violations"))
