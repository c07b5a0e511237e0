"""Dimensional-modelling operators: unknown members, calendar, denormalised
lookups and grouped pre-aggregates used by the fact builders."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import calendar_columns


def synthetic_row(df: DataFrame, **values) -> DataFrame:
    """One row of ``df``'s schema: the given values, and typed nulls in all other columns."""
    return df.sparkSession.range(1).select(*(F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields))


def with_unknown_member(df: DataFrame, **values) -> DataFrame:
    """Dimension plus its explicit unknown member (union all by name)."""
    return df.unionByName(synthetic_row(df, **values))


def date_bounds(columns: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """One-row (min_date, max_date) over several tables' date/timestamp
    columns, computed in a single aggregate job: one scan per table (its
    date columns exploded side by side), partial min/max per branch."""
    by_table: list[tuple[DataFrame, list[str]]] = []
    for d, c in columns:
        for entry in by_table:
            if entry[0] is d:
                entry[1].append(c)
                break
        else:
            by_table.append((d, [c]))
    parts = [d.select(F.explode(F.array(*[F.to_date(F.col(c)) for c in cols])).alias("d"))
             for d, cols in by_table]
    return reduce(DataFrame.unionByName, parts).agg(F.min("d").alias("min_date"),
                                                    F.max("d").alias("max_date"))


def calendar_dimension(columns: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Day calendar spanning every date seen in ``columns`` (inclusive).

    The bounds stay a DataFrame (no driver round trip); the row count is the
    number of days in the span, which does not grow with data volume.
    """
    bounds = date_bounds(columns)
    # Two levels: one row per month of the span, then its days; the rows of
    # any span that dates can have are few.
    months = bounds.select(
        "min_date", "max_date",
        F.explode(F.sequence(F.trunc("min_date", "month"), F.trunc("max_date", "month"),
                             F.expr("interval 1 month"))).alias("month_start"))
    days = months.select(
        F.explode(F.sequence(F.greatest("month_start", "min_date"),
                             F.least(F.last_day("month_start"), F.col("max_date")),
                             F.expr("interval 1 day"))).alias("date"))
    return days.select(*calendar_columns("date"))


def latest_per_key(df: DataFrame, key_col: str, value_cols: Sequence[str],
                   out_key: str | None = None) -> DataFrame:
    """Grouped max of several columns (each maximum independent)."""
    return df.groupBy(F.col(key_col).alias(out_key or key_col)).agg(
        *[F.max(c).alias(c) for c in value_cols])
