"""Deterministic deduplication: keep the best-ranked row per business key.

Shape: ``row_number() over (partition by keys order by rank..., tie-break)
== 1``.  Catalyst turns this into a *partial* WindowGroupLimit before the
shuffle and a final one after it, so every map task forwards at most one row
per key: a key holding a third of the table still sends only one row per map
partition to its reducer (map-side pre-aggregation).

Ties are broken on content (every remaining atomic column, ascending, nulls
first), never on file order or ``monotonically_increasing_id``, so the
survivor does not depend on partitioning or storage round trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RN = "__starloom_rn"


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, (T.MapType, T.VariantType)):
        return False
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def content_tiebreak(df: DataFrame, exclude: Sequence[str] = ()) -> list[Column]:
    """Total order over the row's content: every orderable column (atomic,
    arrays and structs of orderable types), in schema order.  Only map and
    variant columns, which have no ordering, are left out."""
    return [F.col(f"`{f.name}`").asc_nulls_first() for f in df.schema.fields
            if f.name not in exclude and _orderable(f.dataType)]


def dedup_by_rank(df: DataFrame, key_cols: Sequence[str],
                  order_by: Sequence[Column], tie_break: bool = True) -> DataFrame:
    """Keep one row per ``key_cols``: the first under ``order_by`` (Columns
    already carrying asc/desc and null placement), then the content tie-break."""
    keys = list(key_cols)
    order = list(order_by)
    if tie_break:
        order += content_tiebreak(df, exclude=keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(_RN, F.row_number().over(w))
              .filter(F.col(_RN) == 1)
              .drop(_RN))


def dedup_keep_latest(df: DataFrame, key_cols: Sequence[str], order_col: str,
                      extra_order: Sequence[Column] = ()) -> DataFrame:
    """Latest ``order_col`` wins (nulls last), then ``extra_order``."""
    return dedup_by_rank(df, key_cols, [F.col(order_col).desc_nulls_last(), *extra_order])
