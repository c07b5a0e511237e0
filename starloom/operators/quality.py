"""Row-level data-quality flags (``_dq_flags array<string>``).

Flags are built in a single projection: ``array_compact(array(when(c1,'f1'),
when(c2,'f2'), ...))`` keeps declaration order, drops unmet (false or null)
conditions and never grows the plan one Project per flag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAG_COL = "_dq_flags"


def flags_expr(flags: Sequence[tuple[str, Column]]) -> Column:
    if not flags:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in flags]))


def with_dq_flags(df: DataFrame, flags: Sequence[tuple[str, Column]],
                  flag_col: str = FLAG_COL) -> DataFrame:
    """Append ``(name, condition)`` flags to ``flag_col`` (created if missing).

    A null condition adds nothing; a name already present is not repeated.
    """
    new = flags_expr(flags)
    if flag_col in df.columns:
        new = F.array_distinct(F.concat(F.col(flag_col), new))
    else:
        new = F.array_distinct(new)
    return df.withColumn(flag_col, new)


def add_dq_flag(df: DataFrame, flag_col: str, condition: Column, flag_name: str) -> DataFrame:
    """Single-flag form, for call sites that add one flag at a time."""
    return with_dq_flags(df, [(flag_name, condition)], flag_col)
