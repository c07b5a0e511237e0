"""Key existence, foreign-key resolution and lookup joins.

No key set ever travels through the driver: existence is a left join
against the distinct key side, on the plain key.  Spark then knows that the
right side is unique, so a flag that nobody reads costs nothing: the optimizer
drops the whole join.  No broadcast hint is given: with AQE on, the planner
measures the distinct key side after its shuffle and turns the join into a
broadcast only when that measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it stays a
sort-merge join whose skewed partitions AQE splits, the one of the null keys
as well as that of any hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_K = "__starloom_key"
_HIT = "__starloom_hit"


def with_key_exists(df: DataFrame, key_col: str, keys: DataFrame, keys_col: str, out_col: str,
                    nulls_apart: bool = False) -> DataFrame:
    """Add ``out_col``: true if ``df.key_col`` occurs in ``keys.keys_col``,
    false if not, null when the key itself is null (``IN`` semantics).

    The key side is de-duplicated first so the join can never multiply rows,
    and cast to the type of ``df.key_col``.  ``nulls_apart`` sends the rows
    with a null key around the join instead of through it: they are not
    shuffled at all, for the price of reading ``df`` once more.
    """
    key_type = df.schema[key_col].dataType
    # Dealt by another hash than the join's, so that the join shuffles both
    # sides itself: AQE splits hot partitions of such joins alone, and the
    # distinct keys are the small side.
    key_side = (keys.select(F.col(keys_col).cast(key_type).alias(_K)).where(F.col(_K).isNotNull()).distinct()
                .repartition(F.xxhash64(_K)).withColumn(_HIT, F.lit(True)))
    through = df.where(F.col(key_col).isNotNull()) if nulls_apart else df
    joined = through.join(key_side, F.col(key_col) == F.col(_K), "left").withColumn(
        out_col, F.when(F.col(key_col).isNotNull(), F.col(_HIT).isNotNull())).drop(_HIT, _K)
    if not nulls_apart:
        return joined
    return joined.unionByName(df.where(F.col(key_col).isNull()).withColumn(out_col, F.lit(None).cast("boolean")))


def missing_keys(df: DataFrame, key: Column, keys: DataFrame, keys_key: Column, name: str = "missing_key") -> DataFrame:
    """Distinct non-null keys of ``df`` that ``keys`` does not hold.

    Only the keys are shuffled, and the difference is taken before the
    distinct: a distinct in front of it would hold all keys of an unsplit file
    in one task, while a join's task holds one partition and AQE splits a hot
    key of the left side."""
    left = df.select(key.alias(name)).where(F.col(name).isNotNull())
    right = keys.select(keys_key.cast(left.schema[name].dataType).alias(_K)).where(F.col(_K).isNotNull())
    return left.join(right, F.col(name) == F.col(_K), "left_anti").distinct()


def with_key_missing(df: DataFrame, key_col: str, missing: DataFrame, out_col: str) -> DataFrame:
    """``with_key_exists`` from the keys of ``df`` found missing before
    (``missing_keys``, stored): where these are few, their files' size lets the
    planner broadcast them and ``df`` stays where it is; where they are many,
    it is the shuffled join."""
    flagged = with_key_exists(df, key_col, missing, missing.columns[0], out_col)
    return flagged.withColumn(out_col, ~F.col(out_col))


def resolve_fk(key: Column | str, exists: Column | str, unknown: str) -> Column:
    """Orphan or null key -> the dimension's unknown member; valid key kept."""
    k = F.col(key) if isinstance(key, str) else key
    e = F.col(exists) if isinstance(exists, str) else exists
    return F.when(e, k).otherwise(F.lit(unknown))


def orphans(df: DataFrame, key_col: str, dim: DataFrame, dim_col: str) -> DataFrame:
    """Rows whose key has no match in ``dim`` (null keys count as orphans).

    Same result as a left-anti join that keeps null keys."""
    flag = "__starloom_exists"
    return (with_key_exists(df, key_col, dim, dim_col, flag)
            .where(~F.coalesce(F.col(flag), F.lit(False))).drop(flag))
