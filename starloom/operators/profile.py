"""Profiling operators as distributed aggregates.

No group is collected into one task or the driver: value listings are
group-bys, duplicate listings join the rows back to a per-key count, and
the only limit is the explicit first-N listing (a top-k under a total
order, planned as TakeOrderedAndProject).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.numbers import number_in
from starloom.operators.cells import CELL, SHAPE, VALUE, counted, summaries
from starloom.operators.joins import missing_keys
from starloom.session import ship_package


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, n_columns) for several tables in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("table_name"), "n_rows",
                       F.lit(len(df.columns)).alias("n_columns"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def null_blank_counts(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, column_name, n_null, n_blank), one aggregate for all columns."""
    cols = [f.name for f in df.schema.fields]
    aggs = []
    for c in cols:
        col = F.col(f"`{c}`")
        aggs.append(F.count_if(col.isNull()).alias(f"n__{c}"))
        if isinstance(df.schema[c].dataType, T.StringType):
            aggs.append(F.count_if(F.trim(col) == F.lit("")).alias(f"b__{c}"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias(f"b__{c}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`n__{c}`").alias("n_null"),
                              F.col(f"`b__{c}`").alias("n_blank")) for c in cols])
    return wide.select(F.inline(rows)).select(F.lit(table_name).alias("table_name"), "*")


def value_counts(df: DataFrame, col: Column | str, name: str = "value") -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    return df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def case_variant_count(df: DataFrame, col: str) -> Column:
    return F.count_if(F.upper(F.col(col)) != F.col(col))


def duplicate_rows(df: DataFrame, key: Column, key_name: str = "dup_key") -> DataFrame:
    """Every row whose key occurs more than once, null being a key like any
    other, with the copy count.  Per-key counts come from a partial+final aggregate, so a hot key
    is pre-counted map-side; the join back is split by AQE if skewed."""
    keyed = df.withColumn(key_name, key)
    counts = (keyed.groupBy(key_name).agg(F.count(F.lit(1)).alias("n_copies"))
                   .where(F.col("n_copies") > 1))
    kept = counts.select(F.col(key_name).alias("__key"), "n_copies")
    return keyed.join(kept, F.col(key_name).eqNullSafe(F.col("__key")), "inner").drop("__key")


def numeric_issues(df: DataFrame, col: str, null_is_bad: bool = False) -> DataFrame:
    """(n_non_numeric, n_comma_decimal, n_negative, n_zero) for a text column."""
    c = F.col(col)
    num = number_in(c)
    bad = num.isNull() if null_is_bad else (c.isNotNull() & num.isNull())
    return df.agg(F.count_if(bad).alias("n_non_numeric"),
                  F.count_if(c.contains(",")).alias("n_comma_decimal"),
                  F.count_if(num < 0).alias("n_negative"), F.count_if(num == 0).alias("n_zero"))


def orphan_keys(df: DataFrame, key: Column, dim: DataFrame, dim_key: Column,
                name: str = "orphan_key") -> DataFrame:
    """Distinct keys of ``df`` absent from ``dim`` (set difference)."""
    return missing_keys(df, key, dim, dim_key, name)


def pattern_mismatch(df: DataFrame, col: str, pattern: str, null_is_bad: bool) -> DataFrame:
    """Values not matching ``pattern`` with their counts."""
    c = F.col(col)
    bad = ~c.rlike(pattern)
    cond = (c.isNull() | bad) if null_is_bad else bad
    return value_counts(df.where(cond), col)


def format_shapes(df: DataFrame, col: str) -> DataFrame:
    """Histogram of value shapes (every digit -> 9): a deterministic sample of formats."""
    return value_counts(df, F.regexp_replace(F.col(col), "[0-9]", "9"), "shape")


def first_n(df: DataFrame, condition: Column, order: Sequence[Column], n: int = 10) -> DataFrame:
    """First ``n`` offending rows under a total order (the listing *is* the feature)."""
    return df.where(condition).orderBy(*order).limit(n)


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs -> top-level columns ``parent_child`` (recursive)."""
    def walk(schema: T.StructType, prefix: list[str]):
        for f in schema.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, path)
            else:
                yield F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))
    return df.select(*walk(df.schema, []))


# -- all columns of many tables at once ---------------------------------------------

#: A value is frequent from this share of its column's rows; candidates kept of a column (at most 1 / share can be
#: frequent, the rest is room for the summaries' error), values that a task tracks and hands on.
FREQUENT, CANDIDATES, TRACKED, HANDED_ON = 0.01, 200, 10_000, 1_000


def column_texts(df: DataFrame) -> DataFrame:
    """Every column of ``df`` as text, nested fields flattened, arrays joined with '|'."""
    flat = flatten(df)
    return flat.select(*[
        (F.array_join(F.col(f"`{f.name}`").cast("array<string>"), "|") if isinstance(f.dataType, T.ArrayType)
         else F.col(f"`{f.name}`").cast("string")).alias(f.name) for f in flat.schema.fields])


def _by_workers(df: DataFrame, name: str, run, schema: str) -> DataFrame:
    """What the Python workers make of a table's columns."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema).select(F.lit(name).alias("table_name"), "*")


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A row per column of each table: rows, nulls, blanks, case variants,
    numbers, comma decimals, negatives, zeros, shortest and longest value, and
    candidates for its frequent values and shapes: each with the rows that it
    was seen in, and how many more it may have (``missed``, 0: none).

    One scan of each table.  Its cells are counted where they are read; values
    that differ in nothing told here are one row, and every part of a summary
    merges, so what leaves a task are a few rows per column, however many
    distinct values there are."""
    run, schema = summaries(TRACKED, HANDED_ON), "column_name string, kind string, text string, n long, missed long"
    cells = reduce(DataFrame.unionByName, [_by_workers(column_texts(df), name, run, schema) for name, df in tables.items()])
    kind, n, item = F.col("kind"), F.col("n"), F.col("item")
    value = F.when(kind == CELL, F.col("text"))
    number = number_in(value)

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0).cast("bigint"))

    told = {"n_null": rows_where(value.isNull()), "n_blank": rows_where(F.trim(value) == ""), "n_case_variants": rows_where(F.upper(value) != value),
            "n_numeric": rows_where(number.isNotNull()), "n_comma": rows_where(value.contains(",")), "n_negative": rows_where(number < 0),
            "n_zero": rows_where(number == 0), "shortest": F.min(F.length(value)), "longest": F.max(F.length(value))}
    at = ["table_name", "column_name"]
    found = (cells.withColumn("item", F.when(kind != CELL, F.col("text")))
             .groupBy(*at, "kind", "item").agg(*(c.alias(x) for x, c in told.items()), F.sum("missed").alias("missed"), F.sum(n).alias("n")))
    # The most rows that an item can have: its own, and in every task without it what that task lost.
    largest = Window.partitionBy(*at, "kind").orderBy(item.isNotNull(), (n + F.col("missed")).desc(), "item")
    few = found.withColumn("_r", F.row_number().over(largest)).where(F.col("_r") <= CANDIDATES + 1)
    items = [F.collect_list(F.when((kind == k) & item.isNotNull(), F.struct("item", n.alias("count"), "missed"))).alias(f"{k}s") for k in (VALUE, SHAPE)]
    lost = [F.max(F.when((kind == k) & item.isNull(), F.col("missed"))).alias(f"_{k}") for k in (VALUE, SHAPE)]
    wide = few.groupBy(*at).agg(F.max(F.when(kind == CELL, n)).alias("n_rows"), *(F.max(F.when(kind == CELL, F.col(x))).alias(x) for x in told), *items, *lost)

    def candidates(k: str) -> Column:
        null = F.struct(F.lit(None).cast("string").alias("item"), F.col("n_null").alias("count"), F.lit(0).cast("bigint").alias("missed"))
        known = F.transform(f"{k}s", lambda x: F.struct(x["item"].alias("item"), x["count"].alias("count"), (x["missed"] + F.col(f"_{k}")).alias("missed")))
        return F.array_sort(F.filter(F.array_append(known, null), lambda x: x["count"] + x["missed"] >= F.col("n_rows") * FREQUENT)).alias(f"{k}s")
    return wide.select(*at, "n_rows", *told, candidates(VALUE), candidates(SHAPE))


def frequent_values(tables: Mapping[str, DataFrame], profile: DataFrame) -> DataFrame:
    """(table_name, column_name, kind, value, n): values and shapes that at
    least FREQUENT of a column's rows hold, null among them, counted exactly.

    The profile's candidates hold all of them (the summaries miss none of that
    share).  Most are counted there already; a second pass over the tables
    that have others counts just these."""
    few = reduce(DataFrame.unionByName, [profile.select(
        "table_name", "column_name", "n_rows", F.lit(kind).alias("kind"), F.explode(f"{kind}s").alias("c")) for kind in (VALUE, SHAPE)])
    few = few.select("table_name", "column_name", "kind", F.col("c.item").alias("value"), "n_rows", F.col("c.count").alias("n"), F.col("c.missed").alias("missed"))
    named = ["table_name", "column_name", "kind", "value"]
    unsure = few.where(F.col("missed") > 0).drop("n", "missed")

    # One row, of at most as many names as there are columns: no other column is made text again.
    due = profile.where(reduce(Column.__or__, [F.exists(f"{k}s", lambda x: x["missed"] > 0) for k in (VALUE, SHAPE)])).agg(
        F.collect_set(F.struct("table_name", "column_name"))).head()[0]

    def asked(name: str, df: DataFrame) -> DataFrame:
        texts = column_texts(df)
        texts = texts.select(*([f"`{c}`" for c in texts.columns if (name, c) in due] or ["*"]))
        cells = _by_workers(texts, name, counted, "column_name string, kind string, value string, n long")
        # At most 2 * CANDIDATES rows a column: a profile that is stored has that side broadcast, and no cell is shuffled.
        # It is there first: a table without any isn't read.
        return cells.join(unsure.where(F.col("table_name") == name), named)
    kept = reduce(DataFrame.unionByName, [asked(name, df) for name, df in tables.items()])
    again = kept.groupBy(*named, "n_rows").agg(F.sum("n").alias("n"))
    return (few.where(F.col("missed") == 0).drop("missed").unionByName(again)
            .where(F.col("n") >= F.col("n_rows") * FREQUENT).drop("n_rows"))
