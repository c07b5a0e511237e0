"""Check suites with one pass over each table.

A *measure* is an aggregate over a table (a count of rows, of bad rows, of
distinct keys); a *check* is an expression over measures, of one table or of
several.  All measures of a table are computed by one aggregate, so each table
is scanned once however many checks read it; distinct keys are counted by
Spark's two-level aggregates, with partial counts before the shuffle, so a hot
key meets as one row a task.  The one-row results are then laid side by side
and the checks evaluated over them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import with_key_exists


@dataclass(frozen=True)
class Measure:
    """``agg`` of ``table``, as a long."""
    table: str
    name: str
    agg: Column


@dataclass(frozen=True)
class Check:
    """``violations`` over the measures it names, in their order."""
    name: str
    table: str
    measures: tuple[tuple[str, str], ...]
    violations: Callable[..., Column]


# -- measures ---------------------------------------------------------------------

def rows() -> Column:
    return F.count(F.lit(1))


def bad_rows(condition: Column) -> Column:
    """Rows where ``condition`` holds (null: it doesn't)."""
    return F.count_if(condition)


def distinct_keys(*columns: Column | str) -> Column:
    """Distinct keys; null is a value like any other."""
    return F.count_distinct(F.struct(*columns))


def distinct_bad_values(column: str, allowed: Sequence[str]) -> Column:
    """Distinct values outside ``allowed``, null among them."""
    c = F.col(column)
    return F.count_distinct(F.when(c.isNull() | ~c.isin(*allowed), F.struct(c)))


# -- suites -----------------------------------------------------------------------

class Suite:
    """Measures and checks over named tables, evaluated in one job."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = dict(tables)
        self.measures: dict[str, dict[str, Column]] = {}
        self.checks: list[Check] = []

    def measure(self, table: str, name: str, agg: Column) -> tuple[str, str]:
        self.measures.setdefault(table, {}).setdefault(name, agg)
        return table, name

    def check(self, name: str, table: str, violations: Callable[..., Column], *measures: tuple[str, str]) -> None:
        self.checks.append(Check(name, table, measures, violations))

    # The kinds of checks ------------------------------------------------------

    def no_rows(self, name: str, table: str, condition: Column) -> None:
        """No row for which ``condition`` holds."""
        at = self.measure(table, f"bad:{name}", bad_rows(condition))
        self.check(name, table, lambda n: n, at)

    def unique(self, name: str, table: str, columns: Sequence[str]) -> None:
        self.check(name, table, lambda n, keys: n - keys, self.measure(table, "rows", rows()),
                   self.measure(table, f"keys:{','.join(columns)}", distinct_keys(*columns)))

    def vocabulary(self, name: str, table: str, column: str, allowed: Sequence[str]) -> None:
        at = self.measure(table, f"values:{column}:{name}", distinct_bad_values(column, allowed))
        self.check(name, table, lambda n: n, at)

    def same_count(self, name: str, table: str, other: tuple[str, str]) -> None:
        """As many rows as the measure ``other`` says."""
        self.check(name, table, lambda n, m: F.abs(n - m), self.measure(table, "rows", rows()), other)

    def references(self, name: str, table: str, column: str, dim: DataFrame, dim_column: str) -> None:
        """Every row's key is one of ``dim``'s (a null key is none)."""
        flag = f"__known_{len(self.checks)}"
        self.tables[table] = with_key_exists(self.tables[table], column, dim, dim_column, flag)
        self.no_rows(name, table, ~F.coalesce(F.col(flag), F.lit(False)))

    def run(self) -> DataFrame:
        """(check_name, table_name, violations, passed) of every check."""
        def of(table: str, aggs: dict[str, Column]) -> DataFrame:
            one = self.tables[table].agg(*(agg.cast("long").alias(f"m{k}") for k, agg in enumerate(aggs.values())))
            return one.select(F.explode(F.array(*(
                F.struct(F.lit(f"{table}|{name}").alias("key"), F.col(f"m{k}").alias("value")) for k, name in enumerate(aggs)))).alias("m"))
        # One row per measure: a list as long as the suite.
        found = reduce(DataFrame.unionByName, [of(t, aggs) for t, aggs in self.measures.items()])
        values = found.agg(F.map_from_entries(F.collect_list("m")).alias("v"))
        out = values.select(F.inline(F.array(*(
            F.struct(F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"),
                     c.violations(*(F.col("v")[f"{t}|{m}"] for t, m in c.measures)).cast("long").alias("violations"))
            for c in self.checks))))
        return out.withColumn("passed", F.col("violations") == 0)
