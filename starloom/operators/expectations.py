"""Declarative expectations evaluated on every run.

An expectation is data: ``Expectation(name, table, kind, args)``.  A list
of them is evaluated as one suite, in one pass over each table;
:func:`observe_violations` attaches row-level expectations to a write through
``DataFrame.observe`` so they are counted while the table is produced, and
:func:`write_checked` also puts failing rows aside in that very write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators.suite import Suite


@dataclass(frozen=True)
class Expectation:
    name: str
    table: str
    kind: str  # not_null | unique | references | forbidden | vocabulary | row_condition
    args: Mapping = field(default_factory=dict)


def _add(suite: Suite, e: Expectation, tables: Mapping[str, DataFrame]) -> None:
    a = e.args
    if e.kind == "not_null":
        suite.no_rows(e.name, e.table, F.col(a["column"]).isNull())
    elif e.kind == "unique":
        suite.unique(e.name, e.table, a["columns"])
    elif e.kind == "references":
        suite.references(e.name, e.table, a["column"], tables[a["table"]], a["to"])
    elif e.kind == "forbidden":
        suite.no_rows(e.name, e.table, F.col(a["column"]) == F.lit(a["value"]))
    elif e.kind == "vocabulary":
        suite.vocabulary(e.name, e.table, a["column"], a["allowed"])
    elif e.kind == "row_condition":
        suite.no_rows(e.name, e.table, ~F.expr(a["condition"]))
    else:
        raise ValueError(f"unknown expectation kind {e.kind!r}")


def evaluate(expectations: Sequence[Expectation], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, table_name, violations, passed) for every expectation,
    from one pass over each table."""
    suite = Suite(tables)
    for e in expectations:
        _add(suite, e, tables)
    return suite.run()


#: Column of a checked write that lists the expectations a row fails, and the one that parts the rows.
REASONS, QUARANTINED = "_failed", "_quarantined"


def write_checked(df: DataFrame, path: str, conditions: Mapping[str, Column]) -> dict[str, int]:
    """Write ``df`` once: rows that meet all ``conditions`` and rows that fail
    some go to folders of their own in the same job, the latter with the names
    of what they fail.  A condition that is null fails.  Returns the rows kept
    and quarantined and the failures of each condition, counted by the write."""
    holds = {n: F.coalesce(c, F.lit(False)) for n, c in conditions.items()}
    reasons = F.filter(F.array(*(F.when(~c, F.lit(n)) for n, c in holds.items())), lambda r: r.isNotNull())
    told = df.withColumn(REASONS, reasons).withColumn(QUARANTINED, F.size(REASONS) > 0)
    obs = Observation()
    told = told.observe(obs, F.count_if(~F.col(QUARANTINED)).alias("kept"), F.count_if(QUARANTINED).alias("quarantined"),
                        *(F.count_if(F.array_contains(REASONS, n)).alias(f"failed:{n}") for n in holds))
    told.write.mode("overwrite").partitionBy(QUARANTINED).parquet(path)
    return {k: int(v) for k, v in obs.get.items()}


def read_kept(spark: SparkSession, path: str) -> DataFrame:
    """The rows that met all conditions."""
    return spark.read.parquet(path).where(F.col(QUARANTINED) == "false").drop(QUARANTINED, REASONS)


def read_quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The rows that failed some condition, with its name in ``_failed``."""
    return spark.read.parquet(path).where(F.col(QUARANTINED) == "true").drop(QUARANTINED)


def observe_violations(df: DataFrame, conditions: Mapping[str, Column],
                       name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Attach row conditions to ``df``; after the next action on the returned
    DataFrame, ``observation.get`` holds the violation count per condition."""
    obs = Observation(name)
    metrics = [F.count_if(~cond).alias(n) for n, cond in conditions.items()]
    return df.observe(obs, *metrics), obs
