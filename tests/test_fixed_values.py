"""The oracle states its fixed values by itself: a slip in one of the two statements shows."""

from datetime import timedelta

from pyspark.sql import functions as F

from starloom.functions import vocab
from starloom.operators.modeling import synthetic_row, with_unknown_member
from starloom.plans import oracle_values


def test_both_statements_of_the_fixed_values_are_equal():
    public = lambda m: {k: v for k, v in vars(m).items() if k.isupper()}
    ours, theirs = public(vocab), public(oracle_values)
    shared = set(ours) & set(theirs)
    assert len(shared) >= 8 and {k: ours[k] for k in shared} == {k: theirs[k] for k in shared}


def test_synthetic_row_has_typed_nulls_of_any_type(spark):
    df = spark.createDataFrame([(1, "a", ["x"], (1, 2.0), timedelta(days=1))],
                               "n int, s string, l array<string>, t struct<a:int,b:double>, i interval day to second")
    row = synthetic_row(df, s="unknown", n="7")
    assert row.schema.simpleString() == df.schema.simpleString()
    assert tuple(row.first()) == (7, "unknown", None, None, None)
    assert with_unknown_member(df, s="unknown").where(F.col("l").isNull()).count() == 1
