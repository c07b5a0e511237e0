"""Locale-tolerant number parsing and reconciliation predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions import vocab


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_br_decimal_to_double(col: Column | str) -> Column:
    """'1274,78' or '1274.78' -> 1274.78.

    Narrower than ``try_cast``: only ``-?digits(.digits)?`` is accepted, so
    '1.274,78', '.5' and '1e3' give null.
    """
    text = F.replace(F.trim(_c(col).cast("string")), F.lit(","), F.lit("."))
    return F.when(text.rlike(vocab.NUMERIC_PATTERN), text.try_cast("double"))


#: Every text that casts to a double has this shape (some that have it don't).
MAY_BE_NUMBER = (r"(?s)^[\x00-\x20]*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[dDfF]?|0[xX].*"
                 r"|[iI][nN][fF].*|[nN][aA][nN].*)[\x00-\x20]*$")


def number_in(col: Column | str) -> Column:
    """``trim(x)`` cast to a double, null if it is none.  Text without a
    number's shape isn't tried: a failing cast costs an exception inside the JVM."""
    text = F.trim(_c(col))
    return F.when(text.rlike(MAY_BE_NUMBER), text.try_cast("double"))


def safe_cast_double(col: Column | str) -> Column:
    """Sentinels ('N/A', 'unknown', 'null', blank) and null -> null, else the
    number.  No sentinel has the shape of a number, so
    :func:`parse_br_decimal_to_double` rejects them already."""
    return parse_br_decimal_to_double(col)


def mismatch(a: Column | str, b: Column | str, tolerance: float = 0.01) -> Column:
    """|a - b| > tolerance; null on either side -> null (no flag)."""
    return F.abs(_c(a) - _c(b)) > F.lit(tolerance)
