"""Date / timestamp parsing and calendar expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions import vocab


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


_FIELD_WIDTH = {"yyyy": 4, "MM": 2, "dd": 2, "HH": 2, "mm": 2, "ss": 2}


def layout_shape(fmt: str) -> str:
    """Regex of the exact text a layout formats to (yyyy -> 4 digits, MM -> 2
    digits, quoted literals kept), e.g. 'dd/MM/yyyy' -> '^[0-9]{2}/[0-9]{2}/[0-9]{4}$'."""
    out, i = [], 0
    while i < len(fmt):
        if fmt[i] == "'":
            j = fmt.index("'", i + 1)
            out.append(re.escape(fmt[i + 1:j]))
            i = j + 1
            continue
        for field, width in _FIELD_WIDTH.items():
            if fmt.startswith(field, i):
                out.append(f"[0-9]{{{width}}}")
                i += len(field)
                break
        else:
            out.append(re.escape(fmt[i]))
            i += 1
    return "^" + "".join(out) + "$"


def parse_strict(text: Column, fmt: str) -> Column:
    """Parse with one layout and accept it only if formatting the value back
    reproduces the text exactly (no silent roll-over of 2025-13-40 or 31/02).

    The parser is only invoked on text already shaped like the layout: a
    round-trip match implies that shape, so the guard changes no result but
    spares a failing parse (an exception inside the JVM) per wrong layout.
    """
    ts = F.try_to_timestamp(text, F.lit(fmt))
    return F.when(text.rlike(layout_shape(fmt)) & (F.date_format(ts, fmt) == text), ts)


def layout_fields(fmt: str) -> tuple[str, dict[str, int]] | None:
    """A layout's shape code (its text with 9 for every digit) and where each
    field starts (from 1); None if it has other parts than the known fields and
    literals without digits, or no full date."""
    shape, at, i = "", {}, 0
    while i < len(fmt):
        field = next((f for f in _FIELD_WIDTH if fmt.startswith(f, i)), None)
        if fmt[i] == "'":
            j = fmt.index("'", i + 1)
            literal, i = fmt[i + 1:j], j + 1
        elif field:
            if field in at:
                return None
            at[field], literal, i = len(shape) + 1, "9" * _FIELD_WIDTH[field], i + len(field)
        elif fmt[i].isalnum():
            return None
        else:
            literal, i = fmt[i], i + 1
        if not field and re.search("[0-9]", literal):
            return None
        shape += literal
    return (shape, at) if {"yyyy", "MM", "dd"} <= set(at) else None


def _built(text: Column, at: dict[str, int]) -> Column:
    """The stamp made of the digits at the fields' places; null if there is no such day or time."""
    part = lambda f: F.substring(text, at[f], _FIELD_WIDTH[f]).cast("int") if f in at else F.lit(0)
    stamp = F.try_make_timestamp(part("yyyy"), part("MM"), part("dd"), part("HH"), part("mm"), part("ss"))
    return F.when(part("ss") < 60, stamp) if "ss" in at else stamp  # second 60 would roll over


def parse_multi_format_timestamp(col: Column | str,
                                 formats: list[str] | None = None) -> Column:
    """First layout (in order) that parses the trimmed text strictly; else null.

    The text's shape code picks the layout, so each value is parsed once, from
    the digits themselves; layouts with other fields are tried one by one."""
    text = F.trim(_c(col))
    tried = [(f, layout_fields(f)) for f in (formats or vocab.DATETIME_FORMATS)]
    if any(fields is None for _, fields in tried):
        return F.coalesce(*[parse_strict(text, f) for f, _ in tried])
    by_shape: dict[str, list[Column]] = {}
    for _, (shape, at) in tried:
        by_shape.setdefault(shape, []).append(_built(text, at))
    code = F.translate(text, "0123456789", "9" * 10)
    picked = None
    for shape, ways in by_shape.items():
        way = ways[0] if len(ways) == 1 else F.coalesce(*ways)
        picked = F.when(code == shape, way) if picked is None else picked.when(code == shape, way)
    return picked


def parse_multi_format_date(col: Column | str, formats: list[str] | None = None) -> Column:
    return F.to_date(parse_multi_format_timestamp(col, formats))


def date_key(col: Column | str) -> Column:
    """Date or timestamp -> yyyyMMdd integer; null -> null."""
    return F.date_format(_c(col), "yyyyMMdd").try_cast("int")


def days_between(end: Column | str, start: Column | str) -> Column:
    """Calendar days from start to end, only when both are known."""
    e, s = _c(end), _c(start)
    return F.when(e.isNotNull() & s.isNotNull(), F.datediff(e, s))


def calendar_columns(date_col: str = "date") -> list[Column]:
    """Calendar attributes for a day column (ISO week, 1 = Sunday, English names)."""
    d = F.col(date_col)
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    ]
