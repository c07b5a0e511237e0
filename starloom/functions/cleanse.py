"""Column -> Column cleansing operators.

All are pure Catalyst expressions (no UDFs): they fold into one Project,
stay inside whole-stage codegen and never fail on dirty input under ANSI.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions import vocab


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lookup_map(mapping: Mapping[str, str]) -> Column:
    """Literal map column; constant-folded by the optimizer."""
    if not mapping:
        raise ValueError("empty mapping")
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def normalize_key(col: Column | str) -> Column:
    """Business key: trimmed and upper-cased; null stays null."""
    return F.upper(F.trim(_c(col)))


def _blank_to_default(cleaned: Column, default: str) -> Column:
    return F.when(cleaned.isNull() | (cleaned == F.lit("")), F.lit(default))


def standardize_lower(col: Column | str, default: str = vocab.NOT_INFORMED) -> Column:
    """lower(trim(x)); both null and blank become ``default``."""
    cleaned = F.lower(F.trim(_c(col)))
    return _blank_to_default(cleaned, default).otherwise(cleaned)


def standardize_enum(col: Column | str, mapping: Mapping[str, str],
                     default: str = vocab.NOT_INFORMED) -> Column:
    """Map a closed vocabulary.

    null/blank -> ``default``; mapped spelling -> canonical value; anything
    else is kept (lower-cased) so new categories stay visible.
    """
    cleaned = F.lower(F.trim(_c(col)))
    mapped = F.try_element_at(lookup_map(mapping), cleaned)
    return _blank_to_default(cleaned, default).otherwise(F.coalesce(mapped, cleaned))


def normalize_state_to_uf(col: Column | str) -> Column:
    """State spelling -> two-letter code; unmapped values kept upper-cased."""
    cleaned = F.lower(F.trim(_c(col)))
    return F.coalesce(F.try_element_at(lookup_map(vocab.STATE_TO_UF), cleaned), F.upper(cleaned))


def normalize_regional_code(col: Column | str) -> Column:
    """Key normalisation plus legacy alias resolution (``SUL`` -> ``S``)."""
    key = normalize_key(col)
    return F.coalesce(F.try_element_at(lookup_map(vocab.REGIONAL_CODE_ALIAS), key), key)


def yes_no_to_bool(col: Column | str, yes: str = "sim", no: str = "nao") -> Column:
    """'sim' -> true, 'nao' -> false, anything else (null included) -> null."""
    cleaned = F.lower(F.trim(_c(col)))
    return F.when(cleaned == F.lit(yes), F.lit(True)).when(cleaned == F.lit(no), F.lit(False))


def flag_text_to_bool(col: Column | str, true_value: str = "1") -> Column:
    """``x == '1'``; null stays null."""
    return _c(col) == F.lit(true_value)


def trim_or_default(col: Column | str, default: str = vocab.NOT_INFORMED) -> Column:
    """Null fill after trim.  Unlike :func:`standardize_lower`, blank stays blank."""
    return F.coalesce(F.trim(_c(col)), F.lit(default))


def fill_null(col: Column | str, default) -> Column:
    """Plain null fill (struct fields, keys already normalised)."""
    return F.coalesce(_c(col), F.lit(default))


def is_valid_email(col: Column | str) -> Column:
    """user@domain.tld shape; null -> null."""
    return _c(col).rlike(vocab.EMAIL_PATTERN)


def contains_ci(col: Column | str, marker: str) -> Column:
    """Case-insensitive substring test with null read as ''."""
    return F.lower(F.coalesce(_c(col), F.lit(""))).contains(marker.lower())


def parse_json_struct(col: Column | str, schema) -> Column:
    """JSON text -> struct; malformed text gives a struct of nulls, null -> null."""
    return F.from_json(_c(col), schema)


def safe_int(col: Column | str) -> Column:
    """Integer cast that yields null instead of failing under ANSI."""
    return F.trim(_c(col)).try_cast("int")
