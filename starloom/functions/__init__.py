"""Column-level operators (cleansing, dates, numbers) and fixed vocabularies."""

from starloom.functions import vocab
from starloom.functions.cleanse import (
    contains_ci,
    fill_null,
    flag_text_to_bool,
    is_valid_email,
    lookup_map,
    normalize_key,
    normalize_regional_code,
    normalize_state_to_uf,
    parse_json_struct,
    safe_int,
    standardize_enum,
    standardize_lower,
    trim_or_default,
    yes_no_to_bool,
)
from starloom.functions.dates import (
    calendar_columns,
    date_key,
    days_between,
    parse_multi_format_date,
    parse_multi_format_timestamp,
    parse_strict,
)
from starloom.functions.numbers import mismatch, number_in, parse_br_decimal_to_double, safe_cast_double

__all__ = [
    "vocab", "contains_ci", "fill_null", "flag_text_to_bool", "is_valid_email", "lookup_map",
    "normalize_key", "normalize_regional_code", "normalize_state_to_uf", "parse_json_struct",
    "safe_int", "standardize_enum", "standardize_lower", "trim_or_default", "yes_no_to_bool",
    "calendar_columns", "date_key", "days_between", "parse_multi_format_date",
    "parse_multi_format_timestamp", "parse_strict", "mismatch", "number_in", "parse_br_decimal_to_double",
    "safe_cast_double",
]
