"""Inline unit cases for the column operators (literal rows, no files)."""

from pyspark.sql import functions as F

from starloom.functions import (
    flag_text_to_bool, is_valid_email, normalize_key, normalize_regional_code, normalize_state_to_uf,
    parse_br_decimal_to_double, parse_multi_format_date, parse_multi_format_timestamp, safe_cast_double,
    standardize_enum, standardize_lower, trim_or_default, vocab, yes_no_to_bool,
)
from starloom.functions.dates import layout_shape


def one_col(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    return [r[0] for r in df.select(fn(F.col("raw"))).collect()]


def test_invalid_dates_do_not_roll_over(spark):
    out = one_col(spark, ["2025-13-40", "31/02/2025 10:00", "2025-02-24", "21/01/2026 00:00"],
                  parse_multi_format_timestamp)
    assert out[0] is None and out[1] is None
    assert out[2] is not None and out[3] is not None


def test_each_layout_and_rejections(spark):
    vals = ["2025-02-24T10:11:12", "2025-02-24 10:11:12", "24/02/2025 10:11", "2025-02-24",
            "24/02/2025", "2025/02/24", " 2025-02-24 ", "1/2/2025", "2025/02/24 10:11", "", None, "x"]
    out = one_col(spark, vals, lambda c: F.date_format(parse_multi_format_timestamp(c), "yyyy-MM-dd HH:mm:ss"))
    assert out[:7] == ["2025-02-24 10:11:12", "2025-02-24 10:11:12", "2025-02-24 10:11:00",
                       "2025-02-24 00:00:00", "2025-02-24 00:00:00", "2025-02-24 00:00:00",
                       "2025-02-24 00:00:00"]
    assert out[7:] == [None] * 5


def test_parse_date(spark):
    out = one_col(spark, ["21/01/2026 23:59", "2024-02-29", "2023-02-29"],
                  lambda c: F.date_format(parse_multi_format_date(c), "yyyy-MM-dd"))
    assert out == ["2026-01-21", "2024-02-29", None]


def test_layout_shape():
    import re
    shape = layout_shape("yyyy-MM-dd'T'HH:mm:ss")
    assert re.match(shape, "2025-01-02T03:04:05") and not re.match(shape, "2025-1-02T03:04:05")


def test_decimal_parsing(spark):
    out = one_col(spark, ["1274,78", "1274.78", "-3", "1.274,78", ".5", "1e3", "N/A", None, " 12 "],
                  parse_br_decimal_to_double)
    assert out == [1274.78, 1274.78, -3.0, None, None, None, None, None, 12.0]


def test_safe_cast_sentinels(spark):
    out = one_col(spark, ["N/A", "unknown", "NULL", "", "  ", None, "10,5"], safe_cast_double)
    assert out == [None, None, None, None, None, None, 10.5]


def test_standardize_lower_and_enum(spark):
    assert one_col(spark, [" Ativo", "", None, "X"], standardize_lower) == ["ativo", vocab.NOT_INFORMED,
                                                                          vocab.NOT_INFORMED, "x"]
    out = one_col(spark, ["Em Separacao", "ENTREGUE", "devolvido", " ", None],
                  lambda c: standardize_enum(c, vocab.ORDER_STATUS))
    assert out == ["em_separacao", "entregue", "devolvido", vocab.NOT_INFORMED, vocab.NOT_INFORMED]
    assert one_col(spark, ["atrasado", "Troca"], lambda c: standardize_enum(c, vocab.DELIVERY_STATUS)) == \
        ["delayed", "troca"]


def test_null_fill_keeps_blank(spark):
    assert one_col(spark, ["", None, " a "], trim_or_default) == ["", vocab.NOT_INFORMED, "a"]


def test_states_and_regions(spark):
    assert one_col(spark, ["Sta Catarina", "sao paulo", "São Paulo", "Tocantins", None],
                   normalize_state_to_uf) == ["SC", "SP", "SP", "TOCANTINS", None]
    assert one_col(spark, ["sul", " s ", "Ne", None], normalize_regional_code) == ["S", "S", "NE", None]
    assert one_col(spark, [" p0006 ", None], normalize_key) == ["P0006", None]


def test_booleans_and_email(spark):
    assert one_col(spark, ["Sim", "NAO", "talvez", None], yes_no_to_bool) == [True, False, None, None]
    assert one_col(spark, ["1", "0", None], flag_text_to_bool) == [True, False, None]
    assert one_col(spark, ["a@b.com", "a@b", "a b@c.d", None], is_valid_email) == [True, False, False, None]


def test_calendar_month_edges(spark):
    import datetime as dt

    from starloom.operators.modeling import calendar_dimension
    a = spark.createDataFrame([(dt.date(2024, 1, 30),), (None,)], "d date")
    b = spark.createDataFrame([(dt.datetime(2024, 3, 2, 23, 0),)], "t timestamp")
    cal = calendar_dimension([(a, "d"), (b, "t")]).collect()
    days = sorted(r["date"] for r in cal)
    assert len(days) == len(set(days)) == 33
    assert days[0] == dt.date(2024, 1, 30) and days[-1] == dt.date(2024, 3, 2)
    feb29 = [r for r in cal if r["date"] == dt.date(2024, 2, 29)][0]
    assert feb29["date_key"] == 20240229 and feb29["day_name"] == "Thursday" and feb29["day_of_week"] == 5
    one = calendar_dimension([(spark.createDataFrame([(dt.date(2025, 5, 31),)], "d date"), "d")]).collect()
    assert [r["date"] for r in one] == [dt.date(2025, 5, 31)]


def test_partition_sizing():
    from starloom.session import shuffle_partitions_for
    assert shuffle_partitions_for(100 * 2**40) == 409600          # 100 TiB at 256 MiB
    assert shuffle_partitions_for(10 * 2**20) == 200               # floor for small inputs
