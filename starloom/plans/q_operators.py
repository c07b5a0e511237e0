"""Operator-level queries (C, D, E families), registered on import.

Each isolates one column operator over whole raw tables and returns the
input beside the output, so a mismatch points at one operator.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import (
    date_key,
    fill_null,
    flag_text_to_bool,
    is_valid_email,
    mismatch,
    normalize_key,
    normalize_regional_code,
    normalize_state_to_uf,
    parse_br_decimal_to_double,
    parse_json_struct,
    parse_multi_format_date,
    parse_multi_format_timestamp,
    safe_cast_double,
    standardize_enum,
    standardize_lower,
    trim_or_default,
    vocab,
    yes_no_to_bool,
)
from starloom.plans import oracle as O
from starloom.plans.catalog import register
from starloom.plans.silver import PAYMENT_SCHEMA
from starloom.plans.star import Star, export, star_for

NI = vocab.NOT_INFORMED


def q(fn):
    def run(spark, sf_dir):
        return export(fn(star_for(spark, sf_dir)))
    return run


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


register("c01_normalize_key",
         q(lambda s: s.raw_customers.select(F.col("customer_id").alias("raw"),
                                            normalize_key("customer_id").alias("value"))),
         O.with_ctes(["raw_customers"], f"SELECT customer_id AS raw, {O.key('customer_id')} AS value FROM raw_customers"))

register("c02_standardize_lower",
         q(lambda s: s.raw_customers.select(F.col("status_cliente").alias("raw"),
                                            standardize_lower("status_cliente").alias("value"))),
         O.with_ctes(["raw_customers"],
                     f"SELECT status_cliente AS raw, {O.lower_std('status_cliente')} AS value FROM raw_customers"))

ENUM_SITES = [
    ("event_type", "raw_tickets", "event_type", vocab.EVENT_TYPE),
    ("order_status", "raw_orders", "status_order", vocab.ORDER_STATUS),
    ("carrier_mode", "raw_deliveries", "carrier.mode", vocab.CARRIER_MODE),
    ("delivery_status", "raw_deliveries", "delivery_status", vocab.DELIVERY_STATUS),
    ("channel_type", "raw_channels", "tipo_canal", vocab.CHANNEL_TYPE),
    ("customer_size", "raw_customers", "porte", vocab.CUSTOMER_SIZE),
]


def _c03(s: Star) -> DataFrame:
    return union([getattr(s, t).select(F.lit(v).alias("vocabulary"), F.col(c).alias("raw"),
                                       standardize_enum(F.col(c), m).alias("value"))
                  for v, t, c, m in ENUM_SITES])


def _flat_col(c: str) -> str:
    return {"carrier.mode": "carrier_mode"}.get(c, c)


register("c03_standardize_enum", q(_c03), O.with_ctes(
    sorted({t for _, t, _, _ in ENUM_SITES}),
    " UNION ALL ".join(f"SELECT '{v}' AS vocabulary, {_flat_col(c)} AS raw, {O.enum(_flat_col(c), m)} AS value FROM {t}"
                       for v, t, c, m in ENUM_SITES)))

STATE_SITES = [("raw_customers", "estado"), ("raw_deliveries", "destination.state"), ("raw_regions", "state")]
register("c04_state_to_uf",
         q(lambda s: union([getattr(s, t).select(F.lit(t).alias("source"), F.col(c).alias("raw"),
                                                 normalize_state_to_uf(F.col(c)).alias("value"))
                            for t, c in STATE_SITES])),
         O.with_ctes(["raw_customers", "raw_deliveries", "raw_regions"], " UNION ALL ".join(
             f"SELECT '{t}' AS source, {c} AS raw, {O.state_uf(c)} AS value FROM {t}"
             for t, c in [("raw_customers", "estado"), ("raw_deliveries", "dest_state"), ("raw_regions", "state")])))

register("c05_regional_code",
         q(lambda s: union([getattr(s, t).select(F.lit(t).alias("source"), F.col("regional_code").alias("raw"),
                                                 normalize_regional_code("regional_code").alias("value"))
                            for t in ["raw_sellers", "raw_regions"]])),
         O.with_ctes(["raw_sellers", "raw_regions"], " UNION ALL ".join(
             f"SELECT '{t}' AS source, regional_code AS raw, {O.regional('regional_code')} AS value FROM {t}"
             for t in ["raw_sellers", "raw_regions"])))

register("c06_text_to_bool",
         q(lambda s: s.raw_channels.select(F.lit("yes_no").alias("kind"), F.col("ativo").alias("raw"),
                                           yes_no_to_bool("ativo").alias("value"))
           .unionByName(s.raw_regions.select(F.lit("flag_1").alias("kind"), F.col("active_flag").alias("raw"),
                                             flag_text_to_bool("active_flag").alias("value")))),
         O.with_ctes(["raw_channels", "raw_regions"], """
SELECT 'yes_no' AS kind, ativo AS raw,
  CASE WHEN lower(trim(ativo)) = 'sim' THEN TRUE WHEN lower(trim(ativo)) = 'nao' THEN FALSE END AS value
FROM raw_channels
UNION ALL SELECT 'flag_1', active_flag, active_flag = '1' FROM raw_regions"""))

register("c07_null_fill_vs_default",
         q(lambda s: s.raw_customers.select(F.col("segmento").alias("raw"),
                                            trim_or_default("segmento").alias("trim_or_default"),
                                            standardize_lower("segmento").alias("lower_or_default"))),
         O.with_ctes(["raw_customers"], f"""
SELECT segmento AS raw, coalesce(trim(segmento), '{NI}') AS trim_or_default,
  {O.lower_std('segmento')} AS lower_or_default FROM raw_customers"""))

register("c08_email_valid",
         q(lambda s: s.raw_customers.select("email", is_valid_email("email").alias("is_valid"))),
         O.with_ctes(["raw_customers"], f"SELECT email, {O.email_ok('email')} AS is_valid FROM raw_customers"))


def _c09(s: Star) -> DataFrame:
    pay = parse_json_struct("payment_details", PAYMENT_SCHEMA)
    return s.raw_orders.select("payment_details", fill_null(pay.getField("priority"), NI).alias("priority"),
                               fill_null(pay.getField("source"), NI).alias("source"))


def _pj(f: str) -> str:
    return f"CASE WHEN json_valid(payment_details) THEN json_extract_string(payment_details, '$.{f}') END"


register("c09_json_fields", q(_c09), O.with_ctes(["raw_orders"], f"""
SELECT payment_details, coalesce({_pj('priority')}, '{NI}') AS priority,
  coalesce({_pj('source')}, '{NI}') AS source FROM raw_orders"""))

register("c10_text_predicates",
         q(lambda s: s.raw_sellers.select("seller_name",
                                          F.lower(F.col("seller_name")).contains("duplicado").alias("has_marker"))
           .unionByName(s.raw_regions.select(F.col("regional_name").alias("seller_name"),
                                             F.lower(F.col("regional_name")).startswith("região").alias("has_marker")))),
         O.with_ctes(["raw_sellers", "raw_regions"], """
SELECT seller_name, contains(lower(seller_name), 'duplicado') AS has_marker FROM raw_sellers
UNION ALL SELECT regional_name, starts_with(lower(regional_name), 'região') FROM raw_regions"""))

register("d01_parse_timestamp",
         q(lambda s: s.raw_orders.select(F.col("order_date").alias("raw"),
                                         parse_multi_format_timestamp("order_date").alias("value"))),
         O.with_ctes(["raw_orders"],
                     f"SELECT order_date AS raw, strftime({O.parse_ts('order_date')}, '{O.TS_OUT}') AS value FROM raw_orders"))

register("d02_parse_date",
         q(lambda s: s.raw_customers.select(F.col("data_cadastro").alias("raw"),
                                            parse_multi_format_date("data_cadastro").alias("value"))),
         O.with_ctes(["raw_customers"],
                     f"SELECT data_cadastro AS raw, strftime({O.parse_date('data_cadastro')}, '%Y-%m-%d') AS value FROM raw_customers"))

register("d03_date_key",
         q(lambda s: s.raw_tickets.select(F.col("created_at").alias("raw"),
                                          date_key(parse_multi_format_timestamp("created_at")).alias("value"))),
         O.with_ctes(["raw_tickets"],
                     f"SELECT created_at AS raw, {O.date_key(O.parse_ts('created_at'))} AS value FROM raw_tickets"))

register("d06_decimal_comma",
         q(lambda s: s.raw_orders.select(F.col("gross_amount").alias("raw"),
                                         parse_br_decimal_to_double("gross_amount").alias("value"))),
         O.with_ctes(["raw_orders"],
                     f"SELECT gross_amount AS raw, {O.br_decimal('gross_amount')} AS value FROM raw_orders"))

register("d07_safe_cast",
         q(lambda s: s.raw_items.select(F.lit("quantity").alias("source"), F.col("quantity").alias("raw"),
                                        safe_cast_double("quantity").alias("value"))
           .unionByName(s.raw_deliveries.select(F.lit("cost").alias("source"), F.col("cost").alias("raw"),
                                                safe_cast_double("cost").alias("value")))),
         O.with_ctes(["raw_items", "raw_deliveries"], f"""
SELECT 'quantity' AS source, quantity AS raw, {O.safe_double('quantity')} AS value FROM raw_items
UNION ALL SELECT 'cost', cost, {O.safe_double('cost')} FROM raw_deliveries"""))


def _d08(s: Star) -> DataFrame:
    it = s.raw_items.select(
        normalize_key("order_id").alias("order_id"), F.col("item_seq"),
        safe_cast_double("quantity").alias("quantity"), parse_br_decimal_to_double("unit_price").alias("unit_price"),
        safe_cast_double("total_item").alias("total_item"))
    it = it.withColumn("total_item_calculado", F.col("quantity") * F.col("unit_price"))
    return it.withColumn("mismatch", mismatch("total_item", "total_item_calculado"))


register("d08_reconcile", q(_d08), O.with_ctes(["raw_items"], f"""
SELECT *, abs(total_item - total_item_calculado) > 0.01 AS mismatch FROM (
  SELECT *, quantity * unit_price AS total_item_calculado FROM (
    SELECT {O.key('order_id')} AS order_id, item_seq, {O.safe_double('quantity')} AS quantity,
      {O.br_decimal('unit_price')} AS unit_price, {O.safe_double('total_item')} AS total_item FROM raw_items))"""))

FLAGGED = ["silver_products", "silver_customers", "silver_orders", "silver_items", "silver_deliveries",
           "silver_tickets"]


def _e01(s: Star) -> DataFrame:
    parts = [getattr(s, t).select(F.lit(t).alias("table_name"), F.explode("_dq_flags").alias("flag"))
             for t in FLAGGED]
    return union(parts).groupBy("table_name", "flag").agg(F.count(F.lit(1)).alias("n"))


register("e01_flag_counts", q(_e01), O.with_ctes(FLAGGED, " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, flag, count(*) AS n FROM (SELECT unnest(string_split(_dq_flags, '|')) AS flag "
    f"FROM {t} WHERE _dq_flags <> '') GROUP BY flag" for t in FLAGGED)))


# F: dedup isolated on the natural duplicates of lineitem ((orderkey, linenumber) is not unique)
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_TIE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus", "l_shipdate"]


def _f01(s: Star) -> DataFrame:
    from starloom.operators.dedup import dedup_keep_latest
    return dedup_keep_latest(s.table("lineitem"), LINE_KEYS, "l_shipdate")


def _f02(s: Star) -> DataFrame:
    from starloom.operators.dedup import dedup_by_rank
    returned = F.col("l_returnflag") == F.lit("R")  # marker row (returned line) loses
    return dedup_by_rank(s.table("lineitem"), LINE_KEYS, [returned.asc(), F.col("l_quantity").desc_nulls_last()])


def _line_sql(order: list[str]) -> str:
    cols = ", ".join(LINE_KEYS + LINE_TIE[:-1]) + f", strftime(l_shipdate, '{O.TS_OUT}') AS l_shipdate"
    return f"SELECT {cols} FROM ({O.dedup('lineitem', LINE_KEYS, order, LINE_TIE)})"


register("f01_dedup_latest", q(_f01), _line_sql(["l_shipdate DESC NULLS LAST"]))
register("f02_dedup_marker", q(_f02), _line_sql(["(l_returnflag = 'R') ASC NULLS FIRST",
                                                "l_quantity DESC NULLS LAST"]))
