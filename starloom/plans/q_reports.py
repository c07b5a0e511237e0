"""Report (K), check (V) and profile (L) queries, registered on import."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import normalize_key, parse_multi_format_timestamp, vocab
from starloom.operators import checks as V
from starloom.operators import profile as L
from starloom.operators import reports as K
from starloom.operators.suite import Suite, distinct_keys, rows
from starloom.plans import oracle as O
from starloom.plans import silver as S
from starloom.plans.inputs import NO_PRODUCT
from starloom.plans.catalog import register
from starloom.plans.star import Star, export, star_for


def cif(cond: str) -> str:
    """BIGINT conditional count in DuckDB."""
    return f"count(*) FILTER (WHERE {cond})"


def msum(col: str) -> str:
    return f"CAST(sum(TRY_CAST({col} AS DECIMAL(38,6))) AS DOUBLE)"


def dratio(num: str, den: str, scale: str = "1.0") -> str:
    return f"(CAST({num} AS DOUBLE) * {scale} / nullif(CAST({den} AS DOUBLE), 0))"


def q(fn):
    """Adapt ``fn(star)`` to the (spark, sf_dir) query signature."""
    def run(spark, sf_dir):
        return export(fn(star_for(spark, sf_dir)))
    return run


# ------------------------------------------------------------------ K reports

register("k01_kpis", q(lambda s: K.kpis(s.fact_pedidos)), O.with_ctes(["fact_pedidos"], f"""
SELECT {msum('net_amount')} AS receita_liquida, count(*) AS qtd_pedidos,
  {dratio("sum(TRY_CAST(net_amount AS DECIMAL(38,6)))", "count(TRY_CAST(net_amount AS DECIMAL(38,6)))")} AS ticket_medio,
  {dratio("sum(CAST(is_cancelado AS INTEGER))", "count(*)", "100.0")} AS pct_cancelado
FROM fact_pedidos"""))

register("k02_cancellation_rate", q(lambda s: K.cancellation_rate(s.fact_pedidos)),
         O.with_ctes(["fact_pedidos"], f"""
SELECT {cif('is_cancelado')} AS qtd_cancelados, count(*) AS qtd_pedidos,
  {dratio(cif('is_cancelado'), 'count(*)', '100.0')} AS pct_cancelado FROM fact_pedidos"""))

register("k03_late_rate", q(lambda s: K.late_rate(s.fact_pedidos)), O.with_ctes(["fact_pedidos"], f"""
SELECT count(is_atrasado) AS qtd_rastreados, {cif('is_atrasado')} AS qtd_atrasados,
  {dratio(cif('is_atrasado'), 'count(is_atrasado)', '100.0')} AS pct_atrasado FROM fact_pedidos"""))

register("k04_revenue_by_region",
         q(lambda s: K.revenue_by(s.fact_pedidos, s.dim_vendedor, "seller_id", ["regional_name"])),
         O.with_ctes(["fact_pedidos", "dim_vendedor"], f"""
SELECT v.regional_name, {msum('f.net_amount')} AS receita, count(*) AS qtd_pedidos
FROM fact_pedidos f LEFT JOIN dim_vendedor v USING (seller_id) GROUP BY v.regional_name"""))

register("k05_revenue_by_channel",
         q(lambda s: K.revenue_by(s.fact_pedidos, s.dim_vendedor, "seller_id", ["canal_nome"])),
         O.with_ctes(["fact_pedidos", "dim_vendedor"], f"""
SELECT v.canal_nome, {msum('f.net_amount')} AS receita, count(*) AS qtd_pedidos
FROM fact_pedidos f LEFT JOIN dim_vendedor v USING (seller_id) GROUP BY v.canal_nome"""))

register("k06_revenue_by_category",
         q(lambda s: K.revenue_by(s.fact_pedidos_itens, s.dim_produto, "product_id", ["category"],
                                  amount="total_item", count_name="qtd_itens")),
         O.with_ctes(["fact_pedidos_itens", "dim_produto"], f"""
SELECT d.category, {msum('f.total_item')} AS receita, count(*) AS qtd_itens
FROM fact_pedidos_itens f LEFT JOIN dim_produto d USING (product_id) GROUP BY d.category"""))

register("k07_monthly_revenue", q(lambda s: K.monthly_revenue(s.fact_pedidos, s.dim_data)),
         O.with_ctes(["fact_pedidos", "dim_data"], f"""
SELECT d.year, d.month, {msum('f.net_amount')} AS receita, count(*) AS qtd_pedidos
FROM fact_pedidos f LEFT JOIN dim_data d ON f.order_date_key = d.date_key GROUP BY d.year, d.month"""))

register("k08_lead_time_by_carrier", q(lambda s: K.lead_time_by_carrier(s.fact_entregas)),
         O.with_ctes(["fact_entregas"], """
SELECT carrier_name, carrier_mode, avg(lead_time_dias) AS lead_time_medio, count(*) AS qtd_entregas
FROM fact_entregas WHERE lead_time_dias IS NOT NULL GROUP BY carrier_name, carrier_mode"""))

register("k09_item_customer_product",
         q(lambda s: K.item_customer_product(s.fact_pedidos_itens, s.dim_cliente, s.dim_produto)),
         O.with_ctes(["fact_pedidos_itens", "dim_cliente", "dim_produto"], f"""
SELECT c.segmento, p.category, {msum('f.total_item')} AS receita, count(*) AS qtd_itens,
  count(DISTINCT f.customer_id) AS qtd_clientes
FROM fact_pedidos_itens f LEFT JOIN dim_cliente c USING (customer_id)
LEFT JOIN dim_produto p USING (product_id) GROUP BY c.segmento, p.category"""))

register("k10_segment_kpis", q(lambda s: K.segment_kpis(s.fact_pedidos, s.dim_cliente)),
         O.with_ctes(["fact_pedidos", "dim_cliente"], f"""
SELECT c.segmento, count(*) AS qtd_pedidos, {msum('f.net_amount')} AS receita,
  {dratio(cif('f.is_atrasado'), 'count(f.is_atrasado)', '100.0')} AS pct_atrasado,
  {dratio(cif('f.is_cancelado'), 'count(*)', '100.0')} AS pct_cancelado
FROM fact_pedidos f LEFT JOIN dim_cliente c USING (customer_id) GROUP BY c.segmento"""))


register("k11_rejected_amounts", q(lambda s: K.rejected_amounts(s.fact_pedidos, "net_amount")),
         O.with_ctes(["fact_pedidos"], f"""
SELECT {cif('net_amount IS NOT NULL AND TRY_CAST(net_amount AS DECIMAL(38,6)) IS NULL')} AS qtd_rejeitados,
  count(net_amount) AS qtd_valores FROM fact_pedidos"""))


# ------------------------------------------------------------------ V checks

def _v01(s: Star):
    """Silver rows against the distinct keys of the source, in one pass over each table."""
    key = normalize_key
    sources = {
        "customers": (s.raw_customers, [key("customer_id")]), "products": (s.raw_products, [key(F.col("product.product_id"))]),
        "orders": (s.raw_orders, [key("order_id")]), "sellers": (s.raw_sellers, [key("seller_id")]),
        "channels": (s.raw_channels, [key("id_canal")]), "regions": (s.raw_regions, [S.normalize_regional_code("regional_code")]),
        "items": (s.raw_items, [key("order_id"), F.trim("item_seq").try_cast("int")]), "deliveries": (s.raw_deliveries, [F.col("delivery_id")])}
    suite = Suite({f"raw_{t}": df for t, (df, _) in sources.items()} | {f"silver_{t}": getattr(s, f"silver_{t}") for t in [*sources, "tickets"]}
                  | {"raw_tickets": s.raw_tickets})
    for t, (_, columns) in sources.items():
        suite.same_count("rows_equal_distinct_keys", f"silver_{t}", suite.measure(f"raw_{t}", "keys", distinct_keys(*columns)))
    suite.same_count("rows_equal_raw_rows", "silver_tickets", suite.measure("raw_tickets", "rows", rows()))
    return suite.run()


def _dc(src: str, exprs: str) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT {exprs} FROM {src}))"


def _v01_sql() -> str:
    rows = [
        ("rows_equal_distinct_keys", "silver_customers", _dc("raw_customers", O.key("customer_id"))),
        ("rows_equal_distinct_keys", "silver_products", _dc("raw_products", O.key("product_id"))),
        ("rows_equal_distinct_keys", "silver_orders", _dc("raw_orders", O.key("order_id"))),
        ("rows_equal_distinct_keys", "silver_sellers", _dc("raw_sellers", O.key("seller_id"))),
        ("rows_equal_distinct_keys", "silver_channels", _dc("raw_channels", O.key("id_canal"))),
        ("rows_equal_distinct_keys", "silver_regions", _dc("raw_regions", O.regional("regional_code"))),
        ("rows_equal_distinct_keys", "silver_items",
         _dc("raw_items", f"{O.key('order_id')}, TRY_CAST(trim(item_seq) AS INTEGER)")),
        ("rows_equal_distinct_keys", "silver_deliveries", _dc("raw_deliveries", "delivery_id")),
        ("rows_equal_raw_rows", "silver_tickets", "(SELECT count(*) FROM raw_tickets)"),
    ]
    return _suite_sql(rows, lambda t: f"(SELECT count(*) FROM {t})")


def _suite_sql(rows, actual_of) -> str:
    parts = [f"SELECT '{n}' AS check_name, '{t}' AS table_name, "
             f"CAST(abs({actual_of(t)} - {e}) AS BIGINT) AS violations" for n, t, e in rows]
    return "SELECT *, violations = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


def _checks_sql(rows: list[tuple[str, str, str]]) -> str:
    """rows: (check_name, table_name, scalar SQL giving violations)."""
    parts = [f"SELECT '{n}' AS check_name, '{t}' AS table_name, CAST({v} AS BIGINT) AS violations"
             for n, t, v in rows]
    return "SELECT *, violations = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


register("v01_row_counts", q(_v01), O.with_ctes(
    ["raw_customers", "raw_products", "raw_orders", "raw_sellers", "raw_channels", "raw_regions",
     "raw_items", "raw_deliveries", "raw_tickets", "silver_customers", "silver_products",
     "silver_orders", "silver_sellers", "silver_channels", "silver_regions", "silver_items",
     "silver_deliveries", "silver_tickets"], _v01_sql()))

def _over(s: Star, tables: str, *checks) -> DataFrame:
    """A suite over the named tables; each check is (kind, arguments)."""
    suite = Suite({t: getattr(s, t) for t in tables.split()})
    for kind, *args in checks:
        getattr(suite, kind)(*args)
    return suite.run()


register("v02_not_null_keys", q(lambda s: _over(
    s, "fact_pedidos fact_pedidos_itens fact_ocorrencias",
    ("no_rows", "customer_id_not_null", "fact_pedidos", F.col("customer_id").isNull()),
    ("no_rows", "product_id_not_null", "fact_pedidos_itens", F.col("product_id").isNull()),
    ("no_rows", "customer_id_not_null", "fact_ocorrencias", F.col("customer_id").isNull()),
)), O.with_ctes(["fact_pedidos", "fact_pedidos_itens", "fact_ocorrencias"], _checks_sql([
    ("customer_id_not_null", "fact_pedidos", f"(SELECT {cif('customer_id IS NULL')} FROM fact_pedidos)"),
    ("product_id_not_null", "fact_pedidos_itens", f"(SELECT {cif('product_id IS NULL')} FROM fact_pedidos_itens)"),
    ("customer_id_not_null", "fact_ocorrencias", f"(SELECT {cif('customer_id IS NULL')} FROM fact_ocorrencias)"),
])))


def _anti(src: str, col: str, dim: str, dim_col: str) -> str:
    return (f"(SELECT count(*) FROM {src} f WHERE NOT EXISTS "
            f"(SELECT 1 FROM {dim} d WHERE d.{dim_col} = f.{col}))")


register("v03_referential_integrity", q(lambda s: _over(
    s, "fact_pedidos fact_pedidos_itens fact_ocorrencias",
    ("references", "customer_fk", "fact_pedidos", "customer_id", s.dim_cliente, "customer_id"),
    ("references", "product_fk", "fact_pedidos_itens", "product_id", s.dim_produto, "product_id"),
    ("references", "customer_fk", "fact_ocorrencias", "customer_id", s.dim_cliente, "customer_id"),
)), O.with_ctes(["fact_pedidos", "fact_pedidos_itens", "fact_ocorrencias", "dim_cliente", "dim_produto"],
                 _checks_sql([
    ("customer_fk", "fact_pedidos", _anti("fact_pedidos", "customer_id", "dim_cliente", "customer_id")),
    ("product_fk", "fact_pedidos_itens", _anti("fact_pedidos_itens", "product_id", "dim_produto", "product_id")),
    ("customer_fk", "fact_ocorrencias", _anti("fact_ocorrencias", "customer_id", "dim_cliente", "customer_id")),
])))

register("v04_forbidden_values", q(lambda s: _over(
    s, "fact_pedidos fact_pedidos_itens",
    ("no_rows", "placeholder_customer_resolved", "fact_pedidos", F.col("customer_id") == vocab.PLACEHOLDER_CUSTOMER),
    ("no_rows", "orphan_product_resolved", "fact_pedidos_itens", F.col("product_id") == NO_PRODUCT),
)), O.with_ctes(["fact_pedidos", "fact_pedidos_itens"], _checks_sql([
    ("placeholder_customer_resolved", "fact_pedidos",
     f"(SELECT {cif(chr(39).join(['customer_id = ', vocab.PLACEHOLDER_CUSTOMER, '']))} FROM fact_pedidos)"),
    ("orphan_product_resolved", "fact_pedidos_itens",
     f"(SELECT {cif(chr(39).join(['product_id = ', 'PX99999', '']))} FROM fact_pedidos_itens)"),
])))

register("v05_unique_grain", q(lambda s: _over(
    s, "fact_pedidos fact_pedidos_itens fact_entregas",
    ("unique", "unique_grain", "fact_pedidos", ["order_id"]),
    ("unique", "unique_grain", "fact_pedidos_itens", ["order_id", "item_seq"]),
    ("unique", "unique_grain", "fact_entregas", ["delivery_id"]),
)), O.with_ctes(["fact_pedidos", "fact_pedidos_itens", "fact_entregas"], _checks_sql([
    ("unique_grain", "fact_pedidos", f"abs((SELECT count(*) FROM fact_pedidos) - {_dc('fact_pedidos', 'order_id')})"),
    ("unique_grain", "fact_pedidos_itens",
     f"abs((SELECT count(*) FROM fact_pedidos_itens) - {_dc('fact_pedidos_itens', 'order_id, item_seq')})"),
    ("unique_grain", "fact_entregas", f"abs((SELECT count(*) FROM fact_entregas) - {_dc('fact_entregas', 'delivery_id')})"),
])))

STATUS_ALLOWED = ["faturado", "em_separacao", "entregue", "cancelado", vocab.NOT_INFORMED]
MODE_ALLOWED = ["rodoviario", "aereo", vocab.NOT_INFORMED]
DELIVERY_ALLOWED = ["in_transit", "delivered", "cancelled", "delayed", vocab.NOT_INFORMED]


def _vocab_sql(src: str, col: str, allowed: list[str]) -> str:
    vals = ", ".join(O.lit(a) for a in allowed)
    return f"(SELECT count(*) FROM (SELECT DISTINCT {col} AS v FROM {src}) WHERE v IS NULL OR v NOT IN ({vals}))"


register("v06_closed_vocabulary", q(lambda s: _over(
    s, "silver_orders silver_deliveries",
    ("vocabulary", "status_order_vocabulary", "silver_orders", "status_order", STATUS_ALLOWED),
    ("vocabulary", "carrier_mode_vocabulary", "silver_deliveries", "carrier_mode", MODE_ALLOWED),
    ("vocabulary", "delivery_status_vocabulary", "silver_deliveries", "delivery_status", DELIVERY_ALLOWED),
)), O.with_ctes(["silver_orders", "silver_deliveries"], _checks_sql([
    ("status_order_vocabulary", "silver_orders", _vocab_sql("silver_orders", "status_order", STATUS_ALLOWED)),
    ("carrier_mode_vocabulary", "silver_deliveries", _vocab_sql("silver_deliveries", "carrier_mode", MODE_ALLOWED)),
    ("delivery_status_vocabulary", "silver_deliveries",
     _vocab_sql("silver_deliveries", "delivery_status", DELIVERY_ALLOWED)),
])))


def _survivor_sql(clean: str, silver: str, key: str, col: str) -> str:
    return (f"(SELECT {cif(f'l._latest IS NOT NULL AND (s.{col} IS NULL OR s.{col} < l._latest)')} "
            f"FROM {silver} s JOIN (SELECT {key}, max({col}) AS _latest FROM {clean} GROUP BY {key}) l "
            f"USING ({key}))")


register("v07_survivor_is_latest", q(lambda s: V.run_checks([
    ("survivor_latest_updated_at", "silver_customers",
     V.survivor_is_latest(S.customers_clean(s.raw_customers), s.silver_customers, ["customer_id"], "updated_at")),
    ("survivor_latest_updated_at", "silver_products",
     V.survivor_is_latest(S.products_clean(s.raw_products), s.silver_products, ["product_id"], "updated_at")),
    ("survivor_latest_last_update", "silver_orders",
     V.survivor_is_latest(S.orders_clean(s.raw_orders), s.silver_orders, ["order_id"], "last_update")),
])), O.with_ctes(["customers_clean", "silver_customers", "products_clean", "silver_products",
                  "orders_clean", "silver_orders"], _checks_sql([
    ("survivor_latest_updated_at", "silver_customers",
     _survivor_sql("customers_clean", "silver_customers", "customer_id", "updated_at")),
    ("survivor_latest_updated_at", "silver_products",
     _survivor_sql("products_clean", "silver_products", "product_id", "updated_at")),
    ("survivor_latest_last_update", "silver_orders",
     _survivor_sql("orders_clean", "silver_orders", "order_id", "last_update")),
])))

def _v07b(s: Star):
    email = F.col("email").rlike(vocab.EMAIL_PATTERN)
    return V.run_checks([
        ("marked_copy_lost", "silver_channels", s.silver_channels.agg(
            F.count_if(F.lower(F.coalesce("observacao", F.lit(""))).contains("duplicado")).alias("violations"))),
        ("marked_copy_lost", "silver_sellers", s.silver_sellers.agg(
            F.count_if(F.lower("seller_name").contains("duplicado")).alias("violations"))),
        ("valid_fk_preferred", "silver_sellers", V.survivor_has(
            s.raw_sellers.select(normalize_key("seller_id").alias("seller_id"), ~F.lower("seller_name").contains("duplicado")
                                 & ~F.coalesce(normalize_key("canal_id"), F.lit("")).isin("CH98", "CH99", "")),
            s.silver_sellers.select("seller_id", ~F.col("canal_id").isin("CH98", "CH99", vocab.NOT_INFORMED)))),
        ("email_tie_broken", "silver_customers", V.survivor_has(
            V.at_latest(S.customers_clean(s.raw_customers), ["customer_id"], "updated_at").select("customer_id", email),
            s.silver_customers.select("customer_id", email))),
        ("complete_row_preferred", "silver_orders", V.survivor_has(
            V.at_latest(S.orders_clean(s.raw_orders), ["order_id"], "last_update").select(
                "order_id", F.col("gross_amount").isNotNull()),
            s.silver_orders.select("order_id", F.col("gross_amount").isNotNull()))),
        ("valid_date_preferred", "silver_deliveries", V.survivor_has(
            s.raw_deliveries.select("delivery_id", parse_multi_format_timestamp("timestamps.shipped_at").isNotNull()),
            s.silver_deliveries.select("delivery_id", F.col("shipped_at").isNotNull()))),
    ])


def _has_sql(copies: str, kept: str) -> str:
    return (f"(SELECT {cif('c.ok AND NOT coalesce(s.ok, FALSE)')} FROM (SELECT k, bool_or(ok) AS ok FROM ({copies}) "
            f"GROUP BY k) c JOIN ({kept}) s USING (k))")


def _latest_sql(clean: str, key: str, stamp: str, ok: str) -> str:
    return (f"SELECT {key} AS k, {ok} AS ok FROM (SELECT *, max({stamp}) OVER (PARTITION BY {key}) AS top FROM {clean}) "
            f"WHERE {stamp} IS NOT DISTINCT FROM top")


register("v07b_survivor_rules", q(_v07b), O.with_ctes(
    ["silver_channels", "silver_sellers", "raw_sellers", "customers_clean", "silver_customers", "orders_clean",
     "silver_orders", "raw_deliveries", "silver_deliveries"], _checks_sql([
        ("marked_copy_lost", "silver_channels",
         f"(SELECT {cif('contains(lower(coalesce(observacao, {0}{0})), {0}duplicado{0})'.format(chr(39)))} FROM silver_channels)"),
        ("marked_copy_lost", "silver_sellers",
         f"(SELECT {cif('contains(lower(seller_name), {0}duplicado{0})'.format(chr(39)))} FROM silver_sellers)"),
        ("valid_fk_preferred", "silver_sellers", _has_sql(
            f"SELECT {O.key('seller_id')} AS k, NOT contains(lower(seller_name), 'duplicado') AND "
            f"coalesce({O.key('canal_id')}, '') NOT IN ('CH98', 'CH99', '') AS ok FROM raw_sellers",
            f"SELECT seller_id AS k, canal_id NOT IN ('CH98', 'CH99', '{vocab.NOT_INFORMED}') AS ok FROM silver_sellers")),
        ("email_tie_broken", "silver_customers", _has_sql(
            _latest_sql("customers_clean", "customer_id", "updated_at", O.email_ok("email")),
            f"SELECT customer_id AS k, {O.email_ok('email')} AS ok FROM silver_customers")),
        ("complete_row_preferred", "silver_orders", _has_sql(
            _latest_sql("orders_clean", "order_id", "last_update", "gross_amount IS NOT NULL"),
            "SELECT order_id AS k, gross_amount IS NOT NULL AS ok FROM silver_orders")),
        ("valid_date_preferred", "silver_deliveries", _has_sql(
            f"SELECT delivery_id AS k, {O.parse_ts('shipped_at')} IS NOT NULL AS ok FROM raw_deliveries",
            "SELECT delivery_id AS k, shipped_at IS NOT NULL AS ok FROM silver_deliveries")),
    ])))


register("v04b_unknown_members", q(lambda s: s.fact_pedidos.agg(
    F.count_if(F.col("customer_id") == vocab.UNKNOWN_CUSTOMER).alias("pedidos_cliente_desconhecido")).withColumn(
    "itens_produto_desconhecido", s.fact_pedidos_itens.agg(
        F.count_if(F.col("product_id") == vocab.UNKNOWN_PRODUCT)).scalar())),
    O.with_ctes(["fact_pedidos", "fact_pedidos_itens"], f"""
SELECT (SELECT {cif(f"customer_id = '{vocab.UNKNOWN_CUSTOMER}'")} FROM fact_pedidos) AS pedidos_cliente_desconhecido,
  (SELECT {cif(f"product_id = '{vocab.UNKNOWN_PRODUCT}'")} FROM fact_pedidos_itens) AS itens_produto_desconhecido"""))

BAD_DATES = ["2025-13-40", "31/02/2025 10:00"]


def _v08(s: Star):
    def bad_parsed(df, col):
        c = F.col(col)
        return df.agg(F.count_if(F.trim(c).isin(*BAD_DATES) & parse_multi_format_timestamp(c).isNotNull())
                      .alias("violations"))
    return V.run_checks([
        ("invalid_dates_rejected", "raw_orders", bad_parsed(s.raw_orders, "order_date")),
        ("invalid_dates_rejected", "raw_customers", bad_parsed(s.raw_customers, "data_cadastro")),
        ("invalid_dates_rejected", "raw_deliveries",
         bad_parsed(s.raw_deliveries.select(F.col("timestamps.shipped_at").alias("shipped_at")), "shipped_at")),
    ])


def _bad_dates_sql(src: str, col: str) -> str:
    vals = ", ".join(O.lit(b) for b in BAD_DATES)
    return f"(SELECT {cif(f'trim({col}) IN ({vals}) AND {O.parse_ts(col)} IS NOT NULL')} FROM {src})"


register("v08_invalid_date_rejection", q(_v08), O.with_ctes(
    ["raw_orders", "raw_customers", "raw_deliveries"], _checks_sql([
        ("invalid_dates_rejected", "raw_orders", _bad_dates_sql("raw_orders", "order_date")),
        ("invalid_dates_rejected", "raw_customers", _bad_dates_sql("raw_customers", "data_cadastro")),
        ("invalid_dates_rejected", "raw_deliveries", _bad_dates_sql("raw_deliveries", "shipped_at")),
    ])))


def _v09(s: Star):
    """One aggregate over the fact gives all three figures."""
    k = K.kpis(s.fact_pedidos)
    return V.predicates_hold(k, "fact_pedidos", {
        "net_revenue_positive": F.col("receita_liquida") > 0, "average_ticket_positive": F.col("ticket_medio") > 0,
        "cancellation_pct_in_range": F.col("pct_cancelado").between(0, 100)})


def _kpi_sql(pred: str) -> str:
    return (f"(SELECT CASE WHEN {pred} THEN 0 ELSE 1 END FROM (SELECT {msum('net_amount')} AS r, "
            f"{dratio('sum(TRY_CAST(net_amount AS DECIMAL(38,6)))', 'count(TRY_CAST(net_amount AS DECIMAL(38,6)))')} AS t, "
            f"{dratio('sum(CAST(is_cancelado AS INTEGER))', 'count(*)', '100.0')} AS c FROM fact_pedidos))")


register("v09_kpi_ranges", q(_v09), O.with_ctes(["fact_pedidos"], _checks_sql([
    ("net_revenue_positive", "fact_pedidos", _kpi_sql("r > 0")),
    ("average_ticket_positive", "fact_pedidos", _kpi_sql("t > 0")),
    ("cancellation_pct_in_range", "fact_pedidos", _kpi_sql("c BETWEEN 0 AND 100")),
])))


# ------------------------------------------------------------------ L profiles

RAW_WIDTH = {"raw_customers": 10, "raw_products": 4, "raw_channels": 5, "raw_regions": 5,
             "raw_sellers": 6, "raw_orders": 11, "raw_items": 7, "raw_deliveries": 7, "raw_tickets": 8}

register("l01_table_sizes", q(lambda s: L.table_sizes({n: getattr(s, n) for n in RAW_WIDTH})),
         O.with_ctes(list(RAW_WIDTH), " UNION ALL ".join(
             f"SELECT '{n}' AS table_name, count(*) AS n_rows, {w} AS n_columns FROM {n}"
             for n, w in RAW_WIDTH.items())))

CUSTOMER_RAW_COLS = ["customer_id", "nome_cliente", "segmento", "porte", "cidade", "estado",
                     "data_cadastro", "email", "status_cliente", "updated_at"]
ORDER_RAW_COLS = ["order_id", "customer_code", "seller_id", "order_date", "promised_date", "status_order",
                  "gross_amount", "discount_amount", "net_amount", "payment_details", "last_update"]
#: Columns of every raw table (nested ones flattened) -> their name in the oracle.
PROFILED = {t: dict(zip(cs, cs)) for t, cs in {
    "raw_customers": CUSTOMER_RAW_COLS, "raw_orders": ORDER_RAW_COLS,
    "raw_items": ["order_id", "item_seq", "product_code", "quantity", "unit_price", "total_item", "item_status"],
    "raw_regions": ["regional_code", "regional_name", "state", "manager_name", "active_flag"],
    "raw_sellers": ["seller_id", "seller_name", "canal_id", "regional_code", "hire_date", "status"],
    "raw_channels": ["id_canal", "nome_canal", "tipo_canal", "ativo", "observacao"],
    "raw_tickets": ["ticket_id", "order_id", "customer_code", "event_type", "severity", "status", "created_at", "metadata"]}.items()} | {
    "raw_products": {"attributes_family": "family", "attributes_tags": "tags", "pricing_currency": "currency",
                     "pricing_list_price": "list_price", "product_category": "category", "product_name": "name",
                     "product_product_id": "product_id", "product_status": "status", "product_subcategory": "subcategory",
                     "updated_at": "updated_at"},
    "raw_deliveries": {"carrier_mode": "carrier_mode", "carrier_name": "carrier_name", "cost": "cost", "delivery_id": "delivery_id",
                       "delivery_status": "delivery_status", "destination_city": "dest_city", "destination_state": "dest_state",
                       "order_ref": "order_ref", "timestamps_delivered_at": "delivered_at", "timestamps_shipped_at": "shipped_at"}}


def _profile_sql(table: str, name: str, col: str) -> str:
    v, num = col, f"TRY_CAST(trim({col}) AS DOUBLE)"
    return (f"SELECT '{table}' AS table_name, '{name}' AS column_name, count(*) AS n_rows, {cif(f'{v} IS NULL')} AS n_null, "
            f"{cif(f'trim({v}) = {O.lit(str())}')} AS n_blank, {cif(f'upper({v}) <> {v}')} AS n_case_variants, count({num}) AS n_numeric, "
            f"{cif(f'contains({v}, {O.lit(chr(44))})')} AS n_comma, {cif(f'{num} < 0')} AS n_negative, {cif(f'{num} = 0')} AS n_zero, "
            f"CAST(min(length({v})) AS INTEGER) AS shortest, CAST(max(length({v})) AS INTEGER) AS longest FROM {table}")


def _frequent_sql(table: str, name: str, col: str) -> str:
    kinds = {"value": col, "shape": f"translate({col}, '0123456789', '9999999999')"}
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS kind, {v} AS value, count(*) AS n FROM {table} "
        f"GROUP BY 4 HAVING count(*) >= (SELECT count(*) FROM {table}) * {L.FREQUENT}" for kind, v in kinds.items())


def _every_column(sql) -> str:
    return O.with_ctes(list(PROFILED), " UNION ALL ".join(sql(t, n, c) for t, cs in PROFILED.items() for n, c in cs.items()))


def _raw(s: Star) -> dict:
    return {t: getattr(s, t) for t in PROFILED}


register("l15_column_profile", q(lambda s: L.column_profile(_raw(s)).drop("values", "shapes")), _every_column(_profile_sql))
register("l16_frequent_values", q(lambda s: L.frequent_values(_raw(s), s.store.table("column_profile", lambda: L.column_profile(_raw(s))))), _every_column(_frequent_sql))
register("l02b_null_blank_counts_all", q(lambda s: L.column_profile(_raw(s)).select("table_name", "column_name", "n_null", "n_blank")),
         _every_column(lambda t, n, c: f"SELECT '{t}' AS table_name, '{n}' AS column_name, {cif(f'{c} IS NULL')} AS n_null, "
                       f"{cif(f'trim({c}) = {O.lit(str())}')} AS n_blank FROM {t}"))
register("l02_null_blank_counts", q(lambda s: L.null_blank_counts(s.raw_customers, "raw_customers")),
         O.with_ctes(["raw_customers"], " UNION ALL ".join(
             f"SELECT 'raw_customers' AS table_name, '{c}' AS column_name, {cif(f'{c} IS NULL')} AS n_null, "
             f"{cif(f'trim({c}) = {chr(39)}{chr(39)}')} AS n_blank FROM raw_customers" for c in CUSTOMER_RAW_COLS)))

register("l03_value_counts", q(lambda s: L.value_counts(s.raw_sellers, "status")),
         O.with_ctes(["raw_sellers"], "SELECT status AS value, count(*) AS n FROM raw_sellers GROUP BY status"))


def _l04(s: Star):
    parts = [(s.raw_customers, "raw_customers", "customer_id"), (s.raw_orders, "raw_orders", "order_id"),
             (s.raw_items, "raw_items", "product_code")]
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), [
        df.agg(L.case_variant_count(df, c).alias("n_case_variants"))
          .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "n_case_variants")
        for df, t, c in parts])


register("l04_case_variants", q(_l04), O.with_ctes(["raw_customers", "raw_orders", "raw_items"], " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {cif(f'upper({c}) <> {c}')} AS n_case_variants FROM {t}"
    for t, c in [("raw_customers", "customer_id"), ("raw_orders", "order_id"), ("raw_items", "product_code")])))

register("l05_duplicate_keys",
         q(lambda s: L.duplicate_rows(s.raw_customers, F.upper(F.trim("customer_id")))
           .select("customer_id", "dup_key", "n_copies", "nome_cliente", "updated_at")),
         O.with_ctes(["raw_customers"], """
SELECT r.customer_id, r.dup_key, c.n_copies, r.nome_cliente, r.updated_at
FROM (SELECT *, upper(trim(customer_id)) AS dup_key FROM raw_customers) r
JOIN (SELECT upper(trim(customer_id)) AS dup_key, count(*) AS n_copies FROM raw_customers
      GROUP BY 1 HAVING count(*) > 1) c USING (dup_key)"""))


# L5 on the key as it is: copies that differ in case or blanks are other keys, null is one.
register("l05b_duplicate_raw_keys",
         q(lambda s: L.duplicate_rows(s.raw_deliveries.select("order_ref", "delivery_id", "cost"), F.col("order_ref"))
           .select("order_ref", "delivery_id", "n_copies", "cost")),
         O.with_ctes(["raw_deliveries"], """
SELECT r.order_ref, r.delivery_id, c.n_copies, r.cost FROM raw_deliveries r
JOIN (SELECT order_ref, count(*) AS n_copies FROM raw_deliveries GROUP BY 1 HAVING count(*) > 1) c
  ON r.order_ref IS NOT DISTINCT FROM c.order_ref"""))


def _l06(s: Star):
    return (L.numeric_issues(s.raw_orders, "gross_amount")
            .select(F.lit("raw_orders").alias("table_name"), F.lit("gross_amount").alias("column_name"), "*")
            .unionByName(L.numeric_issues(s.raw_items, "quantity")
                         .select(F.lit("raw_items").alias("table_name"), F.lit("quantity").alias("column_name"), "*")))


def _l06_sql(t: str, c: str) -> str:
    num = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
            f"{cif(f'{c} IS NOT NULL AND {num} IS NULL')} AS n_non_numeric, "
            f"{cif(f'contains({c}, {chr(39)},{chr(39)})')} AS n_comma_decimal, {cif(f'{num} < 0')} AS n_negative, {cif(f'{num} = 0')} AS n_zero FROM {t}")


register("l06_numeric_issues", q(_l06), O.with_ctes(["raw_orders", "raw_items"],
                                                    _l06_sql("raw_orders", "gross_amount") + " UNION ALL " +
                                                    _l06_sql("raw_items", "quantity")))


def _l07(s: Star):
    a = L.orphan_keys(s.raw_items, normalize_key("product_code"), s.raw_products,
                      normalize_key(F.col("product.product_id"))).select(
        F.lit("items.product_code->products").alias("relation"), "orphan_key")
    b = L.orphan_keys(s.raw_deliveries, normalize_key("order_ref"), s.raw_orders,
                      normalize_key("order_id")).select(F.lit("deliveries.order_ref->orders").alias("relation"),
                                                        "orphan_key")
    c = L.orphan_keys(s.raw_items, normalize_key("order_id"), s.raw_orders, normalize_key("order_id")).select(
        F.lit("items.order_id->orders").alias("relation"), "orphan_key")
    d = L.orphan_keys(s.raw_tickets, normalize_key("order_id"), s.raw_orders, normalize_key("order_id")).select(
        F.lit("tickets.order_id->orders").alias("relation"), "orphan_key")
    e = L.orphan_keys(s.raw_orders, normalize_key("customer_code"), s.raw_customers, normalize_key("customer_id")).select(
        F.lit("orders.customer_code->customers").alias("relation"), "orphan_key")
    return a.unionByName(b).unionByName(c).unionByName(d).unionByName(e)


def _orphans_sql(relation: str, src: str, col: str, dim: str, dim_col: str) -> str:
    return f"""SELECT '{relation}' AS relation, k AS orphan_key FROM (
  SELECT DISTINCT {O.key(col)} AS k FROM {src} WHERE {O.key(col)} IS NOT NULL EXCEPT SELECT {O.key(dim_col)} FROM {dim})"""


register("l07_orphan_keys", q(_l07), O.with_ctes(["raw_items", "raw_products", "raw_deliveries", "raw_orders",
                                                  "raw_tickets", "raw_customers"], f"""
{_orphans_sql("items.order_id->orders", "raw_items", "order_id", "raw_orders", "order_id")} UNION ALL
{_orphans_sql("tickets.order_id->orders", "raw_tickets", "order_id", "raw_orders", "order_id")} UNION ALL
{_orphans_sql("orders.customer_code->customers", "raw_orders", "customer_code", "raw_customers", "customer_id")} UNION ALL
SELECT 'items.product_code->products' AS relation, k AS orphan_key FROM (
  SELECT DISTINCT {O.key('product_code')} AS k FROM raw_items WHERE {O.key('product_code')} IS NOT NULL
  EXCEPT SELECT {O.key('product_id')} FROM raw_products)
UNION ALL
SELECT 'deliveries.order_ref->orders', k FROM (
  SELECT DISTINCT {O.key('order_ref')} AS k FROM raw_deliveries WHERE {O.key('order_ref')} IS NOT NULL
  EXCEPT SELECT {O.key('order_id')} FROM raw_orders)"""))

# The profiler's looser e-mail shape (blanks allowed).
PROFILE_EMAIL = r"^[^@]+@[^@]+\.[^@]+$"
register("l08_pattern_mismatch", q(lambda s: L.pattern_mismatch(s.raw_customers, "email", PROFILE_EMAIL, True)),
         O.with_ctes(["raw_customers"], f"""
SELECT email AS value, count(*) AS n FROM raw_customers
WHERE email IS NULL OR NOT regexp_matches(email, '{PROFILE_EMAIL}') GROUP BY email"""))

# L8, second half: codes that don't have their key's shape (a letter and digits).
CODE_SHAPE = r"^P[0-9]{5,}$"
register("l08b_code_shape", q(lambda s: L.pattern_mismatch(s.raw_items, "product_code", CODE_SHAPE, True)),
         O.with_ctes(["raw_items"], f"""
SELECT product_code AS value, count(*) AS n FROM raw_items
WHERE product_code IS NULL OR NOT regexp_matches(product_code, '{CODE_SHAPE}') GROUP BY product_code"""))

register("l09_distinct_values", q(lambda s: s.raw_sellers.select(F.col("status").alias("value")).distinct()),
         O.with_ctes(["raw_sellers"], "SELECT DISTINCT status AS value FROM raw_sellers"))

register("l10_format_shapes", q(lambda s: L.format_shapes(s.raw_orders, "order_date")),
         O.with_ctes(["raw_orders"], """
SELECT regexp_replace(order_date, '[0-9]', '9', 'g') AS shape, count(*) AS n FROM raw_orders GROUP BY 1"""))


def _l11(s: Star):
    o = s.raw_orders.agg(
        F.count_if(F.col("customer_code") == vocab.PLACEHOLDER_CUSTOMER).alias("n_placeholder_customer"),
        F.count_if(F.col("order_date").contains("2025-13-40")).alias("n_invalid_month"))
    d = s.raw_deliveries.agg(F.count_if(F.col("timestamps.shipped_at").contains("31/02/2025")))
    return o.withColumn("n_feb_31_shipped", d.scalar())


register("l11_value_occurrence", q(_l11), O.with_ctes(["raw_orders", "raw_deliveries"], f"""
SELECT o.*, d.* FROM (SELECT {cif(f"customer_code = '{vocab.PLACEHOLDER_CUSTOMER}'")} AS n_placeholder_customer,
  {cif("contains(order_date, '2025-13-40')")} AS n_invalid_month FROM raw_orders) o,
 (SELECT {cif("contains(shipped_at, '31/02/2025')")} AS n_feb_31_shipped FROM raw_deliveries) d"""))

register("l12_first_offenders",
         q(lambda s: L.first_n(s.raw_orders,
                               F.col("gross_amount").isNotNull() & F.trim("gross_amount").try_cast("double").isNull(),
                               [F.col(c).asc_nulls_first() for c in ORDER_RAW_COLS], 10)),
         O.with_ctes(["raw_orders"], f"""
SELECT {', '.join(ORDER_RAW_COLS)} FROM raw_orders
WHERE gross_amount IS NOT NULL AND TRY_CAST(trim(gross_amount) AS DOUBLE) IS NULL
ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in ORDER_RAW_COLS)} LIMIT 10"""))

register("l13_flatten_nested", q(lambda s: L.flatten(s.raw_deliveries)), O.with_ctes(["raw_deliveries"], """
SELECT delivery_id, order_ref, delivery_status, cost, carrier_name AS carrier_name, carrier_mode AS carrier_mode,
  shipped_at AS timestamps_shipped_at, delivered_at AS timestamps_delivered_at,
  dest_state AS destination_state, dest_city AS destination_city FROM raw_deliveries"""))


def _l06b(s: Star):
    return (L.numeric_issues(s.raw_orders, "gross_amount", null_is_bad=True)
            .select(F.lit("raw_orders").alias("table_name"), F.lit("gross_amount").alias("column_name"), "*")
            .unionByName(L.numeric_issues(s.raw_items, "quantity", null_is_bad=True)
                         .select(F.lit("raw_items").alias("table_name"), F.lit("quantity").alias("column_name"), "*")))


def _l06b_sql(t: str, c: str) -> str:
    num = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
            f"{cif(f'{num} IS NULL')} AS n_non_numeric, "
            f"{cif(f'contains({c}, {chr(39)},{chr(39)})')} AS n_comma_decimal, {cif(f'{num} < 0')} AS n_negative, {cif(f'{num} = 0')} AS n_zero FROM {t}")


# L6 with the other convention: a missing value counts as non-numeric.
register("l06b_numeric_issues_null_as_bad", q(_l06b), O.with_ctes(
    ["raw_orders", "raw_items"], _l06b_sql("raw_orders", "gross_amount") + " UNION ALL " + _l06b_sql("raw_items", "quantity")))


def _l14(s: Star):
    # L5 on a composite key: order id compared case-insensitively, plus item sequence and product code.
    key = F.struct(F.upper(F.col("order_id")).alias("o"), F.col("item_seq").alias("i"), F.col("product_code").alias("p"))
    dups = L.duplicate_rows(s.raw_items, key, "dup_key")
    return dups.select("order_id", "item_seq", "product_code", "quantity", "n_copies")


register("l14_duplicate_composite_keys", q(_l14), O.with_ctes(["raw_items"], """
SELECT r.order_id, r.item_seq, r.product_code, r.quantity, c.n_copies
FROM raw_items r JOIN (SELECT upper(order_id) AS o, item_seq AS i, product_code AS p, count(*) AS n_copies
                       FROM raw_items GROUP BY 1, 2, 3 HAVING count(*) > 1) c
  ON upper(r.order_id) = c.o AND r.item_seq = c.i AND r.product_code = c.p"""))


# L12, second form: the first ten distinct case variants of a key, in sorted order.
register("l12b_first_distinct_case_variants",
         q(lambda s: s.raw_items.where(F.upper(F.col("order_id")) != F.col("order_id"))
           .select("order_id").distinct().orderBy("order_id").limit(10)),
         O.with_ctes(["raw_items"], """
SELECT DISTINCT order_id FROM raw_items WHERE upper(order_id) <> order_id
ORDER BY order_id LIMIT 10"""))
