"""Registered queries: name -> (spark builder, DuckDB oracle SQL or None).

Every query reads the driver's whole tables (through the raw derivations of
``starloom.plans.inputs``) so its work grows with the data.  Results are
rendered with :func:`starloom.plans.star.export` so both engines produce the
same text for dates, timestamps and arrays.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.session import RUNTIME_CONF
from starloom.plans import oracle as O
from starloom.plans.star import export, star_for

QueryFn = Callable[[SparkSession, str], DataFrame]

# Output columns of each layer table: (name, kind) with kind ts/date/plain.
P, TS, D = "plain", "ts", "date"
TABLE_COLUMNS = {
    "silver_customers": [("customer_id", P), ("nome_cliente", P), ("segmento", P), ("porte", P),
                         ("cidade", P), ("estado_uf", P), ("data_cadastro", D), ("email", P),
                         ("status_cliente", P), ("updated_at", TS), ("_dq_flags", P)],
    "silver_products": [("product_id", P), ("name", P), ("category", P), ("subcategory", P),
                        ("status", P), ("currency", P), ("family", P), ("tags", P),
                        ("updated_at", TS), ("list_price", P), ("_dq_flags", P)],
    "silver_channels": [("id_canal", P), ("nome_canal", P), ("tipo_canal", P), ("ativo", P),
                        ("observacao", P)],
    "silver_regions": [("regional_code", P), ("regional_name", P), ("state_uf", P),
                       ("manager_name", P), ("active_flag", P)],
    "silver_sellers": [("seller_id", P), ("seller_name", P), ("canal_id", P), ("regional_code", P),
                       ("hire_date", D), ("status", P)],
    "silver_orders": [("order_id", P), ("customer_code", P), ("seller_id", P), ("status_order", P),
                      ("gross_amount", P), ("discount_amount", P), ("net_amount", P),
                      ("order_date", D), ("promised_date", D), ("last_update", TS), ("priority", P),
                      ("source", P), ("net_amount_calculado", P), ("_dq_flags", P)],
    "silver_items": [("order_id", P), ("item_seq", P), ("product_code", P), ("quantity", P),
                     ("unit_price", P), ("total_item", P), ("item_status", P),
                     ("total_item_calculado", P), ("_dq_flags", P)],
    "silver_deliveries": [("delivery_id", P), ("order_ref", P), ("carrier_name", P),
                          ("carrier_mode", P), ("delivery_status", P), ("destination_state_uf", P),
                          ("destination_city", P), ("cost", P), ("shipped_at", TS),
                          ("delivered_at", TS), ("_dq_flags", P)],
    "silver_tickets": [("ticket_id", P), ("order_id", P), ("customer_code", P), ("event_type", P),
                       ("severity", P), ("status", P), ("metadata", P), ("created_at", TS),
                       ("_dq_flags", P)],
    "dim_cliente": [("customer_id", P), ("nome_cliente", P), ("segmento", P), ("porte", P),
                    ("cidade", P), ("estado_uf", P), ("data_cadastro", D), ("email", P),
                    ("status_cliente", P)],
    "dim_produto": [(c, P) for c in ["product_id", "name", "category", "subcategory", "status",
                                     "list_price", "currency", "family"]],
    "dim_canal": [(c, P) for c in ["id_canal", "nome_canal", "tipo_canal", "ativo"]],
    "dim_regiao": [(c, P) for c in ["regional_code", "regional_name", "state_uf", "manager_name",
                                    "active_flag"]],
    "dim_vendedor": [("seller_id", P), ("seller_name", P), ("status", P), ("hire_date", D),
                     ("canal_id", P), ("canal_nome", P), ("canal_tipo", P), ("regional_code", P),
                     ("regional_name", P), ("regional_state_uf", P)],
    "dim_data": [("date_key", P), ("date", D), ("year", P), ("quarter", P), ("month", P),
                 ("month_name", P), ("week_of_year", P), ("day", P), ("day_of_week", P),
                 ("day_name", P), ("is_weekend", P)],
    "fact_pedidos": [("order_id", P), ("customer_id", P), ("seller_id", P), ("order_date_key", P),
                     ("order_date", D), ("promised_date", D), ("status_order", P), ("priority", P),
                     ("source", P), ("gross_amount", P), ("discount_amount", P), ("net_amount", P),
                     ("is_cancelado", P), ("delivered_at", TS), ("is_atrasado", P)],
    "fact_pedidos_itens": [(c, P) for c in ["order_id", "item_seq", "product_id", "customer_id",
                                            "seller_id", "order_date_key", "quantity", "unit_price",
                                            "total_item", "item_status"]],
    "fact_entregas": [("delivery_id", P), ("order_ref", P), ("carrier_name", P),
                      ("carrier_mode", P), ("delivery_status", P), ("shipped_at", TS),
                      ("delivered_at", TS), ("shipped_date_key", P), ("destination_state_uf", P),
                      ("destination_city", P), ("cost", P), ("lead_time_dias", P)],
    "fact_ocorrencias": [("ticket_id", P), ("order_id", P), ("customer_id", P), ("event_type", P),
                         ("severity", P), ("status", P), ("created_at", TS),
                         ("created_date_key", P), ("is_aberto", P)],
}


def _layer_query(attr: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return export(getattr(star_for(spark, sf_dir), attr))
    run.__name__ = attr
    return run


REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, fn: QueryFn, sql: str | None) -> None:
    if name in REGISTRY:
        raise ValueError(f"duplicate query {name}")
    REGISTRY[name] = (fn, sql)


for _t in ["customers", "products", "channels", "regions", "sellers", "orders", "items",
           "deliveries", "tickets"]:
    _cte = f"silver_{_t}"
    register(_cte, _layer_query(_cte), O.exported(_cte, TABLE_COLUMNS[_cte]))

for _t in ["dim_cliente", "dim_produto", "dim_canal", "dim_regiao", "dim_vendedor", "dim_data",
           "fact_pedidos", "fact_pedidos_itens", "fact_entregas", "fact_ocorrencias"]:
    register(f"gold_{_t}", _layer_query(_t), O.exported(_t, TABLE_COLUMNS[_t]))


def load_extra_modules() -> None:
    """Import query modules that register themselves (operators, reports,
    checks, profiles, sources)."""
    import starloom.plans.q_operators  # noqa: F401
    import starloom.plans.q_reports  # noqa: F401
    import starloom.plans.q_sources  # noqa: F401
    import starloom.plans.q_extensions  # noqa: F401


def _with_settings(fn: QueryFn) -> QueryFn:
    """The query with the library's settings applied to the session it gets."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for key, value in RUNTIME_CONF.items():
            spark.conf.set(key, value)
        return fn(spark, sf_dir)
    return run


def queries() -> dict[str, QueryFn]:
    load_extra_modules()
    return {k: _with_settings(v[0]) for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    load_extra_modules()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
