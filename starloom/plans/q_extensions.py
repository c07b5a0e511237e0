"""Documented extensions (X1-X4), registered on import."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starloom.functions import vocab
from starloom.operators.expectations import REASONS, Expectation, evaluate, read_kept, read_quarantined, write_checked
from starloom.plans import oracle as O
from starloom.plans import silver as S
from starloom.plans.catalog import TABLE_COLUMNS, register
from starloom.plans.star import export, star_for
from starloom.session import scratch_root
from starloom.streaming.incremental import new_arrivals, upsert_latest
from starloom.streaming.snapshots import SnapshotTable

# X1 ------------------------------------------------------------------------
CUTOFF = "1999-01-01 00:00:00"


def order_rank():
    return [F.col("gross_amount").isNotNull().desc(), F.col("order_date").isNotNull().desc()]


def _x01(spark, sf_dir):
    """Target: everything stamped before the cutoff.  Increment: the rest, and
    rows that arrive late, undated or with a stamp the target has already."""
    clean = S.orders_clean(star_for(spark, sf_dir).raw_orders)
    stamp, cutoff = F.col("last_update"), F.lit(CUTOFF).cast("timestamp")
    old = stamp.isNull() | (stamp < cutoff)
    late = F.coalesce(F.crc32(F.col("order_id").cast("binary")) % 10 == 3, F.lit(False))
    arrived = clean.withColumn("_ingested_at", F.when(old & ~late, F.lit("2024-01-01").cast("timestamp"))
                               .otherwise(F.lit("2024-01-02").cast("timestamp")))
    mark = F.lit("2024-01-01").cast("timestamp")
    target = arrived.where(F.col("_ingested_at") <= mark).drop("_ingested_at")
    increment = new_arrivals(arrived, mark).drop("_ingested_at")
    return export(upsert_latest(target, increment, ["order_id"], "last_update", order_rank()))


_ORDER_TIE = ["customer_code", "seller_id", "status_order", "gross_amount", "discount_amount", "net_amount",
              "order_date", "promised_date", "last_update", "priority", "source", "net_amount_calculado"]
_ORDER_BY = ["last_update DESC NULLS LAST", "(gross_amount IS NOT NULL) DESC NULLS LAST",
             "(order_date IS NOT NULL) DESC NULLS LAST"]


def _x01_sql() -> str:
    # Whatever order rows arrive in, the table ends as if it had been built at once.
    merged = O.dedup("orders_clean", ["order_id"], _ORDER_BY, _ORDER_TIE)
    cols = [{"ts": f"strftime({name}, '{O.TS_OUT}') AS {name}",
             "date": f"strftime({name}, '%Y-%m-%d') AS {name}"}.get(kind, name)
            for name, kind in TABLE_COLUMNS["silver_orders"]]
    return O.with_ctes(["orders_clean"], f"SELECT {', '.join(cols)} FROM ({merged})")


register("x01_incremental_upsert", _x01, _x01_sql())


def _x05(spark, sf_dir):
    """The orders arrive as three increments, dealt by a digest of the whole
    row (so copies of an order arrive apart, late ones and broken ones too),
    and are merged into a partitioned table of snapshots one after the other.
    Every fifth order number has no partition value."""
    clean = S.orders_clean(star_for(spark, sf_dir).raw_orders)
    number = F.regexp_extract("order_id", "([0-9]+)$", 1).try_cast("long")
    dealt = clean.withColumn("part", F.when(number % 5 != 0, (number % 4).cast("string")))
    arrives = F.pmod(F.crc32(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in (
        "order_id", "last_update", "status_order", "net_amount"))).cast("binary")), F.lit(3))
    table = SnapshotTable(spark, f"{scratch_root(spark)}/snapshots-{uuid.uuid4().hex[:12]}", dealt.schema, ["order_id"], "last_update", "part",
                          order_rank())
    for k in range(3):
        table.merge(dealt.where(arrives == k))
    return export(table.read().drop("part"))


register("x05_incremental_snapshots", _x05, _x01_sql())

# X2 ------------------------------------------------------------------------
EXPECTATIONS = [
    Expectation("customer_not_null", "fact_pedidos", "not_null", {"column": "customer_id"}),
    Expectation("item_grain_unique", "fact_pedidos_itens", "unique", {"columns": ["order_id", "item_seq"]}),
    Expectation("ticket_customer_fk", "fact_ocorrencias", "references",
                {"column": "customer_id", "table": "dim_cliente", "to": "customer_id"}),
    Expectation("no_placeholder_customer", "fact_pedidos", "forbidden",
                {"column": "customer_id", "value": vocab.PLACEHOLDER_CUSTOMER}),
    Expectation("carrier_mode_vocabulary", "silver_deliveries", "vocabulary",
                {"column": "carrier_mode", "allowed": ["rodoviario", "aereo", vocab.NOT_INFORMED]}),
    Expectation("lead_time_not_negative", "fact_entregas", "row_condition",
                {"condition": "lead_time_dias IS NULL OR lead_time_dias >= 0"}),
]


def _x02(spark, sf_dir):
    s = star_for(spark, sf_dir)
    tables = {t: getattr(s, t) for t in {e.table for e in EXPECTATIONS} | {"dim_cliente"}}
    return export(evaluate(EXPECTATIONS, tables))


def _x02_sql() -> str:
    rows = [
        ("customer_not_null", "fact_pedidos", "(SELECT count(*) FILTER (WHERE customer_id IS NULL) FROM fact_pedidos)"),
        ("item_grain_unique", "fact_pedidos_itens",
         "(SELECT sum(n) - count(*) FROM (SELECT count(*) AS n FROM fact_pedidos_itens GROUP BY order_id, item_seq))"),
        ("ticket_customer_fk", "fact_ocorrencias",
         "(SELECT count(*) FROM fact_ocorrencias f WHERE NOT EXISTS (SELECT 1 FROM dim_cliente d WHERE d.customer_id = f.customer_id))"),
        ("no_placeholder_customer", "fact_pedidos",
         f"(SELECT count(*) FILTER (WHERE customer_id = '{vocab.PLACEHOLDER_CUSTOMER}') FROM fact_pedidos)"),
        ("carrier_mode_vocabulary", "silver_deliveries",
         f"(SELECT count(*) FROM (SELECT DISTINCT carrier_mode AS v FROM silver_deliveries) WHERE v IS NULL OR v NOT IN "
         f"('rodoviario', 'aereo', '{vocab.NOT_INFORMED}'))"),
        ("lead_time_not_negative", "fact_entregas",
         "(SELECT count(*) FILTER (WHERE NOT (lead_time_dias IS NULL OR lead_time_dias >= 0)) FROM fact_entregas)"),
    ]
    parts = [f"SELECT '{n}' AS check_name, '{t}' AS table_name, CAST({v} AS BIGINT) AS violations" for n, t, v in rows]
    return O.with_ctes(["fact_pedidos", "fact_pedidos_itens", "fact_ocorrencias", "dim_cliente", "silver_deliveries",
                        "fact_entregas"],
                       "SELECT *, violations = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")")


register("x02_declarative_expectations", _x02, _x02_sql())



def _x06(spark, sf_dir):
    """Expectations evaluated in the write itself: orders that fail one go
    aside with their reasons, in the same job."""
    path = f"{scratch_root(spark)}/checked-{uuid.uuid4().hex[:12]}"
    orders = star_for(spark, sf_dir).silver_orders
    counts = write_checked(orders, path, {"dated": F.col("order_date").isNotNull(), "priced": F.col("net_amount").isNotNull(),
                                          "sums_up": F.abs(F.col("net_amount") - F.col("net_amount_calculado")) <= 0.01})
    told = read_quarantined(spark, path).select(F.explode(REASONS).alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("orders"))
    kept = read_kept(spark, path).agg(F.count(F.lit(1)).alias("orders"))
    seen = {"dated": "failed:dated", "priced": "failed:priced", "sums_up": "failed:sums_up", "kept": "kept"}
    said = spark.createDataFrame([(name, counts[key]) for name, key in seen.items()], "outcome string, observed long")
    return told.unionByName(kept.select(F.lit("kept").alias("outcome"), "orders")).join(said, "outcome")


register("x06_checked_write", _x06, O.with_ctes(["silver_orders"], """
SELECT outcome, CAST(count(*) AS BIGINT) AS orders, CAST(count(*) AS BIGINT) AS observed FROM (
  SELECT unnest(CASE WHEN len(f) = 0 THEN ['kept'] ELSE f END) AS outcome FROM (
    SELECT list_filter([CASE WHEN order_date IS NULL THEN 'dated' END, CASE WHEN net_amount IS NULL THEN 'priced' END,
      CASE WHEN NOT coalesce(abs(net_amount - net_amount_calculado) <= 0.01, FALSE) THEN 'sums_up' END], lambda x: x IS NOT NULL) AS f
    FROM silver_orders)) GROUP BY outcome"""))


# X3 ------------------------------------------------------------------------
def _x03(spark, sf_dir):
    s = star_for(spark, sf_dir)
    e = s.fact_entregas.alias("e")
    o = s.silver_orders.select("order_id", "promised_date").alias("o")
    d = F.col("e.delivered_at")
    return export(e.join(o, F.col("e.order_ref") == F.col("o.order_id"), "left").select(
        F.col("e.delivery_id"), F.col("e.order_ref"), d.alias("delivered_at"), F.col("o.promised_date"),
        F.when(d.isNotNull() & F.col("o.promised_date").isNotNull(),
               F.to_date(d) > F.col("o.promised_date")).alias("is_atrasado_entrega")))


register("x03_delivery_late_flag", _x03, O.with_ctes(["fact_entregas", "silver_orders"], f"""
SELECT e.delivery_id, e.order_ref, strftime(e.delivered_at, '{O.TS_OUT}') AS delivered_at,
  strftime(o.promised_date, '%Y-%m-%d') AS promised_date,
  CASE WHEN e.delivered_at IS NOT NULL AND o.promised_date IS NOT NULL
       THEN CAST(e.delivered_at AS DATE) > o.promised_date END AS is_atrasado_entrega
FROM fact_entregas e LEFT JOIN silver_orders o ON e.order_ref = o.order_id"""))


# X4 ------------------------------------------------------------------------
def _x04(spark, sf_dir):
    s = star_for(spark, sf_dir)
    # 1:1 guard: a state maps to a region only if exactly one region carries it.
    uf = (s.dim_regiao.groupBy("state_uf")
          .agg(F.count(F.lit(1)).alias("_n"), F.min("regional_code").alias("regional_code"))
          .where(F.col("_n") == 1).drop("_n"))
    f = s.fact_entregas.select("delivery_id", "destination_state_uf")
    return export(f.join(uf, f["destination_state_uf"] == uf["state_uf"], "left")
                  .select("delivery_id", "destination_state_uf", "regional_code"))


register("x04_delivery_region", _x04, O.with_ctes(["fact_entregas", "dim_regiao"], """
SELECT f.delivery_id, f.destination_state_uf, u.regional_code
FROM fact_entregas f LEFT JOIN (SELECT state_uf, min(regional_code) AS regional_code FROM dim_regiao
                                GROUP BY state_uf HAVING count(*) = 1) u
  ON f.destination_state_uf = u.state_uf"""))
