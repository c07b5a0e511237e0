"""Survivor rules on hand-made duplicates (one per tie-break rule)."""

import contextlib
import io

from pyspark.sql import functions as F

from starloom.operators.dedup import dedup_by_rank
from starloom.plans import silver as S
from starloom.sources import readers as R


def _rows(df, key, value):
    return {r[0]: r[1] for r in df.select(key, value).collect()}


def test_latest_product_wins(spark):
    raw = spark.createDataFrame([
        {"product": {"product_id": "P0006", "name": "Produto 6", "category": "c", "subcategory": None,
                     "status": "ativo"}, "pricing": {"list_price": "10", "currency": "BRL"},
         "attributes": {"family": "f", "tags": ["a"]}, "updated_at": "2025-01-01 10:00:00"},
        {"product": {"product_id": "p0006 ", "name": "Produto 6 revisado", "category": "c", "subcategory": None,
                     "status": "ativo"}, "pricing": {"list_price": "N/A", "currency": "BRL"},
         "attributes": {"family": None, "tags": []}, "updated_at": "05/02/2025 10:00"},
    ], R.PRODUCTS_SCHEMA)
    out = S.silver_products(raw).collect()
    assert len(out) == 1 and out[0]["name"] == "Produto 6 revisado"
    assert list(out[0]["_dq_flags"]) == ["invalid_or_missing_list_price"]


def test_seller_marker_then_valid_channel(spark):
    channels = spark.createDataFrame([("CH02", "Canal 2", "direto", "sim", None)], R.CHANNELS_SCHEMA)
    raw = spark.createDataFrame([
        ("V004", "Vendedor 4", "CH99", "S", "2020-01-01", "ativo"),
        ("V004", "Vendedor 4", "ch02", "sul", "2020-01-01", "ativo"),
        ("V008", "Vendedor 8 duplicado", "CH02", "N", "2020-01-01", "ativo"),
        ("V008", "Vendedor 8", "CH99", "N", "2020-01-01", "ativo"),
    ], R.SELLERS_SCHEMA)
    out = S.silver_sellers(raw, channels)
    assert _rows(out, "seller_id", "canal_id") == {"V004": "CH02", "V008": "CH99"}
    assert _rows(out, "seller_id", "regional_code")["V004"] == "S"


def test_channel_marker_loses(spark):
    raw = spark.createDataFrame([
        ("CH05", "Canal 5 bis", "digital", "sim", "Duplicado conflitante"),
        ("ch05", "Canal 5", "Digital", "nao", None),
    ], R.CHANNELS_SCHEMA)
    out = S.silver_channels(raw).collect()
    assert len(out) == 1 and out[0]["observacao"] is None and out[0]["ativo"] is False


def test_customer_tie_prefers_valid_email(spark):
    raw = spark.createDataFrame([
        ("C0051", "Cliente 51", "x", "media", "c", "sp", "2024-01-01", "cliente51@", "ativo", "2025-01-01 10:00:00"),
        ("C0051", "Cliente 51", "x", "media", "c", "sp", "2024-01-01", "cliente51@empresa.com", "ativo",
         "2025-01-01 10:00:00"),
    ], R.CUSTOMERS_SCHEMA)
    out = S.silver_customers(raw).collect()
    assert len(out) == 1 and out[0]["email"] == "cliente51@empresa.com" and out[0]["porte"] == "Média"


def test_order_tie_prefers_complete_row(spark):
    raw = spark.createDataFrame([
        ("O00081", "C0001", "V001", "2025-03-01", "2025-03-10", "faturado", None, "0", "305,52",
         '{"priority": "alta", "source": "web"}', "2025-03-02 08:00:00"),
        ("O00081", "C0001", "V001", "2025-03-01", "2025-03-10", "faturado", "305,52", "0", "305,52",
         '{"priority": "alta"}', "2025-03-02 08:00:00"),
    ], R.ORDERS_SCHEMA)
    out = S.silver_orders(raw).collect()
    assert len(out) == 1 and out[0]["gross_amount"] == 305.52 and out[0]["source"] == "nao_informado"


def test_delivery_prefers_valid_date_then_valid_order(spark):
    orders = spark.createDataFrame([("O00250",) + (None,) * 10], R.ORDERS_SCHEMA)

    def d(did, ref, shipped):
        return {"delivery_id": did, "order_ref": ref, "delivery_status": "delivered", "cost": "10",
                "carrier": {"name": "X", "mode": "aereo"}, "timestamps": {"shipped_at": shipped, "delivered_at": None},
                "destination": {"state": "sp", "city": "c"}}
    raw = spark.createDataFrame([d("D00004", "O99999", "2025-01-01"), d("D00004", "o00250", "2025-01-01"),
                                 d("D00021", "O00250", "31/02/2025 10:00"), d("D00021", "O00250", "2025-02-03")],
                                R.DELIVERIES_SCHEMA)
    out = S.silver_deliveries(raw, orders)
    assert _rows(out, "delivery_id", "order_ref")["D00004"] == "O00250"
    assert _rows(out, "delivery_id", "shipped_at")["D00021"] is not None
    flags = {r[0]: list(r[1]) for r in S.silver_deliveries(raw, orders).select("delivery_id", "_dq_flags").collect()}
    assert flags == {"D00004": [], "D00021": []}


def test_item_prefers_known_product(spark):
    products = spark.createDataFrame([{"product": {"product_id": "P0047"}}], R.PRODUCTS_SCHEMA)
    raw = spark.createDataFrame([
        ("O00044", "3", "P8888", "2", "10,00", "20.00", "ativo"),
        ("O00044", "3", "P0047", "2", "10,00", "20.00", "ativo"),
    ], R.ITEMS_SCHEMA)
    out = S.silver_items(raw, products).collect()
    assert len(out) == 1 and out[0]["product_code"] == "P0047" and out[0]["item_seq"] == 3


def test_dedup_does_not_depend_on_partitioning(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("k"), (F.col("id") % 5).alias("r"),
                                     (F.col("id") * 7 % 11).alias("v"))
    a = dedup_by_rank(df.repartition(1), ["k"], [F.col("r").desc()]).collect()
    b = dedup_by_rank(df.repartition(7, "v"), ["k"], [F.col("r").desc()]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        dedup_by_rank(df, ["k"], [F.col("v").desc()]).explain()
    plan = buf.getvalue()
    # partial limit below the exchange, final limit above it
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
