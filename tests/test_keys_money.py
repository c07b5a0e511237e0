"""Keys beyond their padded width, amounts beyond cents, joins nobody reads."""

import contextlib
import io

from conftest import SF_SMALL
from pyspark.sql import functions as F

from starloom.operators import reports as K
from starloom.plans import inputs as I
from starloom.plans.catalog import queries
from starloom.sources import readers as R
from starloom.sources.writers import write_delimited


def test_long_keys_stay_distinct(spark):
    for prefix, width in (("C", 6), ("P", 5), ("V", 4), ("O", 7), ("CH", 2)):
        keys = [1, 10 ** (width - 1), 10 ** width - 1, 10 ** width, 10 ** width + 1, 10 ** (width + 1), 12345678901]
        df = spark.createDataFrame([(k,) for k in keys], "k long")
        codes = [r[0] for r in df.select(I._code(prefix, F.col("k"), width)).collect()]
        assert len(set(codes)) == len(set(keys))
        assert codes[0] == prefix + "1".zfill(width) and codes[-1] == prefix + "12345678901"
        for marker in (I.NO_PRODUCT, I.NO_ORDER):
            assert marker not in codes and not marker[1:].isdigit()


def test_money_neither_aborts_nor_rounds(spark):
    rows = [("a", 10.005), ("a", 10.005), ("b", 99999999999999999999.0), ("c", 1e40), ("c", float("nan")), ("c", None), ("c", 1.0)]
    df = spark.createDataFrame(rows, "g string, net_amount double")
    got = {r["g"]: r["receita"] for r in df.groupBy("g").agg(K.money_sum("net_amount").alias("receita")).collect()}
    assert got == {"a": 20.01, "b": 1e20, "c": 1.0}
    assert K.rejected_amounts(df, "net_amount").collect()[0].asDict() == {"qtd_rejeitados": 2, "qtd_valores": 6}


def _optimized(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_unread_customer_test_costs_nothing(spark):
    for name in ("k01_kpis", "k02_cancellation_rate", "k03_late_rate", "k04_revenue_by_region", "k07_monthly_revenue"):
        plan = _optimized(queries()[name](spark, SF_SMALL))
        assert "customer.parquet" not in plan, name


def test_no_round_robin_in_fact_plans(spark):
    for name in ("gold_fact_pedidos", "gold_fact_pedidos_itens", "gold_dim_data", "v05_unique_grain", "x01_incremental_upsert"):
        assert "RoundRobin" not in _optimized(queries()[name](spark, SF_SMALL)), name


def test_header_names_decide(spark, tmp_dir):
    rows = spark.createDataFrame([("P1", "1", "O1")], "product_code string, item_seq string, order_id string")
    write_delimited(rows, f"{tmp_dir}/x.csv", ",")
    back = R.read_delimited(spark, f"{tmp_dir}/x.csv", R.ITEMS_SCHEMA).first()
    assert (back["order_id"], back["item_seq"], back["product_code"], back["quantity"]) == ("O1", "1", "P1", None)


def test_malformed_line_keeps_its_text(spark, tmp_dir):
    with open(f"{tmp_dir}/t.ndjson", "w") as f:
        f.write('{"ticket_id": "T1"}\n{"ticket_id": "T2", broken\n')
    rows = R.read_ndjson(spark, f"{tmp_dir}/t.ndjson", R.TICKETS_SCHEMA, keep_corrupt=True).cache().collect()
    assert [(r["ticket_id"], r[R.CORRUPT]) for r in rows] == [("T1", None), (None, '{"ticket_id": "T2", broken')]
