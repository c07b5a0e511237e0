"""The layer store: one write per table and input, whole tables only."""

import os
import shutil

import pytest

from starloom.plans import inputs as I
from starloom.plans.star import STORED, Star, StoredStar, export
from starloom.sources import layer_store
from starloom.sources.layer_store import LayerStore, files_of

SF = "/root/testdata/sf0.001"


@pytest.fixture
def source(tmp_dir):
    at = os.path.join(tmp_dir, "sf")
    os.makedirs(at)
    for t in I.TABLES:
        shutil.copy(f"{SF}/{t}.parquet", at)
    return at


def test_a_layer_is_built_once_until_its_input_changes(spark, source, tmp_dir):
    built = []

    def build():
        built.append(1)
        return spark.range(5)
    make = lambda: LayerStore(spark, [I.table_path(source, t) for t in I.TABLES], os.path.join(tmp_dir, "store"))
    for _ in range(3):
        assert make().table("x", build).count() == 5
    assert len(built) == 1
    make().table("y", build)
    assert len(built) == 2
    os.utime(f"{source}/orders.parquet", (1, 1))
    make().table("x", build)
    assert len(built) == 3


def test_other_code_is_another_layer(spark, source, tmp_dir, monkeypatch):
    store = LayerStore(spark, [source], os.path.join(tmp_dir, "store"))
    old = store.path("x")
    monkeypatch.setattr(layer_store, "code_version", lambda: "other")
    assert store.path("x") != old


def test_a_failed_write_leaves_no_layer_and_the_first_writer_wins(spark, source, tmp_dir):
    store = LayerStore(spark, [source], os.path.join(tmp_dir, "store"))

    def fails():
        return spark.range(3).selectExpr("raise_error('lost') AS id")
    with pytest.raises(Exception):
        store.table("x", fails)
    assert not os.path.exists(store.path("x"))

    def slower():  # meanwhile another writer has put the table in place
        spark.range(7).write.parquet(store.path("x"))
        return spark.range(3)
    assert store.table("x", slower).count() == 7
    assert files_of(spark, [os.path.join(tmp_dir, "nowhere")]) == []


def test_stored_and_lazy_star_agree(spark, source):
    stored, lazy = StoredStar(spark, source), Star(spark, source)
    for name in [*STORED, "fact_entregas", "dim_cliente", "silver_items"]:
        a, b = export(getattr(stored, name)), export(getattr(lazy, name))
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    assert "parquet" in stored.fact_pedidos._jdf.queryExecution().executedPlan().toString().lower()


def test_spread_deals_a_source_and_keeps_pruning(spark, source):
    plain = I.table(spark, source, "orders")
    spread = I.table(spark, source, "orders", spread=6)
    assert spread.rdd.getNumPartitions() == 6 and spread.count() == plain.count()
    plan = spread.where("o_orderkey > 5").select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan and "GreaterThan(o_orderkey,5)" in plan
