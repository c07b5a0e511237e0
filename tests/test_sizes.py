"""What has to grow with the data, or stay bounded while it grows."""

import contextlib
import glob
import io
import json

from conftest import SF_SMALL
from pyspark.sql import functions as F

from starloom.functions import number_in
from starloom.operators import profile as L
from starloom.operators import reports as K
from starloom.operators.joins import missing_keys, with_key_exists, with_key_missing
from starloom.plans import q_sources
from starloom.plans import silver as S
from starloom.plans.star import Star
from starloom.sources import layers as B
from starloom.sources import readers as R
from starloom.sources import writers as W
from starloom.sources.layer_store import LayerStore


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(True)
    return buf.getvalue()


def test_settings_keep_tasks_small(spark):
    # F1-F4, F8-F12, F15-F17, F19
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_payment_text_is_parsed_once(spark):
    raw = spark.createDataFrame([("O1", '{"priority": "p", "source": "web"}'), ("O2", "not json"), ("O3", None)], "order_id string, payment_details string")
    raw = raw.select("order_id", "payment_details", *(F.lit(None).cast("string").alias(c) for c in R.ORDERS_SCHEMA.names if c not in raw.columns))
    clean = S.orders_clean(raw)
    assert plan_of(clean).split("== Optimized")[1].split("== Physical")[0].count("from_json(") == 1
    assert {(r["order_id"], r["priority"], r["source"]) for r in clean.collect()} == {
        ("O1", "p", "web"), ("O2", S.NI, S.NI), ("O3", S.NI, S.NI)}


def test_json_arrays_are_bounded(spark, tmp_dir):
    # a partition's documents in one file were read by one task.
    src = spark.range(0, 7, numPartitions=1).select(*(F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in R.CHANNELS_SCHEMA.names))
    W.write_json_array(src, f"{tmp_dir}/a", size=3)
    assert sorted(len(json.load(open(f))) for f in glob.glob(f"{tmp_dir}/a/part-*")) == [1, 3, 3]
    W.write_json_array(src.limit(6).repartition(1), f"{tmp_dir}/b", size=3)
    assert sorted(len(json.load(open(f))) for f in glob.glob(f"{tmp_dir}/b/part-*")) == [3, 3]
    assert sorted(R.read_json_array(spark, f"{tmp_dir}/a", R.CHANNELS_SCHEMA).collect()) == sorted(src.collect())


def test_ndjson_is_compressed_and_bounded(spark, tmp_dir, monkeypatch):
    # F14
    monkeypatch.setattr(W, "NDJSON_LINES", 4)
    src = spark.range(0, 10, numPartitions=1).select(*(F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in R.TICKETS_SCHEMA.names))
    W.write_ndjson(src, f"{tmp_dir}/n")
    assert len(glob.glob(f"{tmp_dir}/n/part-*.json.gz")) == 3
    assert sorted(R.read_ndjson(spark, f"{tmp_dir}/n", R.TICKETS_SCHEMA).collect()) == sorted(src.collect())


def test_buckets_grow_with_the_source(spark, tmp_dir):
    # F13
    with open(f"{tmp_dir}/lineitem.parquet", "wb") as f:
        f.truncate(21 << 20)
    assert q_sources.buckets_for(Star(spark, tmp_dir)) == 11
    assert q_sources.buckets_for(Star(spark, "/root/testdata/sf0.001")) == q_sources.BUCKETS


def test_cells_meet_stored_candidates_unshuffled(spark, tmp_dir):
    # F5
    df = spark.range(0, 500).select((F.col("id") % 7).cast("string").alias("a"), F.col("id").cast("string").alias("b"))
    L.column_profile({"t": df}).write.parquet(f"{tmp_dir}/profile")
    out = L.frequent_values({"t": df}, spark.read.parquet(f"{tmp_dir}/profile"))
    plan = plan_of(out)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {r["value"] for r in out.where("column_name = 'a' AND kind = 'value'").collect()} == {str(k) for k in range(7)}


def test_number_in_equals_the_plain_cast(spark):
    # F5, F6
    texts = ["1", " -2.5 ", "+.5", "5.", "1e3", "1E-3", ".", "", " ", "e3", "1e", "1d", "2F", "0x1p3", "inf", "-Infinity", "NaN", "nan", "+inf",
             "\t7\n", "\x007", "O123", "2024-01-01", "1,5", "1 2", "--1", "N/A", "٣", "1_0", "+nan", "in", "0x", "7L", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    got = df.select(number_in("x").cast("string").alias("a"), F.trim("x").try_cast("double").cast("string").alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]


def test_orphan_keys_hold_no_keys_before_the_shuffle(spark):
    # a distinct in front of the exchange held all keys of an unsplit file in one task.
    left = spark.createDataFrame([("a",), ("a",), ("b",), ("x",), ("x",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "d string")
    found = L.orphan_keys(left, F.col("k"), right, F.col("d"))
    assert [r[0] for r in found.collect()] == ["x"]
    assert plan_of(found).split("== Optimized")[1].split("== Physical")[0].count("Aggregate") == 1


def test_keys_found_missing_leave_wide_rows_in_place(spark, tmp_dir):
    # F12, F15-F17: the test of a key shuffled the whole table once more.
    df = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "a"), (5, "y"), (6, "x")], "id int, k string")
    keys = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "d string")
    missing_keys(df, F.col("k"), keys, F.col("d")).write.parquet(f"{tmp_dir}/m")
    missing = spark.read.parquet(f"{tmp_dir}/m")
    assert sorted(r[0] for r in missing.collect()) == ["x", "y"]
    tested = with_key_missing(df, "k", missing, "ok")
    assert sorted(tested.collect()) == sorted(with_key_exists(df, "k", keys, "d", "ok").collect())
    assert "BroadcastHashJoin" in plan_of(tested) and "SortMergeJoin" not in plan_of(tested)
    star = Star(spark, SF_SMALL)
    for name, build in (("products", lambda m: S.silver_items(star.raw_items, star.raw_products, m)),
                        ("orders", lambda m: S.silver_deliveries(star.raw_deliveries, star.raw_orders, m))):
        frames = (star.raw_items, star.raw_products) if name == "products" else (star.raw_deliveries, star.raw_orders)
        getattr(S, f"missing_{name}")(*frames).write.parquet(f"{tmp_dir}/{name}")
        got, want = build(spark.read.parquet(f"{tmp_dir}/{name}")), build(None)
        assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_layers_are_packed(spark, tmp_dir):
    # F12, F15-F17
    B.write_table(spark.range(3), tmp_dir, "silver", "t")
    assert glob.glob(f"{tmp_dir}/silver/t/*.zstd.parquet")
    LayerStore(spark, [], f"{tmp_dir}/store").table("t", lambda: spark.range(3))
    assert glob.glob(f"{tmp_dir}/store/t-*/*.zstd.parquet")


def test_items_meet_categories_before_they_are_summed(spark):
    # sums by customer and product moved nearly every item three times.
    items = spark.createDataFrame([("c1", "p1", 1.0), ("c1", "p2", 2.0), ("c2", "p1", 4.0), (None, "p9", 8.0), ("c9", None, 16.0)],
                                  "customer_id string, product_id string, total_item double")
    customers = spark.createDataFrame([("c1", "s"), ("c2", "s"), ("c2", "s"), (None, "n")], "customer_id string, segmento string")
    products = spark.createDataFrame([("p1", "a"), ("p2", "a"), ("p1", "b")], "product_id string, category string")
    out = K.item_customer_product(items, customers, products)
    assert {tuple(r) for r in out.collect()} == {("s", "a", 11.0, 4, 2), ("s", "b", 9.0, 3, 2), (None, None, 24.0, 2, 1)}
    physical = plan_of(out).split("== Physical")[1]
    assert "hashpartitioning(customer_id" in physical and "keys=[customer_id" in physical
    assert not [line for line in physical.splitlines() if "keys=[customer_id" in line and "product_id" in line.split("functions=")[0]]
