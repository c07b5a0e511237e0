"""Source/sink round trips (A1-A8, B1-B5), registered on import.

Each query writes one derived raw source in its native format to a fresh
folder under the session's checkpoint directory (the shared folder the
cluster names), reads it back with the declared schema through the
readers in ``starloom.sources``, and runs the silver builder on it.  The
result must equal the silver table built straight from the derivation, so
the oracle is the silver table's oracle.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_root
from starloom.streaming.incremental import ingest_stream
from starloom.sources import layers as B
from starloom.sources import readers as R
from starloom.sources.layer_store import files_of
from starloom.sources.writers import write_delimited, write_json_array, write_ndjson
from starloom.sources.workbook import read_workbooks, write_workbooks
from starloom.plans import oracle as O
from starloom.plans import silver as S
from starloom.plans.inputs import table_path
from starloom.plans.catalog import TABLE_COLUMNS, register
from starloom.plans.star import export, star_for


def scratch(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _silver_oracle(name: str) -> str:
    return O.exported(name, TABLE_COLUMNS[name])


def _orders_csv(spark, sf_dir):
    st = star_for(spark, sf_dir)
    path = scratch(spark, "orders-csv")
    write_delimited(st.raw_orders, path, ";")
    back = R.read_delimited(spark, path, R.ORDERS_SCHEMA, sep=";")
    return export(S.silver_orders(back))


def _items_csv(spark, sf_dir):
    st = star_for(spark, sf_dir)
    path = scratch(spark, "items-csv")
    write_delimited(st.raw_items, path, ",")
    back = R.read_delimited(spark, path, R.ITEMS_SCHEMA, sep=",")
    return export(S.silver_items(back, st.raw_products))


def _regions_pipe(spark, sf_dir):
    st = star_for(spark, sf_dir)
    path = scratch(spark, "regions-pipe")
    write_delimited(st.raw_regions, path, "|")
    back = R.read_delimited(spark, path, R.REGIONS_SCHEMA, sep="|")
    return export(S.silver_regions(back))


def _sellers_csv(spark, sf_dir):
    st = star_for(spark, sf_dir)
    path = scratch(spark, "sellers-csv")
    write_delimited(st.raw_sellers, path, ";")
    back = R.read_delimited(spark, path, R.SELLERS_SCHEMA, sep=";")
    return export(S.silver_sellers(back, st.raw_channels))


def _deliveries_ndjson(spark, sf_dir):
    st = star_for(spark, sf_dir)
    path = scratch(spark, "deliveries-ndjson")
    write_ndjson(st.raw_deliveries, path)
    back = R.read_ndjson(spark, path, R.DELIVERIES_SCHEMA)
    return export(S.silver_deliveries(back, st.raw_orders))


def _tickets_ndjson(spark, sf_dir):
    st = star_for(spark, sf_dir)
    path = scratch(spark, "tickets-ndjson")
    write_ndjson(st.raw_tickets, path)
    back = R.read_ndjson(spark, path, R.TICKETS_SCHEMA)
    return export(S.silver_tickets(back))


def _products_json_array(spark, sf_dir):
    st = star_for(spark, sf_dir)
    path = scratch(spark, "products-json")
    write_json_array(st.raw_products, path)
    back = R.read_json_array(spark, path, R.PRODUCTS_SCHEMA)
    return export(S.silver_products(back))


def _channels_workbook(spark, sf_dir):
    st = star_for(spark, sf_dir)
    path = scratch(spark, "channels-xlsx")
    write_workbooks(st.raw_channels, path, sheet="canais")
    back = read_workbooks(spark, path, R.CHANNELS_SCHEMA, sheet="canais")
    return export(S.silver_channels(back))


def _customers_bronze(spark, sf_dir):
    st = star_for(spark, sf_dir)
    base = scratch(spark, "layers")
    B.write_table(B.with_ingest_columns(st.raw_customers, "customers"), base, "bronze", "customers")
    back = B.read_table(spark, base, "bronze", "customers").drop("_ingested_at", "_source_file")
    return export(S.silver_customers(back))


def _tickets_stream(spark, sf_dir):
    """Raw tickets land as NDJSON files; a Structured Streaming run
    (availableNow) ingests them into bronze micro-batch folders."""
    st = star_for(spark, sf_dir)
    base = scratch(spark, "tickets-stream")
    st.raw_tickets.write.mode("overwrite").json(f"{base}/landing")
    ingest_stream(spark, f"{base}/landing", R.TICKETS_SCHEMA, "json", f"{base}/bronze", f"{base}/_checkpoint")
    back = spark.read.parquet(f"{base}/bronze").drop("_ingested_at", "_source_file", "batch_id")
    return export(S.silver_tickets(back))


def _bronze_counts(spark, sf_dir):
    """All raw sources written to a bronze layer (observe-counted), then the
    per-table row report read back from storage."""
    st = star_for(spark, sf_dir)
    base = scratch(spark, "bronze")
    for name in RAW_NAMES:
        B.write_table(B.with_ingest_columns(getattr(st, f"raw_{name}"), name), base, "bronze", name)
    return B.layer_counts(spark, base, "bronze", RAW_NAMES)


RAW_NAMES = ["customers", "products", "channels", "regions", "sellers", "orders", "items", "deliveries", "tickets"]


def _bronze_counts_sql() -> str:
    return O.with_ctes([f"raw_{n}" for n in RAW_NAMES], " UNION ALL ".join(
        f"SELECT 'bronze' AS layer, '{n}' AS table_name, count(*) AS rows FROM raw_{n}" for n in RAW_NAMES))


register("s01_csv_semicolon_json_cell", _orders_csv, _silver_oracle("silver_orders"))
register("s02_csv_comma_decimals", _items_csv, _silver_oracle("silver_items"))
register("s03_pipe_delimited", _regions_pipe, _silver_oracle("silver_regions"))
register("s04_csv_semicolon_plain", _sellers_csv, _silver_oracle("silver_sellers"))
register("s05_ndjson_nested", _deliveries_ndjson, _silver_oracle("silver_deliveries"))
register("s06_ndjson_flat", _tickets_ndjson, _silver_oracle("silver_tickets"))
register("s07_json_array", _products_json_array, _silver_oracle("silver_products"))
register("s08_workbook", _channels_workbook, _silver_oracle("silver_channels"))
register("s09_bronze_layer_roundtrip", _customers_bronze, _silver_oracle("silver_customers"))
register("s10_stream_ingest", _tickets_stream, _silver_oracle("silver_tickets"))
register("s11_bronze_layer_counts", _bronze_counts, _bronze_counts_sql())


# ---------------------------------------------------------- source files and layers

def _reordered_header(spark, sf_dir):
    """A file whose columns stand in another order than the schema's: names decide."""
    st = star_for(spark, sf_dir)
    path = scratch(spark, "items-reordered")
    write_delimited(st.raw_items.select(*reversed(st.raw_items.columns)), path, ",")
    return export(S.silver_items(R.read_delimited(spark, path, R.ITEMS_SCHEMA, sep=","), st.raw_products))


def _mixed_headers(spark, sf_dir):
    """One folder whose files have their columns in three different orders:
    each file is read by its own header."""
    st = star_for(spark, sf_dir)
    path = scratch(spark, "orders-mixed")
    raw, digit = st.raw_orders, F.substring(F.trim("order_id"), -1, 1)
    low, middle = F.coalesce(digit < "3", F.lit(False)), F.coalesce(digit.between("3", "5"), F.lit(False))
    for k, (columns, rows) in enumerate([(raw.columns, low), (raw.columns[::-1], middle), (raw.columns[3:] + raw.columns[:3], ~low & ~middle)]):
        write_delimited(raw.where(rows).select(*columns), f"{path}/kind{k}", ";")
    return export(S.silver_orders(R.read_delimited(spark, path, R.ORDERS_SCHEMA, sep=";")))


def _malformed_lines(spark, sf_dir):
    """Every tenth ticket's line is cut short; bronze keeps its text and the file it came from."""
    st = star_for(spark, sf_dir)
    base = scratch(spark, "tickets-malformed")
    line = F.to_json(F.struct(*st.raw_tickets.columns))
    cut = F.substring("ticket_id", 2, 20).cast("long") % 10 == 0
    (st.raw_tickets.select(F.when(cut, F.substring_index(line, ",", 1)).otherwise(line).alias("line"))
     .write.text(f"{base}/tickets.ndjson"))
    B.build_bronze_from_files(spark, base, f"{base}/out", only=["tickets"])
    bronze = B.read_table(spark, f"{base}/out", "bronze", "tickets")
    return bronze.agg(F.count(F.lit(1)).alias("rows"), F.count(R.CORRUPT).alias("malformed"),
                      F.count_if(F.col(R.CORRUPT).startswith('{"ticket_id":"T')).alias("malformed_text_kept"),
                      F.count_if(F.col("_source_file").contains("tickets.ndjson")).alias("with_file"))


def _layer_counts_query(layer: str):
    tables = [*B.SILVER_TABLES] if layer == "silver" else [*B.GOLD_TABLES]

    def run(spark, sf_dir):
        """The layers written one from the other, then the row report read back."""
        base = scratch(spark, f"{layer}-layer")
        B.build_bronze(spark, sf_dir, base)
        B.build_silver(spark, base)
        if layer == "gold":
            B.build_gold(spark, base)
        return B.layer_counts(spark, base, layer, tables)
    return run


def _written_fact(spark, sf_dir):
    """fact_pedidos_itens as the gold layer holds it, built from written layers."""
    base = scratch(spark, "gold-fact")
    B.build_bronze(spark, sf_dir, base)
    B.build_silver(spark, base)
    B.build_gold(spark, base)
    return export(B.read_table(spark, base, "gold", "fact_pedidos_itens"))


def _counts_sql(layer: str, names: dict[str, str]) -> str:
    return O.with_ctes(list(names.values()), " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{n}' AS table_name, count(*) AS rows FROM {cte}" for n, cte in names.items()))


register("s12_reordered_header", _reordered_header, _silver_oracle("silver_items"))
register("s17_mixed_headers", _mixed_headers, _silver_oracle("silver_orders"))
register("s13_malformed_lines", _malformed_lines, O.with_ctes(["raw_tickets"], """
SELECT count(*) AS rows, count(*) FILTER (WHERE bad) AS malformed, count(*) FILTER (WHERE bad) AS malformed_text_kept,
  count(*) AS with_file FROM (SELECT CAST(substr(ticket_id, 2) AS BIGINT) % 10 = 0 AS bad FROM raw_tickets)"""))
register("s14_silver_layer_counts", _layer_counts_query("silver"),
         _counts_sql("silver", {t: f"silver_{t}" for t in B.SILVER_TABLES}))
register("s15_gold_layer_counts", _layer_counts_query("gold"), _counts_sql("gold", {t: t for t in B.GOLD_TABLES}))
register("s16_gold_fact_written", _written_fact, O.exported("fact_pedidos_itens", TABLE_COLUMNS["fact_pedidos_itens"]))


# ---------------------------------------------------------- records set aside, stamps, catalog

def _quarantined(spark, sf_dir):
    """Every tenth ticket's line is cut short: these records reach the
    quarantine with their text, and no silver row is made of them."""
    st = star_for(spark, sf_dir)
    base = scratch(spark, "tickets-quarantine")
    line = F.to_json(F.struct(*st.raw_tickets.columns))
    cut = F.substring("ticket_id", 2, 20).cast("long") % 10 == 0
    (st.raw_tickets.select(F.when(cut, F.substring_index(line, ",", 1)).otherwise(line).alias("line"))
     .write.text(f"{base}/tickets.ndjson"))
    B.build_bronze_from_files(spark, base, f"{base}/out", only=["tickets"])
    silver = S.silver_tickets(B.set_aside_malformed(spark, f"{base}/out", "tickets").drop("_ingested_at", "_source_file", R.CORRUPT))
    aside = B.read_table(spark, f"{base}/out", "quarantine", "tickets")
    return silver.agg(F.count(F.lit(1)).alias("kept"), F.count("ticket_id").alias("kept_with_id")).withColumns({
        "quarantined": aside.agg(F.count(F.lit(1))).scalar(),
        "quarantined_with_text": aside.agg(F.count_if(F.col(R.CORRUPT).startswith('{"ticket_id":"T'))).scalar()})


def _ingest_stamps(spark, sf_dir):
    """D8: every bronze row carries the time of its write, one time per write."""
    base = scratch(spark, "stamps")
    started = F.current_timestamp()
    B.write_table(B.with_ingest_columns(star_for(spark, sf_dir).raw_customers, "customers"), base, "bronze", "customers")
    back = B.read_table(spark, base, "bronze", "customers")
    return back.agg(F.count(F.lit(1)).alias("rows"), F.count("_ingested_at").alias("stamped"),
                    F.count_distinct("_ingested_at").alias("stamps"), F.count_if(F.col("_ingested_at") > started).alias("later_than_now"))


def _namespace(spark, sf_dir):
    """B4: bronze tables named in a catalog namespace and counted by name."""
    st = star_for(spark, sf_dir)
    base, names = scratch(spark, "catalog"), ["customers", "orders", "tickets"]
    for n in names:
        B.write_table(B.with_ingest_columns(getattr(st, f"raw_{n}"), n), base, "bronze", n)
    tables = B.register_layer(spark, base, "bronze", names, f"starloom_{uuid.uuid4().hex[:12]}")
    parts = [spark.table(t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, t in zip(names, tables)]
    return reduce(DataFrame.unionByName, parts)


#: Buckets of a small fact, and source bytes of the larger fact's table for each further one: a bucket is a task.
BUCKETS, BUCKET_BYTES = 8, 2 << 20


def buckets_for(star) -> int:
    """Buckets for the facts of ``star``, growing with the table behind the larger of them."""
    read = sum(size for _, size, _ in files_of(star.spark, [table_path(star.sf_dir, "lineitem")]))
    return max(BUCKETS, -(-read // BUCKET_BYTES))


def _bucketed(spark, sf_dir):
    """B3 laid out for joins: item and order facts bucketed by order, joined where they lie."""
    st = star_for(spark, sf_dir)
    base, name = scratch(spark, "bucketed"), f"starloom_{uuid.uuid4().hex[:12]}"
    n = buckets_for(st)
    items, orders = (spark.table(B.write_bucketed(getattr(st, t), base, "gold", t, "order_id", n, name))
                     for t in ("fact_pedidos_itens", "fact_pedidos"))
    joined = items.join(orders.select("order_id", "status_order", "is_cancelado"), "order_id")
    return joined.groupBy("order_id", "status_order").agg(
        F.count(F.lit(1)).alias("items"), F.count_if("is_cancelado").alias("cancelled"), F.max("quantity").alias("most"))


def _literal_rows(spark, sf_dir):
    """A9: inline rows (the spellings of two states) met with the customers."""
    spellings = spark.createDataFrame([("sp", "SP"), ("sao paulo", "SP"), ("minas gerais", "MG"), ("mg", "MG"), ("none such", "XX")],
                                      "spelling string, uf string")
    raw = star_for(spark, sf_dir).raw_customers.select(F.lower(F.trim("estado")).alias("spelling"))
    return spellings.join(raw.groupBy("spelling").agg(F.count(F.lit(1)).alias("n")), "spelling", "left").groupBy("uf").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("customers"))


register("s18_quarantined_records", _quarantined, O.with_ctes(["raw_tickets"], """
SELECT count(*) FILTER (WHERE NOT bad) AS kept, count(*) FILTER (WHERE NOT bad) AS kept_with_id, count(*) FILTER (WHERE bad) AS quarantined,
  count(*) FILTER (WHERE bad) AS quarantined_with_text
FROM (SELECT CAST(substr(ticket_id, 2) AS BIGINT) % 10 = 0 AS bad FROM raw_tickets)"""))
register("s19_bucketed_join", _bucketed, O.with_ctes(["fact_pedidos_itens", "fact_pedidos"], """
SELECT order_id, o.status_order, count(*) AS items, count(*) FILTER (WHERE o.is_cancelado) AS cancelled, max(i.quantity) AS most
FROM fact_pedidos_itens i JOIN fact_pedidos o USING (order_id) GROUP BY ALL"""))
register("s20_ingest_stamps", _ingest_stamps, O.with_ctes(["raw_customers"], """
SELECT count(*) AS rows, count(*) AS stamped, CAST(1 AS BIGINT) AS stamps, CAST(0 AS BIGINT) AS later_than_now FROM raw_customers"""))
register("s21_catalog_namespace", _namespace, O.with_ctes(["raw_customers", "raw_orders", "raw_tickets"], " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS rows FROM raw_{n}" for n in ("customers", "orders", "tickets"))))
register("s22_literal_rows", _literal_rows, O.with_ctes(["raw_customers"], """
SELECT uf, CAST(count(estado) AS BIGINT) AS customers
FROM (VALUES ('sp', 'SP'), ('sao paulo', 'SP'), ('minas gerais', 'MG'), ('mg', 'MG'), ('none such', 'XX')) l(spelling, uf)
LEFT JOIN raw_customers ON lower(trim(estado)) = spelling GROUP BY uf"""))
