"""Layer sinks: bronze / silver / gold written as Parquet under one base
path (one folder per layer), and the whole-chain builder.

* Row counts come from ``DataFrame.observe`` during the write itself, so a
  table is computed once (no second ``count()`` job after the write).
* Each layer is read back from storage before the next one is built: the
  written table cuts the lineage, so a lost executor recomputes at most one
  layer, never the chain from the raw files.
* Writes are full overwrites of a folder, hence idempotent on retry.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators.joins import missing_keys, with_key_missing
from starloom.plans import gold as G
from starloom.plans import inputs as I
from starloom.plans import silver as S
from starloom.session import tune_for_input
from starloom.sources import readers as R
from starloom.sources.workbook import read_workbooks


def layer_path(base_path: str, layer: str, table: str) -> str:
    return f"{base_path.rstrip('/')}/{layer}/{table}"


def with_ingest_columns(df: DataFrame, source_file: str | None = None) -> DataFrame:
    """Bronze lineage: ``_ingested_at`` and ``_source_file`` (the scan's own
    file path when no name is given and the DataFrame is a file scan; a reader
    that names the files itself is left as it is)."""
    stamped = df.withColumn("_ingested_at", F.current_timestamp())
    if source_file is None and R.SOURCE_FILE in df.columns:
        return stamped
    return stamped.withColumn(R.SOURCE_FILE, F.lit(source_file) if source_file is not None else F.col("_metadata.file_path"))


def write_table(df: DataFrame, base_path: str, layer: str, table: str,
                partition_by: list[str] | None = None) -> int:
    """Overwrite ``layer/table`` with ``df``; returns the rows written."""
    obs = Observation(f"{layer}.{table}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(layer_path(base_path, layer, table))
    return int(obs.get["rows"])


def written(df: DataFrame, base_path: str, layer: str, table: str) -> DataFrame:
    """``df`` written to ``layer/table`` and read back."""
    write_table(df, base_path, layer, table)
    return read_table(df.sparkSession, base_path, layer, table)


def read_table(spark: SparkSession, base_path: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(layer_path(base_path, layer, table))


def write_bucketed(df: DataFrame, base_path: str, layer: str, table: str, key: str, buckets: int, namespace: str) -> str:
    """Overwrite ``layer/table`` bucketed and sorted by ``key`` and name it in
    the catalog; returns the name.  Tables of equal bucket numbers join on the
    key where they lie, without an exchange.  (A key that holds much of a table
    is one bucket: for such tables the shuffled join, which splits it, is better.)"""
    create_namespace(df.sparkSession, base_path, namespace)
    name = f"{namespace}.{layer}_{table}"
    # Rows are dealt to their buckets first: one file a bucket, not one per task and bucket.
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", layer_path(base_path, layer, table)).saveAsTable(name))
    return name


def create_namespace(spark: SparkSession, base_path: str, namespace: str) -> None:
    """The catalog's namespace for the tables under ``base_path``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}` LOCATION '{base_path.rstrip('/')}/{namespace}'")


def register_layer(spark: SparkSession, base_path: str, layer: str, tables: list[str], namespace: str) -> list[str]:
    """Name the written tables of a layer in the catalog, as ``namespace.layer_table``."""
    create_namespace(spark, base_path, namespace)
    for t in tables:
        spark.catalog.createTable(f"{namespace}.{layer}_{t}", path=layer_path(base_path, layer, t), source="parquet")
    return [f"{namespace}.{layer}_{t}" for t in tables]


def layer_counts(spark: SparkSession, base_path: str, layer: str, tables: list[str]) -> DataFrame:
    """(layer, table_name, rows) for every table of a layer, one job."""
    parts = [read_table(spark, base_path, layer, t).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), "rows") for t in tables]
    return reduce(DataFrame.unionByName, parts)


SILVER_TABLES = ["products", "channels", "regions", "sellers", "customers", "orders", "items",
                 "deliveries", "tickets"]
GOLD_TABLES = ["dim_cliente", "dim_produto", "dim_canal", "dim_regiao", "dim_vendedor", "dim_data",
               "fact_pedidos", "fact_pedidos_itens", "fact_entregas", "fact_ocorrencias"]


def source_readers(spark: SparkSession, source_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """The nine raw sources of a folder, by the reader of their format.  A
    name stands for a file or a folder of files."""
    at = source_dir.rstrip("/")
    return {
        "products": lambda: R.read_json_array(spark, f"{at}/products.json", R.PRODUCTS_SCHEMA, keep_corrupt=True),
        "orders": lambda: R.read_delimited(spark, f"{at}/orders.csv", R.ORDERS_SCHEMA, sep=";", keep_corrupt=True, keep_file=True),
        "items": lambda: R.read_delimited(spark, f"{at}/items.csv", R.ITEMS_SCHEMA, sep=",", keep_corrupt=True, keep_file=True),
        "regions": lambda: R.read_delimited(spark, f"{at}/regions.txt", R.REGIONS_SCHEMA, sep="|", keep_corrupt=True, keep_file=True),
        "sellers": lambda: R.read_delimited(spark, f"{at}/sellers.csv", R.SELLERS_SCHEMA, sep=";", keep_corrupt=True, keep_file=True),
        "deliveries": lambda: R.read_ndjson(spark, f"{at}/deliveries.ndjson", R.DELIVERIES_SCHEMA, keep_corrupt=True),
        "tickets": lambda: R.read_ndjson(spark, f"{at}/tickets.ndjson", R.TICKETS_SCHEMA, keep_corrupt=True),
        "channels": lambda: read_workbooks(spark, f"{at}/channels.xlsx", R.CHANNELS_SCHEMA),
        "customers": lambda: R.read_delimited(spark, f"{at}/customers.csv", R.CUSTOMERS_SCHEMA, sep=",", keep_corrupt=True, keep_file=True),
    }


def build_bronze_from_files(spark: SparkSession, source_dir: str, base_path: str,
                            only: list[str] | None = None) -> dict[str, int]:
    """Raw source files -> bronze: every record as delivered, malformed ones
    as text in ``_corrupt_record``, with the file that each came from."""
    return {name: write_table(with_ingest_columns(read(), None if name != "channels" else f"{source_dir}/channels.xlsx"),
                              base_path, "bronze", name)
            for name, read in source_readers(spark, source_dir).items() if only is None or name in only}


def build_bronze(spark: SparkSession, sf_dir: str, base_path: str) -> dict[str, int]:
    """Raw sources (derived from the test tables) -> bronze, as delivered."""
    return {name: write_table(with_ingest_columns(fn(spark, sf_dir), f"{name}"), base_path, "bronze", name)
            for name, fn in I.RAW_BUILDERS.items()}


def set_aside_malformed(spark: SparkSession, base_path: str, table: str) -> DataFrame:
    """A bronze table's records that parsed; the others go to the layer
    ``quarantine`` as they came, with their text, file and time."""
    bronze = read_table(spark, base_path, "bronze", table)
    if R.CORRUPT not in bronze.columns:
        return bronze
    bad = F.col(R.CORRUPT).isNotNull()
    write_table(bronze.where(bad).select(R.CORRUPT, "_source_file", "_ingested_at"), base_path, "quarantine", table)
    return bronze.where(~bad)


def build_silver(spark: SparkSession, base_path: str) -> dict[str, int]:
    """Bronze -> silver; malformed records make no silver rows.  Keys without
    a match are written first (layer ``keys``): few as they are, no table is
    shuffled for their test."""
    b = {t: set_aside_malformed(spark, base_path, t).drop("_ingested_at", "_source_file", R.CORRUPT)
         for t in I.RAW_BUILDERS}
    frames = {
        "products": S.silver_products(b["products"]),
        "channels": S.silver_channels(b["channels"]),
        "regions": S.silver_regions(b["regions"]),
        "sellers": S.silver_sellers(b["sellers"], b["channels"]),
        "customers": S.silver_customers(b["customers"]),
        "orders": S.silver_orders(b["orders"]),
        "items": S.silver_items(b["items"], b["products"], written(
            S.missing_products(b["items"], b["products"]), base_path, "keys", "missing_products")),
        "deliveries": S.silver_deliveries(b["deliveries"], b["orders"], written(
            S.missing_orders(b["deliveries"], b["orders"]), base_path, "keys", "missing_orders")),
        "tickets": S.silver_tickets(b["tickets"]),
    }
    return {t: write_table(df, base_path, "silver", t) for t, df in frames.items()}


def build_gold(spark: SparkSession, base_path: str) -> dict[str, int]:
    s = {t: read_table(spark, base_path, "silver", t) for t in SILVER_TABLES}
    # Facts resolve their keys against the dimensions of this very build.
    customers, products = G.dim_cliente(s["customers"]), G.dim_produto(s["products"])
    missing = {t: written(G.missing_customers(s[t], customers), base_path, "keys", f"missing_{t}_customers") for t in ("orders", "tickets")}
    items = with_key_missing(s["items"], "product_code", written(
        missing_keys(s["items"], F.col("product_code"), products, F.col("product_id")), base_path, "keys", "missing_item_products"), "_product_valid")
    frames = {
        "dim_cliente": customers,
        "dim_produto": products,
        "dim_canal": G.dim_canal(s["channels"]),
        "dim_regiao": G.dim_regiao(s["regions"]),
        "dim_vendedor": G.dim_vendedor(s["sellers"], s["channels"], s["regions"]),
        "dim_data": G.dim_data(s["orders"], s["deliveries"], s["tickets"]),
        "fact_pedidos": G.fact_pedidos(s["orders"], s["deliveries"], customers, missing["orders"]),
        "fact_pedidos_itens": G.fact_pedidos_itens(items, s["orders"], customers, products, missing["orders"]),
        "fact_entregas": G.fact_entregas(s["deliveries"]),
        "fact_ocorrencias": G.fact_ocorrencias(s["tickets"], customers, missing["tickets"]),
    }
    return {t: write_table(df, base_path, "gold", t) for t, df in frames.items()}


def build_all(spark: SparkSession, sf_dir: str | None, base_path: str, source_dir: str | None = None,
              input_bytes: int | None = None) -> dict[str, dict[str, int]]:
    """bronze -> silver -> gold under ``base_path`` (a shared folder), from
    source files or else the test tables; ``input_bytes`` sizes scans and
    shuffles for the volume."""
    if input_bytes:
        tune_for_input(spark, input_bytes)
    return {"bronze": build_bronze_from_files(spark, source_dir, base_path) if source_dir
            else build_bronze(spark, sf_dir, base_path),
            "silver": build_silver(spark, base_path),
            "gold": build_gold(spark, base_path)}
