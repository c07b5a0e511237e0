"""Wiring of raw -> silver -> gold over one test-data folder.

Every attribute of ``Star`` is a lazy DataFrame built on first access; nothing
runs until an action.  ``StoredStar`` writes the heavy tables to a layer store
when they are first asked for and reads them back.  ``export`` renders a result in a stable, engine-neutral
form (dates/timestamps as text, arrays joined) for comparison and writing.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.plans import gold as G
from starloom.plans import inputs as I
from starloom.plans import silver as S
from starloom.sources.layer_store import LayerStore


class Star:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return I.table(self.spark, self.sf_dir, name)

    # raw -----------------------------------------------------------------
    @cached_property
    def raw_customers(self): return I.raw_customers(self.spark, self.sf_dir)
    @cached_property
    def raw_products(self): return I.raw_products(self.spark, self.sf_dir)
    @cached_property
    def raw_channels(self): return I.raw_channels(self.spark, self.sf_dir)
    @cached_property
    def raw_regions(self): return I.raw_regions(self.spark, self.sf_dir)
    @cached_property
    def raw_sellers(self): return I.raw_sellers(self.spark, self.sf_dir)
    @cached_property
    def raw_orders(self): return I.raw_orders(self.spark, self.sf_dir)
    @cached_property
    def raw_items(self): return I.raw_items(self.spark, self.sf_dir)
    @cached_property
    def raw_deliveries(self): return I.raw_deliveries(self.spark, self.sf_dir)
    @cached_property
    def raw_tickets(self): return I.raw_tickets(self.spark, self.sf_dir)

    # Keys that a table misses; a store holds them, a lazy star joins instead.
    missing_products = missing_orders = missing_order_customers = missing_ticket_customers = None

    # silver --------------------------------------------------------------
    @cached_property
    def silver_customers(self): return S.silver_customers(self.raw_customers)
    @cached_property
    def silver_products(self): return S.silver_products(self.raw_products)
    @cached_property
    def silver_channels(self): return S.silver_channels(self.raw_channels)
    @cached_property
    def silver_regions(self): return S.silver_regions(self.raw_regions)
    @cached_property
    def silver_sellers(self): return S.silver_sellers(self.raw_sellers, self.raw_channels)
    @cached_property
    def silver_orders(self): return S.silver_orders(self.raw_orders)
    @cached_property
    def items_tested(self): return S.items_tested(self.raw_items, self.raw_products, self.missing_products)
    @cached_property
    def silver_items(self): return self.items_tested.drop("_product_valid")
    @cached_property
    def silver_deliveries(self): return S.silver_deliveries(self.raw_deliveries, self.raw_orders, self.missing_orders)
    @cached_property
    def silver_tickets(self): return S.silver_tickets(self.raw_tickets)

    # gold ----------------------------------------------------------------
    @cached_property
    def dim_cliente(self): return G.dim_cliente(self.silver_customers)
    @cached_property
    def dim_produto(self): return G.dim_produto(self.silver_products)
    @cached_property
    def dim_canal(self): return G.dim_canal(self.silver_channels)
    @cached_property
    def dim_regiao(self): return G.dim_regiao(self.silver_regions)
    @cached_property
    def dim_vendedor(self):
        return G.dim_vendedor(self.silver_sellers, self.silver_channels, self.silver_regions)
    @cached_property
    def dim_data(self):
        return G.dim_data(self.silver_orders, self.silver_deliveries, self.silver_tickets)
    @cached_property
    def fact_pedidos(self):
        return G.fact_pedidos(self.silver_orders, self.silver_deliveries, G.customer_members(self.raw_customers),
                              self.missing_order_customers)
    @cached_property
    def fact_pedidos_itens(self):
        return G.fact_pedidos_itens(self.items_tested, self.silver_orders,
                                    G.customer_members(self.raw_customers), G.product_members(self.raw_products),
                                    self.missing_order_customers)
    @cached_property
    def fact_entregas(self): return G.fact_entregas(self.silver_deliveries)
    @cached_property
    def fact_ocorrencias(self):
        return G.fact_ocorrencias(self.silver_tickets, G.customer_members(self.raw_customers), self.missing_ticket_customers)


class StoredStar(Star):
    """The star whose silver tables and facts are written once to a layer
    store, by the first query that reads them, and read back by all."""

    @cached_property
    def store(self) -> LayerStore:
        return LayerStore(self.spark, [I.table_path(self.sf_dir, t) for t in I.TABLES])

    @cached_property
    def missing_products(self):
        return self.store.table("missing_products", lambda: S.missing_products(self.raw_items, self.raw_products))
    @cached_property
    def missing_orders(self):
        return self.store.table("missing_orders", lambda: S.missing_orders(self.raw_deliveries, self.raw_orders))
    @cached_property
    def missing_order_customers(self):
        return self.store.table("missing_order_customers", lambda: G.missing_customers(
            self.silver_orders, G.customer_members(self.raw_customers)))
    @cached_property
    def missing_ticket_customers(self):
        return self.store.table("missing_ticket_customers", lambda: G.missing_customers(
            self.silver_tickets, G.customer_members(self.raw_customers)))


#: Tables that the store holds; all others are light projections of these or of the sources.
STORED = ["silver_customers", "silver_products", "silver_channels", "silver_regions", "silver_sellers", "silver_orders", "items_tested",
          "silver_deliveries", "silver_tickets", "dim_data", "fact_pedidos", "fact_pedidos_itens", "fact_ocorrencias"]


def _stored(name: str) -> cached_property:
    build = getattr(Star, name).func
    prop = cached_property(lambda self: self.store.table(name, lambda: build(self)))
    prop.__set_name__(StoredStar, name)
    return prop


for _name in STORED:
    setattr(StoredStar, _name, _stored(_name))


def star_for(spark: SparkSession, sf_dir: str) -> Star:
    """The star over a folder, with a file listing of its own; layers come from the store."""
    return StoredStar(spark, sf_dir)


SILVER = ["customers", "products", "channels", "regions", "sellers", "orders", "items",
          "deliveries", "tickets"]
GOLD = ["dim_cliente", "dim_produto", "dim_canal", "dim_regiao", "dim_vendedor", "dim_data",
        "fact_pedidos", "fact_pedidos_itens", "fact_entregas", "fact_ocorrencias"]


def export(df: DataFrame) -> DataFrame:
    """Engine-neutral rendering: timestamps 'yyyy-MM-dd HH:mm:ss', dates
    'yyyy-MM-dd', string arrays joined with '|', structs as JSON."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        elif isinstance(t, (T.StructType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)
