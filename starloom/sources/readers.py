"""Schema-declared readers for the raw source formats.

Every reader takes an explicit schema (all leaf scalars as string, as the
sources deliver them), so no inference pass runs and the schema cannot
drift between files.  CSV/NDJSON are splittable; a multi-line JSON array
file is read by one task per file, so keep such sources as many files.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _s(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Source schemas (column names are the source's contract).
PRODUCTS_SCHEMA = T.StructType([
    T.StructField("attributes", T.StructType(_s("family") + [
        T.StructField("tags", T.ArrayType(T.StringType()))])),
    T.StructField("pricing", T.StructType(_s("currency", "list_price"))),
    T.StructField("product", T.StructType(_s("category", "name", "product_id", "status", "subcategory"))),
    T.StructField("updated_at", T.StringType()),
])
ORDERS_SCHEMA = T.StructType(_s("order_id", "customer_code", "seller_id", "order_date", "promised_date",
                                "status_order", "gross_amount", "discount_amount", "net_amount",
                                "payment_details", "last_update"))
ITEMS_SCHEMA = T.StructType(_s("order_id", "item_seq", "product_code", "quantity", "unit_price",
                               "total_item", "item_status"))
REGIONS_SCHEMA = T.StructType(_s("regional_code", "regional_name", "state", "manager_name", "active_flag"))
SELLERS_SCHEMA = T.StructType(_s("seller_id", "seller_name", "canal_id", "regional_code", "hire_date", "status"))
DELIVERIES_SCHEMA = T.StructType([
    T.StructField("carrier", T.StructType(_s("mode", "name"))),
    T.StructField("cost", T.StringType()),
    T.StructField("delivery_id", T.StringType()),
    T.StructField("delivery_status", T.StringType()),
    T.StructField("destination", T.StructType(_s("city", "state"))),
    T.StructField("order_ref", T.StringType()),
    T.StructField("timestamps", T.StructType(_s("delivered_at", "shipped_at"))),
])
TICKETS_SCHEMA = T.StructType(_s("ticket_id", "order_id", "customer_code", "event_type", "severity",
                                 "status", "created_at", "metadata"))
CHANNELS_SCHEMA = T.StructType(_s("id_canal", "nome_canal", "tipo_canal", "ativo", "observacao"))
CUSTOMERS_SCHEMA = T.StructType(_s("customer_id", "nome_cliente", "segmento", "porte", "cidade", "estado",
                                   "data_cadastro", "email", "status_cliente", "updated_at"))


#: Column that keeps the text of a record that doesn't parse.
CORRUPT = "_corrupt_record"
#: Column that names the file of a record.
SOURCE_FILE = "_source_file"


def _json(spark: SparkSession, schema: T.StructType, keep_corrupt: bool):
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if keep_corrupt else schema
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """A file holding one top-level JSON array -> one row per element."""
    return _json(spark, schema, keep_corrupt).option("multiLine", True).json(path)


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """Newline-delimited JSON (splittable).  ``keep_corrupt`` adds the text of
    malformed lines as ``_corrupt_record``, so bronze loses none of them."""
    return _json(spark, schema, keep_corrupt).json(path)


#: Header groups of one source beyond which its files are taken to be of different sources; bytes of a header line.
MOST_HEADERS, HEADER_BYTES = 256, 1 << 20


def _header_line(spark: SparkSession, path: str) -> str:
    """First line of a file, through the file system (and codec) that Spark reads it with."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    at, line = hadoop.fs.Path(path), hadoop.io.Text()
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    stream = at.getFileSystem(conf).open(at)
    try:
        hadoop.util.LineReader(stream if codec is None else codec.createInputStream(stream)).readLine(line, HEADER_BYTES)
    finally:
        stream.close()
    return line.toString()


def header_groups(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(header line, files) of the files at ``path``, from one listing and the
    first line of each file; empty files have no header and no rows."""
    sc = spark.sparkContext
    pattern = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = pattern.getFileSystem(sc._jsc.hadoopConfiguration())
    files = []
    for top in fs.globStatus(pattern) or []:
        found = fs.listFiles(top.getPath(), True)
        while found.hasNext():
            f = found.next()
            below = f.getPath().toString()[len(top.getPath().toString()):]
            if f.getLen() and not any(p[:1] in ("_", ".") and "=" not in p for p in below.split("/")[1:]):
                files.append(f.getPath().toString())
    with ThreadPoolExecutor(16) as pool:  # waits for the file system, not for the processor
        lines = list(pool.map(lambda f: _header_line(spark, f), files))
    groups: dict[str, list[str]] = {}
    for file, line in sorted(zip(files, lines)):
        groups.setdefault(line.rstrip("\r"), []).append(file)
    if len(groups) > MOST_HEADERS:
        raise ValueError(f"{len(groups)} different headers among the {len(files)} files of {path}")
    return sorted(groups.items())


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   quote: str = '"', escape: str = '"', keep_corrupt: bool = False, keep_file: bool = False) -> DataFrame:
    """Header CSV / pipe / semicolon text; columns are found by the names in
    each file's own header, whatever their order, and one that is missing is
    null.  Files are read together where they share a header, so a source with
    few headers is few reads.  ``escape='"'`` decodes doubled quotes inside
    quoted cells (JSON kept in a CSV cell); empty cells -> null.  ``keep_file``
    adds the path of each row's file as ``_source_file``."""
    extra = [T.StructField(CORRUPT, T.StringType())] * keep_corrupt + [T.StructField(SOURCE_FILE, T.StringType())] * keep_file
    options = {"header": True, "sep": sep, "quote": quote, "escape": escape, "mode": "PERMISSIVE"}

    def read(files: list[str]) -> DataFrame:
        named = spark.read.options(**options).csv(files[0]).columns  # reads the header line alone
        full = T.StructType([T.StructField(n, T.StringType()) for n in named]
                            + [T.StructField(CORRUPT, T.StringType())] * keep_corrupt)
        found = spark.read.options(**options).option("columnNameOfCorruptRecord", CORRUPT).schema(full).csv(files)
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in named
                   else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return found.select(*columns, *[CORRUPT] * keep_corrupt, *[F.col("_metadata.file_path").alias(SOURCE_FILE)] * keep_file)

    groups = header_groups(spark, path)
    if not groups:
        return spark.createDataFrame([], T.StructType([*schema.fields, *extra]))
    return reduce(DataFrame.unionByName, [read(files) for _, files in groups])
