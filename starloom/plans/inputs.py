"""Dirty raw sources derived from the driver's TPC-H-style tables.

The driver's tables are clean, so the source-system dirt the library exists
to handle (case/space noise on keys, mixed date layouts, comma decimals,
sentinels, duplicates with conflicting content, orphan references) is
introduced by deterministic expressions over whole tables.  Every rule here
has a twin in ``starloom.plans.oracle`` written in DuckDB SQL.

Domain mapping: customer -> customers, part -> products, supplier ->
sellers, nation -> channels, region -> regions, orders -> order headers,
lineitem -> order items and deliveries, events -> tickets.

All columns are strings (as a CSV/JSON source would declare them); products
and deliveries are nested structs like their JSON sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
# Codes outside the format of every real key: references to nothing.
NO_PRODUCT, NO_ORDER = "PX99999", "OX9999999"
# Customers per seller in the source tables: spreads orders over all seller keys.
CUSTOMERS_PER_SELLER = 15


#: Setting that names the tasks over which a caller spreads sources that can't be split (one row group a file).
SPREAD = "spark.starloom.spread"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str, spread: int | None = None) -> DataFrame:
    """A test table.  ``spread`` (or else the session's ``spark.starloom.spread``;
    0: as the files are split) deals its rows to that many tasks, which pays
    only where few unsplittable files feed much work."""
    found = spark.read.parquet(table_path(sf_dir, name))
    n = spread if spread is not None else int(spark.conf.get(SPREAD, "0"))
    return found.repartition(n) if n > 1 else found


def _code(prefix: str, col: Column, width: int) -> Column:
    """Prefix and key, zero-padded up to ``width`` and never shortened."""
    digits = col.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits))


def _money(col: Column) -> Column:
    """Two-decimal text of a double (exact for values with two decimals)."""
    return col.cast("decimal(18,2)").cast("string")


def _comma(text: Column) -> Column:
    return F.regexp_replace(text, r"\.", ",")


def _clock(day_text: Column, k: Column) -> Column:
    """'<day> HH:mm:00' with hour/minute taken from an integer key."""
    return F.concat(day_text, F.lit(" "), F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((k % 60).cast("string"), 2, "0"), F.lit(":00"))


def _with_copies(base: DataFrame, cond: Column, overrides: dict[str, Column]) -> DataFrame:
    """Emit every row once, plus a second copy where ``cond`` holds, with
    ``overrides`` applied to the copy.  One scan (explode of a variant
    index) instead of a union of two scans of the same table."""
    n = base.withColumn("_v", F.explode(F.when(cond, F.array(F.lit(0), F.lit(1)))
                                         .otherwise(F.array(F.lit(0)))))
    copy = F.col("_v") == 1
    return n.select(*[F.when(copy, overrides[c]).otherwise(F.col(c)).alias(c) if c in overrides else F.col(c)
                      for c in base.columns])


def _pick(k: Column, modulus: int, values: list) -> Column:
    """CASE k % modulus WHEN i THEN values[i] ... (None -> null)."""
    expr = None
    for i, v in enumerate(values):
        val = v if isinstance(v, Column) else F.lit(v)
        expr = F.when(k % modulus == i, val) if expr is None else expr.when(k % modulus == i, val)
    return expr


# --------------------------------------------------------------------------
# customers <- customer
# --------------------------------------------------------------------------

def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    cid = _code("C", k, 6)
    signup = F.date_add(F.lit("2020-01-01").cast("date"), (k % 1500).cast("int"))
    updated_day = F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))
    updated = _clock(updated_day, k)
    base = c.select(
        F.when(k % 5 == 1, F.lower(cid)).when(k % 5 == 2, F.concat(F.lit("  "), cid, F.lit(" ")))
         .otherwise(cid).alias("customer_id"),
        F.col("c_name").alias("nome_cliente"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 7 == 0, F.lit(""))
         .otherwise(F.col("c_mktsegment")).alias("segmento"),
        _pick(k, 6, ["grande", "Média", "media", " PEQUENA ", None, "Micro"]).alias("porte"),
        F.concat(F.lit("Cidade "), F.col("c_nationkey").cast("string")).alias("cidade"),
        _pick(F.col("c_nationkey"), 8, ["sao paulo", "SP", "Minas Gerais", "sta catarina",
                                        "Paraná", " rj ", "Goiás", "Tocantins"]).alias("estado"),
        F.when(k % 4 == 0, F.date_format(signup, "yyyy-MM-dd"))
         .when(k % 4 == 1, F.date_format(signup, "dd/MM/yyyy"))
         .when(k % 4 == 2, F.date_format(signup, "yyyy/MM/dd"))
         .when(k % 8 == 3, F.lit("2025-13-40"))
         .otherwise(F.concat(F.date_format(signup, "dd/MM/yyyy"), F.lit(" 10:30"))).alias("data_cadastro"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
         .when(k % 9 == 0, F.concat(F.lit("cliente"), k.cast("string"), F.lit("@empresa")))
         .otherwise(F.concat(F.lit("cliente"), k.cast("string"), F.lit("@empresa.com"))).alias("email"),
        _pick(k, 4, ["Ativo", " ativo", "INATIVO", None]).alias("status_cliente"),
        updated.alias("updated_at"),
        k.alias("_k"),
    )
    # Second copies of every 10th customer: later update (copy wins) or the
    # same update time with a broken e-mail (valid e-mail wins the tie).
    return _with_copies(base, F.col("_k") % 10 == 3, {
        "customer_id": F.lower(F.trim(F.col("customer_id"))),
        "nome_cliente": F.concat(F.col("nome_cliente"), F.lit(" (dup)")),
        "email": F.when(F.col("_k") % 20 == 13, F.lit("invalid-email")).otherwise(F.col("email")),
        "updated_at": F.when(F.col("_k") % 20 == 3, _clock(F.lit("2024-02-15"), F.col("_k")))
                       .otherwise(F.col("updated_at")),
    }).drop("_k")


# --------------------------------------------------------------------------
# products <- part (nested like the catalogue JSON dump)
# --------------------------------------------------------------------------

def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    pid = _code("P", k, 5)
    price = _money(F.col("p_retailprice"))
    day = F.concat(F.lit("2024-06-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))
    flat = p.select(
        F.when(k % 5 == 1, F.lower(pid)).otherwise(pid).alias("product_id"),
        F.when(k % 29 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("name"),
        F.col("p_type").alias("category"),
        F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("subcategory"),
        _pick(k, 4, ["Ativo", "INATIVO", None, " "]).alias("status"),
        F.when(k % 13 == 0, F.lit("N/A")).when(k % 3 == 1, _comma(price)).otherwise(price).alias("list_price"),
        F.lit("BRL").alias("currency"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Fam "), (F.col("p_size") % 10).cast("string"))).alias("family"),
        F.array(F.col("p_brand"), F.col("p_type")).alias("tags"),
        F.when(k % 3 == 0, F.concat(day, F.lit("T08:15:00")))
         .when(k % 3 == 1, F.concat(day, F.lit(" 08:15:00")))
         .otherwise(F.concat(F.date_format(F.to_date(day), "dd/MM/yyyy"), F.lit(" 08:15")))
         .alias("updated_at"),
        k.alias("_k"),
    )
    # Revised copies: a later revision wins; an unparseable stamp loses.
    both = _with_copies(flat, F.col("_k") % 10 == 6, {
        "product_id": F.lower(F.col("product_id")),
        "name": F.concat(F.coalesce(F.col("name"), F.lit("Produto")), F.lit(" revisado")),
        "updated_at": F.when(F.col("_k") % 20 == 6, F.lit("2024-07-30 12:00:00")).otherwise(F.lit("not a date")),
    })
    return both.select(
        F.struct("product_id", "name", "category", "subcategory", "status").alias("product"),
        F.struct(F.col("list_price"), F.col("currency")).alias("pricing"),
        F.struct("family", "tags").alias("attributes"),
        "updated_at",
    )


# --------------------------------------------------------------------------
# channels <- nation, regions <- region
# --------------------------------------------------------------------------

def raw_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    chid = _code("CH", k, 2)
    base = n.select(
        F.when(k % 3 == 1, F.lower(chid)).otherwise(chid).alias("id_canal"),
        F.when(k % 8 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("nome_canal"),
        F.when(k % 10 == 9, F.lit(None).cast("string"))
         .otherwise(_pick(k, 4, ["direto", "INDIRETO", " Digital ", "Parceiro"])).alias("tipo_canal"),
        _pick(k, 3, ["Sim", "nao", "talvez"]).alias("ativo"),
        F.lit(None).cast("string").alias("observacao"),
        k.alias("_k"),
    )
    return _with_copies(base, F.col("_k") % 5 == 0, {
        "nome_canal": F.concat(F.coalesce(F.col("nome_canal"), F.lit("")), F.lit(" X")),
        "observacao": F.lit("Duplicado conflitante"),
    }).drop("_k")


# Region code and state spelling per region key 0..4.
REGION_CODES = ["N", "NE", "SE", "S", "CO"]
REGION_STATES = ["amazonas", "Bahia", "sao paulo", "Santa Catarina", "Goiás"]


def raw_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    k = F.col("r_regionkey")
    code = _pick(k, 5, REGION_CODES)
    base = r.select(
        code.alias("regional_code"),
        F.col("r_name").alias("regional_name"),
        _pick(k, 5, REGION_STATES).alias("state"),
        F.concat(F.lit("Gerente "), k.cast("string")).alias("manager_name"),
        F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit("0")).alias("active_flag"),
    )
    # Legacy copies: 'sul' alias or lower-case code, long-form name (loses).
    dup = r.select(
        F.when(k == 3, F.lit("sul")).otherwise(F.concat(F.lower(code), F.lit(" "))).alias("regional_code"),
        F.concat(F.lit("Região "), F.col("r_name")).alias("regional_name"),
        F.upper(_pick(k, 5, REGION_STATES)).alias("state"),
        F.concat(F.lit("Gerente "), k.cast("string")).alias("manager_name"),
        F.lit("1").alias("active_flag"),
    )
    return base.unionByName(dup)


# --------------------------------------------------------------------------
# sellers <- supplier
# --------------------------------------------------------------------------

def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    vid = _code("V", k, 4)
    hire = F.date_add(F.lit("2015-01-01").cast("date"), (k * 37 % 3000).cast("int"))
    region_code = _pick(F.col("s_nationkey") % 5, 5, ["N", "NE", "SE", "sul", "CO"])
    base = s.select(
        F.when(k % 4 == 1, F.lower(vid)).otherwise(vid).alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        F.when(k % 9 == 0, F.lit(None).cast("string")).when(k % 11 == 0, F.lit("CH99"))
         .otherwise(_code("CH", F.col("s_nationkey"), 2)).alias("canal_id"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(region_code).alias("regional_code"),
        _pick(k, 3, [F.date_format(hire, "yyyy-MM-dd"), F.date_format(hire, "dd/MM/yyyy"),
                     F.date_format(hire, "yyyy/MM/dd")]).alias("hire_date"),
        _pick(k, 5, ["Ativo", "ATIVO ", "inativo", None, ""]).alias("status"),
        k.alias("_k"),
    )
    return _with_copies(base, (F.col("_k") % 10 == 4) | (F.col("_k") % 10 == 8), {
        "seller_name": F.when(F.col("_k") % 10 == 4, F.concat(F.col("seller_name"), F.lit(" duplicado")))
                        .otherwise(F.col("seller_name")),
        "canal_id": F.when(F.col("_k") % 10 == 8, F.lit("CH98")).otherwise(F.col("canal_id")),
    }).drop("_k")


# --------------------------------------------------------------------------
# order headers <- orders
# --------------------------------------------------------------------------

def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    oid = _code("O", k, 7)
    cust = _code("C", F.col("o_custkey"), 6)
    od = F.col("o_orderdate")
    gross = _money(F.col("o_totalprice"))
    disc = F.concat((k % 500).cast("string"), F.lit("."), F.lpad((k % 100).cast("string"), 2, "0"))
    net = (F.col("o_totalprice").cast("decimal(18,2)") - disc.cast("decimal(18,2)")).cast("string")
    # Some amounts carry a third decimal; one is beyond every money type.
    net = (F.when(k % 23 == 0, gross).when(k % 101 == 0, F.concat(net, F.lit("5")))
           .when(k == 5, F.lit("9" * 40)).otherwise(net))

    def amount(text: Column) -> Column:
        return F.when(k % 3 == 1, _comma(text)).otherwise(text)

    status = (F.when(k % 29 == 0, F.lit(None).cast("string"))
              .when(k % 31 == 0, F.lit("devolvido"))
              .when(F.col("o_orderstatus") == "F", F.lit("Faturado"))
              .when(F.col("o_orderstatus") == "O",
                    F.when(k % 2 == 0, F.lit("em separacao")).otherwise(F.lit("EM_SEPARACAO")))
              .otherwise(_pick(k, 3, ["Entregue", "cancelado", " Cancelado "])))
    payment = (F.when(k % 43 == 0, F.lit(None).cast("string"))
               .when(k % 41 == 0, F.lit("not json"))
               .otherwise(F.concat(F.lit('{"priority": "'), F.col("o_orderpriority"), F.lit('"'),
                                   _pick(k, 3, [F.lit(', "source": "web"}'), F.lit(', "source": "app"}'),
                                                F.lit("}")]))))
    base = o.select(
        F.when(k % 6 == 1, F.lower(oid)).when(k % 6 == 2, F.concat(F.lit(" "), oid, F.lit("  ")))
         .otherwise(oid).alias("order_id"),
        F.when(k % 53 == 0, F.lit("C9999")).when(k % 4 == 1, F.lower(cust))
         .otherwise(cust).alias("customer_code"),
        _code("V", F.floor(F.col("o_custkey") / CUSTOMERS_PER_SELLER), 4).alias("seller_id"),
        _pick(k, 8, [F.date_format(od, "yyyy-MM-dd'T'HH:mm:ss"), F.date_format(od, "yyyy-MM-dd HH:mm:ss"),
                     F.date_format(od, "dd/MM/yyyy HH:mm"), F.date_format(od, "yyyy-MM-dd"),
                     F.date_format(od, "dd/MM/yyyy"), F.date_format(od, "yyyy/MM/dd"),
                     F.lit("2025-13-40"),
                     F.when(k % 16 == 7, F.lit("31/02/2025 10:00"))
                      .otherwise(F.date_format(od, "yyyy-MM-dd"))]).alias("order_date"),
        F.when(k % 19 == 0, F.lit(None).cast("string"))
         .otherwise(F.date_format(F.date_add(od, 60), "yyyy-MM-dd")).alias("promised_date"),
        status.alias("status_order"),
        F.when(k % 97 == 0, F.lit("N/A")).otherwise(amount(gross)).alias("gross_amount"),
        amount(disc).alias("discount_amount"),
        amount(net).alias("net_amount"),
        payment.alias("payment_details"),
        _clock(F.date_format(od, "yyyy-MM-dd"), k).alias("last_update"),
        k.alias("_k"),
    )
    # Re-sent headers: a later update wins; an equal stamp with a lost gross
    # amount loses to the complete row.
    return _with_copies(base, F.col("_k") % 10 == 1, {
        "order_id": F.lower(F.trim(F.col("order_id"))),
        "status_order": F.lit("Entregue"),
        "gross_amount": F.when(F.col("_k") % 20 == 11, F.lit("N/A")).otherwise(F.col("gross_amount")),
        "last_update": F.when(F.col("_k") % 20 == 1, _clock(F.lit("2002-01-01"), F.col("_k")))
                        .otherwise(F.col("last_update")),
    }).drop("_k")


# --------------------------------------------------------------------------
# order items and deliveries <- lineitem
# --------------------------------------------------------------------------

def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    oid = _code("O", ok, 7)
    qty = F.col("l_quantity").cast("bigint").cast("string")
    r = (ok + ln) % 50
    price = _money(F.col("l_extendedprice"))
    total = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_quantity").cast("bigint")
    total = F.when(ln % 7 == 0, total + 1).otherwise(total).cast("string")
    return li.select(
        F.when(ln % 2 == 0, F.lower(oid)).otherwise(oid).alias("order_id"),
        ln.cast("string").alias("item_seq"),
        F.when(F.col("l_suppkey") % 17 == 0, F.lit(NO_PRODUCT))
         .otherwise(_code("P", F.col("l_partkey"), 5)).alias("product_code"),
        F.when(r == 0, F.lit("")).when(r == 1, F.concat(F.lit("-"), qty)).when(r == 2, F.lit("0"))
         .when(r == 3, F.lit("unknown")).otherwise(qty).alias("quantity"),
        F.when(ln % 3 == 0, _comma(price)).otherwise(price).alias("unit_price"),
        total.alias("total_item"),
        F.when(ok % 13 == 0, F.lit(None).cast("string"))
         .when(F.col("l_returnflag") == "R", F.lit("Cancelado"))
         .when(F.col("l_linestatus") == "O", F.lit("Ativo"))
         .otherwise(F.lit(" ATIVO")).alias("item_status"),
    )


# Destination state spellings by supplier key % 8.
DEST_STATES = ["SP", "são paulo", "Rio de Janeiro", "s. catarina", "parana", "MG", "bahia", "Pernambuco"]


def raw_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok, ln, pk, sk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    oid = _code("O", ok, 7)
    shipped = F.date_sub(F.col("l_shipdate"), 3)
    delivered = F.date_add(F.col("l_shipdate"), ln)
    status = (F.when(pk % 31 == 0, F.lit(None).cast("string"))
              .when(F.col("l_returnflag") == "A", F.lit("Delivered"))
              .when(F.col("l_returnflag") == "R", F.lit("atrasado"))
              .when(F.col("l_linestatus") == "O", F.lit("IN_TRANSIT"))
              .otherwise(F.lit("cancelled")))
    return li.select(
        F.concat(F.lit("D"), ok.cast("string"), F.lit("-"), ln.cast("string")).alias("delivery_id"),
        F.when(pk % 43 == 0, F.lit(None).cast("string")).when(pk % 41 == 0, F.lit(NO_ORDER))
         .when(pk % 3 == 0, F.lower(oid)).otherwise(oid).alias("order_ref"),
        status.alias("delivery_status"),
        F.when(pk % 19 == 0, F.lit("unknown"))
         .otherwise(F.concat((pk % 900).cast("string"), F.lit(","),
                             F.lpad((sk % 100).cast("string"), 2, "0"))).alias("cost"),
        F.struct(
            F.when(sk % 7 == 6, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("Carrier "), (sk % 7).cast("string"))).alias("name"),
            _pick(sk, 5, ["Rodoviário", "rodoviario", "AÉREO", "aereo", None]).alias("mode"),
        ).alias("carrier"),
        F.struct(
            _pick(pk, 5, [F.date_format(shipped, "yyyy-MM-dd'T'HH:mm:ss"),
                          F.date_format(shipped, "yyyy-MM-dd HH:mm:ss"),
                          F.date_format(shipped, "dd/MM/yyyy HH:mm"),
                          F.date_format(shipped, "yyyy-MM-dd"),
                          F.when(pk % 10 == 4, F.lit("31/02/2025 10:00"))
                           .otherwise(F.date_format(shipped, "dd/MM/yyyy"))]).alias("shipped_at"),
            F.when(ok % 9 == 0, F.lit(None).cast("string"))
             .otherwise(F.date_format(delivered, "yyyy-MM-dd HH:mm:ss")).alias("delivered_at"),
        ).alias("timestamps"),
        F.struct(
            _pick(sk, 8, DEST_STATES).alias("state"),
            F.concat(F.lit("Cidade "), (sk % 20).cast("string")).alias("city"),
        ).alias("destination"),
    )


# --------------------------------------------------------------------------
# tickets <- events (NDJSON-like, no duplicates)
# --------------------------------------------------------------------------

def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    oid = _code("O", k, 7)
    cust = _code("C", F.col("user_id"), 6)
    et = F.col("event_type")
    event_type = (F.when(k % 41 == 0, F.lit(None).cast("string"))
                  .when(k % 37 == 0, F.lit("escalation"))
                  .when(et == "view", F.lit("Delay"))
                  .when(et == "signup", F.lit("TROCA"))
                  .when(et == "error", F.lit(" refund "))
                  .when(et == "click", F.lit("Complaint"))
                  .otherwise(F.lit("cancel_request")))
    ts = F.col("ts")
    return e.select(
        F.concat(F.lit("T"), k.cast("string")).alias("ticket_id"),
        F.when(k % 2 == 0, F.lower(oid)).otherwise(oid).alias("order_id"),
        F.when(k % 23 == 0, F.lit(None).cast("string")).when(k % 3 == 0, F.lower(cust))
         .otherwise(cust).alias("customer_code"),
        event_type.alias("event_type"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).when(F.col("value") < 5, F.lit("Low"))
         .when(F.col("value") < 10, F.lit(" MEDIUM")).otherwise(F.lit("high")).alias("severity"),
        F.when(k % 17 == 0, F.lit("")).otherwise(_pick(k, 3, ["Open", "closed", " OPEN "])).alias("status"),
        _pick(k, 4, [F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.date_format(ts, "dd/MM/yyyy HH:mm"),
                     F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "dd/MM/yyyy")]).alias("created_at"),
        F.col("props").alias("metadata"),
    )


RAW_BUILDERS = {
    "customers": raw_customers,
    "products": raw_products,
    "channels": raw_channels,
    "regions": raw_regions,
    "sellers": raw_sellers,
    "orders": raw_orders,
    "items": raw_items,
    "deliveries": raw_deliveries,
    "tickets": raw_tickets,
}
