"""Independent DuckDB SQL oracles.

Each query in ``starloom.plans.catalog`` has a twin here written in plain
SQL against the driver's pre-registered views.  The raw-source derivations
and the silver/gold semantics are re-stated as CTEs; the small helpers
below only generate repetitive SQL text (CASE ladders, the strict
multi-layout date parse), they do not share code with the Spark side.
"""

from __future__ import annotations

from starloom.plans import oracle_values as vocab

NI = vocab.NOT_INFORMED

# Spark layout -> strftime/strptime layout, in the accepted order.
STRF = {
    "yyyy-MM-dd'T'HH:mm:ss": "%Y-%m-%dT%H:%M:%S",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "dd/MM/yyyy HH:mm": "%d/%m/%Y %H:%M",
    "yyyy-MM-dd": "%Y-%m-%d",
    "dd/MM/yyyy": "%d/%m/%Y",
    "yyyy/MM/dd": "%Y/%m/%d",
}
TS_OUT = "%Y-%m-%d %H:%M:%S"


def lit(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def pick(k: str, m: int, values: list) -> str:
    """CASE k % m WHEN i THEN v_i END; values are SQL snippets or python
    literals wrapped by :func:`L`."""
    parts = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"(CASE ({k}) % {m} {parts} END)"


def L(values: list) -> list[str]:
    return [lit(v) for v in values]


def code(prefix: str, expr: str, width: int) -> str:
    digits = f"CAST({expr} AS VARCHAR)"
    return f"('{prefix}' || lpad({digits}, CAST(greatest(length({digits}), {width}) AS INTEGER), '0'))"


def money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS VARCHAR)"


def comma(text: str) -> str:
    return f"replace({text}, '.', ',')"


def clock(day: str, k: str) -> str:
    return (f"({day} || ' ' || lpad(CAST(({k}) % 24 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST(({k}) % 60 AS VARCHAR), 2, '0') || ':00')")


def strf(expr: str, spark_fmt: str) -> str:
    return f"strftime({expr}, '{STRF[spark_fmt]}')"


def parse_ts(expr: str) -> str:
    t = f"trim({expr})"
    arms = [f"CASE WHEN strftime(try_strptime({t}, '{f}'), '{f}') = {t} THEN try_strptime({t}, '{f}') END"
            for f in (STRF[x] for x in vocab.DATETIME_FORMATS)]
    return "coalesce(" + ", ".join(arms) + ")"


def parse_date(expr: str) -> str:
    return f"CAST({parse_ts(expr)} AS DATE)"


def key(expr: str) -> str:
    return f"upper(trim({expr}))"


def lower_std(expr: str, default: str = NI) -> str:
    c = f"lower(trim({expr}))"
    return f"(CASE WHEN {c} IS NULL OR {c} = '' THEN {lit(default)} ELSE {c} END)"


def case_map(expr: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {arms} END)"


def enum(expr: str, mapping: dict, default: str = NI) -> str:
    c = f"lower(trim({expr}))"
    return (f"(CASE WHEN {c} IS NULL OR {c} = '' THEN {lit(default)} "
            f"ELSE coalesce({case_map(c, mapping)}, {c}) END)")


def state_uf(expr: str) -> str:
    c = f"lower(trim({expr}))"
    return f"coalesce({case_map(c, vocab.STATE_TO_UF)}, upper({c}))"


def regional(expr: str) -> str:
    c = key(expr)
    return f"coalesce({case_map(c, vocab.REGIONAL_CODE_ALIAS)}, {c})"


def br_decimal(expr: str) -> str:
    t = f"replace(trim(CAST({expr} AS VARCHAR)), ',', '.')"
    return f"(CASE WHEN regexp_matches({t}, '{vocab.NUMERIC_PATTERN}') THEN TRY_CAST({t} AS DOUBLE) END)"


def safe_double(expr: str) -> str:
    c = f"lower(trim(CAST({expr} AS VARCHAR)))"
    sentinels = ", ".join(lit(s) for s in vocab.NUMERIC_SENTINELS)
    return f"(CASE WHEN {c} IS NULL OR {c} IN ({sentinels}) THEN NULL ELSE {br_decimal(expr)} END)"


def email_ok(expr: str) -> str:
    return f"regexp_matches({expr}, '{vocab.EMAIL_PATTERN}')"


def flags(pairs: list[tuple[str, str]]) -> str:
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in pairs) + ")"


def date_key(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS INTEGER)"


def dedup(src: str, keys: list[str], order: list[str], tie: list[str]) -> str:
    ob = ", ".join(order + [f"{c} ASC NULLS FIRST" for c in tie])
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {ob}) AS _rn FROM {src}) WHERE _rn = 1")


# ---------------------------------------------------------------- raw CTEs

def _raw_customers() -> str:
    k = "c_custkey"
    cid = code("C", k, 6)
    signup = f"(DATE '2020-01-01' + CAST({k} % 1500 AS INTEGER))"
    day = f"('2024-01-' || lpad(CAST({k} % 28 + 1 AS VARCHAR), 2, '0'))"
    base = f"""SELECT {k} AS _k,
      CASE WHEN {k} % 5 = 1 THEN lower({cid}) WHEN {k} % 5 = 2 THEN '  ' || {cid} || ' ' ELSE {cid} END AS customer_id,
      c_name AS nome_cliente,
      CASE WHEN {k} % 11 = 0 THEN NULL WHEN {k} % 7 = 0 THEN '' ELSE c_mktsegment END AS segmento,
      {pick(k, 6, L(["grande", "Média", "media", " PEQUENA ", None, "Micro"]))} AS porte,
      'Cidade ' || CAST(c_nationkey AS VARCHAR) AS cidade,
      {pick("c_nationkey", 8, L(["sao paulo", "SP", "Minas Gerais", "sta catarina", "Paraná", " rj ", "Goiás", "Tocantins"]))} AS estado,
      CASE WHEN {k} % 4 = 0 THEN {strf(signup, "yyyy-MM-dd")} WHEN {k} % 4 = 1 THEN {strf(signup, "dd/MM/yyyy")}
           WHEN {k} % 4 = 2 THEN {strf(signup, "yyyy/MM/dd")} WHEN {k} % 8 = 3 THEN '2025-13-40'
           ELSE {strf(signup, "dd/MM/yyyy")} || ' 10:30' END AS data_cadastro,
      CASE WHEN {k} % 17 = 0 THEN NULL WHEN {k} % 9 = 0 THEN 'cliente' || CAST({k} AS VARCHAR) || '@empresa'
           ELSE 'cliente' || CAST({k} AS VARCHAR) || '@empresa.com' END AS email,
      {pick(k, 4, L(["Ativo", " ativo", "INATIVO", None]))} AS status_cliente,
      {clock(day, k)} AS updated_at
    FROM customer"""
    cols = "customer_id, nome_cliente, segmento, porte, cidade, estado, data_cadastro, email, status_cliente, updated_at"
    return f"""raw_customers_base AS ({base}),
raw_customers AS (SELECT {cols} FROM raw_customers_base UNION ALL
  SELECT lower(trim(customer_id)), nome_cliente || ' (dup)', segmento, porte, cidade, estado, data_cadastro,
    CASE WHEN _k % 20 = 13 THEN 'invalid-email' ELSE email END, status_cliente,
    CASE WHEN _k % 20 = 3 THEN {clock("'2024-02-15'", "_k")} ELSE updated_at END
  FROM raw_customers_base WHERE _k % 10 = 3)"""


def _raw_products() -> str:
    k = "p_partkey"
    pid = code("P", k, 5)
    price = money("p_retailprice")
    day = f"('2024-06-' || lpad(CAST({k} % 28 + 1 AS VARCHAR), 2, '0'))"
    base = f"""SELECT {k} AS _k,
      CASE WHEN {k} % 5 = 1 THEN lower({pid}) ELSE {pid} END AS product_id,
      CASE WHEN {k} % 29 = 0 THEN NULL ELSE p_name END AS name,
      p_type AS category,
      CASE WHEN {k} % 6 = 0 THEN NULL ELSE p_brand END AS subcategory,
      {pick(k, 4, L(["Ativo", "INATIVO", None, " "]))} AS status,
      CASE WHEN {k} % 13 = 0 THEN 'N/A' WHEN {k} % 3 = 1 THEN {comma(price)} ELSE {price} END AS list_price,
      'BRL' AS currency,
      CASE WHEN {k} % 7 = 0 THEN NULL ELSE 'Fam ' || CAST(p_size % 10 AS VARCHAR) END AS family,
      p_brand || '|' || p_type AS tags,
      CASE WHEN {k} % 3 = 0 THEN {day} || 'T08:15:00' WHEN {k} % 3 = 1 THEN {day} || ' 08:15:00'
           ELSE strftime(CAST({day} AS DATE), '%d/%m/%Y') || ' 08:15' END AS updated_at
    FROM part"""
    cols = "product_id, name, category, subcategory, status, list_price, currency, family, tags, updated_at"
    return f"""raw_products_base AS ({base}),
raw_products AS (SELECT {cols} FROM raw_products_base UNION ALL
  SELECT lower(product_id), coalesce(name, 'Produto') || ' revisado', category, subcategory, status,
    list_price, currency, family, tags,
    CASE WHEN _k % 20 = 6 THEN '2024-07-30 12:00:00' ELSE 'not a date' END
  FROM raw_products_base WHERE _k % 10 = 6)"""


def _raw_channels() -> str:
    k = "n_nationkey"
    ch = code("CH", k, 2)
    base = f"""SELECT {k} AS _k,
      CASE WHEN {k} % 3 = 1 THEN lower({ch}) ELSE {ch} END AS id_canal,
      CASE WHEN {k} % 8 = 0 THEN NULL ELSE n_name END AS nome_canal,
      CASE WHEN {k} % 10 = 9 THEN NULL ELSE {pick(k, 4, L(["direto", "INDIRETO", " Digital ", "Parceiro"]))} END AS tipo_canal,
      {pick(k, 3, L(["Sim", "nao", "talvez"]))} AS ativo,
      CAST(NULL AS VARCHAR) AS observacao
    FROM nation"""
    return f"""raw_channels_base AS ({base}),
raw_channels AS (SELECT id_canal, nome_canal, tipo_canal, ativo, observacao FROM raw_channels_base UNION ALL
  SELECT id_canal, coalesce(nome_canal, '') || ' X', tipo_canal, ativo, 'Duplicado conflitante'
  FROM raw_channels_base WHERE _k % 5 = 0)"""


REGION_CODES = ["N", "NE", "SE", "S", "CO"]
REGION_STATES = ["amazonas", "Bahia", "sao paulo", "Santa Catarina", "Goiás"]


def _raw_regions() -> str:
    k = "r_regionkey"
    c = pick(k, 5, L(REGION_CODES))
    s = pick(k, 5, L(REGION_STATES))
    return f"""raw_regions AS (
  SELECT {c} AS regional_code, r_name AS regional_name, {s} AS state,
    'Gerente ' || CAST({k} AS VARCHAR) AS manager_name,
    CASE WHEN {k} % 2 = 0 THEN '1' ELSE '0' END AS active_flag FROM region
  UNION ALL
  SELECT CASE WHEN {k} = 3 THEN 'sul' ELSE lower({c}) || ' ' END, 'Região ' || r_name, upper({s}),
    'Gerente ' || CAST({k} AS VARCHAR), '1' FROM region)"""


def _raw_sellers() -> str:
    k = "s_suppkey"
    vid = code("V", k, 4)
    hire = f"(DATE '2015-01-01' + CAST({k} * 37 % 3000 AS INTEGER))"
    rc = pick("s_nationkey % 5", 5, L(["N", "NE", "SE", "sul", "CO"]))
    base = f"""SELECT {k} AS _k,
      CASE WHEN {k} % 4 = 1 THEN lower({vid}) ELSE {vid} END AS seller_id,
      s_name AS seller_name,
      CASE WHEN {k} % 9 = 0 THEN NULL WHEN {k} % 11 = 0 THEN 'CH99' ELSE {code("CH", "s_nationkey", 2)} END AS canal_id,
      CASE WHEN {k} % 13 = 0 THEN NULL ELSE {rc} END AS regional_code,
      {pick(k, 3, [strf(hire, "yyyy-MM-dd"), strf(hire, "dd/MM/yyyy"), strf(hire, "yyyy/MM/dd")])} AS hire_date,
      {pick(k, 5, L(["Ativo", "ATIVO ", "inativo", None, ""]))} AS status
    FROM supplier"""
    return f"""raw_sellers_base AS ({base}),
raw_sellers AS (SELECT seller_id, seller_name, canal_id, regional_code, hire_date, status FROM raw_sellers_base
  UNION ALL
  SELECT seller_id, CASE WHEN _k % 10 = 4 THEN seller_name || ' duplicado' ELSE seller_name END,
    CASE WHEN _k % 10 = 8 THEN 'CH98' ELSE canal_id END, regional_code, hire_date, status
  FROM raw_sellers_base WHERE _k % 10 = 4 OR _k % 10 = 8)"""


def _raw_orders() -> str:
    k = "o_orderkey"
    oid = code("O", k, 7)
    cust = code("C", "o_custkey", 6)
    od = "o_orderdate"
    gross = money("o_totalprice")
    disc = f"(CAST({k} % 500 AS VARCHAR) || '.' || lpad(CAST({k} % 100 AS VARCHAR), 2, '0'))"
    less = f"CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CAST({disc} AS DECIMAL(18,2)) AS VARCHAR)"
    net = (f"(CASE WHEN {k} % 23 = 0 THEN {gross} WHEN {k} % 101 = 0 THEN {less} || '5' "
           f"WHEN {k} = 5 THEN '{'9' * 40}' ELSE {less} END)")

    def amount(t):
        return f"(CASE WHEN {k} % 3 = 1 THEN {comma(t)} ELSE {t} END)"

    order_date = pick(k, 8, [strf(od, "yyyy-MM-dd'T'HH:mm:ss"), strf(od, "yyyy-MM-dd HH:mm:ss"),
                             strf(od, "dd/MM/yyyy HH:mm"), strf(od, "yyyy-MM-dd"), strf(od, "dd/MM/yyyy"),
                             strf(od, "yyyy/MM/dd"), "'2025-13-40'",
                             f"CASE WHEN {k} % 16 = 7 THEN '31/02/2025 10:00' ELSE {strf(od, 'yyyy-MM-dd')} END"])
    status = (f"CASE WHEN {k} % 29 = 0 THEN NULL WHEN {k} % 31 = 0 THEN 'devolvido' "
              f"WHEN o_orderstatus = 'F' THEN 'Faturado' "
              f"WHEN o_orderstatus = 'O' THEN CASE WHEN {k} % 2 = 0 THEN 'em separacao' ELSE 'EM_SEPARACAO' END "
              f"ELSE {pick(k, 3, L(['Entregue', 'cancelado', ' Cancelado ']))} END")
    payment = (f"CASE WHEN {k} % 43 = 0 THEN NULL WHEN {k} % 41 = 0 THEN 'not json' "
               f"ELSE '{{\"priority\": \"' || o_orderpriority || '\"' || "
               f"{pick(k, 3, L([', \"source\": \"web\"}', ', \"source\": \"app\"}', '}']))} END")
    base = f"""SELECT {k} AS _k,
      CASE WHEN {k} % 6 = 1 THEN lower({oid}) WHEN {k} % 6 = 2 THEN ' ' || {oid} || '  ' ELSE {oid} END AS order_id,
      CASE WHEN {k} % 53 = 0 THEN 'C9999' WHEN {k} % 4 = 1 THEN lower({cust}) ELSE {cust} END AS customer_code,
      {code("V", "o_custkey // 15", 4)} AS seller_id,
      {order_date} AS order_date,
      CASE WHEN {k} % 19 = 0 THEN NULL ELSE strftime(CAST({od} AS DATE) + 60, '%Y-%m-%d') END AS promised_date,
      {status} AS status_order,
      CASE WHEN {k} % 97 = 0 THEN 'N/A' ELSE {amount(gross)} END AS gross_amount,
      {amount(disc)} AS discount_amount,
      {amount(net)} AS net_amount,
      {payment} AS payment_details,
      {clock(strf(od, "yyyy-MM-dd"), k)} AS last_update
    FROM orders"""
    cols = ("order_id, customer_code, seller_id, order_date, promised_date, status_order, gross_amount, "
            "discount_amount, net_amount, payment_details, last_update")
    return f"""raw_orders_base AS ({base}),
raw_orders AS (SELECT {cols} FROM raw_orders_base UNION ALL
  SELECT lower(trim(order_id)), customer_code, seller_id, order_date, promised_date, 'Entregue',
    CASE WHEN _k % 20 = 11 THEN 'N/A' ELSE gross_amount END, discount_amount, net_amount, payment_details,
    CASE WHEN _k % 20 = 1 THEN {clock("'2002-01-01'", "_k")} ELSE last_update END
  FROM raw_orders_base WHERE _k % 10 = 1)"""


def _raw_items() -> str:
    oid = code("O", "l_orderkey", 7)
    qty = "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"
    r = "((l_orderkey + l_linenumber) % 50)"
    price = money("l_extendedprice")
    total = "(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS BIGINT))"
    return f"""raw_items AS (SELECT
      CASE WHEN l_linenumber % 2 = 0 THEN lower({oid}) ELSE {oid} END AS order_id,
      CAST(l_linenumber AS VARCHAR) AS item_seq,
      CASE WHEN l_suppkey % 17 = 0 THEN 'PX99999' ELSE {code("P", "l_partkey", 5)} END AS product_code,
      CASE WHEN {r} = 0 THEN '' WHEN {r} = 1 THEN '-' || {qty} WHEN {r} = 2 THEN '0'
           WHEN {r} = 3 THEN 'unknown' ELSE {qty} END AS quantity,
      CASE WHEN l_linenumber % 3 = 0 THEN {comma(price)} ELSE {price} END AS unit_price,
      CAST(CASE WHEN l_linenumber % 7 = 0 THEN {total} + 1 ELSE {total} END AS VARCHAR) AS total_item,
      CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'Cancelado'
           WHEN l_linestatus = 'O' THEN 'Ativo' ELSE ' ATIVO' END AS item_status
    FROM lineitem)"""


DEST_STATES = ["SP", "são paulo", "Rio de Janeiro", "s. catarina", "parana", "MG", "bahia", "Pernambuco"]


def _raw_deliveries() -> str:
    pk, sk = "l_partkey", "l_suppkey"
    oid = code("O", "l_orderkey", 7)
    shipped = "(CAST(l_shipdate AS DATE) - 3)"
    delivered = "(CAST(l_shipdate AS DATE) + l_linenumber)"
    status = (f"CASE WHEN {pk} % 31 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'Delivered' "
              f"WHEN l_returnflag = 'R' THEN 'atrasado' WHEN l_linestatus = 'O' THEN 'IN_TRANSIT' "
              f"ELSE 'cancelled' END")
    ship = pick(pk, 5, [strf(shipped, "yyyy-MM-dd'T'HH:mm:ss"), strf(shipped, "yyyy-MM-dd HH:mm:ss"),
                        strf(shipped, "dd/MM/yyyy HH:mm"), strf(shipped, "yyyy-MM-dd"),
                        f"CASE WHEN {pk} % 10 = 4 THEN '31/02/2025 10:00' ELSE {strf(shipped, 'dd/MM/yyyy')} END"])
    return f"""raw_deliveries AS (SELECT
      'D' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS delivery_id,
      CASE WHEN {pk} % 43 = 0 THEN NULL WHEN {pk} % 41 = 0 THEN 'OX9999999' WHEN {pk} % 3 = 0 THEN lower({oid})
           ELSE {oid} END AS order_ref,
      {status} AS delivery_status,
      CASE WHEN {pk} % 19 = 0 THEN 'unknown'
           ELSE CAST({pk} % 900 AS VARCHAR) || ',' || lpad(CAST({sk} % 100 AS VARCHAR), 2, '0') END AS cost,
      CASE WHEN {sk} % 7 = 6 THEN NULL ELSE 'Carrier ' || CAST({sk} % 7 AS VARCHAR) END AS carrier_name,
      {pick(sk, 5, L(["Rodoviário", "rodoviario", "AÉREO", "aereo", None]))} AS carrier_mode,
      {ship} AS shipped_at,
      CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE {strf(delivered, "yyyy-MM-dd HH:mm:ss")} END AS delivered_at,
      {pick(sk, 8, L(DEST_STATES))} AS dest_state,
      'Cidade ' || CAST({sk} % 20 AS VARCHAR) AS dest_city
    FROM lineitem)"""


def _raw_tickets() -> str:
    k = "event_id"
    oid = code("O", k, 7)
    cust = code("C", "user_id", 6)
    return f"""raw_tickets AS (SELECT
      'T' || CAST({k} AS VARCHAR) AS ticket_id,
      CASE WHEN {k} % 2 = 0 THEN lower({oid}) ELSE {oid} END AS order_id,
      CASE WHEN {k} % 23 = 0 THEN NULL WHEN {k} % 3 = 0 THEN lower({cust}) ELSE {cust} END AS customer_code,
      CASE WHEN {k} % 41 = 0 THEN NULL WHEN {k} % 37 = 0 THEN 'escalation'
           WHEN event_type = 'view' THEN 'Delay' WHEN event_type = 'signup' THEN 'TROCA'
           WHEN event_type = 'error' THEN ' refund ' WHEN event_type = 'click' THEN 'Complaint'
           ELSE 'cancel_request' END AS event_type,
      CASE WHEN {k} % 13 = 0 THEN NULL WHEN value < 5 THEN 'Low' WHEN value < 10 THEN ' MEDIUM'
           ELSE 'high' END AS severity,
      CASE WHEN {k} % 17 = 0 THEN '' ELSE {pick(k, 3, L(["Open", "closed", " OPEN "]))} END AS status,
      {pick(k, 4, [strf("ts", "yyyy-MM-dd HH:mm:ss"), strf("ts", "dd/MM/yyyy HH:mm"),
                   strf("ts", "yyyy-MM-dd"), strf("ts", "dd/MM/yyyy")])} AS created_at,
      props AS metadata
    FROM events)"""


# ---------------------------------------------------------------- silver CTEs

def _products_clean() -> str:
    return f"""products_clean AS (SELECT *, {flags([("missing_name", "name IS NULL"),
                                                    ("invalid_or_missing_list_price", "list_price IS NULL")])} AS _dq_flags
  FROM (SELECT {key("product_id")} AS product_id, name, category,
      coalesce(trim(subcategory), '{NI}') AS subcategory, {lower_std("status")} AS status, currency,
      coalesce(trim(family), '{NI}') AS family, tags, {parse_ts("updated_at")} AS updated_at,
      {safe_double("list_price")} AS list_price
    FROM raw_products))"""


def _silver_products() -> str:
    return "silver_products AS (" + dedup(
        "products_clean", ["product_id"], ["updated_at DESC NULLS LAST"],
        ["name", "category", "subcategory", "status", "currency", "family", "updated_at", "list_price"]) + ")"


def _silver_channels() -> str:
    src = f"""(SELECT {key("id_canal")} AS id_canal, coalesce(trim(nome_canal), '{NI}') AS nome_canal,
      {enum("tipo_canal", vocab.CHANNEL_TYPE)} AS tipo_canal,
      CASE WHEN lower(trim(ativo)) = 'sim' THEN TRUE WHEN lower(trim(ativo)) = 'nao' THEN FALSE END AS ativo,
      observacao FROM raw_channels)"""
    return "silver_channels AS (" + dedup(
        src, ["id_canal"], ["contains(lower(coalesce(observacao, '')), 'duplicado') ASC NULLS FIRST"],
        ["nome_canal", "tipo_canal", "ativo", "observacao"]) + ")"


def _silver_regions() -> str:
    src = f"""(SELECT {regional("regional_code")} AS regional_code, regional_name,
      {state_uf("state")} AS state_uf, manager_name, active_flag = '1' AS active_flag FROM raw_regions)"""
    return "silver_regions AS (" + dedup(
        src, ["regional_code"], ["(NOT starts_with(lower(regional_name), 'região')) DESC NULLS LAST"],
        ["regional_name", "state_uf", "manager_name", "active_flag"]) + ")"


def _silver_sellers() -> str:
    src = f"""(SELECT *, CASE WHEN canal_id IS NOT NULL THEN canal_id IN (SELECT {key("id_canal")} FROM raw_channels WHERE id_canal IS NOT NULL) END AS _canal_valid
    FROM (SELECT {key("seller_id")} AS seller_id, seller_name,
      coalesce({key("canal_id")}, '{NI}') AS canal_id,
      coalesce({regional("regional_code")}, '{NI}') AS regional_code,
      {parse_date("hire_date")} AS hire_date, {lower_std("status")} AS status FROM raw_sellers))"""
    return "silver_sellers AS (SELECT * EXCLUDE (_canal_valid) FROM (" + dedup(
        src, ["seller_id"], ["contains(lower(seller_name), 'duplicado') ASC NULLS FIRST",
                             "_canal_valid DESC NULLS LAST"],
        ["seller_name", "canal_id", "regional_code", "hire_date", "status", "_canal_valid"]) + "))"


def _customers_clean() -> str:
    return f"""customers_clean AS (SELECT *,
    {flags([("invalid_email_format", f"email IS NOT NULL AND NOT {email_ok('email')}")])} AS _dq_flags
  FROM (SELECT {key("customer_id")} AS customer_id, nome_cliente,
      coalesce(trim(segmento), '{NI}') AS segmento, {enum("porte", vocab.CUSTOMER_SIZE)} AS porte,
      cidade, {state_uf("estado")} AS estado_uf, {parse_date("data_cadastro")} AS data_cadastro,
      email, {lower_std("status_cliente")} AS status_cliente, {parse_ts("updated_at")} AS updated_at
    FROM raw_customers))"""


def _silver_customers() -> str:
    return "silver_customers AS (" + dedup(
        "customers_clean", ["customer_id"],
        ["updated_at DESC NULLS LAST", f"{email_ok('email')} DESC NULLS LAST"],
        ["nome_cliente", "segmento", "porte", "cidade", "estado_uf", "data_cadastro", "email",
         "status_cliente", "updated_at"]) + ")"


def _orders_clean() -> str:
    pd = "payment_details"
    pj = lambda f: f"CASE WHEN json_valid({pd}) THEN json_extract_string({pd}, '$.{f}') END"
    return f"""orders_clean AS (SELECT *, {flags([
        ("invalid_or_missing_order_date", "order_date IS NULL"),
        ("net_amount_mismatch", "abs(net_amount - net_amount_calculado) > 0.01"),
        ("placeholder_customer", f"customer_code = '{vocab.PLACEHOLDER_CUSTOMER}'")])} AS _dq_flags
  FROM (SELECT *, gross_amount - discount_amount AS net_amount_calculado FROM (
    SELECT {key("order_id")} AS order_id, {key("customer_code")} AS customer_code, {key("seller_id")} AS seller_id,
      {enum("status_order", vocab.ORDER_STATUS)} AS status_order,
      {br_decimal("gross_amount")} AS gross_amount, {br_decimal("discount_amount")} AS discount_amount,
      {br_decimal("net_amount")} AS net_amount,
      {parse_date("order_date")} AS order_date, {parse_date("promised_date")} AS promised_date,
      {parse_ts("last_update")} AS last_update,
      coalesce({pj("priority")}, '{NI}') AS priority, coalesce({pj("source")}, '{NI}') AS source
    FROM raw_orders)))"""


def _silver_orders() -> str:
    return "silver_orders AS (" + dedup(
        "orders_clean", ["order_id"],
        ["last_update DESC NULLS LAST", "(gross_amount IS NOT NULL) DESC NULLS LAST",
         "(order_date IS NOT NULL) DESC NULLS LAST"],
        ["customer_code", "seller_id", "status_order", "gross_amount", "discount_amount", "net_amount",
         "order_date", "promised_date", "last_update", "priority", "source", "net_amount_calculado"]) + ")"


def _items_clean() -> str:
    return f"""items_clean AS (SELECT *, {flags([
        ("missing_quantity", "quantity IS NULL"), ("negative_quantity", "quantity < 0"),
        ("zero_quantity", "quantity = 0"),
        ("total_item_mismatch", "abs(total_item - total_item_calculado) > 0.01")])} AS _dq_flags
  FROM (SELECT *, quantity * unit_price AS total_item_calculado FROM (
    SELECT {key("order_id")} AS order_id, TRY_CAST(trim(item_seq) AS INTEGER) AS item_seq,
      {key("product_code")} AS product_code, {safe_double("quantity")} AS quantity,
      {br_decimal("unit_price")} AS unit_price, {safe_double("total_item")} AS total_item,
      {lower_std("item_status")} AS item_status
    FROM raw_items)))"""


def _silver_items() -> str:
    src = f"""(SELECT *, CASE WHEN product_code IS NOT NULL THEN product_code IN (SELECT {key("product_id")} FROM raw_products WHERE product_id IS NOT NULL) END AS _product_valid FROM items_clean)"""
    return "silver_items AS (SELECT * EXCLUDE (_product_valid) FROM (" + dedup(
        src, ["order_id", "item_seq"], ["_product_valid DESC NULLS LAST", "quantity DESC NULLS LAST"],
        ["product_code", "quantity", "unit_price", "total_item", "item_status", "total_item_calculado",
         "_product_valid"]) + "))"


def _silver_deliveries() -> str:
    src = f"""(SELECT *, {flags([("invalid_or_missing_shipped_at", "shipped_at IS NULL"),
                                ("orphan_order_ref", "NOT _order_valid")])} AS _dq_flags
  FROM (SELECT *, CASE WHEN order_ref IS NOT NULL THEN order_ref IN (SELECT {key("order_id")} FROM raw_orders WHERE order_id IS NOT NULL) END AS _order_valid
    FROM (SELECT delivery_id, {key("order_ref")} AS order_ref, carrier_name,
      {enum("carrier_mode", vocab.CARRIER_MODE)} AS carrier_mode,
      {enum("delivery_status", vocab.DELIVERY_STATUS)} AS delivery_status,
      {state_uf("dest_state")} AS destination_state_uf, dest_city AS destination_city,
      {safe_double("cost")} AS cost, {parse_ts("shipped_at")} AS shipped_at,
      {parse_ts("delivered_at")} AS delivered_at
    FROM raw_deliveries)))"""
    return "silver_deliveries AS (SELECT * EXCLUDE (_order_valid) FROM (" + dedup(
        src, ["delivery_id"], ["(shipped_at IS NOT NULL) DESC NULLS LAST", "_order_valid DESC NULLS LAST"],
        ["order_ref", "carrier_name", "carrier_mode", "delivery_status", "destination_state_uf",
         "destination_city", "cost", "shipped_at", "delivered_at", "_order_valid"]) + "))"


def _silver_tickets() -> str:
    return f"""silver_tickets AS (SELECT ticket_id, {key("order_id")} AS order_id,
    coalesce({key("customer_code")}, '{NI}') AS customer_code,
    {enum("event_type", vocab.EVENT_TYPE)} AS event_type, {lower_std("severity")} AS severity,
    {lower_std("status")} AS status, metadata, {parse_ts("created_at")} AS created_at,
    {flags([("time_missing_assumed_midnight", "NOT contains(created_at, ':')")])} AS _dq_flags
  FROM raw_tickets)"""


# ---------------------------------------------------------------- gold CTEs

def _dim_cliente() -> str:
    return f"""dim_cliente AS (
  SELECT customer_id, nome_cliente, segmento, porte, cidade, estado_uf, data_cadastro, email, status_cliente
  FROM silver_customers
  UNION ALL SELECT '{vocab.UNKNOWN_CUSTOMER}', 'Cliente Desconhecido', '{NI}', '{NI}', '{NI}', '{NI}',
    NULL, NULL, '{NI}')"""


def _dim_produto() -> str:
    return f"""dim_produto AS (
  SELECT product_id, name, category, subcategory, status, list_price, currency, family FROM silver_products
  UNION ALL SELECT '{vocab.UNKNOWN_PRODUCT}', 'Produto Desconhecido', '{NI}', '{NI}', '{NI}', NULL, '{NI}', '{NI}')"""


def _dim_vendedor() -> str:
    return f"""dim_vendedor AS (SELECT v.seller_id, v.seller_name, v.status, v.hire_date, v.canal_id,
    coalesce(c.nome_canal, '{NI}') AS canal_nome, coalesce(c.tipo_canal, '{NI}') AS canal_tipo,
    v.regional_code, coalesce(r.regional_name, '{NI}') AS regional_name,
    coalesce(r.state_uf, '{NI}') AS regional_state_uf
  FROM silver_sellers v LEFT JOIN silver_channels c ON v.canal_id = c.id_canal
  LEFT JOIN silver_regions r ON v.regional_code = r.regional_code)"""


def _dim_data() -> str:
    return """date_bounds AS (SELECT min(d) AS mn, max(d) AS mx FROM (
    SELECT order_date AS d FROM silver_orders UNION ALL SELECT promised_date FROM silver_orders
    UNION ALL SELECT CAST(shipped_at AS DATE) FROM silver_deliveries
    UNION ALL SELECT CAST(delivered_at AS DATE) FROM silver_deliveries
    UNION ALL SELECT CAST(created_at AS DATE) FROM silver_tickets)),
dim_data AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
    strftime(d, '%B') AS month_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
    CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
    strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(mn, mx, INTERVAL 1 DAY)) AS DATE) AS d FROM date_bounds
        WHERE mn IS NOT NULL))"""


def _customer_valid(col: str) -> str:
    return (f"CASE WHEN {col} IS NOT NULL THEN {col} IN (SELECT customer_id FROM dim_cliente "
            f"WHERE customer_id IS NOT NULL) END")


def _fact_pedidos() -> str:
    return f"""deliveries_by_order AS (SELECT order_ref, max(delivered_at) AS delivered_at, max(shipped_at) AS shipped_at
  FROM silver_deliveries GROUP BY order_ref),
fact_pedidos AS (SELECT p.order_id,
    CASE WHEN {_customer_valid("p.customer_code")} THEN p.customer_code ELSE '{vocab.UNKNOWN_CUSTOMER}' END AS customer_id,
    p.seller_id, {date_key("p.order_date")} AS order_date_key, p.order_date, p.promised_date, p.status_order,
    p.priority, p.source, p.gross_amount, p.discount_amount, p.net_amount,
    p.status_order = 'cancelado' AS is_cancelado, e.delivered_at,
    CASE WHEN e.delivered_at IS NOT NULL AND p.promised_date IS NOT NULL
         THEN CAST(e.delivered_at AS DATE) > p.promised_date END AS is_atrasado
  FROM silver_orders p LEFT JOIN deliveries_by_order e ON p.order_id = e.order_ref)"""


def _fact_pedidos_itens() -> str:
    pv = ("CASE WHEN i.product_code IS NOT NULL THEN i.product_code IN (SELECT product_id FROM dim_produto "
          "WHERE product_id IS NOT NULL) END")
    return f"""fact_pedidos_itens AS (SELECT i.order_id, i.item_seq,
    CASE WHEN {pv} THEN i.product_code ELSE '{vocab.UNKNOWN_PRODUCT}' END AS product_id,
    CASE WHEN {_customer_valid("p.customer_code")} THEN p.customer_code ELSE '{vocab.UNKNOWN_CUSTOMER}' END AS customer_id,
    p.seller_id, {date_key("p.order_date")} AS order_date_key, i.quantity, i.unit_price, i.total_item, i.item_status
  FROM silver_items i JOIN silver_orders p ON i.order_id = p.order_id)"""


def _fact_entregas() -> str:
    return f"""fact_entregas AS (SELECT delivery_id, order_ref, carrier_name, carrier_mode, delivery_status,
    shipped_at, delivered_at, {date_key("shipped_at")} AS shipped_date_key, destination_state_uf,
    destination_city, cost,
    CASE WHEN shipped_at IS NOT NULL AND delivered_at IS NOT NULL
         THEN CAST(date_diff('day', CAST(shipped_at AS DATE), CAST(delivered_at AS DATE)) AS INTEGER) END AS lead_time_dias
  FROM silver_deliveries)"""


def _fact_ocorrencias() -> str:
    return f"""fact_ocorrencias AS (SELECT ticket_id, order_id,
    CASE WHEN {_customer_valid("customer_code")} THEN customer_code ELSE '{vocab.UNKNOWN_CUSTOMER}' END AS customer_id,
    event_type, severity, status, created_at, {date_key("created_at")} AS created_date_key,
    status = 'open' AS is_aberto
  FROM silver_tickets)"""


# name -> (builder, dependencies)
CTES = {
    "raw_customers": (_raw_customers, []),
    "raw_products": (_raw_products, []),
    "raw_channels": (_raw_channels, []),
    "raw_regions": (_raw_regions, []),
    "raw_sellers": (_raw_sellers, []),
    "raw_orders": (_raw_orders, []),
    "raw_items": (_raw_items, []),
    "raw_deliveries": (_raw_deliveries, []),
    "raw_tickets": (_raw_tickets, []),
    "products_clean": (_products_clean, ["raw_products"]),
    "silver_products": (_silver_products, ["products_clean"]),
    "silver_channels": (_silver_channels, ["raw_channels"]),
    "silver_regions": (_silver_regions, ["raw_regions"]),
    "silver_sellers": (_silver_sellers, ["raw_sellers", "raw_channels"]),
    "customers_clean": (_customers_clean, ["raw_customers"]),
    "silver_customers": (_silver_customers, ["customers_clean"]),
    "orders_clean": (_orders_clean, ["raw_orders"]),
    "silver_orders": (_silver_orders, ["orders_clean"]),
    "items_clean": (_items_clean, ["raw_items"]),
    "silver_items": (_silver_items, ["items_clean", "raw_products"]),
    "silver_deliveries": (_silver_deliveries, ["raw_deliveries", "raw_orders"]),
    "silver_tickets": (_silver_tickets, ["raw_tickets"]),
    "dim_cliente": (_dim_cliente, ["silver_customers"]),
    "dim_produto": (_dim_produto, ["silver_products"]),
    "dim_canal": (lambda: "dim_canal AS (SELECT id_canal, nome_canal, tipo_canal, ativo FROM silver_channels)",
                  ["silver_channels"]),
    "dim_regiao": (lambda: "dim_regiao AS (SELECT regional_code, regional_name, state_uf, manager_name, "
                           "active_flag FROM silver_regions)", ["silver_regions"]),
    "dim_vendedor": (_dim_vendedor, ["silver_sellers", "silver_channels", "silver_regions"]),
    "dim_data": (_dim_data, ["silver_orders", "silver_deliveries", "silver_tickets"]),
    "fact_pedidos": (_fact_pedidos, ["silver_orders", "silver_deliveries", "dim_cliente"]),
    "fact_pedidos_itens": (_fact_pedidos_itens, ["silver_items", "silver_orders", "dim_cliente",
                                                 "dim_produto"]),
    "fact_entregas": (_fact_entregas, ["silver_deliveries"]),
    "fact_ocorrencias": (_fact_ocorrencias, ["silver_tickets", "dim_cliente"]),
}


def with_ctes(needed: list[str], final: str) -> str:
    """Prefix ``final`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    return "WITH " + ",\n".join(CTES[n][0]() for n in order) + "\n" + final


def exported(cte: str, columns: list[tuple[str, str]]) -> str:
    """SELECT rendering columns like ``starloom.plans.star.export``.

    ``columns``: (name, kind) with kind in ts/date/plain."""
    sel = []
    for name, kind in columns:
        if kind == "ts":
            sel.append(f"strftime({name}, '{TS_OUT}') AS {name}")
        elif kind == "date":
            sel.append(f"strftime({name}, '%Y-%m-%d') AS {name}")
        else:
            sel.append(name)
    return with_ctes([cte], f"SELECT {', '.join(sel)} FROM {cte}")
