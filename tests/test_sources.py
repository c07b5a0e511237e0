"""Readers for the source formats, the workbook source and layer writers."""

import gzip
import io
import json
import os
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.plans import silver as S
from starloom.sources import layers as B
from starloom.sources import readers as R
from starloom.sources.workbook import parse_xlsx, read_workbooks, write_workbooks


def test_json_array_with_mixed_number_and_text(spark, tmp_dir):
    docs = [
        {"product": {"product_id": "p0001", "name": "A", "category": "c", "subcategory": None, "status": "Ativo"},
         "pricing": {"list_price": 376.26, "currency": "BRL"}, "attributes": {"family": None, "tags": ["x"]},
         "updated_at": "2025-01-01T10:00:00"},
        {"product": {"product_id": "P9999", "name": None, "category": "c", "subcategory": "s", "status": None},
         "pricing": {"list_price": "N/A", "currency": "BRL"}, "attributes": {"family": "f", "tags": []},
         "updated_at": "2025-01-02"},
    ]
    with open(os.path.join(tmp_dir, "dump.json"), "w") as fh:
        json.dump(docs, fh, indent=2)
    df = R.read_json_array(spark, tmp_dir, R.PRODUCTS_SCHEMA)
    out = {r["product_id"]: r for r in S.silver_products(df).collect()}
    assert out["P0001"]["list_price"] == 376.26 and out["P9999"]["list_price"] is None
    assert list(out["P9999"]["_dq_flags"]) == ["missing_name", "invalid_or_missing_list_price"]


def test_csv_with_json_cell_and_comma_decimals(spark, tmp_dir):
    text = ('order_id;customer_code;seller_id;order_date;promised_date;status_order;gross_amount;'
            'discount_amount;net_amount;payment_details;last_update\n'
            'o00001;c0001;V001;2025-01-02;2025-01-10;Em Separacao;"1274,78";0;"1274,78";'
            '"{""priority"": ""alta"", ""source"": ""app""}";2025-01-02 10:00:00\n'
            'O00002;C9999;V001;2025-13-40;;;N/A;;;;\n')
    with open(os.path.join(tmp_dir, "orders.csv"), "w") as fh:
        fh.write(text)
    df = R.read_delimited(spark, tmp_dir, R.ORDERS_SCHEMA, sep=";")
    out = {r["order_id"]: r for r in S.silver_orders(df).collect()}
    assert out["O00001"]["gross_amount"] == 1274.78 and out["O00001"]["priority"] == "alta"
    assert out["O00001"]["status_order"] == "em_separacao"
    assert list(out["O00002"]["_dq_flags"]) == ["invalid_or_missing_order_date", "placeholder_customer"]


def test_pipe_file_short_row(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "r.txt"), "w") as fh:
        fh.write("regional_code|regional_name|state|manager_name|active_flag\nsul|Região Sul|sc|M|1\n"
                 "S|Sul|Santa Catarina|M|1\nXX\n")
    out = {r["regional_code"]: r for r in S.silver_regions(R.read_delimited(spark, tmp_dir, R.REGIONS_SCHEMA,
                                                                            sep="|")).collect()}
    assert out["S"]["regional_name"] == "Sul" and out["S"]["state_uf"] == "SC"
    assert out["XX"]["regional_name"] is None and out["XX"]["state_uf"] is None


def _shared_strings_workbook() -> bytes:
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets>'
                   f'<sheet name="outra" sheetId="1" r:id="rId1"/><sheet name="canais" sheetId="2" r:id="rId2"/>'
                   f'</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
                   '<Relationship Id="rId2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}"><si><t>id_canal</t></si><si><t>nome_canal</t></si>'
                   f'<si><t>ativo</t></si><si><t>CH01</t></si><si><r><t>Loja </t></r><r><t>Web</t></r></si>'
                   f'<si><t>Sim</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{ns}"><sheetData/></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{ns}"><sheetData>'
                   '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="s"><v>2</v></c></row>'
                   '<row r="2"><c r="A2" t="s"><v>3</v></c><c r="B2" t="s"><v>4</v></c><c r="D2" t="s"><v>5</v></c></row>'
                   '<row r="3"><c r="A3" t="inlineStr"><is><t>CH02</t></is></c><c r="B3"><v>42</v></c></row>'
                   '</sheetData></worksheet>')
    return buf.getvalue()


def test_workbook_shared_strings_and_sheet_by_name(spark, tmp_dir):
    data = _shared_strings_workbook()
    rows = parse_xlsx(data, "canais")
    assert rows[1] == ["CH01", "Loja Web", None, "Sim"] and rows[2] == ["CH02", "42"]
    with open(os.path.join(tmp_dir, "canais.xlsx"), "wb") as fh:
        fh.write(data)
    df = read_workbooks(spark, tmp_dir, R.CHANNELS_SCHEMA, sheet="canais")
    got = {r["id_canal"]: (r["nome_canal"], r["ativo"], r["tipo_canal"]) for r in df.collect()}
    assert got == {"CH01": ("Loja Web", "Sim", None), "CH02": ("42", None, None)}


def test_workbook_write_read_round_trip(spark, tmp_dir):
    src = spark.createDataFrame([("CH01", "A & B", None, "sim", None), ("ch02", " x ", "digital", None, "obs")],
                                R.CHANNELS_SCHEMA).repartition(2)
    assert write_workbooks(src, tmp_dir, sheet="canais") >= 1
    back = read_workbooks(spark, tmp_dir, R.CHANNELS_SCHEMA, sheet="canais")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, src.collect()), key=str)


def test_layer_writer_counts_with_observe(spark, tmp_dir):
    df = spark.range(0, 1234).select(F.col("id").cast("string").alias("v"))
    n = B.write_table(B.with_ingest_columns(df, "src.csv"), tmp_dir, "bronze", "t")
    assert n == 1234
    back = B.read_table(spark, tmp_dir, "bronze", "t")
    assert set(back.columns) == {"v", "_ingested_at", "_source_file"}
    counts = B.layer_counts(spark, tmp_dir, "bronze", ["t"]).collect()
    assert counts[0]["rows"] == 1234


def test_ingest_columns_use_file_path(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as fh:
        fh.write("x\n1\n")
    df = spark.read.option("header", True).csv(tmp_dir)
    row = B.with_ingest_columns(df).first()
    assert row["_source_file"].endswith("a.csv")


def test_workbook_streams_in_chunks(spark, tmp_dir):
    src = spark.createDataFrame([(f"CH{i:02d}", f"n{i}", None, "sim", None) for i in range(23)],
                                R.CHANNELS_SCHEMA).coalesce(1)
    write_workbooks(src, tmp_dir)
    back = read_workbooks(spark, tmp_dir, R.CHANNELS_SCHEMA, chunk_rows=4)
    assert sorted(r["id_canal"] for r in back.collect()) == [f"CH{i:02d}" for i in range(23)]


def test_leftover_attempt_files_are_invisible(spark, tmp_dir):
    """A failed sink attempt leaves only a hidden temp file; readers skip it."""
    from starloom.sources.writers import write_json_array
    src = spark.createDataFrame([("CH01", "A", None, "sim", None)], R.CHANNELS_SCHEMA)
    write_json_array(src, os.path.join(tmp_dir, "json"))
    write_workbooks(src, os.path.join(tmp_dir, "xlsx"))
    for sub, name in [("json", ".part-00007.json.attempt-9.tmp"), ("xlsx", ".part-00007.xlsx.attempt-9.tmp")]:
        with open(os.path.join(tmp_dir, sub, name), "w") as fh:
            fh.write("[{\"id_canal\": \"BROKEN")   # truncated partial write
    assert [r["id_canal"] for r in R.read_json_array(spark, os.path.join(tmp_dir, "json"), R.CHANNELS_SCHEMA).collect()] == ["CH01"]
    assert [r["id_canal"] for r in read_workbooks(spark, os.path.join(tmp_dir, "xlsx"), R.CHANNELS_SCHEMA).collect()] == ["CH01"]


def _styled_workbook(date1904: bool = False) -> bytes:
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        pr = '<workbookPr date1904="1"/>' if date1904 else ""
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="{rel}">{pr}<sheets>'
                   f'<sheet name="clientes" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{ns}">'
                   '<numFmts count="2"><numFmt numFmtId="164" formatCode="dd/mm/yyyy hh:mm"/>'
                   '<numFmt numFmtId="165" formatCode="&quot;day&quot; 0.00"/></numFmts>'
                   '<cellXfs count="4"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/>'
                   '</cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{ns}"><sheetData>'
                   '<row r="1"><c r="A1" t="inlineStr"><is><t>customer_id</t></is></c>'
                   '<c r="B1" t="inlineStr"><is><t>data_cadastro</t></is></c>'
                   '<c r="C1" t="inlineStr"><is><t>updated_at</t></is></c>'
                   '<c r="D1" t="inlineStr"><is><t>cidade</t></is></c></row>'
                   '<row r="2"><c r="A2" t="inlineStr"><is><t>c0001</t></is></c>'
                   '<c r="B2" s="1"><v>45678</v></c><c r="C2" s="2"><v>45678.5</v></c>'
                   '<c r="D2" s="3"><v>42</v></c></row>'
                   '</sheetData></worksheet>')
    return buf.getvalue()


def test_workbook_date_cells_become_parseable_text(spark, tmp_dir):
    data = _styled_workbook()
    rows = parse_xlsx(data)
    assert rows[1] == ["c0001", "2025-01-21 00:00:00", "2025-01-21 12:00:00", "42"]
    with open(os.path.join(tmp_dir, "crm.xlsx"), "wb") as fh:
        fh.write(data)
    raw = read_workbooks(spark, tmp_dir, R.CUSTOMERS_SCHEMA)
    out = S.silver_customers(raw).collect()[0]
    import datetime as dt
    assert out["data_cadastro"] == dt.date(2025, 1, 21)
    assert out["updated_at"].strftime("%Y-%m-%d %H:%M:%S") == "2025-01-21 12:00:00"
    assert out["customer_id"] == "C0001" and out["cidade"] == "42"


def test_workbook_1904_date_system():
    rows = parse_xlsx(_styled_workbook(date1904=True))
    assert rows[1][1] == "2029-01-22 00:00:00"   # same serial, 1462 days later


def test_files_of_one_source_with_different_headers(spark, tmp_dir):
    at = os.path.join(tmp_dir, "mixed")
    os.makedirs(at)
    texts = {"a.csv": "x,y\n1,2\n", "b.csv": "y,x\n3,4\n", "c.csv": "x\n5\n", "d.csv": "", "e.csv": "x,y\r\n6,7\r\n", "_skipped": "y,x\n8,9\n"}
    for name, text in texts.items():
        with open(os.path.join(at, name), "w", newline="") as f:
            f.write(text)
    with gzip.open(os.path.join(at, "g.csv.gz"), "wt") as f:
        f.write("z,y,x\n10,11,12\n")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "xy"])
    got = R.read_delimited(spark, at, schema, keep_file=True)
    assert sorted((r["x"], r["y"], r["_source_file"].rsplit("/", 1)[1]) for r in got.collect()) == [
        ("1", "2", "a.csv"), ("12", "11", "g.csv.gz"), ("4", "3", "b.csv"), ("5", None, "c.csv"), ("6", "7", "e.csv")]
    assert len(R.header_groups(spark, at)) == 4 and len(R.header_groups(spark, f"{at}/[ab].csv")) == 2
    assert R.read_delimited(spark, f"{at}/none*", schema, keep_corrupt=True).count() == 0
    bronze = B.with_ingest_columns(got)
    assert bronze.columns == ["x", "y", "_source_file", "_ingested_at"]
