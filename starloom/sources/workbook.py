"""Spreadsheet (xlsx) source and sink without openpyxl.

Reading: ``binaryFile`` lists the workbooks, ``mapInPandas`` parses each one
inside a task with the standard library (``zipfile`` + ``xml.etree``
``iterparse``), so workbooks are read in parallel, one task per file, never
on the driver, and a sheet is streamed row by row into bounded pandas
chunks rather than held as one XML tree.
Every cell comes back as text under the declared schema; a missing or empty
cell is null (never NaN).  Shared strings, inline strings, booleans and
plain numbers are supported; numeric cells styled with a date format become
'yyyy-MM-dd HH:mm:ss' text (the strict date parser accepts it); formulas
return their cached value.

Writing (used to produce workbook inputs from data): each partition becomes
one workbook file, streamed batch by batch into the zip entry by its task
under a deterministic name, so a retried task overwrites its own file.
"""

from __future__ import annotations

import datetime as _dt
import io
import os
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.session import ship_package

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _first_sheet_path(z: zipfile.ZipFile, sheet: str | None) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheets = wb.findall("m:sheets/m:sheet", _NS)
    if not sheets:
        raise ValueError("workbook has no sheets")
    chosen = sheets[0]
    if sheet is not None:
        named = [s for s in sheets if s.get("name") == sheet]
        if not named:
            raise ValueError(f"sheet {sheet!r} not found")
        chosen = named[0]
    rid = chosen.get(f"{{{_REL_NS}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels:
        if rel.get("Id") == rid:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else "xl/" + target
    return "xl/worksheets/sheet1.xml"


# Built-in spreadsheet number-format ids that render as dates/times.
_BUILTIN_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_EPOCH = _dt.datetime(1899, 12, 30)  # day 0 of the 1900 date system (1900 leap-year bug included)
_EPOCH_1904 = _dt.datetime(1904, 1, 1)  # day 0 when the workbook sets date1904


def _is_date_code(code: str) -> bool:
    """A custom format renders a date if, outside quoted text and [..]
    sections, it uses day/month/year/hour/second tokens."""
    bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code or "").lower()
    return bool(re.search(r"[dmyhs]", bare))


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles (``s`` attribute) whose number format is a date."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))  # style table: small, bounded by styles not rows
    date_ids = set(_BUILTIN_DATE_FORMATS)
    for nf in root.findall("m:numFmts/m:numFmt", _NS):
        if _is_date_code(nf.get("formatCode")):
            date_ids.add(int(nf.get("numFmtId")))
    xfs = root.findall("m:cellXfs/m:xf", _NS)
    return {i for i, xf in enumerate(xfs) if int(xf.get("numFmtId", "0")) in date_ids}


def _date_epoch(z: zipfile.ZipFile) -> _dt.datetime:
    pr = ET.fromstring(z.read("xl/workbook.xml")).find("m:workbookPr", _NS)
    flag = (pr.get("date1904") if pr is not None else None) or "0"
    return _EPOCH_1904 if flag.lower() in ("1", "true") else _EPOCH


def _serial_to_text(value: str, epoch: _dt.datetime = _EPOCH) -> str:
    """Date serial -> 'yyyy-MM-dd HH:mm:ss' (to the nearest second)."""
    stamp = epoch + _dt.timedelta(seconds=round(float(value) * 86400))
    return stamp.strftime("%Y-%m-%d %H:%M:%S")


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    with z.open("xl/sharedStrings.xml") as fh:
        for _, el in ET.iterparse(fh):
            if el.tag == f"{{{_NS['m']}}}si":
                out.append("".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t")))
                el.clear()
    return out


def iter_xlsx_rows(data: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """Rows of one sheet as lists of text cells (None for empty), streamed
    with ``iterparse`` so a large sheet is never held as one XML tree."""
    z = zipfile.ZipFile(io.BytesIO(data))
    shared = _shared_strings(z)
    date_styles = _date_styles(z)
    epoch = _date_epoch(z) if date_styles else _EPOCH
    m = f"{{{_NS['m']}}}"
    with z.open(_first_sheet_path(z, sheet)) as fh:
        for _, row in ET.iterparse(fh):
            if row.tag != f"{m}row":
                continue
            cells: dict[int, str | None] = {}
            for pos, c in enumerate(row.findall(f"{m}c")):
                ref = c.get("r")
                idx = _col_index(_CELL_REF.match(ref).group(1)) if ref else pos
                kind = c.get("t")
                if kind == "inlineStr":
                    node = c.find(f"{m}is")
                    val = "".join(t.text or "" for t in node.iter(f"{m}t")) if node is not None else None
                else:
                    v = c.find(f"{m}v")
                    val = v.text if v is not None else None
                    if val is not None and kind == "s":
                        val = shared[int(val)]
                    elif val is not None and kind == "b":
                        val = "TRUE" if val == "1" else "FALSE"
                    elif val is not None and kind in (None, "n") and c.get("s") is not None \
                            and int(c.get("s")) in date_styles:
                        val = _serial_to_text(val, epoch)
                cells[idx] = val if val != "" else None
            width = max(cells) + 1 if cells else 0
            yield [cells.get(i) for i in range(width)]
            row.clear()


def parse_xlsx(data: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """All rows of one sheet (convenience for small workbooks and tests)."""
    return list(iter_xlsx_rows(data, sheet))


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType,
                   sheet: str | None = None, header: bool = True, chunk_rows: int = 10000) -> DataFrame:
    """Workbooks under ``path`` -> rows under ``schema`` (header names map
    columns by name; absent columns are null)."""
    names = [f.name for f in schema.fields]

    def frame(body: list[list[str | None]], pos: dict[str, int]) -> pd.DataFrame:
        out = {n: [(r[pos[n]] if n in pos and pos[n] < len(r) else None) for r in body] for n in names}
        return pd.DataFrame(out, columns=names, dtype=object)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                rows = iter_xlsx_rows(bytes(content), sheet)
                if header:
                    first = next(rows, None)
                    if first is None:
                        continue
                    pos = {h.strip(): i for i, h in enumerate(first) if h}
                else:
                    pos = {n: i for i, n in enumerate(names)}
                body: list[list[str | None]] = []
                for r in rows:
                    body.append(r)
                    if len(body) >= chunk_rows:
                        yield frame(body, pos)
                        body = []
                if body:
                    yield frame(body, pos)

    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("content")
    return files.mapInPandas(parse, schema)


_STATIC_PARTS = {
    "[Content_Types].xml":
        '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
        '</Types>',
    "_rels/.rels":
        '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
        '</Relationships>',
    "xl/_rels/workbook.xml.rels":
        '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
        '</Relationships>',
}


def _row_xml(r: int, vals: list[str | None]) -> str:
    cells = "".join(f'<c r="{_col_letters(i)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
                    for i, v in enumerate(vals) if v is not None)
    return f'<row r="{r}">{cells}</row>'


def write_xlsx(target: str, columns: list[str], batches: Iterator[list[list[str | None]]],
               sheet: str = "Sheet1") -> int:
    """Stream rows into one workbook file (inline strings); returns data rows."""
    n = 0
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in _STATIC_PARTS.items():
            z.writestr(name, text)
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_NS["m"]}" xmlns:r="{_REL_NS}">'
                   f'<sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        with z.open("xl/worksheets/sheet1.xml", "w") as fh:
            fh.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_NS["m"]}"><sheetData>'.encode())
            fh.write(_row_xml(1, list(columns)).encode())
            for rows in batches:
                fh.write("".join(_row_xml(n + 2 + i, r) for i, r in enumerate(rows)).encode())
                n += len(rows)
            fh.write(b"</sheetData></worksheet>")
    return n


def write_workbooks(df: DataFrame, path: str, sheet: str = "Sheet1") -> int:
    """One workbook per partition under ``path`` (a shared folder); text
    cells, nulls left empty.  Returns the number of files written."""
    columns = df.columns
    text = df.select(*[df[c].cast("string").alias(c) for c in columns])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        os.makedirs(path, exist_ok=True)
        target = os.path.join(path, f"part-{part:05d}.xlsx")
        # one temp file per attempt, hidden (leading dot) so readers never see a partial file
        tmp = os.path.join(path, f".{os.path.basename(target)}.attempt-{TaskContext.get().taskAttemptId()}.tmp")
        rows_in = ([[None if pd.isna(v) else str(v) for v in rec] for rec in pdf.itertuples(index=False)]
                   for pdf in batches)
        n = write_xlsx(tmp, columns, rows_in, sheet)
        if n:
            os.replace(tmp, target)
        else:
            os.remove(tmp)
        yield pd.DataFrame({"files": [1 if n else 0]})

    ship_package(df.sparkSession)
    out = text.mapInPandas(write, "files int")
    return int(out.agg({"files": "sum"}).collect()[0][0] or 0)
