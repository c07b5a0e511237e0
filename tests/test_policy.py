"""Static guard for the design rules: the library source never uses the
constructs the design rules out."""

import io
import pathlib
import re
import tokenize

PKG = pathlib.Path(__file__).resolve().parents[1] / "starloom"

FORBIDDEN = {
    r"localCheckpoint": "lineage is cut with written tables, never localCheckpoint",
    r"\bF\.udf\b|@udf|pandas_udf": "no row-at-a-time or scalar Python UDFs",
    r"\.rdd\.": "DataFrame only, no RDD operations",
    r"crossJoin": "no cross joins",
    r"F\.broadcast\(|\.hint\(": "no broadcast hints; AQE decides from measured sizes",
    r"coalesce\(1\)|monotonically_increasing_id": "no single-partition dedup / file-order tie-breaks",
}


def _code_only(src: str) -> str:
    """Source with comments and string literals removed (docs may name what is avoided)."""
    skip = {tokenize.COMMENT, tokenize.STRING}
    skip |= {getattr(tokenize, n) for n in ("FSTRING_START", "FSTRING_MIDDLE", "FSTRING_END") if hasattr(tokenize, n)}
    return "".join(t.string for t in tokenize.generate_tokens(io.StringIO(src).readline) if t.type not in skip)


def _sources():
    return {p: _code_only(p.read_text()) for p in PKG.rglob("*.py")
            if PKG / "llm" not in p.parents}


def test_no_forbidden_constructs():
    hits = [f"{p.relative_to(PKG)}: {why}" for p, src in _sources().items()
            for pat, why in FORBIDDEN.items() if re.search(pat, src)]
    assert hits == []


def test_driver_collects_only_one_row_results():
    # The only collect() calls are the sinks' one-row file counters.
    allowed = {"sources/workbook.py", "sources/writers.py"}
    hits = [str(p.relative_to(PKG)) for p, src in _sources().items() if re.search(r"\.\s*collect\s*\(", src)]
    assert set(hits) <= allowed, hits
