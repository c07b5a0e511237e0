"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping spans of four kinds (email, ip,
card, phone).  Each candidate gets format features (digits, groups,
separators, lengths) and context features (neighbouring characters); the marks
that make a span strict ('+', '@', check digits) are masked.  A candidate is
right if it is strict, or well-formed but for its mark and announced by a cue
word; wrong if its form rules it out (check digit, number of digits, part of a
longer code or of another kind's strict span); else its outcome is unknown.
Boosted trees are fitted on a bounded sample of known ones; a threshold per
kind is calibrated on all known candidates of the documents held out, so that
what passes it is right with the asked precision.  Spans of the strict patterns
always stay; candidates that pass, are not ruled out and touch no strict span
are added.

Defined results: null and empty texts have no spans; rows are scanned whole
and one by one, so repeated rows repeat their result; with too few labelled
candidates (empty or tiny tables) no span is added; further columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import frames, id_and_text, written

KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Generators of loose candidates.
LOOSE = (
    re.compile(r"[^\s@<>\"',;]{1,64}(?:@|\s?[(\[](?:at|@)[)\]]\s?)[^\s@<>\"',;]{2,128}"),
    re.compile(r"(?<![0-9.])[0-9]{1,5}(?:[.][0-9]{1,5}){3,5}"),
    re.compile(r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,23}"),
    re.compile(r"(?<![0-9])(?:\+|00)?[(]?[0-9]{1,4}[)]?(?:[\x20.-]?[(]?[0-9]{2,5}[)]?){2,4}"),
)
#: Ways to write the sign of an address; what an international number starts with.
AT, PREFIX = re.compile(r"@|\s?[(\[](?:at|@)[)\]]\s?"), re.compile(r"\A(?:\+|00)")
CUES = (("mail", "contact", "@"), ("ip", "host", "addr", "server"), ("card", "visa", "credit", "account"),
        ("phone", "tel", "call", "mobile", "fax"))
#: Rows to fit on, those held out for thresholds included; precision asked of added spans.
FIT_ROWS, PRECISION, LEAST_FIT = 20_000, 0.98, 50
CONTEXT = 24


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else 2 * v - 9 * (v > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain.tld, found from each @ outwards, so
    that long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of the strict patterns, by kind and start."""
    found = [(0, *s) for s in emails(text)] if "@" in text else []
    found += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255
                                                              for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Loose spans of all kinds; they may overlap each other."""
    found = []
    for kind, pattern in enumerate(LOOSE):
        if kind == 0 and "@" not in text and "at)" not in text and "at]" not in text:
            continue
        found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return found


def unmarked(kind: int, span: str) -> str:
    """The span without what makes it strict: no '+' or '00' before a phone, one sign for any way to write '@'."""
    return AT.sub("@", span, count=1) if kind == 0 else PREFIX.sub("", span) if kind == 3 else span


def outcome(text: str, kind: int, start: int, end: int, base: list[tuple[int, int, int]]) -> int | None:
    """1: right, 0: wrong, None: unknown."""
    if (kind, start, end) in base:
        return 1
    if any(k != kind and s < end and start < e for k, s, e in base):
        return 0
    if any(s < end and start < e for _, s, e in base):
        return None
    span, digits = unmarked(kind, text[start:end]), _digits(text[start:end])
    glued = (start > 0 and (text[start - 1].isalnum() or text[start - 1] in "_.@-")) or text[end:end + 1].isalnum() or text[end:end + 1] in ("_", "@")
    if kind == 0:
        m = re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.([a-z]{2,24}|[A-Z]{2,24})[.:!?)]*", span)
        formed = m is not None
    elif kind == 1:
        groups = span.split(".")
        formed = not glued and len(groups) == 4 and all(int(g) <= 255 for g in groups)
    elif kind == 2:
        formed = not glued and 13 <= len(digits) <= 19 and luhn(digits)
    else:
        formed = not glued and 9 <= len(digits) <= 15
    if not formed:
        return 0
    before = text[max(0, start - CONTEXT):start].lower()
    return 1 if any(c in before for c in CUES[kind]) else None


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context; nothing here tells a strict span from one without its mark."""
    span, before, after = unmarked(kind, text[start:end]), text[max(0, start - CONTEXT):start], text[end:end + 2]
    digits = sum(c.isdigit() for c in span)
    groups = [g for g in re.split(r"[^0-9A-Za-z]+", span) if g]
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        float(len(span)), float(digits), float(sum(c.isalpha() for c in span)),
        float(sum(not c.isalnum() for c in span)), float(len(groups)),
        float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)),
        float(len(groups[0]) if groups else 0), float(len(groups[-1]) if groups else 0),
        float("(" in span), float(" " in span), float("-" in span), float("." in span),
        float(span.count(".")),
        float(max((int(g) for g in groups if g.isdecimal() and len(g) < 6), default=0)),
        float(not before or before[-1].isspace()), float(bool(before) and before[-1].isalnum()),
        float(bool(before) and before[-1] in "\"'=:"), float(not after or after[0].isspace()),
        float(bool(after) and after[0].isalnum()), float(bool(after) and after[0] in "\"'.,;"),
    ]


SPAN = "struct<kind: int, start: long, `end`: long>"
FOUND = f"doc_id long, row long, base array<{SPAN}>, loose array<struct<kind: int, start: long, `end`: long, label: int, touches: boolean, features: array<double>>>"


def _find(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for doc_id, row, text in zip(pdf["doc_id"], pdf["row"], pdf["text"]):
        base = base_spans(text)
        loose = [{"kind": k, "start": s, "end": e, "label": outcome(text, k, s, e, base),
                  "touches": any(s < y and x < e for _, x, y in base), "features": features(text, k, s, e)}
                 for k, s, e in candidates(text)]
        rows.append((doc_id, row, [{"kind": k, "start": s, "end": e} for k, s, e in base], loose))
    return pd.DataFrame(rows, columns=["doc_id", "row", "base", "loose"]).astype({"doc_id": "Int64"})


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base spans and featured candidates of each row, written once."""
    rows = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return written(rows.mapInPandas(lambda it: frames(it, _find), FOUND), "pii-candidates")


def _featured(found: DataFrame, *more: str) -> DataFrame:
    return (found.select("doc_id", "row", *more, F.explode("loose").alias("c"))
            .select("doc_id", "row", *more, "c.kind", "c.start", "c.end", "c.label", "c.touches",
                    array_to_vector("c.features").alias("features")))


def fit(found: DataFrame, fit_rows: int = FIT_ROWS, precision: float = PRECISION):
    """(model, threshold by kind): trees from at most ``fit_rows`` candidates of
    known outcome, taken in the order of a hash; all those of the fifth of the
    documents that another hash holds out set the thresholds.  None if the
    candidates to fit on don't hold both outcomes."""
    hashed = F.xxhash64("doc_id", "kind", "start", "end")
    known = _featured(found.withColumn("held_out", F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(5)) == 0),
                      "held_out").filter("label IS NOT NULL")
    sample = written(known.filter("not held_out").orderBy(hashed).limit(fit_rows), "pii-sample")
    counts = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if min(counts.get(0, 0), counts.get(1, 0)) < LEAST_FIT:
        return None
    model = GBTClassifier(maxIter=8, maxDepth=3, maxBins=32, stepSize=0.3, seed=11).fit(sample)
    scored = (model.transform(known.filter("held_out")).withColumn("p", vector_to_array("probability")[1])
              .select("kind", "label", F.floor(F.col("p") * 100).cast("int").alias("step")))
    at = Window.partitionBy("kind").orderBy(F.desc("step"))
    steps = (scored.groupBy("kind", "step").agg(F.count("*").alias("n"), F.sum("label").alias("right"))
             .withColumn("n", F.sum("n").over(at)).withColumn("right", F.sum("right").over(at)))
    cut = {k: 2.0 for k in range(len(KINDS))}
    for r in steps.filter((F.col("right") >= precision * F.col("n")) & (F.col("n") >= 20)).groupBy("kind").agg(
            F.min("step").alias("step")).collect():
        cut[r["kind"]] = r["step"] / 100
    return model, cut


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: array of (kind, start, end, base) by kind and start."""
    found = find(docs, id_col, text_col)
    fitted = fit(found)
    base = found.select("doc_id", "row", F.transform("base", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(True).alias("base"))).alias("spans"))
    if fitted is None:
        return base.drop("row")
    model, cut = fitted
    threshold = F.element_at(F.create_map(*(x for k, v in cut.items() for x in (F.lit(k), F.lit(v)))), F.col("kind"))
    added = (model.transform(_featured(found).filter("not touches AND (label IS NULL OR label = 1)"))
             .filter(vector_to_array("probability")[1] >= threshold)
             .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", F.lit(False).alias("base"))).alias("more")))
    return base.join(added, "row", "left").select("doc_id", F.array_sort(F.concat(
        "spans", F.coalesce("more", F.expr("cast(array() as array<struct<kind: int, start: long, end: long, base: boolean>>)"))
    )).alias("spans"))


def digest(spans_by_doc: DataFrame) -> DataFrame:
    """Counts, hash and text form of the spans of ``detect``."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc_id, spans in zip(pdf["doc_id"], pdf["spans"]):
            text = [f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in spans]
            base = [t for t, s in zip(text, spans) if s["base"]]
            counts = [sum(1 for s in spans if s["base"] and s["kind"] == k) for k in range(len(KINDS))]
            out.append((doc_id, *counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(text)))
        return pd.DataFrame(out, columns=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]).astype(
            {"doc_id": "Int64"})

    return spans_by_doc.mapInPandas(
        lambda it: frames(it, one), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                    "base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span, joined where they overlap, replaced by its kind in angle brackets."""
    out, done = [], 0
    for start, end, kind in sorted(spans):
        if end <= done:
            continue
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind]}>"]
        done = end
    return "".join([*out, text[done:]])
