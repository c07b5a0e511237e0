"""Secret scans: fixed patterns plus a randomness test battery.

Candidates are long runs of code characters.  For each one the encoding is
inferred from its characters (hexadecimal, base-32, letters and digits, ...);
three statistics measure how far it is from independent uniform draws of that
alphabet: chi-squared uniformity, the number of runs above and below the
middle of the alphabet, and lag-one serial correlation.  What ordinary prose
scores is estimated, per encoding and length class, from all words of the
corpus joined to the same lengths; a candidate's p-value is the chance that prose
looks as random.  Candidates of all documents then pass a false-discovery
control (Benjamini-Hochberg) weighted by length, as longer runs carry more
evidence.  P-values are counted in a fixed number of bins, so the driver only
sees a table of bounded size.

Defined results: null and empty texts have no spans; every row is scanned
whole; repeated rows give repeated results; further columns are dropped.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import frames, id_and_text, release, written

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
#: A candidate: a whole run of code characters, this long at least.
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Encodings from the narrowest alphabet to the widest.
ENCODINGS = {
    "decimal": DIGITS, "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF",
    "lower": LOWER, "upper": LOWER.upper(), "base32": LOWER.upper() + "234567",
    "lower36": DIGITS + LOWER, "upper36": DIGITS + LOWER.upper(), "letters": LOWER.upper() + LOWER,
    "base62": DIGITS + LOWER.upper() + LOWER, "base64": LOWER.upper() + LOWER + DIGITS + "+/",
    "base64url": LOWER.upper() + LOWER + DIGITS + "-_", "any": LOWER.upper() + LOWER + DIGITS + "+/-_=",
}
ALPHABETS = {k: frozenset(v) for k, v in ENCODINGS.items()}
#: Shortest candidate of each length class.
LENGTHS = (16, 24, 32, 48, 64)
#: False-discovery rate, bins of p-values; prose runs that a class is judged by at least, steps of a summed score.
RATE, BINS, LEAST_RUNS, STEPS = 0.001, 400, 30, 10_000
#: Share of hexadecimal characters in prose, rounded up; departure that 99 % of random runs stay below.
HEX_SHARE, RANDOM_BELOW = 0.4, math.log1p(11.3)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of the fixed patterns, by start and then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def encoding_of(run: str) -> str:
    chars = frozenset(run.rstrip("="))
    return next((k for k, a in ALPHABETS.items() if chars <= a), "any")


def statistics(run: str, encoding: str) -> tuple[float, float, float]:
    """z-scores of chi-squared uniformity, runs and serial correlation; all near
    zero for independent uniform characters."""
    alphabet = ENCODINGS[encoding]
    body = run.rstrip("=") or run
    at = np.array([alphabet.find(c) for c in body], float)
    n, k = len(at), len(alphabet)
    count = np.bincount(at.astype(int).clip(0), minlength=k)
    chi = (count ** 2).sum() * k / n - n
    z_chi = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * max(n - 1, 1) / n)
    high = at >= k / 2
    p = (k - math.ceil(k / 2)) / k
    switches, q = float((high[1:] != high[:-1]).sum()), 2 * p * (1 - p)
    z_runs = (switches - (n - 1) * q) / math.sqrt(max((n - 1) * q * (1 - q), 1e-9))
    centred = at - (k - 1) / 2
    z_serial = float((centred[1:] * centred[:-1]).sum()) / ((k * k - 1) / 12 * math.sqrt(max(n - 1, 1)))
    return z_chi, z_runs, z_serial


def departure(run: str, encoding: str) -> float:
    """One figure for the battery: large for prose, small for random characters."""
    z_chi, z_runs, z_serial = statistics(run, encoding)
    return math.log1p(max(z_chi, 0.0) ** 2 + z_runs ** 2 + z_serial ** 2)


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def _scan(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
        base = base_spans(text)
        runs = []
        for m in RUN.finditer(text):
            encoding = encoding_of(m[0])
            covered = any(s < m.end() and m.start() < e for _, s, e in base)
            runs.append({"start": m.start(), "end": m.end(), "encoding": encoding, "covered": covered,
                         "score": departure(m[0], encoding)})
        rows.append((doc_id, [{"kind": k, "start": s, "end": e} for k, s, e in base], runs))
    return pd.DataFrame(rows, columns=["doc_id", "base", "runs"]).astype({"doc_id": "Int64"})


SCANNED = ("doc_id long, base array<struct<kind: int, start: long, `end`: long>>, "
           "runs array<struct<start: long, `end`: long, encoding: string, covered: boolean, score: double>>")


PLAIN = re.compile(r"[A-Za-z]{2,15}")
#: Encodings that words can be taken for, by the letters they are read in; those that score alike share an entry.
READ_AS = (("fold", ("lower", "upper")), ("fold", ("lower36", "upper36")), ("fold", ("base32",)), ("case", ("letters",)),
           ("case", ("base62",)), ("case", ("base64", "base64url")), ("case", ("any",)))


def _pair_table(encoding: str) -> np.ndarray:
    """For each pair of neighbouring letters (upper 0 to 25, lower 26 to 51) four
    times the product of their centred places, shifted, plus whether they lie on
    different sides of the middle."""
    alphabet, letters = ENCODINGS[encoding], LOWER.upper() + LOWER
    if encoding in ("lower", "lower36"):
        letters = letters.lower()
    elif encoding == "base32":
        letters = letters.upper()
    at, k = np.array([alphabet.find(c) for c in letters], np.int64), len(alphabet)
    centred, high = 2 * at - (k - 1), at >= k / 2
    return (np.outer(centred, centred) * 128 + (high[:, None] != high)).astype(np.int32).ravel()


PAIRS = [_pair_table(names[0]) for _, names in READ_AS]


def _joined(shortest: int, ends: np.ndarray, words_of: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Letters at which runs of neighbouring words start and end: each takes the
    words it needs to be ``shortest`` long, the next one starts after it."""
    after = np.searchsorted(ends, ends[:-1] + shortest).tolist()
    first, last, at = [], [], 0
    for n in words_of:
        stop = at + n
        while at < stop and (then := after[at]) <= stop:
            first.append(at)
            last.append(then)
            at = then
        at = stop
    return ends[first], ends[last]


def prose_scores(texts: list[str]) -> Iterator[tuple[tuple[str, ...], int, np.ndarray]]:
    """Encodings, length class and ``departure`` of all neighbouring plain words
    joined to that class, read in each encoding whose alphabet they could be taken for."""
    words = [PLAIN.findall(t) for t in texts]
    flat, words_of = [w for some in words for w in some], list(map(len, words))
    if not flat:
        return
    code = np.frombuffer("".join(flat).encode("ascii"), np.uint8).astype(np.int64)
    code = np.where(code < 97, code - 65, code - 71)
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)))])
    pairs = code[:-1] * 52 + code[1:]
    # Sums up to each letter may wrap round; the differences over a run do not.
    sums = [np.concatenate([np.zeros(1, np.int32), np.cumsum(table[pairs], dtype=np.int32)]) for table in PAIRS]
    for c, shortest in enumerate(LENGTHS):
        first, last = _joined(shortest, ends, words_of)
        if not len(first):
            continue
        size = last - first
        run = np.repeat(np.arange(len(first)), size)
        inside = np.arange(len(run)) + np.repeat(first - (np.cumsum(size) - size), size)
        count = np.bincount(run * 52 + code[inside], minlength=52 * len(first)).reshape(-1, 2, 26)
        squares = {"case": (count ** 2).sum((1, 2)), "fold": (count.sum(1) ** 2).sum(1)}
        n = size.astype(float)
        for (letters, names), total in zip(READ_AS, sums):
            k = len(ENCODINGS[names[0]])
            both = (total[last - 1] - total[first]).astype(np.int64)
            switches, product = both & 127, (both >> 7) / 4
            z_chi = (squares[letters] * k / n - n - (k - 1)) / np.sqrt(2 * (k - 1) * (n - 1) / n)
            p = (k - math.ceil(k / 2)) / k
            q = 2 * p * (1 - p)
            z_runs = (switches - (n - 1) * q) / np.sqrt((n - 1) * q * (1 - q))
            z_serial = product / ((k * k - 1) / 12 * np.sqrt(n - 1))
            yield names, c, np.log1p(np.maximum(z_chi, 0) ** 2 + z_runs ** 2 + z_serial ** 2)


def _prose_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Number, sum and sum of squares of a task's prose scores, in whole steps, so that their order is of no account."""
    release()
    sums: dict[tuple[str, int], list[int]] = {}
    for pdf in batches:
        texts, some, letters = pdf["text"].tolist(), [], 0
        for k, text in enumerate(texts):
            some.append(text)
            letters += len(text)
            if letters < 1 << 20 and k < len(texts) - 1:
                continue
            for names, c, scores in prose_scores(some):
                steps = np.rint(scores * STEPS).astype(np.int64)
                for name in names:
                    old = sums.get((name, c), (0, 0, 0))
                    sums[name, c] = [old[0] + len(steps), old[1] + int(steps.sum()), old[2] + int((steps ** 2).sum())]
            some, letters = [], 0
    yield pd.DataFrame([(*key, n, str(total), str(squares)) for key, (n, total, squares) in sums.items()],
                       columns=["encoding", "class", "n", "total", "squares"])


def fit_prose(docs: DataFrame) -> dict[tuple[str, int], tuple[float, float]]:
    """Mean and deviation of prose scores by encoding and length class, from all
    rows; a class with few runs takes those of the nearest class that has enough."""
    sums = (docs.select("text").mapInPandas(_prose_sums, "encoding string, class int, n long, total string, squares string")
            .groupBy("encoding", "class")
            .agg(F.sum("n").alias("n"), *(F.sum(F.col(x).cast("decimal(38,0)")).alias(x) for x in ("total", "squares"))))
    found = {}
    for r in sums.collect():  # a row for each encoding and class
        n, total, squares = r["n"], int(r["total"]), int(r["squares"])
        if n >= LEAST_RUNS:
            sd = math.sqrt(max(n * squares - total * total, 0)) / n / STEPS
            found[r["encoding"], r["class"]] = (total / n / STEPS, max(sd, 0.05))
    prose = dict(found)
    for encoding in {e for e, _ in found}:
        known = [c for e, c in found if e == encoding]
        for c in range(len(LENGTHS)):
            prose.setdefault((encoding, c), found[encoding, min(known, key=lambda x: (abs(x - c), x))])
    return prose


def log_p(score: float, encoding: str, n: int, prose: dict) -> float:
    """Natural log of the chance that prose scores as low.  Prose hardly ever
    stays within the hexadecimal characters, so there the chance of that
    decides if the run looks random; plain numbers are never secrets."""
    if encoding in ("hex", "HEX"):
        return n * math.log(HEX_SHARE) if score <= RANDOM_BELOW else 0.0
    fit = prose.get((encoding, length_class(n)))
    if fit is None:
        return 0.0
    z = (score - fit[0]) / fit[1]
    return math.log(max(0.5 * math.erfc(-z / math.sqrt(2)), 1e-300))


def weight_of(n: int) -> float:
    """Weights of the length classes; classes with more evidence get more of the rate."""
    return float(2 ** length_class(n)) / 4


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """doc_id, spans: array of (kind, start, end, base) by start and then kind;
    kind 3 (``random``) are runs that the battery adds."""
    rows = id_and_text(docs, id_col, text_col)
    scanned = written(rows.mapInPandas(lambda it: frames(it, _scan), SCANNED), "secret-runs")
    prose = fit_prose(rows)

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        """Weighted p-values as bins: bin b holds -log10 p from b/20 on."""
        out = [(min(BINS - 1, max(0, int(-20 * (log_p(s, e, n, prose) - math.log(weight_of(n))) / math.log(10)))),)
               for s, e, n in zip(pdf["score"], pdf["encoding"], pdf["n"])]
        return pd.DataFrame(out, columns=["bin"])

    runs = scanned.select(F.explode("runs").alias("r")).select(
        "r.score", "r.encoding", (F.col("r.end") - F.col("r.start")).alias("n"))
    bins = np.zeros(BINS)
    for r in runs.mapInPandas(lambda it: frames(it, judge), "bin int").groupBy("bin").count().collect():
        bins[r["bin"]] = r["count"]
    cut = discovery_bin(bins, rate)

    def select(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc_id, base, found in zip(pdf["doc_id"], pdf["base"], pdf["runs"]):
            spans = [(s["kind"], s["start"], s["end"], True) for s in base]
            for r in found:
                n = r["end"] - r["start"]
                p10 = -(log_p(r["score"], r["encoding"], n, prose) - math.log(weight_of(n))) / math.log(10)
                if not r["covered"] and min(BINS - 1, max(0, int(20 * p10))) >= cut:
                    spans.append((len(KINDS), r["start"], r["end"], False))
            spans.sort(key=lambda s: (s[1], s[0]))
            out.append((doc_id, [dict(zip(("kind", "start", "end", "base"), s)) for s in spans]))
        return pd.DataFrame(out, columns=["doc_id", "spans"]).astype({"doc_id": "Int64"})

    return scanned.mapInPandas(lambda it: frames(it, select), SPANS)


SPANS = "doc_id long, spans array<struct<kind: int, start: long, `end`: long, base: boolean>>"


def discovery_bin(bins: np.ndarray, rate: float) -> int:
    """Lowest bin whose runs pass Benjamini-Hochberg: the k runs from it on
    have p of 10^(-bin/20) at most, which must be within rate * k / all."""
    total = bins.sum()
    at_least = bins[::-1].cumsum()[::-1]
    for b in range(len(bins)):
        if at_least[b] and 10 ** (-b / 20) <= rate * at_least[b] / total:
            return b
    return len(bins)


def digest(spans_by_doc: DataFrame) -> DataFrame:
    """Counts, hash and text form of the spans of ``scan``."""
    names = (*KINDS, "random")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc_id, spans in zip(pdf["doc_id"], pdf["spans"]):
            text = [f"{names[s['kind']]}:{s['start']}:{s['end']}" for s in spans]
            base = [t for t, s in zip(text, spans) if s["base"]]
            counts = [sum(1 for s in spans if s["base"] and s["kind"] == k) for k in range(len(KINDS))]
            out.append((doc_id, *counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(text)))
        return pd.DataFrame(out, columns=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]).astype(
            {"doc_id": "Int64"})

    return spans_by_doc.mapInPandas(
        lambda it: frames(it, one),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every secret span replaced by ``<secret>``; all
    columns and rows stay.  Spans are recomputed from each text beside the
    corpus-wide cut, so no join by id is needed and repeated ids are safe."""
    rows = id_and_text(docs, id_col, text_col)
    prose = fit_prose(rows)
    cut = _corpus_cut(rows, prose)
    at = docs.columns.index(text_col)

    def redact(batches):
        import pyarrow as pa
        for batch in batches:
            texts = [t if t is None else mask(t, prose, cut) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(redact, docs.schema)


def _corpus_cut(rows: DataFrame, prose: dict, rate: float = RATE) -> int:
    def judged(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(_bin(m[0], prose),) for text in pdf["text"] for m in RUN.finditer(text)], columns=["bin"])

    bins = np.zeros(BINS)
    for r in rows.mapInPandas(lambda it: frames(it, judged), "bin int").groupBy("bin").count().collect():
        bins[r["bin"]] = r["count"]
    return discovery_bin(bins, rate)


def _bin(run: str, prose: dict) -> int:
    encoding = encoding_of(run)
    p = log_p(departure(run, encoding), encoding, len(run), prose) - math.log(weight_of(len(run)))
    return min(BINS - 1, max(0, int(-20 * p / math.log(10))))


def mask(text: str, prose: dict, cut: int) -> str:
    """``text`` with the union of its base spans and discovered runs masked."""
    spans = [(s, e) for _, s, e in base_spans(text)]
    spans += [m.span() for m in RUN.finditer(text) if _bin(m[0], prose) >= cut]
    out, done = [], 0
    for s, e in sorted(spans):
        if e <= done:
            continue
        if s >= done:
            out += [text[done:s], "<secret>"]
        done = e
    return "".join([*out, text[done:]])
