"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled documents.  The ordinary one
is trained by the library on windows of ordinary text.  The toxic one holds
the same trained part, so that ordinary content costs the same under both,
followed by words that toxic documents use far more often than ordinary ones
(the library's trainer alone prefers frequent syllables of either class).  In
the ordinary one a filler takes their place, which keeps all offsets equal.
Every document is cut into windows at word ends; a window's difference is its
compressed length under the ordinary dictionary less that under the toxic one.
A likelihood ratio for each difference and a logistic calibration over a
document's windows, both learned from labelled documents that the dictionaries
didn't see, turn the differences into a probability.

Labels of held-out rows (crc32 of the id as text, modulo 4, is 2) are never
read.  Fitting takes at most ``FIT_ROWS`` labelled rows, in the order of a hash
of the id; every document is scored over its whole text.

Defined results: a null or empty text is one empty window and gets a score
too; repeated rows repeat their score; without labels of both kinds all scores
are 0; further columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import frames, id_and_text, written

#: Labelled rows to fit on, bytes of a window, of the trained part and of the toxic words.
FIT_ROWS, WINDOW, TRAINED_BYTES, WORD_BYTES = 16_000, 64, 16_384, 16_384
#: Windows that the trained part is made from, level of compression.
TRAINING_WINDOWS, LEVEL = 30_000, 3
#: A toxic word is in this share of the toxic documents, and this many times more often than in the others.
LEAST_SHARE, RATIO = 0.02, 4.0
#: Differences are counted from LOW to HIGH.
LOW, HIGH = -3, 9
THRESHOLD = 0.3


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """The lower-cased text in windows of at most ``size`` bytes, cut before a
    space where there is one."""
    data = text.lower().encode("utf-8", "surrogatepass")
    out, at = [], 0
    while at + size < len(data):
        cut = data.rfind(b" ", at + 1, at + size)
        out.append(data[at:cut if cut > at else at + size])
        at += len(out[-1])
    return [*out, data[at:]]


class Dictionaries:
    """Compressors under the two dictionaries."""

    def __init__(self, trained: bytes, words: bytes):
        def under(data: bytes) -> zstandard.ZstdCompressor:
            return zstandard.ZstdCompressor(
                level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
                dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        self.ordinary, self.toxic = under(trained + b"\n" * len(words)), under(trained + words)

    def histogram(self, text: str) -> np.ndarray:
        """How many windows have each difference of compressed lengths."""
        plain, toxic = self.ordinary.compress, self.toxic.compress
        differences = [len(plain(w)) - len(toxic(w)) for w in windows(text)]
        return np.bincount(np.clip(differences, LOW, HIGH) - LOW, minlength=HIGH - LOW + 1)


def _features(counts: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Per document: summed log ratio, plain and by the square root of the
    windows; the largest ones; share and number of telling windows; length."""
    n = counts.sum(axis=1)
    total = counts @ ratio
    order = np.argsort(-ratio)
    before = np.cumsum(counts[:, order], axis=1) - counts[:, order]
    top = [(np.clip(k - before, 0, counts[:, order]) * ratio[order]).sum(axis=1) for k in (1, 3)]
    telling = counts[:, ratio > 1.0].sum(axis=1)
    return np.column_stack([total, total / np.sqrt(n), *top, telling / (n + 2), np.log1p(telling), np.log(n)])


class Calibration:
    """Log ratios of the differences and a ridge logistic fit over documents."""

    def __init__(self, counts: np.ndarray, toxic: np.ndarray):
        of = [counts[toxic == k].sum(axis=0) + 1.0 for k in (0, 1)]
        self.ratio = np.log(of[1] / of[1].sum()) - np.log(of[0] / of[0].sum())
        x = _features(counts, self.ratio)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        x = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        self.weights = np.zeros(x.shape[1])
        ridge = np.append(np.full(x.shape[1] - 1, 1e-3 * len(x)), 1e-9)
        for _ in range(50):  # Newton steps
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            slope = x.T @ (p - toxic) + ridge * self.weights
            bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
            self.weights -= np.linalg.solve(bend, slope)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        x = (_features(counts, self.ratio) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def held_out(doc_id) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(rows: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[bytes, bytes, Calibration] | None:
    """Dictionary parts and calibration from ``rows`` (doc_id, text) and
    ``labels`` (doc_id, toxic); None without both kinds."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = (known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id")).limit(fit_rows))
    seen = written(rows.join(F.broadcast(known), "doc_id").withColumn(  # at most fit_rows rows
        "part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(2))), "toxicity-fit")
    size = {(r["part"], r["toxic"]): r["n"] for r in seen.groupBy("part", "toxic").agg(F.count("*").alias("n")).collect()}
    if min(size.get((p, t), 0) for p in (0, 1) for t in (0, 1)) == 0:
        return None
    ordinary, toxic = size[0, 0], size[0, 1]
    words = (seen.filter("part = 0").select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower("text"), F.lit(r"[^\s!-@\[-`{-~]{4,}"), F.lit(0)))).alias("word"))
        .groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
        .filter((F.col("t") >= max(3, LEAST_SHARE * toxic)) & (F.col("t") / toxic >= RATIO * (F.col("o") + 0.5) / ordinary))
        .orderBy(F.desc("t"), "word").limit(WORD_BYTES // 5).collect())
    # The most frequent words stand last, where offsets are shortest.
    content = b"".join(b" " + w["word"].encode() for w in reversed(words))[-WORD_BYTES:]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"w": [w for t in pdf["text"] for w in windows(t)]})

    plain = seen.filter("part = 0 AND toxic = 0").select("text").mapInPandas(cut, "w binary")
    samples = [bytes(r["w"]) for r in plain.sample(min(1.0, TRAINING_WINDOWS / max(1, plain.count())), seed=3).collect()]
    try:
        trained = zstandard.train_dictionary(TRAINED_BYTES, samples, k=64, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        trained = b"".join(samples)[-TRAINED_BYTES:].ljust(8, b"\n")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        pair = Dictionaries(trained, content)
        return pd.DataFrame({"toxic": pdf["toxic"], "counts": [pair.histogram(t).tolist() for t in pdf["text"]]})

    got = seen.filter("part = 1").orderBy("doc_id").select("toxic", "text").mapInPandas(
        lambda it: frames(it, count), "toxic int, counts array<long>").toPandas()
    return trained, content, Calibration(np.array(got["counts"].tolist(), float), got["toxic"].to_numpy(float))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = id_and_text(docs, id_col, text_col)
    fitted = fit(rows, labels)
    if fitted is None:
        scored = rows.select("doc_id", F.lit(0.0).alias("score"))
    else:
        trained, content, calibration = fitted

        def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pair = Dictionaries(trained, content)
            for pdf in batches:
                if len(pdf):
                    counts = np.array([pair.histogram(t) for t in pdf["text"]], float)
                    yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": calibration.scores(counts)})

        scored = rows.mapInPandas(rate, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
