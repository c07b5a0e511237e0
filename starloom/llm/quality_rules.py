"""Quality rules as a short-circuit cascade.

Every rule says when a document is rejected.  On a bounded sample the
operator measures what each rule costs (seconds a document) and which
documents it rejects, and orders the rules greedily by rejections per cost
among the documents that the rules before it let pass.  Documents then run
through the rules in that order and stop at the first rejection.  The
verdict is a conjunction, so the order changes the cost and never the result.

Defined results: a null or empty text has no words and is rejected (too
short); repeated rows and ties are judged row by row; an empty table gives an
empty result; further columns of the input pass through ``keep_good`` and are
dropped by ``measure``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from starloom.llm.common import SPACES, bounded_sample, frames, id_and_text, release, text_words

SYMBOLS = "#*$%&|<>"
#: Rows of the sample that costs and selectivities are estimated on.
SAMPLE_ROWS = 1024


class Document:
    """One text with the measures that rules ask for, each computed once at most."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return text_words(self.text)

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a window of three words found twice or more."""
        if self.n_words < 4:
            return 0
        index: dict[bytes, int] = {}
        ids = np.fromiter((index.setdefault(w, len(index)) for w in self.words), np.int64, self.n_words)
        pairs = np.unique(ids[:-1] * len(index) + ids[1:], return_inverse=True)[1]
        _, which, count = np.unique(pairs[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
        starts = np.flatnonzero(count[which] > 1)
        inside = np.zeros(self.n_words, bool)
        for k in range(3):
            inside[starts + k] = True
        return int(inside.sum())

    @cached_property
    def n_shouted(self) -> int:
        """Words of two or more letters without a lower-case one."""
        return sum(1 for w in self.words if w != w.lower() or not w.isascii()
                   if len(u := w.decode("utf-8", "surrogatepass")) > 1 and u.isupper())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


def _few_words(d: Document) -> bool:
    return d.n_words < 50


def _repeats(d: Document) -> bool:
    return 100 * d.n_repeat_words > 50 * d.n_words


def _symbols(d: Document) -> bool:
    return 10 * d.n_symbols > 3 * d.n_words


def _dup_lines(d: Document) -> bool:
    return 2 * d.n_dup_lines > len(d.lines)


def _word_length(d: Document) -> bool:
    return not 2 * d.n_words <= d.word_chars <= 20 * d.n_words


def _shouting(d: Document) -> bool:
    return 2 * d.n_shouted > d.n_words


BASE_RULES = (Rule("few_words", _few_words), Rule("repeats", _repeats))
RULES = (*BASE_RULES, Rule("symbols", _symbols), Rule("dup_lines", _dup_lines),
         Rule("word_length", _word_length), Rule("shouting", _shouting))


def _trials(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                failed, seconds = [], []
                for r in rules:
                    began = time.perf_counter()
                    failed.append(bool(r.rejects(Document(text))))  # its cost when nothing is shared
                    seconds.append(time.perf_counter() - began)
                rows.append((failed, seconds))
            yield pd.DataFrame(rows, columns=["failed", "seconds"])
    return run


def order_by_rejections(failed: np.ndarray, cost: np.ndarray) -> list[int]:
    """Greedy order: next comes the rule that rejects most of what is left per second."""
    left, order = np.ones(len(failed), bool), []
    while len(order) < failed.shape[1]:
        gain = [(-1.0 if i in order else failed[left, i].sum() / max(cost[i], 1e-9)) for i in range(failed.shape[1])]
        best = max(range(len(gain)), key=lambda i: (gain[i], -cost[i], -i) if i not in order else (-2.0, 0.0, 0))
        order.append(best)
        left &= ~failed[:, best]
    return order


def plan_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
                 sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """Rules ordered by measured rejections per cost on at most ``sample_rows`` rows."""
    sample = bounded_sample(docs.select(docs[text_col].cast("string").alias("text")), sample_rows)
    seen = sample.mapInPandas(_trials(rules), "failed array<boolean>, seconds array<double>").toPandas()
    if not len(seen):
        return rules
    return tuple(rules[i] for i in order_by_rejections(np.array(seen["failed"].tolist(), bool),
                                                       np.array(seen["seconds"].tolist()).mean(axis=0)))


def passes(d: Document, cascade: tuple[Rule, ...]) -> bool:
    return not any(r.rejects(d) for r in cascade)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, the five base measures, base_failed, and kept by the cascade."""
    cascade = plan_cascade(docs, rules, text_col)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            d = Document(text)
            kept = passes(d, cascade)
            base = any(r.rejects(d) for r in BASE_RULES)
            rows.append((doc_id, d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words,
                         base, kept and not base))
        return pd.DataFrame(rows, columns=MEASURES).astype({"doc_id": "Int64"})

    return id_and_text(docs, id_col, text_col).mapInPandas(
        lambda it: frames(it, one),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean")


MEASURES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The documents that no rule rejects, all columns as they are; one pass, no shuffle."""
    cascade = plan_cascade(docs, rules, text_col)
    at = docs.columns.index(text_col)

    def keep(batches):
        release()
        for batch in batches:
            mask = [passes(Document(t), cascade) for t in batch.column(at).to_pylist()]
            yield batch.filter(_pa_mask(mask))

    return docs.mapInArrow(keep, docs.schema)


def _pa_mask(mask: list[bool]):
    import pyarrow as pa
    return pa.array(mask, pa.bool_())


#: The query's rows in DuckDB SQL.
SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
x AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT r, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p AS g
        FROM x WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win WHERE g IS NOT NULL)
          WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t),
lines AS (SELECT r, count(*) AS n, count(DISTINCT line) AS d FROM l
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT t.r, doc_id, len(ws)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(lines.n - lines.d, 0)::BIGINT AS n_dup_lines, coalesce(lines.n, 0) AS n_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(ws, lambda v: length(v) > 1 AND v = upper(v) AND v <> lower(v))) AS n_shouted
      FROM t JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_shouted > n_words) AS kept
FROM b
"""
