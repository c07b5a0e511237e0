"""Values of text columns, counted in Arrow by the Python workers.

A chunk of rows is taken column by column: its distinct values and their
counts, and from these its shapes, so that what follows costs by distinct
value and not by cell.  What a task holds is one chunk and, for each column,
two summaries of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows and bytes from which a chunk is taken.
CHUNK_ROWS, CHUNK_BYTES = 1 << 17, 32 << 20

COUNTED = pa.schema([("column_name", pa.string()), ("kind", pa.string()), ("text", pa.string()), ("n", pa.int64())])
SUMMED = COUNTED.append(pa.field("missed", pa.int64()))
CELL, VALUE, SHAPE = "cell", "value", "shape"

_NINES = bytes(ord("9") if chr(b) in "0123456789" else b for b in range(256))
_NON_ZERO = np.array([chr(b) in "123456789" for b in range(256)], dtype=np.uint8)
#: Shapes of numbers that are below or equal to zero by their sign and by having a digit other than 0, up to a length
#: that no double underflows at, and shapes whose texts may be numbers in another way (exponents, hexadecimals).
_PLAIN, _ODD = r"^[\x00-\x20]*[+-]?(?:9+\.?9*|\.9+)[dDfF]?[\x00-\x20]*$", r"(?s)^[\x00-\x20]*[+-]?[9.].*[eExX]"
_LONG = 300


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows, size = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def distinct(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The values other than null, as bytes, and their counts."""
    found = pc.value_counts(column.cast(pa.binary()))
    values, counts = found.field("values"), found.field("counts")
    if values.null_count:
        counts, values = counts.filter(values.is_valid()), values.drop_null()
    return values, counts.to_numpy(zero_copy_only=False)


def shapes(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct shapes (every digit as 9) of values, and which of them each value has."""
    _, offsets, data = values.buffers()
    if data is not None:
        nines = pa.py_buffer(data.to_pybytes().translate(_NINES))
        values = pa.Array.from_buffers(values.type, len(values), [None, offsets, nines], offset=values.offset)
    found = values.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False)


def summed(counts: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(codes, weights=counts, minlength=n).astype(np.int64)  # exact: far fewer than 2 ** 53 rows in a chunk


def alike(values: pa.Array, counts: np.ndarray, kinds: pa.Array, codes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """One value for all that a profile can't tell apart, with their count.

    Digits matter neither to length, case, blanks and commas nor to being a
    number, but for hexadecimals; a plain number's sign and zero are told by
    its shape and by having a digit other than 0.  Others stand for themselves."""
    long, plain = pc.greater(pc.binary_length(kinds), _LONG), pc.match_substring_regex(kinds, _PLAIN)
    own = pc.or_(pc.match_substring_regex(kinds, _ODD), pc.and_(plain, long)).to_numpy(zero_copy_only=False)[codes]
    plain = plain.to_numpy(zero_copy_only=False)
    group = codes.astype(np.int64) * 2
    if plain.any():
        _, offsets, data = values.buffers()
        ends = np.frombuffer(offsets, dtype=np.int32)[values.offset:values.offset + len(values) + 1]
        non_zero = np.concatenate([[0], np.cumsum(_NON_ZERO[np.frombuffer(data, dtype=np.uint8)], dtype=np.int64)])
        group += plain[codes] & (non_zero[ends[1:]] > non_zero[ends[:-1]])
    at = np.flatnonzero(~own)
    first = np.full(2 * len(kinds), -1)
    first[group[at]] = at
    found = np.flatnonzero(first >= 0)
    if own.any():
        total = summed(counts[at], group[at], 2 * len(kinds))
        alone = np.flatnonzero(own)
        return values.take(pa.array(np.concatenate([first[found], alone]))), np.concatenate([total[found], counts[alone]])
    return values.take(pa.array(first[found])), summed(counts, group, 2 * len(kinds))[found]


class Frequent:
    """Misra-Gries summary of at most ``most`` values, with what is known of each.

    ``lost`` bounds the rows of any value that isn't there, and is at most
    1 / ``most`` of all rows, so that no value of a larger share is missing.
    A value has at least ``seen`` rows and at most ``missed`` more: those that
    it may have had before it came in; 0: its count is exact."""

    def __init__(self, most: int):
        self.most, self.lost = most, 0
        self.values = pa.array([], pa.binary())
        self.weight = self.seen = self.missed = np.zeros(0, dtype=np.int64)

    def add(self, values: pa.Array, counts: np.ndarray) -> None:
        """Distinct values with their counts: summed up by themselves, then put together with those before."""
        weight, lost = counts, 0
        if (rest := len(counts) - self.most) > 0:
            lost = int(np.partition(counts, rest - 1)[rest - 1])
            kept = counts > lost
            values, counts = values.filter(pa.array(kept)), counts[kept]
            weight = counts - lost
        at = pc.fill_null(pc.index_in(values, value_set=self.values), -1).to_numpy(zero_copy_only=False)
        old, new = at[at >= 0], at < 0
        missed = self.missed + lost
        missed[old] -= lost
        for name, these in (("weight", weight), ("seen", counts)):
            both = getattr(self, name).copy()
            both[old] += these[~new]
            setattr(self, name, np.concatenate([both, these[new]]))
        self.missed = np.concatenate([missed, np.full(new.sum(), self.lost)])
        self.values = pa.concat_arrays([self.values, values.filter(pa.array(new))])
        self.lost += lost
        self.cut(self.most)

    def cut(self, most: int) -> None:
        """Keep the ``most`` heaviest at most."""
        if (rest := len(self.weight) - most) > 0:
            lost = int(np.partition(self.weight, rest - 1)[rest - 1])
            kept = self.weight > lost
            self.values = self.values.filter(pa.array(kept))
            self.weight, self.seen, self.missed = self.weight[kept] - lost, self.seen[kept], self.missed[kept]
            self.lost += lost


def _rows(schema: pa.Schema, column: str, kind: str, text: pa.Array, *numbers: np.ndarray) -> pa.RecordBatch:
    n = len(text)
    named = [pa.DictionaryArray.from_arrays(pa.array(np.zeros(n, dtype=np.int32)), pa.array([x])).cast(pa.string()) for x in (column, kind)]
    return pa.RecordBatch.from_arrays([*named, text.view(pa.string()), *(pa.array(x, pa.int64()) for x in numbers)], schema=schema)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every value but null and every shape of every column, with its count in a chunk."""
    for chunk in chunks(batches):
        for name, column in zip(chunk.column_names, chunk.columns):
            values, counts = distinct(column)
            kinds, codes = shapes(values)
            yield _rows(COUNTED, name, VALUE, values, counts)
            yield _rows(COUNTED, name, SHAPE, kinds, summed(counts, codes, len(kinds)))


def summaries(tracked: int, handed_on: int):
    """A task's rows: its values by what a profile tells apart, with their
    counts (kind 'cell'); of each column the summaries of its values and
    shapes.  A summary's row without a text has what it lost, from its other
    rows that is taken off: summed over all tasks, a value has missed both sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[str, Frequent]] = {}
        for chunk in chunks(batches):
            for name, column in zip(chunk.column_names, chunk.columns):
                of = known.setdefault(name, {kind: Frequent(tracked) for kind in (VALUE, SHAPE)})
                values, counts = distinct(column)
                kinds, codes = shapes(values)
                of[VALUE].add(values, counts)
                of[SHAPE].add(kinds, summed(counts, codes, len(kinds)))
                some, n = alike(values, counts, kinds, codes)
                if column.null_count:
                    some, n = pa.concat_arrays([some, pa.nulls(1, pa.binary())]), np.append(n, column.null_count)
                yield _rows(SUMMED, name, CELL, some, n, np.zeros(len(n)))
        for name, of in known.items():
            for kind, found in of.items():
                found.cut(handed_on)
                yield _rows(SUMMED, name, kind, pa.concat_arrays([found.values, pa.nulls(1, pa.binary())]),
                            np.append(found.seen, 0), np.append(found.missed - found.lost, found.lost))
    return run
