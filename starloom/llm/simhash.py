"""SimHash near duplicates by the generalised pigeonhole principle.

A fingerprint bit is 1 if it is set in over half of a text's shingle hashes.
Equal fingerprints form a class, which counts once.  Two fingerprints link if
they differ in at most ``radius`` bits.

The bits are dealt to parts, correlated bits (by their co-occurrence over all
fingerprints) together.  If two fingerprints differ in at most r bits, then for
any thresholds t_i >= -1 with sum r - parts + 1 they differ in at most t_i bits
of some part i (-1: the part is not looked at).  Each fingerprint picks its own
thresholds: counts of all fingerprints by part value give the candidates that
each threshold would bring, and dynamic programming over the parts finds the
cheapest allocation, so that crowded values are skipped.  It then probes every
part value within the threshold; all fingerprints lie in the index under each
of their part values.  No pair within the radius is missed.

Links serve components only.  Before probing, every fingerprint is compared
with a few pivots of the 16-bit values that it holds, which joins crowds of near
copies; members of the largest component need not probe (the other end of a
link to them does), and nobody is compared with its own component.  Crowded
part values are cut into blocks of bounded size, and each task returns a
spanning forest of the links that it finds.

Nothing grows on the driver: the statistics have fixed size.

Defined results: null and empty texts have fingerprint zero and link like any
other; rows with a null id have a fingerprint and take part, and component_id is
the smallest non-null id (null if there is none); repeated rows fall into one
class; an empty table gives an empty result; further columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import id_and_text, written
from starloom.llm.links import components, forest

#: Words of a shingle, seed of its hash, most differing bits of a link.
WORDS, SEED, RADIUS = 4, 42, 4
#: Bits of a fingerprint; bits of a counted value; fingerprints up to which four parts serve, three beyond.
BITS, VALUE, FEW = 64, 16, 1 << 27
#: Pivots of a value, fingerprints of a block, pairs compared at once, cost of a probe against that of a comparison.
PIVOTS, BLOCK, AT_ONCE, PROBE_COST = 4, 1 << 14, 1 << 20, 16.0

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash of a text's shingles, as an unsigned number."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    if len(found) < words:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    joined, digest = memoryview(b" ".join(found)), xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends[words - 1:].tolist())
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(found) - words + 1)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(h), 1 << 16):
        ones += unpacked(h[k:k + (1 << 16)]).sum(axis=0, dtype=np.int64)
    return int(packed(ones[None] * 2 > len(h))[0])


def unpacked(codes: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers, the lowest first."""
    return np.unpackbits(np.ascontiguousarray(codes).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, code (the fingerprint as a signed long) of rows (doc_id, text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes = np.fromiter((fingerprint(t, words) for t in pdf["text"]), np.uint64, len(pdf))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "code": codes.view(np.int64)})
    return rows.mapInPandas(run, "doc_id long, code long")


def co_occurrence(codes: DataFrame) -> tuple[int, np.ndarray]:
    """Fingerprints, and how many have both of any two bits: 64 rows a task, 64 on the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for pdf in batches:
            for k in range(0, len(pdf), 1 << 13):
                bits = unpacked(pdf["code"].to_numpy(np.int64)[k:k + (1 << 13)].view(np.uint64)).astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
                n += len(bits)
        yield pd.DataFrame({"bit": np.arange(BITS), "n": n, "both": list(both)})
    counted = codes.mapInPandas(run, "bit int, n long, both array<long>").groupBy("bit").agg(
        F.sum("n").alias("n"), *(F.sum(F.get("both", F.lit(k))).alias(f"b{k}") for k in range(BITS))).collect()
    both = np.zeros((BITS, BITS), np.int64)
    for r in counted:
        both[r["bit"]] = [r[f"b{k}"] for k in range(BITS)]
    return (counted[0]["n"] if counted else 0), both


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits of each part: correlated ones together, sizes equal but for one."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    scale = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    near = np.abs(cov / np.outer(scale, scale))
    np.fill_diagonal(near, 0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        part = [max(free, key=lambda i: (near[i, free].sum(), -i))]
        free.remove(part[0])
        while len(part) < size:
            part.append(max(free, key=lambda i: (near[i, part].sum(), -i)))
            free.remove(part[-1])
        out.append(sorted(part))
    return out


def within(counts: np.ndarray, radius: int) -> np.ndarray:
    """For each value, how many of the counted lie at distance exactly 0 .. radius."""
    width = len(counts).bit_length() - 1
    values, out = np.arange(len(counts)), np.zeros((radius + 1, len(counts)), np.float64)
    out[0] = counts
    for bit in range(width):  # each bit is flipped or not
        flipped = out[:, values ^ (1 << bit)]
        out[1:] += flipped[:-1]
    return out


def masks(width: int, radius: int) -> np.ndarray:
    """Numbers of ``width`` bits with at most ``radius`` ones, fewest ones first."""
    levels = [[0]]
    for _ in range(min(radius, width)):
        levels.append([m | (1 << b) for m in levels[-1] for b in range(m.bit_length(), width)])
    return np.array([m for level in levels for m in level], np.int64)


class Plan:
    """Parts, counts and costs, the same in every task; of fixed size."""

    def __init__(self, n: int, both: np.ndarray, radius: int, parts: int | None):
        self.n, self.radius = n, radius
        self.parts = group_bits(n, both, parts or (4 if n <= FEW else 3))
        self.masks = [masks(len(p), radius) for p in self.parts]
        #: Values of parts beyond 16 bits are counted by halves.
        self.pieces = [[p[k:k + VALUE] if len(p) <= VALUE else half for k, half in ((0, p[:len(p) // 2]), (1, p[len(p) // 2:]))
                        if len(p) > VALUE or k == 0] for p in self.parts]
        self.near: list[list[np.ndarray]] = []

    def values(self, codes: np.ndarray, bits: list[int]) -> np.ndarray:
        """The number that ``bits`` make of each fingerprint."""
        codes = codes.view(np.uint64)
        out = np.zeros(len(codes), np.int64)
        for k, bit in enumerate(bits):
            out |= ((codes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
        return out

    def counted(self, counts: dict[tuple[int, int], np.ndarray]) -> None:
        self.near = [[within(counts[i, j], self.radius) for j in range(len(pieces))] for i, pieces in enumerate(self.pieces)]

    def candidates(self, codes: np.ndarray, i: int) -> np.ndarray:
        """Estimated fingerprints within 0 .. radius of each one's part ``i``;
        exact for parts of one piece, by independence of the halves otherwise."""
        each = [near[:, self.values(codes, bits)] for near, bits in zip(self.near[i], self.pieces[i])]
        at = each[0]
        if len(each) > 1:
            at = np.stack([sum(each[0][a] * each[1][r - a] for a in range(r + 1)) for r in range(self.radius + 1)]) / max(self.n, 1)
        return np.cumsum(at, axis=0)

    def thresholds(self, codes: np.ndarray) -> np.ndarray:
        """The cheapest t_i (rows: parts) of each fingerprint whose t_i + 1 sum to
        radius + 1, by dynamic programming over the parts."""
        size, units = len(codes), self.radius + 2
        best = np.full((units, size), np.inf)
        best[0] = 0
        choice = []
        for i, masks_ in enumerate(self.masks):
            probes = np.searchsorted(np.bitwise_count(masks_), np.arange(self.radius + 1), side="right")
            cost = np.concatenate([np.zeros((1, size)), self.candidates(codes, i) + PROBE_COST * probes[:, None]])
            options = np.full((units, units, size), np.inf)  # by units spent so far, by units spent here
            for here in range(units):
                options[here:, here] = best[:units - here] + cost[here]
            choice.append(options.argmin(axis=1))
            best = options.min(axis=1)
        left, out = np.full(size, units - 1), np.zeros((len(self.parts), size), np.int64)
        for i in range(len(self.parts) - 1, -1, -1):
            out[i] = choice[i][left, np.arange(size)]
            left = left - out[i]
        return out - 1


def value_statistics(codes: DataFrame, plan: Plan) -> tuple[dict, dict]:
    """By piece of a part: fingerprints of each 16-bit value, and its pivots."""
    names = [(i, j) for i, pieces in enumerate(plan.pieces) for j in range(len(pieces))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            code = pdf["code"].to_numpy(np.int64)
            for k, (i, j) in enumerate(names):
                yield pd.DataFrame({"at": (k << VALUE) + plan.values(code, plan.pieces[i][j]), "code": code, "docs": pdf["docs"].to_numpy()})
    draws = [F.min_by("code", F.xxhash64(F.lit(r), "code")).alias(f"pivot{r}") for r in range(1, PIVOTS)]
    # At most 2^16 rows a piece.
    table = codes.mapInPandas(run, "at long, code long, docs long").groupBy("at").agg(
        F.count("*").alias("n"), F.max_by("code", F.col("docs")).alias("pivot0"), *draws).toArrow()
    at = table["at"].to_numpy()
    counts, pivots = {}, {}
    for k, name in enumerate(names):
        mine = at >> VALUE == k
        values = at[mine] & ((1 << VALUE) - 1)
        counts[name] = np.zeros(1 << len(plan.pieces[name[0]][name[1]]), np.int64)
        counts[name][values] = table["n"].to_numpy()[mine]
        pivots[name] = np.zeros((PIVOTS, len(counts[name])), np.int64)
        for r in range(PIVOTS):
            pivots[name][r, values] = table[f"pivot{r}"].to_numpy()[mine]
    return counts, pivots


def pivot_links(codes: DataFrame, plan: Plan, pivots: dict) -> DataFrame:
    """Links (a, b) of each fingerprint to the pivots of its values."""
    shared, radius = codes.sparkSession.sparkContext.broadcast(pivots), plan.radius

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            code = pdf["code"].to_numpy(np.int64)
            pairs = []
            for (i, j), table in shared.value.items():
                for row in table[:, plan.values(code, plan.pieces[i][j])]:
                    near = np.flatnonzero((np.bitwise_count((code ^ row).view(np.uint64)) <= radius) & (code != row))
                    pairs.append((code[near], row[near]))
            a, b = (np.concatenate(x) for x in zip(*pairs))
            if len(a):
                a, b = forest(a, b)
                yield pd.DataFrame({"a": a, "b": b})
    return codes.select("code").mapInPandas(run, "a long, b long")


def entries(codes: DataFrame, plan: Plan, settled: int | None) -> DataFrame:
    """Rows (slot, value, probe, code, part): the index entries of all
    fingerprints and the probes of those outside the component ``settled``."""
    shared = codes.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = shared.value
        for pdf in batches:
            for k in range(0, len(pdf), 4096):
                code, part = (pdf[c].to_numpy(np.int64)[k:k + 4096] for c in ("code", "part"))
                asks = np.ones(len(code), bool) if settled is None else part != settled
                limits = plan.thresholds(code) if asks.any() else None
                for i, bits in enumerate(plan.parts):
                    values = plan.values(code, bits)
                    yield pd.DataFrame({"slot": i, "value": values, "probe": False, "code": code, "part": part})
                    for t in range(plan.radius + 1) if limits is not None else ():
                        who = np.flatnonzero(asks & (limits[i] == t))
                        if len(who):
                            flips = plan.masks[i][np.bitwise_count(plan.masks[i]) <= t]
                            for some in np.array_split(who, -(-len(who) * len(flips) // 100_000)):
                                yield pd.DataFrame({"slot": i, "value": (values[some][:, None] ^ flips).ravel(), "probe": True,
                                                    "code": np.repeat(code[some], len(flips)), "part": np.repeat(part[some], len(flips))})
    return codes.select("code", "part").mapInPandas(run, "slot int, value long, probe boolean, code long, part long")


def _pairs(asks: np.ndarray, ask_part: np.ndarray, first: np.ndarray, holders: np.ndarray, codes: np.ndarray,
           parts: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between probes and the ``holders`` entries from ``first`` on, of other components."""
    many = holders >= 512
    # Few holders: all pairs laid out in a row.
    rest = np.flatnonzero(~many & (holders > 0))
    bounds = np.cumsum(holders[rest])
    for lo in range(0, int(bounds[-1]) if len(bounds) else 0, AT_ONCE):
        some = rest[np.searchsorted(bounds, lo, side="right"):np.searchsorted(bounds, min(lo + AT_ONCE, bounds[-1]), side="left") + 1]
        some = some[:len(some)]
        size = holders[some]
        who = np.repeat(some, size)
        at = np.arange(len(who)) - np.repeat(np.cumsum(size) - size, size) + first[who]
        near = np.flatnonzero((np.bitwise_count((asks[who] ^ codes[at]).view(np.uint64)) <= radius) & (ask_part[who] != parts[at]))
        yield asks[who[near]], codes[at[near]]
    # Many holders: a matrix per value, without the probe's own component.
    big = np.flatnonzero(many)
    for start in np.unique(first[big]):
        mine = big[first[big] == start]
        own = slice(start, start + holders[mine[0]])
        held, of = codes[own], parts[own]
        groups, inverse = np.unique(ask_part[mine], return_inverse=True)
        crowd = np.isin(groups, of)
        blocks = [mine[~crowd[inverse]], *(mine[inverse == g] for g in np.flatnonzero(crowd))]
        for block in blocks:
            if not len(block):
                continue
            others = held if block is blocks[0] else held[of != ask_part[block[0]]]
            step = max(1, AT_ONCE // max(1, len(others)))
            for k in range(0, len(block), step):
                x = asks[block[k:k + step]]
                i, j = np.nonzero(np.bitwise_count((x[:, None] ^ others[None]).view(np.uint64)) <= radius)
                yield x[i], others[j]


def _compared(radius: int):
    """Links of sorted entries: each value's index entries come before its
    probes and stay at hand until the value ends."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((5, 0), np.int64)  # slot, value, block, code, part
        for pdf in batches:
            if not len(pdf):
                continue
            rows = np.stack([pdf[c].to_numpy(np.int64) for c in ("slot", "value", "block", "code", "part")])
            probe = pdf["probe"].to_numpy(bool)
            if held.shape[1] and (held[:3, -1] != rows[:3, 0]).any():
                held = held[:, :0]
            index = np.concatenate([held, rows[:, ~probe]], axis=1)
            asked = rows[:, probe]
            # Each value's number, in order, over entries and probes together.
            keys, at = np.unique(np.concatenate([index[:3], asked[:3]], axis=1), axis=1, return_inverse=True)
            at = np.ravel(at)
            of_index, of_asked = at[:index.shape[1]], at[index.shape[1]:]
            holders = np.bincount(of_index, minlength=keys.shape[1])
            first = np.cumsum(holders) - holders
            order = np.argsort(of_index, kind="stable")
            found = []
            for a, b in _pairs(asked[3], asked[4], first[of_asked], holders[of_asked], index[3][order], index[4][order], radius):
                if len(a):
                    found.append(forest(a, b))
            if found:
                a, b = forest(*(np.concatenate(x) for x in zip(*found)))
                yield pd.DataFrame({"a": a, "b": b})
            held = index[:, (index[:3] == rows[:3, -1:]).all(axis=0)]
    return run


def probe_links(entry: DataFrame, radius: int) -> DataFrame:
    """Links between probes and index entries of one part value, of different components."""
    at = ["slot", "value"]
    crowded = entry.filter("NOT probe").groupBy(*at).agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).filter("blocks > 1")
    n = F.coalesce("blocks", F.lit(1).cast("long"))
    dealt = entry.join(crowded, at, "left").withColumn("block", F.explode(F.when(
        F.col("probe"), F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array(F.pmod(F.xxhash64("code"), n)))))
    key = [*at, "block"]
    return dealt.repartition(*key).sortWithinPartitions(*key, "probe").select(
        *key, "probe", "code", "part").mapInPandas(_compared(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS,
                    parts: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    found = written(fingerprints(id_and_text(docs, id_col, text_col), words), "simhash-codes")
    codes = written(found.groupBy("code").agg(F.min("doc_id").alias("rep"), F.count("*").alias("docs")), "simhash-classes")
    plan = Plan(*co_occurrence(codes), radius, parts)
    counts, pivots = value_statistics(codes, plan)
    plan.counted(counts)
    links = written(pivot_links(codes, plan, pivots), "simhash-links")
    known = written(components(links), "simhash-parts")
    placed = written(codes.join(known.withColumnRenamed("node", "code"), "code", "left").select(
        "code", "rep", F.coalesce("part", "code").alias("part")), "simhash-placed")
    largest = known.groupBy("part").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "part").head()
    entry = written(entries(placed, plan, largest["part"] if largest else None), "simhash-entries")
    links = links.unionByName(written(probe_links(entry, radius), "simhash-links"))
    final = written(components(links), "simhash-parts").withColumnRenamed("node", "code")
    whole = codes.join(final, "code", "left").select("code", "rep", F.coalesce("part", "code").alias("part"))
    smallest = whole.groupBy("part").agg(F.min("rep").alias("component_id"))
    of = whole.join(smallest, "part").select("code", "component_id")
    return found.join(of, "code").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
