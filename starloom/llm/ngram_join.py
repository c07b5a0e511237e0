"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct five-word shingles, held as 64-bit
hashes.  Documents with equal sets form a class, which counts once.

All shingles have one global order: by a count sketch of the corpus (rare
first), then by hash.  If two sets are similar enough, the first shingles they
share lie early in both: with prefixes of n - ceil(t n) + l shingles they share
l of them at least.  Each document picks its own l: a longer prefix costs more
entries, but a pair must then share more of them before it is verified; the
choice minimises the estimated sum from the sketch's counts.  A pair has to
share min(l of both), as the longer prefix holds the shorter one.

Links are wanted for components only, so pairs that are connected already need
no look.  Candidates are settled in three steps: (1) within each prefix
shingle, all holders against one pivot; (2) in shingles with many holders left
in different components, all smaller components against the largest one and
each other, in blocks; (3) all pairs that are left, under the multi-match
rule.  Pairs pass a parity bitmap first (its Hamming distance never exceeds
the symmetric difference, so it drops no link), which spares most of them the
fetching of their sets; each step then verifies whole sets and merges
components.  Together they decide every pair that the prefixes admit, without
emitting the pairs of a large group as rows.

Nothing grows on the driver: the sketch has a fixed size and a bitmap of the
documents to fetch too.

Defined results: null and empty texts have no shingles and link with nothing;
texts of fewer than five words are one shingle; repeated rows fall into one
class; rows with a null id take no part in links and have no component; an
empty table gives an empty result; further columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import SPACES, id_and_text, kept, passing, ready, written
from starloom.llm.links import components

#: Words of a shingle; similarity in percent; counters of the sketch; bits of the bitmap.
WORDS, PERCENT, SKETCH, BITS = 5, 75, 1 << 18, 1 << 24
#: Longest extension of a prefix; cost of a candidate against that of an entry.
MOST_MATCHES, CANDIDATE_COST = 4, 4.0
#: Holders from which a shingle counts as hot; shingles of a block of documents.
HOT, BLOCK_SHINGLES = 64, 1 << 18

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                    0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


#: Word separators among the bytes; base of the words' polynomial and its inverse modulo 2^64; powers at hand.
_SPACE = np.isin(np.arange(256), list(SPACES.encode()))
_BASE, _POWERS = 0x9E6C63D0876A9A47, 1 << 18


def shingler_of(words: int) -> "Shingler":
    """The worker's shingler, with its tables."""
    return kept(("shingler", words), lambda: Shingler(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _SPREAD[1]
    return h ^ (h >> np.uint64(29))


class Shingler:
    """Sorted distinct shingle hashes of texts, a text's bytes at a time.

    A word is the number that its bytes make in an odd base modulo 2^64: a
    difference of running sums over the text, divided by the power of its start."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.powers, self.inverse = self._powers(_POWERS)

    @staticmethod
    def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
        each = (np.full(n + 1, f, np.uint64) for f in (_BASE, pow(_BASE, -1, 1 << 64)))
        out = []
        for factors in each:
            factors[0] = 1
            out.append(np.cumprod(factors))
        return out[0], out[1]

    def word_hashes(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
        n = len(data)
        powers, inverse = (self.powers, self.inverse) if n <= _POWERS else self._powers(n)
        word = np.zeros(n + 2, np.int8)
        word[1:-1] = ~_SPACE[data]
        edges = np.flatnonzero(word[1:] != word[:-1])  # starts and ends by turns
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
        starts, ends = edges[::2], edges[1::2]
        return _mixed((sums[ends] - sums[starts]) * inverse[starts])

    def hashes(self, text: str) -> np.ndarray:
        h = self.word_hashes(text)
        if not len(h):
            return np.zeros(0, np.uint64)
        size = min(self.words, len(h))  # fewer words: the whole sequence
        n = len(h) - size + 1
        mixed = np.full(n, size, np.uint64)
        for k in range(size):
            mixed += h[k:k + n] * _SPREAD[k]
        mixed = np.sort(_mixed(mixed))
        return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def class_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _node(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def parity(hashes: np.ndarray) -> bytes:
    """Bitmap of two to four bits per shingle, a power of two in all; each
    shingle flips its bit."""
    bits = max(64, 1 << int(2 * len(hashes) - 1).bit_length())
    at = ((hashes >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference: the larger bitmap, folded to
    the size of the other, differs from it in so many bits."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _texts(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with two hashes that stand for the text."""
    return rows.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})


def digests(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows of two kinds: documents (doc_id, t1, t2, n, key, node, bitmap) and counters of the sketch (counter, n)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, sketch = shingler_of(words), np.zeros(SKETCH, np.int64)
        for pdf in batches:
            for k in range(0, len(pdf), 1024):
                some = pdf.iloc[k:k + 1024]
                sets = [shingler.hashes(t) for t in some["text"]]
                every = np.concatenate(sets) & np.uint64(SKETCH - 1)
                sketch += np.bincount(every.astype(np.int64), minlength=SKETCH)
                keys = [class_key(h) if len(h) else None for h in sets]
                yield pd.DataFrame({
                    "doc_id": some["doc_id"].astype("Int64"), "t1": some["t1"], "t2": some["t2"],
                    "counter": pd.array([None] * len(some), "Int32"),
                    "n": [len(h) for h in sets], "key": keys,
                    "node": pd.array([None if k is None else _node(k) for k in keys], "Int64"),
                    "bitmap": [parity(h) if len(h) else None for h in sets]})
        at = np.flatnonzero(sketch)
        if len(at):
            none = [None] * len(at)
            yield pd.DataFrame({"doc_id": pd.array(none, "Int64"), "t1": 0, "t2": 0, "counter": pd.array(at, "Int32"),
                                "n": sketch[at], "key": none, "node": pd.array(none, "Int64"), "bitmap": none})
    return _texts(rows).mapInPandas(run, "doc_id long, t1 long, t2 long, counter int, n long, key binary, node long, bitmap binary")


def choose_matches(counts: np.ndarray, shortest: int) -> int:
    """l of least estimated cost for a document whose shingles, in order, have
    these counts: entries up to l, and candidates, which need l matches each."""
    most = min(MOST_MATCHES, len(counts) - shortest + 1)
    partners = np.cumsum(counts - 1)
    cost = [shortest + l - 1 + CANDIDATE_COST * partners[shortest + l - 2] / l for l in range(1, most + 1)]
    return 1 + int(np.argmin(cost))


def prefix_entries(rows: DataFrame, sketch: np.ndarray, words: int, percent: int) -> DataFrame:
    """(shingle, node, meta) of every prefix; meta is 8 * n + l."""
    noise = int(np.median(sketch))
    shared = rows.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen, counters = shingler_of(words), set(), shared.value
        for pdf in batches:
            shingles, nodes, metas, sizes = [], [], [], []
            for text in pdf["text"]:
                h = shingler.hashes(text)
                key = class_key(h) if len(h) else None
                if key is None or key in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                n = len(h)
                count = counters[(h & np.uint64(SKETCH - 1)).astype(np.int64)]
                shortest = n - -(-percent * n // 100) + 1
                reach = min(n, shortest + MOST_MATCHES - 1)
                early = np.argpartition(count, reach - 1)[:reach] if reach < n else np.arange(n)
                early = np.flatnonzero(count <= count[early].max())
                order = early[np.lexsort((h[early], count[early]))][:reach]
                matches = choose_matches(np.maximum(count[order] - noise, 1), shortest)
                take = h[order[:shortest + matches - 1]]
                shingles.append(take.view(np.int64))
                nodes.append(_node(key))
                metas.append(8 * n + matches)
                sizes.append(len(take))
            if shingles:
                yield pd.DataFrame({"shingle": np.concatenate(shingles), "node": np.repeat(nodes, sizes),
                                    "meta": np.repeat(metas, sizes)})
    return rows.mapInPandas(run, "shingle long, node long, meta long")


def _reaches(a: str, b: str, percent: int) -> Column:
    """Whether a document as large as a's is large enough to be similar to one as large as b's."""
    return 100 * F.floor(F.col(a) / 8) >= percent * F.floor(F.col(b) / 8)


def _fits(a: str, b: str, percent: int) -> Column:
    """Sizes that a similar pair can have."""
    return _reaches(a, b, percent) & _reaches(b, a, percent)


def _matches(a: str, b: str) -> Column:
    return F.least(F.col(a) % 8, F.col(b) % 8)


def possible(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, part_a, part_b) whose bitmaps leave room for a link."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [(100 - percent) * (m + n) >= (100 + percent) * least_difference(x, y)
                  for m, n, x, y in zip(pdf["n_a"], pdf["n_b"], pdf["bitmap_a"], pdf["bitmap_b"])]
            yield pdf.loc[ok, ["a", "b", "part_a", "part_b"]]

    of = lambda side: bitmaps.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"),
                                     F.col("bitmap").alias(f"bitmap_{side}"))
    return written(pairs.join(of("b"), "b").join(of("a"), "a").mapInPandas(
        run, "a long, b long, part_a long, part_b long"), "join-possible")


def _around(pairs: DataFrame) -> DataFrame:
    """Groups for ``verify``: each first node against its partners."""
    partners = pairs.select(F.col("a").alias("group"), F.col("b").alias("node"), F.col("part_b").alias("part"),
                            F.lit(False).alias("is_left"))
    return partners.unionByName(pairs.select(F.col("a").alias("group"), F.col("a").alias("node"),
                                             F.col("part_a").alias("part"), F.lit(True).alias("is_left")).distinct())


def _bit(*cols: str) -> dict[str, Column]:
    """Place of a key in a bitmap of fixed size: a word's number and the bit in it."""
    h = F.xxhash64(*cols)
    return {"word": (F.pmod(h, F.lit(BITS)) / 64).cast("int"),
            "bit": F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))}


def shingle_sets(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node and shingles of the wanted classes (node, rep, key), fetched from
    the document that stands for each.  A bitmap of fixed size spares most other
    documents the work; the join by id and class decides, as an id may be held
    by several texts."""
    words_of = wanted.withColumns(_bit("rep")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # BITS / 64 rows at most
    bitmap = np.zeros(BITS // 64, np.int64)
    bitmap[words_of["word"].to_numpy()] = words_of["bits"].to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)
    hashed = rows.withColumn("h", F.xxhash64("doc_id"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, wants, seen = shingler_of(words), shared.value, set()
        for pdf in batches:
            h = pdf["h"].to_numpy()
            hit = (wants[(h % BITS) // 64] >> (h % 64)) & 1
            rows = []
            for doc_id, text in pdf.loc[hit == 1, ["doc_id", "text"]].itertuples(index=False):
                shingles = shingler.hashes(text)
                key = class_key(shingles)
                if len(shingles) and (doc_id, key) not in seen:  # a repeated row once a task
                    if len(seen) < 1_000_000:
                        seen.add((doc_id, key))
                    rows.append((doc_id, key, shingles.view(np.int64)))
            if rows:
                yield pd.DataFrame(rows, columns=["rep", "key", "shingles"])

    found = hashed.filter("doc_id IS NOT NULL").mapInPandas(run, "rep long, key binary, shingles array<long>")
    return found.join(wanted, ["rep", "key"]).select("node", "shingles", F.size("shingles").alias("size"))


def _verified(percent: int):
    """Links of one block: all left documents against all right ones.  Of the
    links only a spanning forest over components is returned."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["node", "is_left"])
        right = pdf[~pdf["is_left"]]
        left = pdf[pdf["is_left"]]
        if not len(left) or not len(right):
            return EMPTY
        size = right["shingles"].map(len).to_numpy()
        holder = np.repeat(np.arange(len(right)), size)
        flat = np.concatenate(right["shingles"].tolist())
        order = np.argsort(flat, kind="stable")
        flat, holder = flat[order], holder[order]
        names, parts = right["node"].to_numpy(), right["part"].to_numpy()
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while above.setdefault(x, x) != x:
                above[x] = above[above[x]]
                x = above[x]
            return x

        out = []
        for node, part, own in zip(left["node"], left["part"], left["shingles"]):
            lo, hi = np.searchsorted(flat, own), np.searchsorted(flat, own, side="right")
            spread = hi - lo
            at = np.arange(int(spread.sum())) + np.repeat(lo - (np.cumsum(spread) - spread), spread)
            common = np.bincount(holder[at], minlength=len(right))
            for k in np.flatnonzero(100 * common >= percent * (size + len(own) - common)).tolist():
                a, b = top(int(part)), top(int(parts[k]))
                if a != b:
                    above[max(a, b)] = min(a, b)
                    out.append((node, names[k]))
        return pd.DataFrame(out, columns=["a", "b"]).astype(np.int64)
    return run


def verify(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among ``groups`` (group, node, part, is_left): within each group
    every left node is compared with every right one whole.  Groups are cut
    into blocks of bounded content, each pair of blocks being a task's work;
    links within a ``part`` are not looked for."""
    volume = (groups.join(sets.select("node", "size"), "node").groupBy("group")
              .agg(F.sum(F.when(F.col("is_left"), F.col("size"))).alias("l"),
                   F.sum(F.when(~F.col("is_left"), F.col("size"))).alias("r"))
              .select("group", F.ceil(F.col("l") / BLOCK_SHINGLES).alias("lefts"), F.ceil(F.col("r") / BLOCK_SHINGLES).alias("rights"),
                      (F.col("l") + F.col("r")).alias("volume")))
    volume = written(volume.filter("lefts > 0 AND rights > 0"), "join-volume")
    work = volume.agg(F.sum((F.col("lefts") + F.col("rights")) * F.greatest(F.col("volume") / F.greatest("lefts", "rights"), F.lit(1)))
                      ).head()[0] or 0
    tasks = 1 + int(work / (4 * BLOCK_SHINGLES))
    own = F.when(F.col("is_left"), F.pmod(F.xxhash64("node"), F.col("lefts"))).otherwise(
        F.pmod(F.xxhash64("node"), F.col("rights")))
    others = F.when(F.col("is_left"), F.col("rights")).otherwise(F.col("lefts"))
    dealt = groups.join(volume, "group").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)))
    dealt = dealt.select(
        "group", F.when(F.col("is_left"), F.col("own")).otherwise(F.col("other")).alias("x"),
        F.when(F.col("is_left"), F.col("other")).otherwise(F.col("own")).alias("y"), "node", "part", "is_left")
    # Small blocks share a call, dealt by a hash of the block; a call stays near the size of a few full blocks.
    call = F.pmod(F.xxhash64("group", "x", "y"), F.lit(tasks))
    verified = _verified(percent)
    return dealt.withColumn("call", call).join(sets.select("node", "shingles"), "node").groupBy("call").applyInPandas(
        lambda pdf: pd.concat([EMPTY, *(verified(g) for _, g in pdf.groupby(["group", "x", "y"], sort=False))]),
        "a long, b long")


EMPTY = pd.DataFrame({"a": [], "b": []}, dtype=np.int64)


def _labelled(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """Entries of shingles whose holders lie in two components at least."""
    at = Window.partitionBy("shingle")
    return (shared.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
            .withColumn("lo", F.min("part").over(at)).withColumn("hi", F.max("part").over(at))
            .filter("lo < hi").drop("lo", "hi"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
         percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    documents, classes = _grouped(docs, id_col, text_col, words, percent)
    smallest = classes.groupBy("part").agg(F.min("rep").alias("component_id"))
    by_key = classes.join(smallest, "part").select("key", "component_id")
    return (documents.join(by_key, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, t1, t2, n, key) and classes (key, rep, part): each
    class's smallest id, and the component that it lies in."""
    ready(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)
    first = written(digests(rows, words), "join-digests")
    sketch = np.zeros(SKETCH, np.int64)
    counts = first.filter("counter IS NOT NULL").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()  # SKETCH rows at most
    sketch[counts["counter"].to_numpy()] = counts["n"].to_numpy()
    documents = first.filter("counter IS NULL").select("doc_id", "t1", "t2", "n", "key")
    classes = written(first.filter("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key", "node", "n").agg(
        F.min("doc_id").alias("rep"), F.max("bitmap").alias("bitmap")), "join-classes")
    with passing(docs.sparkSession):
        parts = written(_parts(rows.filter("doc_id IS NOT NULL"), classes, sketch, words, percent), "join-parts", outlives=True)
    return documents, classes.select("key", "node", "rep").join(parts, "node", "left").select(
        "key", "rep", F.coalesce("part", "node").alias("part"))


def _parts(identified: DataFrame, classes: DataFrame, sketch: np.ndarray, words: int, percent: int) -> DataFrame:
    """(node, part) of every class that is linked with another."""
    bitmaps = classes.select("node", "n", "bitmap")
    at = Window.partitionBy("shingle")
    shared = written(
        prefix_entries(identified, sketch, words, percent)
        .withColumns({"lo": F.min("node").over(at), "hi": F.max("node").over(at),
                      "pivot": F.min(F.struct(F.xxhash64("node").alias("h"), "node", "meta")).over(at)})
        .filter("lo < hi").dropDuplicates(["shingle", "node"]).withColumn("holders", F.count("*").over(at))
        .select("shingle", "node", "meta", "holders", F.col("pivot.node").alias("pivot"), F.col("pivot.meta").alias("pivot_meta")),
        "join-entries")

    def fetched(nodes: DataFrame) -> DataFrame:
        wanted = nodes.distinct().join(classes.select("rep", "key", "node"), "node")
        return written(shingle_sets(identified, wanted, words), "join-sets")

    # 1. Every holder against the pivot of its shingle.
    pairs = (shared.filter("node != pivot").groupBy("pivot", "node")
             .agg(F.count("*").alias("c"), F.first("meta").alias("meta"), F.first("pivot_meta").alias("pivot_meta"))
             .filter(_fits("meta", "pivot_meta", percent) & (F.col("c") >= _matches("meta", "pivot_meta")))
             .select(F.col("pivot").alias("a"), F.col("node").alias("b"), F.col("pivot").alias("part_a"), F.col("node").alias("part_b")))
    pairs = possible(pairs, bitmaps, percent)
    hot = F.col("holders") > HOT
    sets = fetched(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(
        shared.filter(hot).select("node")))
    links = written(verify(_around(pairs), sets, percent), "join-links")
    parts = written(components(links), "join-parts")

    # 2. Shingles with many holders in several components: the others against the largest.
    left = written(_labelled(shared.drop("pivot", "pivot_meta"), parts), "join-left")
    heads = left.filter(hot).groupBy("shingle", "part").agg(F.count("*").alias("n"))
    heads = heads.withColumn("top", F.max(F.struct("n", "part")).over(at)).filter(F.col("part") != F.col("top.part"))
    parents = written(heads.groupBy("part").agg(F.max("top").alias("top")).select("part", F.col("top.part").alias("label")),
                      "join-parents")
    # Of each component its members in hot shingles, whose sets are at hand; a
    # member outside them shares no hot shingle and is left to step 3.
    members = left.filter(hot).select("node", "part").distinct()
    small = members.join(parents, "part").select(F.col("label").alias("group"), "node", "part")
    large = members.join(parents.select(F.col("label").alias("part")).distinct(), "part").select(
        F.col("part").alias("group"), "node", "part")
    groups = small.withColumn("is_left", F.lit(True)).unionByName(
        small.unionByName(large).withColumn("is_left", F.lit(False)))
    links = links.unionByName(written(verify(groups, sets, percent), "join-links"))
    merged = written(components(links), "join-parts")

    # 3. Pairs that are left: in different components, not compared by a common label.
    compared = small.select("node", F.col("group").alias("label")).unionByName(
        large.select("node", F.col("group").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
    # Labels of compared members are component ids, so node ids too; the flag
    # keeps them apart from the nodes that step 2 did not compare.
    label = F.struct(F.col("label").isNull().alias("alone"), F.coalesce("label", "node").alias("id"))
    left = (left.drop("part", "holders").join(compared, "node", "left").withColumn("label", label)
            .join(merged, "node", "left").withColumn("part", F.coalesce("part", "node")))
    left = written(left.withColumns({"lo": F.min("label").over(at), "hi": F.max("label").over(at),
                                     "first": F.min("part").over(at), "last": F.max("part").over(at)})
                   .filter("lo < hi AND first < last").drop("lo", "hi", "first", "last"), "join-rest")
    # Two labels meet only if members of theirs can be similar by size.
    labels = left.groupBy("shingle", "label").agg(F.min("meta").alias("low"), F.max("meta").alias("high"))
    others = labels.select("shingle", *(F.col(c).alias(f"{c}_b") for c in ("label", "low", "high")))
    crossed = labels.join(others, "shingle").filter(
        (F.col("label") < F.col("label_b")) & _reaches("high", "low_b", percent) & _reaches("high_b", "low", percent)).select(
        "shingle", "label", "label_b")
    a = left.select("shingle", "label", F.col("part").alias("part_a"), F.col("node").alias("a"), F.col("meta").alias("meta_a"))
    b = left.select("shingle", F.col("label").alias("label_b"), F.col("part").alias("part_b"), F.col("node").alias("b"),
                    F.col("meta").alias("meta_b"))
    pairs = (crossed.join(a, ["shingle", "label"]).join(b, ["shingle", "label_b"]).filter("part_a != part_b")
             .filter(_fits("meta_a", "meta_b", percent)).groupBy("a", "b")
             .agg(F.count("*").alias("c"), F.first("meta_a").alias("meta_a"), F.first("meta_b").alias("meta_b"),
                  F.first("part_a").alias("part_a"), F.first("part_b").alias("part_b"))
             .filter(F.col("c") >= _matches("meta_a", "meta_b")).select("a", "b", "part_a", "part_b"))
    pairs = possible(pairs, bitmaps, percent)
    if pairs.isEmpty():
        return merged
    sets = fetched(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))))
    return components(links.unionByName(written(verify(_around(pairs), sets, percent), "join-links")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                percent: int = PERCENT) -> DataFrame:
    """One document of each component, all columns as they are: the one of the
    smallest id; among several texts of that id the one whose hash is smallest,
    among rows equal in both the one whose hash over all columns is smallest.
    Documents without shingles and rows without an id are like nothing and all
    stay, whatever ids they share."""
    at = ["doc_id", "t1", "t2"]
    with passing(docs.sparkSession):
        told = written(_told(*_grouped(docs, id_col, text_col, words, percent), at), "join-told", outlives=True)
    # The document is one column, so its own names meet none of these.
    doc_id, text = docs[id_col].cast("long"), F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = _texts(docs.select(F.struct("*").alias("doc"), doc_id.alias("doc_id"), text.alias("text"))).drop("text")
    # A bitmap of fixed size spares most documents the shuffle: what it doesn't
    # show is not told of; of the others the joins decide.
    bits = told.withColumns(_bit(*at)).groupBy("word").agg(
        F.bit_or("bit").alias("bits"), F.bit_or(F.when(F.col("stays"), F.col("bit"))).alias("stay_bits"))  # BITS / 64 rows at most
    rows = rows.withColumns(_bit(*at)).join(F.broadcast(bits), "word", "left")
    shown = lambda c: F.coalesce(F.col(c).bitwiseAND(F.col("bit")) != 0, F.lit(False))
    untold = rows.filter(~shown("bits")).select("doc")
    once = rows.filter(shown("bits")).join(told.select(*at), at, "left_anti").select("doc")
    many = rows.filter(shown("stay_bits")).join(told.filter("stays").select(*at), at, "left_semi").groupBy(*at).agg(
        F.min_by("doc", F.xxhash64("doc")).alias("doc")).select("doc")
    kept = untold.unionByName(once).unionByName(many)
    return kept.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def _told(documents: DataFrame, classes: DataFrame, at: list[str]) -> DataFrame:
    """The texts (by ``at``) of which not every row stays: ``stays`` if one of several rows does, else none."""
    texts = documents.filter("key IS NOT NULL AND doc_id IS NOT NULL").groupBy(*at, "key").agg(F.count("*").alias("rows"))
    placed = written(texts.join(classes.select("key", "part"), "key").select(*at, "part", "rows"), "join-texts")
    # The first text of a component stays; of a text that is there more than once, one row.
    firsts = placed.groupBy("part").agg(F.min(F.struct(*at)).alias("first"))
    first = F.struct(*at) == F.col("first")
    return placed.join(firsts, "part").select(*at, first.alias("stays"), "rows").filter("NOT stays OR rows > 1")
