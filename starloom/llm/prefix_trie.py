"""Prefix trie over rebuilt conversations, by composable monoid fingerprints.

Conversation c is rebuilt from a head (the first h turns of conversation
c - c % 5, h = crc32 of c's decimal % 9) and its own turns after its first h.
Each distinct sequence of first d rebuilt turns is a node.

A turn sequence has a fingerprint F(t1..tn) = sum of a(ti) B^(i-1) modulo three
primes, a monoid: F(xy) = F(x) + B^|x| F(y).  So the fingerprint of every
rebuilt prefix follows from prefix products of the base and of the
conversation itself; no rebuilt sequence is made and no text is moved: a step
of a rebuilt conversation is a reference (conversation, position) to a stored
turn.  Prefix products come from one scan over turns sorted by range: products
of the runs that cross a partition are composed afterwards, so a conversation
may span any number of tasks.

Steps with equal depth and fingerprint form a node.  Equality is verified, not
assumed: all steps of a node must hold one turn hash and one parent, so by
induction equal sequences of turn hashes; where they refer to different stored
turns, these turns' roles and texts are compared.  If anything differs, all is
done again with other hashes.

Sums over subtrees need no walk through the trie.  A node belongs to its
smallest member, and a member owns its path from some depth on; a node's saved
bytes are then, over its members, the bytes of the steps that they do not own,
and its leaves the members that own a leaf.  Both are plain grouped sums.

Defined results: turns are ordered by turn (null first), ties by role, then
the first 256 characters of the text, then a hash; null role and text count as
empty; rows without conv_id take no part; repeated rows are turns of their
own; an empty table gives no rows; further columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written

#: Moduli of the fingerprint; conversations that share a base; most head turns; ids of a digest block; salts of a lookup.
PRIMES, BASES, HEAD, ID_BLOCK, SALTS = (2147483647, 2147483629, 2147483587), 5, 8, 512, 32
LIMBS = range(len(PRIMES))
KEY = ["d", *(f"f{i}" for i in LIMBS)]
PARENT = [f"p{i}" for i in LIMBS]


@lru_cache(maxsize=4)
def multipliers(seed: int) -> tuple[int, ...]:
    draw = np.random.default_rng([seed, 11])
    return tuple(int(draw.integers(1 << 20, p - 1)) for p in PRIMES)


@lru_cache(maxsize=4)
def _powers(seed: int, n: int) -> np.ndarray:
    """B^0 .. B^n modulo each prime."""
    out = np.ones((len(PRIMES), n + 1), np.int64)
    for row, b, p in zip(out, multipliers(seed), PRIMES):
        for k in range(n):
            row[k + 1] = row[k] * b % p
    return out


def turn_values(a1: np.ndarray, a2: np.ndarray) -> np.ndarray:
    """a(t) modulo each prime, from the 128 bits of a turn's hash."""
    low = np.int64((1 << 31) - 1)
    return np.stack([(a1 & low) % PRIMES[0], ((a1 >> 31) & low) % PRIMES[1], (a2 & low) % PRIMES[2]])


STEP = "conv long, part int, pos long, a1 long, a2 long, bytes long, before long, {}, {}, edge int".format(
    ", ".join(f"f{i} long" for i in LIMBS), ", ".join(f"p{i} long" for i in LIMBS))


def _frame(conv, part, pos, a1, a2, size, before, f, p, edge) -> pd.DataFrame:
    return pd.DataFrame({"conv": conv, "part": part, "pos": pos, "a1": a1, "a2": a2, "bytes": size, "before": before,
                         **{f"f{i}": f[i] for i in LIMBS}, **{f"p{i}": p[i] for i in LIMBS},
                         "edge": pd.array(edge, "Int32")})


def _scan(seed: int):
    """Steps of a sorted partition with products, positions and bytes counted
    from the start of their run, and a row per run: turns, bytes, product and,
    in place of the product before, B^turns; edge says whether the run may go
    on in another partition (0: no, 1: yes)."""
    primes = np.array(PRIMES, np.int64)[:, None]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        # The open run: conversation, turns, bytes, product, B^turns.
        conv, turns, size, product, power, first = None, 0, 0, np.zeros((3, 1), np.int64), np.ones((3, 1), np.int64), True

        def closed(edge: int) -> pd.DataFrame:
            return _frame([conv], part, [turns], 0, 0, [size], 0, product, power, [edge])

        for pdf in batches:
            n = len(pdf)
            if not n:
                continue
            powers = _powers(seed, 1 << n.bit_length())
            of, bytes_ = pdf["conv"].to_numpy(np.int64), pdf["bytes"].to_numpy(np.int64)
            a1, a2 = pdf["a1"].to_numpy(np.int64), pdf["a2"].to_numpy(np.int64)
            starts = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
            lengths = np.diff(np.append(starts, n))
            at = np.arange(n) - np.repeat(starts, lengths)
            terms = turn_values(a1, a2) * powers[:, at] % primes
            sums = np.cumsum(terms, axis=1)
            f = (sums - np.repeat((sums - terms)[:, starts], lengths, axis=1)) % primes
            p = np.concatenate([np.zeros((3, 1), np.int64), f[:, :-1]], axis=1)
            p[:, starts] = 0
            total = np.cumsum(bytes_)
            before = total - bytes_ - np.repeat((total - bytes_)[starts], lengths)
            pos = at + 1
            ended = []
            if conv is not None and of[0] == conv:  # the open run goes on
                own = slice(0, lengths[0])
                f[:, own] = (product + power * f[:, own]) % primes
                p[:, own] = (product + power * p[:, own]) % primes
                pos[own] += turns
                before[own] += size
            elif conv is not None:
                ended.append(closed(int(first)))
                first = False
                turns, power = 0, np.ones((3, 1), np.int64)
            else:
                turns, power = 0, np.ones((3, 1), np.int64)
            yield _frame(of, part, pos, a1, a2, bytes_, before, f, p, [None] * n)
            last = starts[-1] + lengths[-1] - 1
            ends = starts + lengths - 1
            for k in range(len(starts) - 1):  # runs that end within the batch
                grown = powers[:, lengths[k]:lengths[k] + 1]
                ended.append((of[ends[k]], pos[ends[k]], before[ends[k]] + bytes_[ends[k]], f[:, ends[k]],
                              (power * grown % primes if k == 0 else grown)[:, 0], int(first and k == 0)))
            if len(starts) > 1:
                first, power = False, np.ones((3, 1), np.int64)
            plain = [e for e in ended if isinstance(e, tuple)]
            yield from (e for e in ended if not isinstance(e, tuple))
            if plain:
                c, t, s, fs, qs, edge = zip(*plain)
                yield _frame(c, part, t, 0, 0, s, 0, np.stack(fs, axis=1), np.stack(qs, axis=1), list(edge))
            conv, turns, size = of[last], pos[last], before[last] + bytes_[last]
            product, power = f[:, last:last + 1], power * powers[:, lengths[-1]:lengths[-1] + 1] % primes
        if conv is not None:
            yield closed(1)
    return run


def _composed(pdf: pd.DataFrame) -> pd.DataFrame:
    """What lies before each run of one conversation: a row per partition."""
    pdf = pdf.sort_values("part")
    turns, size, product, power, out = 0, 0, [0] * 3, [1] * 3, []
    for r in pdf.itertuples(index=False):
        out.append((r.conv, r.part, turns, size, *product, *power))
        f, q = [getattr(r, f"f{i}") for i in LIMBS], [getattr(r, f"p{i}") for i in LIMBS]
        product = [(product[i] + power[i] * f[i]) % PRIMES[i] for i in LIMBS]
        power = [power[i] * q[i] % PRIMES[i] for i in LIMBS]
        turns, size = turns + r.pos, size + r.bytes
    return pd.DataFrame(out, columns=["conv", "part", "turns", "size", *(f"g{i}" for i in LIMBS), *(f"q{i}" for i in LIMBS)])


def _placed(steps: DataFrame, before: DataFrame) -> DataFrame:
    """Steps or runs with positions, bytes and products from the conversation's start."""
    at = steps.join(before, ["conv", "part"], "left")
    moved = {f"{x}{i}": (F.coalesce(f"g{i}", F.lit(0)) + F.coalesce(f"q{i}", F.lit(1)) * F.col(f"{x}{i}")) % PRIMES[i]
             for x in "fp" for i in LIMBS}
    return at.withColumns({"pos": F.col("pos") + F.coalesce("turns", F.lit(0)),
                           "before": F.col("before") + F.coalesce("size", F.lit(0)), **moved}).drop(
        "turns", "size", *(f"g{i}" for i in LIMBS), *(f"q{i}" for i in LIMBS))


def _stored(conversations: DataFrame, seed: int, names: tuple[str, str, str, str]) -> DataFrame:
    conv, turn, role, text = (conversations[n] for n in names)
    rows = conversations.select(conv.cast("long").alias("conv"), turn.alias("turn"),
                                F.coalesce(role.cast("string"), F.lit("")).alias("role"),
                                F.coalesce(text.cast("string"), F.lit("")).alias("text")).filter("conv IS NOT NULL")
    return rows.withColumns({"a1": F.xxhash64(F.lit(2 * seed), "role", "text"),
                             "a2": F.xxhash64(F.lit(2 * seed + 1), "role", "text"),
                             "bytes": F.octet_length("text").cast("long")})


def steps_of(stored: DataFrame, seed: int) -> DataFrame:
    order = ["conv", "turn", "role", "head", "a1", "spread"]
    # Equal rows are dealt by ``spread``, so that no key is too frequent for a range.
    slim = stored.select("conv", "turn", "role", F.substring("text", 1, 256).alias("head"), "a1", "a2", "bytes",
                         F.monotonically_increasing_id().alias("spread"))
    ranged = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("conv", "a1", "a2", "bytes").mapInPandas(_scan(seed), STEP)


def _at(items: Column, k: Column, field: str) -> Column:
    """``field`` of the k-th head turn, 0 before the first."""
    return F.when(k > 0, F.get(items, k - 1)[field]).otherwise(F.lit(0).cast("long"))


def rebuilt(stored: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(steps, conversations): a row per rebuilt turn and root, as references
    to stored turns; and (conv, part) of every conversation and run."""
    scanned = written(steps_of(stored, seed), "trie-scan")
    turns, runs = scanned.filter("edge IS NULL").drop("edge"), scanned.filter("edge IS NOT NULL")
    before = written(runs.filter("edge = 1").groupBy("conv").applyInPandas(
        _composed, "conv long, part int, turns long, size long, {}, {}".format(
            ", ".join(f"g{i} long" for i in LIMBS), ", ".join(f"q{i} long" for i in LIMBS))), "trie-before")

    ahead = _placed(turns.filter(F.col("pos") <= HEAD), before).filter(F.col("pos") <= HEAD)
    fields = ["pos", "a1", "a2", "bytes", "before", *(f"f{i}" for i in LIMBS), *PARENT]
    heads = ahead.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    convs = runs.groupBy("conv").agg(F.sum("pos").alias("n"), F.sum("bytes").alias("total")).withColumns(
        {"h": h, "base": F.col("conv") - F.col("conv") % BASES})
    convs = convs.join(heads.withColumnRenamed("head", "own"), "conv", "left").join(
        heads.select(F.col("conv").alias("base"), F.col("head").alias("lent")), "base", "left")
    hb = F.least(F.col("h"), F.coalesce(F.size("lent"), F.lit(0)))
    cut = F.least(F.col("h"), F.col("n").cast("int"))  # own turns that give way
    end = lambda side, k: _at(F.col(side), F.col(k), "before") + _at(F.col(side), F.col(k), "bytes")
    convs = convs.withColumn("hb", F.greatest(hb, F.lit(0))).withColumn("cut", cut).withColumns({
        "depth": F.col("hb") + F.col("n") - F.col("cut"), "rise": end("lent", "hb") - end("own", "cut"),
        "whole": end("lent", "hb") + F.col("total") - end("own", "cut"),
        **{f"lent{i}": _at(F.col("lent"), F.col("hb"), f"f{i}") for i in LIMBS},
        **{f"cut{i}": _at(F.col("own"), F.col("cut"), f"f{i}") for i in LIMBS}})
    convs = written(convs.withColumn("lent", F.slice("lent", F.lit(1), F.col("hb"))).drop("own", "total", "n", "base"), "trie-convs")

    # Own suffixes: F(head) + B^(hb - cut) (F(own prefix) - F(own first turns)).
    powers = [[pow(b, k, p) for k in range(-HEAD, HEAD + 1)] for b, p in zip(multipliers(seed), PRIMES)]
    by_run = runs.select("conv", "part").join(convs.drop("lent"), "conv")
    own = _placed(turns, before).join(by_run, ["conv", "part"]).filter(F.col("pos") > F.col("h"))

    def moved(x: str, i: int) -> Column:
        factor = F.element_at(F.array(*map(F.lit, powers[i])), (F.col("hb") - F.col("cut") + HEAD + 1).cast("int"))
        return (F.col(f"lent{i}") + factor * F.pmod(F.col(f"{x}{i}") - F.col(f"cut{i}"), F.lit(PRIMES[i]))) % PRIMES[i]

    of = ["conv", "part", "d", *KEY[1:], *PARENT, "a1", "a2", "bytes", "before", "ref_conv", "ref_pos", "at_end"]
    own = own.select("conv", "part", (F.col("pos") - F.col("cut") + F.col("hb")).alias("d"),
                     *(moved(x, i).alias(f"{x}{i}") for x in "fp" for i in LIMBS), "a1", "a2", "bytes",
                     (F.col("before") + F.col("rise")).alias("before"), F.col("conv").alias("ref_conv"), F.col("pos").alias("ref_pos"),
                     (F.col("pos") - F.col("cut") + F.col("hb") == F.col("depth")).alias("at_end")).select(*of)
    lone = F.lit(-1).alias("part")
    lent = convs.select("conv", "depth", F.explode("lent").alias("t")).select(
        "conv", lone, F.col("t.pos").alias("d"), *(F.col(f"t.{x}{i}").alias(f"{x}{i}") for x in "fp" for i in LIMBS),
        "t.a1", "t.a2", "t.bytes", "t.before", (F.col("conv") - F.col("conv") % BASES).alias("ref_conv"),
        F.col("t.pos").alias("ref_pos"), (F.col("t.pos") == F.col("depth")).alias("at_end")).select(*of)
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", lone, zero.alias("d"), *(zero.alias(f"{x}{i}") for x in "fp" for i in LIMBS),
                         *(zero.alias(c) for c in ("a1", "a2", "bytes", "before", "ref_conv", "ref_pos")),
                         (F.col("depth") == 0).alias("at_end")).select(*of)
    steps = written(own.unionByName(lent).unionByName(roots), "trie-steps")
    spans = runs.select("conv", "part").unionByName(convs.select("conv", lone)).join(convs.select("conv", "whole"), "conv")
    return steps, spans


def differing(nodes: DataFrame, stored: DataFrame) -> int:
    """Nodes whose steps differ in turn hash or parent, and turn hashes that
    stand for different turns where a node's equality rests on them."""
    pairs = [("a1", "a1_hi"), ("a2", "a2_hi"), *((p, f"{p}_hi") for p in PARENT)]
    unlike = nodes.filter(" OR ".join(f"{a} != {b}" for a, b in pairs)).count()
    rests = nodes.filter("ref_conv != ref_conv_hi OR ref_pos != ref_pos_hi").select("a1", "a2").distinct()
    turn = F.struct("role", "text")
    return unlike + stored.join(rests, ["a1", "a2"], "left_semi").groupBy("a1", "a2").agg(
        (F.min(turn) != F.max(turn)).alias("unlike")).filter("unlike").count()


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ids of sorted members, joined by commas, in blocks of one node each."""
    for pdf in batches:
        if not len(pdf):
            continue
        keys = pdf[KEY].to_numpy(np.int64)
        new = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(pdf)]])
        ids = pdf["conv"].to_numpy(np.int64)
        rows = [(*keys[k], ids[k], ",".join(map(str, ids[k:min(k + ID_BLOCK, hi)].tolist())))
                for lo, hi in zip(new[:-1], new[1:]) for k in range(lo, hi, ID_BLOCK)]
        yield pd.DataFrame(rows, columns=[*KEY, "first", "ids"])


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's blocks, read in order."""
    key, digest = None, None
    for pdf in batches:
        rows = []
        for *now, ids in pdf[[*KEY, "ids"]].itertuples(index=False):
            if now == key:
                digest.update(b"," + ids.encode())
                continue
            if key is not None:
                rows.append((*key, digest.hexdigest()))
            key, digest = now, hashlib.sha256(ids.encode())
        yield pd.DataFrame(rows, columns=[*KEY, "ends"])
    if key is not None:
        yield pd.DataFrame([(*key, digest.hexdigest())], columns=[*KEY, "ends"])


def member_digests(ended: DataFrame) -> DataFrame:
    """Node key and SHA-256 of the comma-joined ids (``conv``) that end there.
    Ids meet as blocks, so a node with very many is read as few rows, in a stream."""
    keys = ", ".join(f"{k} long" for k in KEY)
    order = [*KEY, "conv"]
    blocks = ended.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        _blocks, f"{keys}, first long, ids string")
    return blocks.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInPandas(_hashed, f"{keys}, ends string")


def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text") -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    for seed in count():
        stored = _stored(conversations, seed, (conv_col, turn_col, role_col, text_col))
        steps, spans = rebuilt(stored, seed)
        both = ["a1", "a2", *PARENT, "ref_conv", "ref_pos"]
        nodes = written(steps.groupBy(*KEY).agg(
            F.min("conv").alias("owner"), F.count("*").alias("n_convs"), F.min("before").alias("before"),
            *(F.min(c).alias(c) for c in both), *(F.max(c).alias(f"{c}_hi") for c in both)), "trie-nodes")
        if not differing(nodes, stored):
            break
    children = nodes.filter("d > 0").select((F.col("d") - 1).alias("d"), *(F.col(p).alias(k) for p, k in zip(PARENT, KEY[1:]))).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.select(*KEY, "owner", "n_convs", "before").join(children, KEY, "left"), "trie-tree")
    # Each member's path is its own from depth ``top`` on, after ``lead`` bytes; without nodes of its own, nowhere.
    owners = nodes.groupBy(F.col("owner").alias("conv")).agg(
        F.min("d").alias("top"), F.min("before").alias("lead"), F.max(F.col("n_children").isNull().cast("long")).alias("leaf"))
    paths = spans.join(owners, "conv", "left").select(
        "conv", "part", "top", F.coalesce("lead", "whole").alias("lead"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    walked = written(steps.select("conv", "part", *KEY, *PARENT, "before").join(paths, ["conv", "part"]), "trie-walked")
    sums = walked.groupBy(*KEY).agg(F.sum(F.greatest(F.col("lead") - F.col("before"), F.lit(0))).alias("saved_tokens"),
                                    F.sum("leaf").alias("n_leaves"),
                                    F.max(F.when(F.col("d") > F.col("top"), F.col("conv"))).alias("same"))
    # Where a path becomes a member's own, the node above belongs to another one.
    # Very many may hang below one node: its owner is looked up once, then met by salted parts of them.
    above = ["up", *PARENT]
    tops = walked.filter("d = top AND d > 0").select(*KEY, (F.col("d") - 1).alias("up"), *PARENT, F.pmod(F.xxhash64("conv"), F.lit(SALTS)).alias("salt"))
    up = nodes.select(F.col("d").alias("up"), *(F.col(k).alias(p) for k, p in zip(KEY[1:], PARENT)), F.col("owner").alias("other"))
    met = tops.groupBy(*above).agg(F.collect_set("salt").alias("salts")).join(up, above)  # SALTS numbers at most
    tops = tops.join(met.withColumn("salt", F.explode("salts")), [*above, "salt"]).select(*KEY, "other")
    ends = member_digests(steps.filter("at_end"))
    none = hashlib.sha256(b"").hexdigest()
    return (nodes.join(sums, KEY).join(tops, KEY, "left").join(ends, KEY, "left")
            .select(F.col("owner").alias("conv_id"), F.col("d").alias("depth"),
                    F.when(F.col("d") > 0, F.coalesce("same", "other")).alias("parent_conv_id"), "n_convs",
                    F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens",
                    F.coalesce("ends", F.lit(none)).alias("ends_sha256")))


#: The same in DuckDB SQL, over whole prefixes.
SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i::BIGINT], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
         lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
               coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 5 AS base, xor(list_reduce(list_concat([4294967295::BIGINT],
                 list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                 lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
          FROM (SELECT DISTINCT c FROM own), crc),
parts AS (SELECT convs.c, 0 AS side, p, role, text FROM convs JOIN own ON own.c = base AND p <= h
          UNION ALL SELECT convs.c, 1, p, role, text FROM convs JOIN own ON own.c = convs.c AND p > h),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY side, p) AS d, md5(role || chr(1) || text) AS t, strlen(text) AS b FROM parts),
steps AS (SELECT c, d, string_agg(t, '') OVER (PARTITION BY c ORDER BY d) AS path, b FROM turns UNION ALL SELECT c, 0, '', 0 FROM convs),
lens AS (SELECT c, max(d) AS l FROM steps GROUP BY c),
nodes AS (SELECT d, path, min(c) AS c, count(*) AS n, any_value(b) AS b,
                 string_agg(CASE WHEN d = l THEN c::VARCHAR END, ',' ORDER BY c) AS ends FROM steps JOIN lens USING (c) GROUP BY d, path),
kids AS (SELECT d - 1 AS d, left(path, (32 * (d - 1))::BIGINT) AS path, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids USING (d, path)),
-- Each node's value goes to the nodes on its own path above it.
below AS (SELECT left(u.path, (32 * k)::BIGINT) AS path, k AS d, sum((u.n - 1) * u.b) AS saved, sum((u.kids = 0)::INT) AS leaves
          FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM full_nodes) u GROUP BY ALL)
SELECT v.c::BIGINT AS conv_id, v.d::BIGINT AS depth, up.c::BIGINT AS parent_conv_id, v.n::BIGINT AS n_convs, v.kids::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM full_nodes v JOIN below USING (d, path)
LEFT JOIN nodes up ON up.d = v.d - 1 AND up.path = left(v.path, (32 * (v.d - 1))::BIGINT) AND v.d > 0
"""
