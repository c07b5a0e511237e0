"""Prefix trie, SimHash near duplicates, hard negatives: against brute force
and SQL, and over rows that every operator has to stand."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from llm_rows import PROSE, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from starloom.llm import hard_negatives, links, prefix_trie, queries, simhash
from starloom.llm.common import SPACES
from starloom.session import ship_package

SF = "/root/testdata/sf0.01"
TALK = "conv_id long, turn long, role string, text string, d long, f0 string, owner long, part int"
VECTORS = "vec_id long, embedding array<float>, label int, id string, block long, vector string, spread int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def twin(df, table, sql):
    """The SQL twin's rows over the same columns."""
    con = duckdb.connect()
    con.register(table, df.toPandas() if table != "embeddings" else df.select("vec_id", "embedding", "label").toArrow())
    return con.sql(sql).fetchall(), [c[0] for c in con.sql(sql).description]


# Prefix trie

def plain_trie(rows):
    """The trie by whole prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends, built = defaultdict(set), defaultdict(set), {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        path = built[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].add(c)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    saved, leaves = defaultdict(int), defaultdict(int)
    for path, who in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(who) - 1) * (len(path[-1][1].encode()) if path else 0)
            leaves[path[:d]] += not children[path]
    return sorted(((min(who), len(path), min(members[path[:-1]]) if path else None, len(who), len(children[path]), leaves[path],
                    saved[path], hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest())
                   for path, who in members.items()), key=repr)


def talk(seed, convs=60, words=3):
    """Conversations over few texts, so that prefixes meet; uneven, repeated, gapped."""
    draw = np.random.default_rng(seed)
    rows = []
    for c in range(convs):
        if c % 11 == 3:
            continue  # some bases are absent
        n = int(draw.integers(1, 14))
        rows += [(c - 20, None if k == 0 and c % 7 == 0 else k, ["user", None, "assistant"][k % 3],
                  None if draw.random() < 0.05 else f"text {draw.integers(words)} é") for k in range(n)]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_equals_whole_prefixes(spark, seed):
    ship_package(spark)
    rows = talk(seed)
    df = spark.createDataFrame([(*r, 5, "x", 9, 3) for r in rows], TALK).repartition(7)
    assert rows_of(prefix_trie.trie(df)) == plain_trie(rows)


def test_trie_of_long_and_copied_conversations(spark):
    """One conversation over many tasks; many copies of another; a third of the rows each."""
    ship_package(spark)
    rows = [(0, k, "user", f"long {k % 50}") for k in range(700)]
    rows += [(c, k, "user", f"copy {k}") for c in range(1000, 1150) for k in range(4)] + talk(5) + talk(5)[:9]
    df = spark.createDataFrame([(*r, 5, "x", 9, 3) for r in rows], TALK)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions",
                                         "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
        assert rows_of(prefix_trie.trie(df.repartition(5))) == plain_trie(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_trie_of_nothing_and_of_nulls(spark):
    ship_package(spark)
    assert prefix_trie.trie(spark.createDataFrame([], TALK)).count() == 0
    rows = [(None, 1, "user", "x"), (5, None, None, None), (6, 0, "", ""), (7, 0, "user", "a" * 100_000)]
    df = spark.createDataFrame([(*r, 5, "x", 9, 3) for r in rows], TALK)
    assert rows_of(prefix_trie.trie(df)) == plain_trie(rows)


def test_trie_finds_colliding_turn_hashes(spark):
    """A node whose steps refer to different texts under one hash is found."""
    ship_package(spark)
    stored = spark.createDataFrame([("user", "a", 1, 1), ("user", "b", 1, 1), ("user", "c", 2, 2), ("user", "c", 2, 2)],
                                   "role string, text string, a1 long, a2 long")
    both = ["a1", "a2", *prefix_trie.PARENT, "ref_conv", "ref_pos"]

    def node(a, ref_hi, parent_hi=0):
        low = dict(a1=a, a2=a, p0=0, p1=0, p2=0, ref_conv=1, ref_pos=1)
        return {**low, **{f"{c}_hi": low[c] for c in both}, "ref_pos_hi": ref_hi, "p1_hi": parent_hi}
    make = lambda *nodes: spark.createDataFrame(list(nodes))
    assert prefix_trie.differing(make(node(2, 5)), stored) == 0  # equal texts at two places
    assert prefix_trie.differing(make(node(1, 1)), stored) == 0  # one place
    assert prefix_trie.differing(make(node(1, 5)), stored) == 1
    assert prefix_trie.differing(make(node(2, 1, parent_hi=3)), stored) == 1


def test_trie_query_equals_its_sql(spark):
    got = queries.op11_prefix_trie(spark, SF)
    want, names = twin(spark.read.parquet(f"{SF}/conversations.parquet"), "conversations", prefix_trie.SQL)
    assert got.columns == names and rows_of(got) == sorted(want, key=repr)


# SimHash

def plain_simhash(rows, words=4, radius=4):
    prints = []
    for _, text in rows:
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for x in SPACES[1:]:
            low = low.replace(x, " ")
        found = [w for w in low.split(" ") if w]
        grams = [" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)] * bool(found)
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for (doc, _), g in zip(rows, group):
        if doc is not None:
            least[g].append(doc)
    return sorted(((doc, f"{p:016x}", min(least[g], default=None)) for (doc, _), p, g in zip(rows, prints, group)), key=repr)


def edited(draw, n):
    """Texts with near copies: words of long texts changed here and there."""
    vocabulary = [f"w{k}" for k in range(300)]
    out = []
    for _ in range(n):
        if out and draw.random() < 0.6:
            words = out[draw.integers(len(out))].split()
            for at in draw.integers(0, len(words), draw.integers(0, 3)):
                words[at] = str(draw.choice(vocabulary))
        else:
            words = list(draw.choice(vocabulary, draw.integers(1, 250)))
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("parts", [None, 2, 3, 5])
def test_simhash_equals_all_pairs(spark, parts):
    ship_package(spark)
    rows = [(k * 3 + 1, t) for k, t in enumerate(edited(np.random.default_rng(4), 240))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(simhash.near_duplicates(df, parts=parts)) == plain_simhash(rows)


def test_simhash_stands_odd_rows(spark, odd_docs, no_docs):
    ship_package(spark)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    extra = odd_docs.withColumns({c: F.lit(1) for c in ("code", "rep", "part", "component_id", "fingerprint", "a.b")})
    assert rows_of(simhash.near_duplicates(extra)) == plain_simhash(rows)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_blocks_and_other_components(spark, monkeypatch):
    """Crowded values are cut into blocks; dense groups besides the largest are linked too."""
    ship_package(spark)
    draw = np.random.default_rng(9)
    centres = [0, 0x0123456789ABCDEF, 0x0123456789ABC000]
    codes = {int(c) ^ sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 7), replace=False)) for c in centres for _ in range(400)}
    codes = np.array(sorted(codes), np.uint64)
    table = spark.createDataFrame([(int(c), 1) for c in codes.view(np.int64)], "code long, docs long")
    monkeypatch.setattr(simhash, "BLOCK", 64)
    plan = simhash.Plan(*simhash.co_occurrence(table), 4, None)
    counts, pivots = simhash.value_statistics(table, plan)
    plan.counted(counts)
    placed = table.select("code", F.col("code").alias("part"))
    found = links.components(simhash.probe_links(simhash.entries(placed, plan, None), 4)).collect()
    got = {r["node"]: r["part"] for r in found}
    near = np.bitwise_count(codes[:, None] ^ codes[None]) <= 4
    signed = codes.view(np.int64)
    label = signed.copy()
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    assert {int(c): int(p) for c, p in zip(signed, label) if near[list(signed).index(c)].sum() > 1} == got


def test_simhash_thresholds(spark):
    """Thresholds sum to radius - parts + 1, are the cheapest, and find every pair within the radius."""
    draw = np.random.default_rng(3)
    codes = draw.integers(0, 1 << 63, 500).astype(np.uint64).view(np.int64)
    bits = simhash.unpacked(codes.view(np.uint64)).astype(np.int64)
    for parts in (3, 4, 5):
        plan = simhash.Plan(len(codes), bits.T @ bits, 4, parts)
        assert sorted(b for p in plan.parts for b in p) == list(range(64))
        plan.counted({(i, j): np.bincount(plan.values(codes, b), minlength=1 << len(b)) for i, p in enumerate(plan.pieces) for j, b in enumerate(p)})
        limits = plan.thresholds(codes)
        assert (limits.sum(axis=0) == 4 - parts + 1).all() and limits.min() >= -1
        other = codes[0] ^ np.bitwise_or.reduce(1 << draw.choice(62, 4, replace=False).astype(np.int64))
        apart = [np.bitwise_count(plan.values(codes[:1], p) ^ plan.values(np.array([other]), p))[0] for p in plan.parts]
        assert any(x <= t for x, t in zip(apart, limits[:, 0]))
    values = plan.values(codes, plan.parts[0])
    exact = [(np.bitwise_count(values ^ values[7]) <= t).sum() for t in range(5)]
    assert plan.candidates(codes, 0)[:, 7].astype(int).tolist() == exact


def test_forest_and_components(spark):
    ship_package(spark)
    draw = np.random.default_rng(1)
    a, b = draw.integers(-400, 400, 500), draw.integers(-400, 400, 500)
    pairs = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)] + [(k, k + 1) for k in range(1000, 1300)], "a long, b long")
    label = {int(x): int(x) for x in [*a, *b, *range(1000, 1301)]}
    todo = [*zip(a.tolist(), b.tolist()), *((k, k + 1) for k in range(1000, 1300))]
    for _ in range(400):
        for x, y in todo:
            label[x] = label[y] = min(label[x], label[y])
    got = {r["node"]: r["part"] for r in links.components(pairs.repartition(6)).collect()}
    alone = {x for x in label if all(x not in p or p[0] == p[1] for p in todo)}
    assert got == {k: v for k, v in label.items() if k not in alone}


# Hard negatives

LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def mined(df, **sizes):
    return hard_negatives.mine(df, F.expr(LABEL), F.col("id") % 100 == 0, **sizes)


def plain_negatives(rows):
    kept = []
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v):
            q = [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]
            kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, q))
    out = []
    for a, label, q in {(i, lb, tuple(q)): (i, lb, q) for i, lb, q in kept if i % 100 == 0}.values():
        scored = sorted((-sum(x * y for x, y in zip(q, c)), i, lb) for i, lb, c in kept if i != a)
        for minus, p, _ in [s for s in scored if s[2] == label][:5]:
            ps = -minus
            fit = [(i, -m) for m, i, lb in scored if lb != label and 80 * ps <= -100 * m <= 100 * ps][:5]
            out += [(a, p, k + 1, i, ps, ns) for k, (i, ns) in enumerate(fit)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [{}, {"anchors_in_block": 3, "candidates_in_block": 50}])
def test_negatives_equal_all_pairs(spark, sizes):
    ship_package(spark)
    draw = np.random.default_rng(6)
    rows = [(int(i), [float(np.float32(x)) for x in draw.normal(0, 0.4, 20)], int(draw.integers(3))) for i in range(0, 900, 3)]
    rows += [(i, rows[0][1], 1) for i in range(5000, 5080)]  # one vector many times: ties
    rows += [(300, rows[0][1], 1), (300, rows[0][1], 1), (7, [], 2), (14, [1.5], 0), (100, [-0.25] * 9, 9),
             (None, [1.0], 1), (901, None, 1), (903, [1.0], None), (904, [None, 1.0], 1), (905, [float("nan")], 2), (906, [float("inf")], 2)]
    df = spark.createDataFrame([(*r, "x", 5, "y", 2) for r in rows], VECTORS)
    assert rows_of(mined(df, **sizes)) == plain_negatives(rows)
    assert mined(df.limit(0)).count() == 0


def test_negatives_of_huge_components(spark):
    """Scores beyond 64 bits stay exact in order; the long shown is the largest."""
    ship_package(spark)
    rows = [(100, [1e20, 0.5], 1), (1, [2e20, 1.0], 1), (2, [1.9e20, 3.0], 2), (3, [0.1, 1e-3], 2), (4, [1e20, 1e30], 2)]
    df = spark.createDataFrame([(*r, "x", 5, "y", 2) for r in rows], VECTORS)
    got = rows_of(mined(df))
    assert {r[3] for r in got} <= {2, 4} and all(r[4] == hard_negatives.LARGEST for r in got)


def test_bit_planes_score_exactly():
    draw = np.random.default_rng(2)
    for dims, top in ((64, 300), (5, 1 << 24), (1, 1), (13, 1 << 33)):
        a, c = draw.integers(-top, top, (7, dims)), draw.integers(-top, top, (50, dims))
        q = [hard_negatives.whole((x / 256).tolist()) for x in (a, c)]
        got = np.concatenate([s for _, s in hard_negatives.block_scores(q[0], hard_negatives.bit_planes(q[1]))])
        want = c.astype(object) @ a.astype(object).T
        assert (got.astype(object) == want).all()


def test_negatives_query_equals_its_sql(spark):
    got = queries.op13_hard_negatives(spark, SF)
    want, names = twin(spark.read.parquet(f"{SF}/embeddings.parquet"), "embeddings", hard_negatives.SQL)
    assert got.count() > 50 and rows_of(got.select(*names)) == sorted(want, key=repr)
