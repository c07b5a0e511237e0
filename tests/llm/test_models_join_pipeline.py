"""Toxicity, site quality, n-gram join, pipeline."""

import re
from collections import Counter
from itertools import combinations

import corpus_pipeline
import numpy as np
import zlib
from llm_rows import PROSE, SF_SMALL, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from starloom.llm import common, mixing, ngram_join, piece_sampling, quality_eb, quality_rules, queries, secret_scan, toxicity

SF = "/root/testdata/sf0.01"


def test_toxicity_windows_cover_the_text():
    for text in ("", "a", PROSE * 3, "x" * 500, "é" * 100):
        assert b"".join(toxicity.windows(text)) == text.lower().encode() and all(len(w) <= toxicity.WINDOW for w in toxicity.windows(text))


def test_toxicity_learns_from_its_fold_alone(spark, no_docs):
    insults, plain = ["vile brute", "rotten scoundrel", "dismal wretch"], PROSE.split()
    draw = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(1200):
        words = list(draw.permutation(plain))[:40]
        toxic = int(i % 5 == 0)
        if toxic:
            words[10:10] = insults[i % 3].split() + insults[(i + 1) % 3].split()
        rows.append((i, " ".join(words), "x"))
        labels.append((i, 1 - toxic if zlib.crc32(str(i).encode()) % 4 == 2 else toxic))  # lies where it must not look
    rows += [(5000, None, "x"), (5001, "", "x"), (0, rows[0][1], "x"), (None, PROSE, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = toxicity.score(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 1200]
    assert len(held) > 200 and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)
    right = sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held)
    assert right >= 0.95 * len(held)
    none = toxicity.score(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert len(none) == len(rows) and {r["score"] for r in none} == {0.0}
    assert toxicity.score(no_docs, spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0


def test_site_quality(spark, odd_docs, no_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries.op6_quality_sites(spark, SF).join(labels, "doc_id").collect()
    assert sum(r["kept"] == bool(r["quality"]) for r in got) >= 0.97 * len(got)
    out = quality_eb.classify(odd_docs, labels, "source", "lang").collect()
    assert len(out) == odd_docs.count() and all(0 < r["score"] < 1 for r in out)
    assert quality_eb.classify(no_docs, labels, "source", "lang").count() == 0
    even = quality_eb.classify(odd_docs, labels.limit(0), "source", "lang").collect()
    assert all(abs(r["p_doc"] - 0.5) < 1e-9 for r in even)


def test_sparse_sites_shrink_to_the_prior(spark):
    good, bad = PROSE, "buy $$$ now *** " * 30
    rows = [(i, good if i % 2 else bad, "mixed" if i < 100 else f"site{i % 20}", "/a") for i in range(200)]
    rows += [(1000 + i, bad, "junk", "/b") for i in range(60)] + [(2000, good, "lonely", "/c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    labels = docs.select("doc_id", (F.col("text") == good).cast("int").alias("quality"))
    got = {r["doc_id"]: r for r in quality_eb.classify(docs, labels, "host", "path").collect()}
    mean = sum(r["p_doc"] for r in got.values()) / len(got)
    assert abs(got[2000]["host_share"] - mean) < 0.05          # nothing but itself on its host
    assert got[1000]["path_share"] < 0.25 < got[1]["path_share"] and got[1]["kept"] and not got[1000]["kept"]


def shingles(text, n=5):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) or (frozenset([tuple(words)]) if words else frozenset())


def plain_components(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in sets}


def test_join_equals_brute_force(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op10_ngram_join(spark, SF_SMALL).collect()}
    assert got == plain_components(docs)
    out = ngram_join.join(odd_docs).collect()
    want = plain_components([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert len(out) == odd_docs.count()
    assert all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] for r in out if r["doc_id"] is not None)
    assert all(r["component_id"] is None for r in out if r["doc_id"] is None)
    assert ngram_join.join(no_docs).count() == 0
    left = ngram_join.one_of_each(odd_docs)
    assert left.columns == odd_docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter({None: 2, **{c: 1 for i, (_, c) in want.items()}})


def test_join_of_a_large_near_group(spark):
    """Near copies around a hub, outliers that share their rare shingles, chains: hot shingles of every step."""
    draw = np.random.default_rng(11)
    words = [f"w{i}" for i in range(400)]
    base = list(draw.choice(words, 120))
    rows = []
    for i in range(260):
        copy = list(base)
        for at in draw.choice(120, draw.integers(0, 9), replace=False):
            copy[at] = f"x{draw.integers(1 << 30)}"
        rows.append((i, " ".join(copy)))
    for i in range(60):  # chains of small changes
        chain = list(draw.choice(words, 80)) if i % 6 == 0 else list(chain)
        chain[(i % 6) * 12 % 80] = f"y{i}"
        rows.append((1000 + i, " ".join(chain)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs).collect()}
    assert got == plain_components(rows)


def test_smallest_node_without_a_hot_shingle_meets_a_small_member(spark, monkeypatch):
    """b is compared with y, z and w in their hot shingle, but not with x, whose node names their component."""
    def node(text):
        return ngram_join._node(ngram_join.class_key(ngram_join.Shingler().hashes(text)))

    words = [f"w{i}" for i in range(59)]
    x = words + [min((f"last{k}" for k in range(200)), key=lambda last: node(" ".join([*words, last])))]
    texts = {"x": " ".join(x), "b": " ".join([*x[:53], *(f"b{i}" for i in range(7))])}
    texts |= {name: " ".join([*x[6:], f"{name}1", f"{name}2"]) for name in "yzw"}
    strangers = [" ".join(f"p{i}x{j}" for j in range(60)) for i in range(100)]
    texts["p"] = spark.createDataFrame([(t, node(t)) for t in strangers], "text string, node long").orderBy(F.xxhash64("node")).first()["text"]
    nodes = {name: node(t) for name, t in texts.items()}
    assert nodes["x"] == min(nodes[name] for name in "xyzw")
    by_hash = spark.createDataFrame([(name, nodes[name]) for name in "xbp"], "name string, node long").orderBy(F.xxhash64("node"))
    assert by_hash.first()["name"] == "p"  # the pivot, so step 1 does not compare x with b
    entries = [(s, nodes[name], 8 * len(shingles(texts[name])) + 1)
               for s, names in enumerate(("xy", "xz", "xw", "xbp", "yzwb")) for name in names]
    monkeypatch.setattr(ngram_join, "HOT", 3)
    monkeypatch.setattr(ngram_join, "prefix_entries", lambda *_: spark.createDataFrame(entries, "shingle long, node long, meta long"))
    rows = list(enumerate(texts.values()))
    want = plain_components(rows)
    assert [c for _, c in want.values()] == [0, 0, 0, 0, 0, 5] and not any(linked(texts["b"], texts[name]) for name in "yzw")
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def linked(a, b):
    a, b = shingles(a), shingles(b)
    return 100 * len(a & b) >= 75 * len(a | b)


def test_bitmap_never_exceeds_the_difference():
    draw = np.random.default_rng(2)
    for _ in range(200):
        pool = draw.integers(0, 2**63, 600).astype(np.uint64)
        a, b = (np.unique(draw.choice(pool, draw.integers(1, 500))) for _ in range(2))
        assert ngram_join.least_difference(ngram_join.parity(a), ngram_join.parity(b)) <= len(np.setxor1d(a, b))


def test_longer_prefixes_ask_for_more_matches():
    assert ngram_join.choose_matches(np.ones(40), 30) == 1
    assert ngram_join.choose_matches(np.full(40, 500), 30) > 1


def test_pipeline_stages(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_join", "secret_scan", "mixing", "sentencepiece"]
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality_rules"](spark, docs, SF_SMALL)
    rows = good.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(
        r["doc_id"] for r in docs.collect() if quality_rules.passes(quality_rules.Document(r["text"]), quality_rules.RULES))
    single = stage["ngram_join"](spark, good, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in single) == sorted({c for _, c in plain_components((r["doc_id"], r["text"]) for r in rows).values()})
    single = spark.createDataFrame(single, good.schema)
    masked = stage["secret_scan"](spark, single, SF_SMALL)
    for a, b in zip(sorted(single.collect()), sorted(masked.collect())):
        assert a["doc_id"] == b["doc_id"] and b["n_chars"] == len(b["text"]) and not secret_scan.base_spans(b["text"])
        assert (a["text"] == b["text"]) == (not secret_scan.base_spans(a["text"]))
    mix = stage["mixing"](spark, masked, SF_SMALL)
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken(masked).collect()}
    words = Counter()
    for r in mix.collect():
        words[r["doc_id"]] += len(r["text"].split())
    assert dict(words) == {i: n for i, n in taken.items() if n}
    out = stage["sentencepiece"](spark, mix, SF_SMALL).collect()
    assert len(out) == mix.count() and all(r["lossless"] for r in out)
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, no_docs, SF_SMALL).count() == 0
        result = function(spark, odd_docs, SF_SMALL)
        assert result.count() <= 2 * odd_docs.count()
        assert name == "sentencepiece" or result.columns == odd_docs.columns


def test_texts_reach_python_in_bounded_batches(spark):
    """Long texts come some MB at a time, however few rows that is; no row is lost."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 800).alias("text"))
    corpus_pipeline.quality(spark, docs, SF_SMALL)

    def sizes(batches):
        for pdf in batches:
            yield pdf.iloc[:1].assign(doc_id=len(pdf), text=str(pdf["text"].str.len().sum()))[["doc_id", "text"]]

    seen = docs.mapInPandas(sizes, "doc_id long, text string").collect()
    assert sum(r["doc_id"] for r in seen) == 4000
    assert max(int(r["text"]) for r in seen) <= 2 * common.BATCH_BYTES


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert rows and all(r["lossless"] for r in rows) and {"doc_id", "ids"} <= set(rows[0].asDict())
    assert piece_sampling.SMOOTHING == 1.0


def test_repeated_ids_lose_no_link(spark):
    """Ids that are held by two texts each, each text with a near copy; columns of clashing names."""
    draw = np.random.default_rng(21)
    vocabulary = [f"w{k}" for k in range(4000)]
    rows = []
    for i in range(30):
        for side in (0, 1):
            words = list(draw.choice(vocabulary, 60))
            near = [*words]
            near[30] = "changed"
            rows += [(i, " ".join(words)), (1000 + 2 * i + side, " ".join(near))]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in rows], "doc_id long, text string, __copy int, __row int, `a.b` int, part string")
    got = ngram_join.join(docs).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == sorted(
        (i, i if i < 1000 else (i - 1000) // 2) for i, _ in rows)
    left = ngram_join.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == sorted(r for r in rows if r[0] < 1000)
    assert {(r["__copy"], r["__row"], r["a.b"], r["part"]) for r in left.collect()} == {(1, 2, 3, "x")}


def test_documents_unlike_any_other_all_stay(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(7, a, "p"), (7, b, "p"), (8, None, "p"), (8, "x y", "p"), (9, b.upper(), "q"), (9, b, "q"), (9, b, "r"), (None, a, "q"), (None, a, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = sorted(map(tuple, ngram_join.one_of_each(docs).collect()), key=repr)
    assert left == sorted([r for r in rows if r[0] != 9], key=repr)
    same = spark.createDataFrame([(1, a, s) for s in "cab"], "doc_id long, text string, source string")
    first = [tuple(r) for k in (1, 5) for r in ngram_join.one_of_each(same.repartition(k)).collect()]
    assert len(first) == 2 and first[0] == first[1]


def test_mix_of_equal_rows_and_clashing_names(spark):
    """Thousands of equal rows without an id; columns named like the plan's own."""
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(None, text, "a", k % 3) for k in range(3000)] + [(5, f"{text} {k}", "a", 0) for k in range(500)] + [
        (k, f"{PROSE} {k}", "b", 0) for k in range(100, 160)]
    docs = spark.createDataFrame([(i, t, s, k, 1, 2, 3, 4) for i, t, s, k in rows],
                                 "doc_id long, text string, source string, k int, __key int, __hash int, __copy int, `a.b` int")
    old, mixing.RANGE = mixing.RANGE, 100  # so that ranges are crowded
    try:
        taken = mixing.taken(docs).collect()
        out = mixing.mixed(docs).collect()
    finally:
        mixing.RANGE = old
    assert len(taken) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in taken)
    targets = {r["source_size"]: r["target"] for r in taken}
    for size, target in targets.items():
        assert abs(sum(r["taken"] for r in taken if r["source_size"] == size) - target) <= 2 * mixing.BLOCK
    assert sum(len(r["text"].split()) for r in out) == sum(r["taken"] for r in taken)
    assert {(r["__key"], r["__hash"], r["__copy"], r["a.b"]) for r in out} == {(1, 2, 3, 4)}
    by_id = Counter()
    for r in out:
        by_id[r["doc_id"], r["source"]] += len(r["text"].split())
    want = Counter()
    for r in taken:
        want[r["doc_id"], "a" if r["doc_id"] in (None, 5) else "b"] += r["taken"]
    assert by_id == +want


def test_mixed_texts_are_runs_of_their_words(spark):
    docs = spark.createDataFrame([(k, " ".join(f"d{k}w{j}" for j in range(3 + 17 * k)), "s" if k % 3 else "t") for k in range(60)],
                                 "doc_id long, text string, source string")
    whole = {r["doc_id"]: r["text"].split() for r in docs.collect()}
    got = Counter()
    for r in mixing.mixed(docs).collect():
        words = r["text"].split()
        places = [whole[r["doc_id"]].index(w) for w in words]
        assert places == sorted(set(places)) and words
        got[r["doc_id"]] += len(words)
    assert got == +Counter({r["doc_id"]: r["taken"] for r in mixing.taken(docs).collect()})
