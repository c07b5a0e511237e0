"""Neighbours, mixing, token files, sampled pieces: against plain versions."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_rows import PROSE, SF_SMALL, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from starloom.llm import ann, mixing, piece_sampling, queries, token_store
from starloom.llm.common import scratch_path


def neighbours(rows, is_query, k=10):
    """Brute force: rows (id, vector) -> {query: [(score, id)]}."""
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if is_query(q):
            found = {i: float(np.sqrt(((x - v) ** 2).sum())) for i, x in ok if i != q and len(x) == len(v)}
            out[q] = sorted((s, i) for i, s in found.items())[:k]
    return out


def test_nearest_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = neighbours([(r["vec_id"], r["embedding"]) for r in vectors.collect()], lambda i: i % 100 == 0)
    got = {}
    for r in queries.op1_nearest(spark, "/root/testdata/sf0.01").orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_nearest_odd_vectors(spark):
    rows = [(i, [1.0, float(i % 3), 0.5]) for i in range(40)]                     # many equal vectors, ties to smaller ids
    rows += [(100, None), (101, [0.0, 0.0, 0.0]), (102, [float("nan"), 1.0, 1.0]), (103, [None, 1.0, 1.0]),
             (104, [float("inf"), 1.0, 1.0]), (105, []), (None, [1.0, 1.0, 1.0]), (0, [1.0, 0.0, 0.5]),
             (200, [1.0, 2.0]), (201, [1.0, 2.5])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = {}
    for r in ann.search(df, F.col("id") % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    want = neighbours(dict(r for r in rows if r[0] is not None).items(), lambda i: i % 10 == 0)
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
    assert [i for _, i in got[200]] == [201]
    assert ann.search(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(1).normal(size=(5, 64))
    y = ann.rotated(x, 0, 0, 5)
    assert np.allclose(np.linalg.norm(y, axis=1), 1) and np.allclose(ann.hadamard(ann.hadamard(x)), x)
    assert ann.hashes_for(50_000, 64) == 1 and ann.hashes_for(10**9, 64) > 1


def plain_targets(sizes):
    """Water-filling in rounds: {source: size} -> {source: target}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s], left = 2.0 * sizes[s], left - 2 * sizes[s]
        open_ -= over
    return target


def check_mix(frame):
    rows = frame.collect()
    sizes, taken = {}, {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source_size"], r["target"]] = sizes.get((r["source_size"], r["target"]), 0) + r["size"]
        taken[r["source_size"], r["target"]] = taken.get((r["source_size"], r["target"]), 0) + r["taken"]
    for (size, target), n in taken.items():
        assert abs(n - target) <= 2 * mixing.BLOCK
    return rows


def test_mix_meets_targets(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = check_mix(queries.op5_mixing(spark, SF_SMALL))
    assert rows and Counter(map(tuple, rows)) == Counter(map(tuple, queries.op5_mixing(spark, SF_SMALL).collect()))
    sizes = {r["source"]: r["n"] for r in docs.groupBy("source").agg(
        F.sum(F.size(F.regexp_extract_all("text", F.lit(f"({mixing.WORD})")))).alias("n")).collect()}
    want = plain_targets(sizes)
    assert {(r["source_size"], round(r["target"], 6)) for r in rows} == {(sizes[s], round(t, 6)) for s, t in want.items()}
    assert len(check_mix(mixing.taken(odd_docs))) == odd_docs.count()
    assert mixing.taken(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


def test_mixed_documents_hold_the_words_taken(spark, odd_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for frame in (docs, odd_docs):
        out = mixing.mixed(frame)
        assert out.columns == frame.columns
        words = Counter()
        for r in out.collect():
            words[r["doc_id"]] += len((r["text"] or "").encode().split())
        want = Counter()
        for r in mixing.taken(frame).collect():
            want[r["doc_id"]] += r["taken"]
        assert +words == +want


def test_shuffle_is_a_permutation(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(F.lit(3).alias("sid"), F.lit(1).cast("long").alias("epoch"), F.lit(n).cast("long").alias("n"), "id")
        keys = mixing._keys(F.col("sid"), F.col("epoch"), F.col("n"))
        got = [r[0] for r in df.select(mixing._shuffled(F.col("id"), F.col("n"), keys)).collect()]
        assert sorted(got) == list(range(n))


TOKENIZER = str(public_tokenizers.path("word_bpe_49k.json"))
TRICKY = ["", "  ", "Hello, World's été café İstanbul", "<|endoftext|>a<|startoftext|>", "a b c　d\x1ce",
          "x" * 5000, "don't we'll I'd 12345 ٣² ªº ǅ \U0001F600‍", "ΣΑΣ ß ×÷ 'ſ", PROSE]


def test_word_encoder_equals_the_library():
    from tokenizers import Tokenizer
    library, encoder = Tokenizer.from_file(TOKENIZER), token_store.Encoder(TOKENIZER)
    assert encoder.by_word
    for text, ids in zip(TRICKY, encoder.encode(TRICKY)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
    other = token_store.Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert not other.by_word and len(other.encode(["a b"])[0]) == 2


def plain_ids(rows):
    from tokenizers import Tokenizer
    library, start, out = Tokenizer.from_file(TOKENIZER), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = plain_ids((r["doc_id"], r["text"]) for r in docs.collect())
    assert sorted(map(tuple, queries.op7_token_files(spark, SF_SMALL).collect()), key=lambda r: r[1]) == want
    path = scratch_path(spark, "odd")
    token_store.write_token_files(odd_docs, path, TOKENIZER, 1)
    got = sorted(map(tuple, token_store.index_and_checksums(spark, path).collect()), key=lambda r: r[1])
    assert got == plain_ids((r["doc_id"], r["text"]) for r in odd_docs.collect())
    assert token_store.read_token_files(spark, path).count() == odd_docs.count()
    one = token_store.read_document(spark, path, 6).collect()
    assert [len(r["ids"]) for r in one] == [n for i, _, n, _ in got if i == 6] and token_store.read_document(spark, path, 77).count() == 0
    empty = scratch_path(spark, "empty")
    token_store.write_token_files(no_docs, empty, TOKENIZER, 1)
    assert token_store.index_and_checksums(spark, empty).count() == 0


def test_foreign_dictionary_is_refused(spark, odd_docs):
    path = scratch_path(spark, "dictionary")
    token_store.write_token_files(odd_docs, path, TOKENIZER, 1)
    block = spark.read.parquet(f"{path}/blocks").limit(1).toPandas()
    with pytest.raises(ValueError, match="dictionary"):
        list(token_store._decoded("another", b"x" * 64, len)(iter([block])))


MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


def all_segmentations(sp, word, weight):
    if not word:
        return [((), 0.0)]
    out = []
    for k in range(1, len(word) + 1):
        i = sp.piece_to_id(word[:k])
        if sp.id_to_piece(i) == word[:k]:
            out += [((i, *rest), weight[i] + w) for rest, w in all_segmentations(sp, word[k:], weight)]
    return out


def test_sampling_follows_the_lattice():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sampler = piece_sampling.PieceSampler(MODEL)
    n = 20_000
    drawn = Counter(tuple(i.tolist()) for i in sampler.encode(["stated"] * n, list(range(n))))
    paths = dict(all_segmentations(sp, "▁stated", sampler.log_weight))
    total = np.logaddexp.reduce(list(paths.values()))
    assert set(drawn) <= set(paths)
    for path, w in paths.items():
        p = math.exp(w - total)
        assert abs(drawn[path] / n - p) <= 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_sums_of_a_word_are_its_own():
    """A word's sums are the same to the last bit, alone and among any others of its batch."""
    draw = np.random.default_rng(3)
    many = ["▁" + "".join(draw.choice(list("etaoinshrdlucméß日%9"), n)) for n in draw.integers(1, 24, 20_000)]
    among = piece_sampling.PieceSampler(MODEL)
    among.remember(many)

    def edges(sampler, word):
        node, out = int(sampler.end.room[sampler.at[word]]), []
        seen, todo = {node}, [node]
        while todo:
            at = todo.pop()
            k = int(sampler.first.room[at])
            while True:
                before = int(sampler.source.room[k])
                out.append((int(sampler.piece.room[k]), float(sampler.upto.room[k])))
                if before >= 0 and before not in seen:
                    seen.add(before)
                    todo.append(before)
                if sampler.upto.room[k] == 2.0:
                    break
                k += 1
        return out

    alone = piece_sampling.PieceSampler(MODEL)
    for word in [*many[-60:], *sorted(many, key=len)[-60:]]:
        alone.forget()
        alone.remember([word])
        assert edges(alone, word) == edges(among, word)


def test_trie_holds_every_piece():
    sampler = piece_sampling.PieceSampler(MODEL)
    for i in range(0, len(sampler.bytes_of), 7):
        piece = sampler.bytes_of[i].decode("utf-8", "replace").replace(" ", "▁")
        if i in sampler.byte or not piece:
            continue
        node = np.zeros(1, np.int64)
        for c in piece:
            node = sampler._step(node, np.array([ord(c)])).astype(np.int64)
            assert node[0] > 0
        assert sampler.piece_at[node[0]] == i
    assert sampler._step(np.zeros(2, np.int64), np.array([0x10FFFF, 0xDFFE])).tolist() == [-1, -1]


def test_pieces_are_lossless_and_reproducible(spark, odd_docs, no_docs):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sampler = piece_sampling.PieceSampler(MODEL)
    for text, ids in zip(TRICKY, sampler.encode(TRICKY, list(range(len(TRICKY))))):
        assert sampler.decode(ids) == text
        if "▁" not in text:
            assert sp.decode(ids.tolist()) == text
    apart = [piece_sampling.PieceSampler(MODEL).encode([t], [k])[0].tolist() for k, t in enumerate(TRICKY)]
    assert apart == [i.tolist() for i in sampler.encode(TRICKY, list(range(len(TRICKY))))]
    rows = piece_sampling.encode(odd_docs, MODEL).collect()
    assert len(rows) == odd_docs.count() and all(r["lossless"] and r["n_pieces"] == len(r["ids"]) for r in rows)
    assert len({tuple(r["ids"]) for r in rows if r["doc_id"] == 1}) == 1
    assert piece_sampling.encode(no_docs, MODEL).count() == 0
    assert all(r["lossless"] for r in queries.op9_sentencepiece(spark, SF_SMALL).select("lossless").collect())
