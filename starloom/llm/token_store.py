"""Token-id output: one zstandard frame per document under a shared dictionary.

Documents are dealt into ranges of ascending id (a range partitioning of id
and text; the texts cross the network once), encoded and written as blocks.
A block holds the frames of neighbouring documents back to back, the offset
index (where each frame ends and how many ids it holds), the ids of its first
and last document and the hash of the dictionary.  The dictionary is trained
on the serialized id arrays of a bounded sample and stored beside the blocks.
Any document is read alone: the range of ids finds its block, the index its
frame.  Blocks are rows of Parquet files, so Spark's committer keeps them
whole when a task is repeated and any file system serves.

Defined results: a null or empty text is a document with the end id alone;
null document ids come first; documents with equal ids stay apart, in the
order of their texts; an empty table gives a dictionary and no block; further
columns are dropped.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import bounded_sample, id_and_text, kept

#: Bytes of the dictionary, rows it is trained on, compression level.
DICTIONARY_BYTES, SAMPLE_ROWS, LEVEL = 65_536, 2000, 3
#: A block is closed at so many documents or ids.
BLOCK_DOCS, BLOCK_IDS = 512, 1 << 20
#: Words and pieces that an encoder remembers before it starts anew.
CACHE = 600_000


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable
    Latin-1 bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(other)}}


class Known:
    """Strings with their ids, remembered until there are too many.  ``spell``
    gives the ids of a list of strings and how many each has."""

    def __init__(self, spell):
        self.spell = spell
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.start = self.size = np.zeros(0, np.int64)

    def _places(self, every: list[str]) -> np.ndarray:
        """Where each string's ids are; -1 if it isn't known."""
        return np.fromiter(map(self.at.get, every, repeat(-1)), np.int64, len(every))

    def ids(self, every: list[str], counts: list[int]) -> list[np.ndarray]:
        """Ids of runs of strings, of which each has its number in ``counts``."""
        which = self._places(every)
        missing = np.flatnonzero(which < 0).tolist()
        if missing:
            new = {every[i] for i in missing}
            if self.at and len(self.at) + len(new) > CACHE:
                self.forget()
                new, missing = set(every), range(len(every))
            ids, size = self.spell(list(new))
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, np.array(ids, np.uint32)])
            which[missing] = self._places([every[i] for i in missing])
        size = self.size[which]
        end = np.cumsum(size)
        flat = self.flat[np.arange(int(size.sum())) + np.repeat(self.start[which] - (end - size), size)]
        return np.split(flat, np.concatenate([[0], end])[np.cumsum(counts)][:-1]) if counts else []


class Encoder:
    """Ids of texts by the tokenizers library.

    A tokenizer whose splitting never crosses white space gives a text the ids
    of its pieces one after the other.  In texts of ASCII and accented Latin-1
    letters alone, whose normal form is their lower case, the pieces are found
    by the splitting pattern, and each distinct piece goes to the model once and
    is remembered.  Other texts are cut at white space, and each distinct word
    goes through the whole tokenizer.  Tokenizers of another kind encode whole
    texts.
    """

    #: Normal and splitting steps (as the tokenizer file names them) that this holds for.
    NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    ODD = re.compile("[^\x20\x09-\x0D\x21-\x7eÀ-ÖØ-öø-ÿ]")
    PIECE = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\x20\x09-\x0Da-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.by_word = ((spec.get("normalizer") or {}).get("normalizers") == self.NORMAL
                        and split[0].get("pattern", {}).get("Regex") == self.SPLIT
                        and [s.get("type") for s in split] == ["Split", "ByteLevel"])
        # What all special tokens begin with (something that no text holds, if there are none).
        self.mark = os.path.commonprefix([t["content"] for t in spec.get("added_tokens", [])] or ["\0\0"])
        letters = _byte_letters()
        self.letters = str.maketrans({chr(c): "".join(letters[b] for b in chr(c).encode()) for c in range(256)})
        self.pieces, self.words = Known(self._spell_pieces), Known(self._spell_words)

    def _spell_words(self, words: list[str]) -> tuple[list[int], np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return list(chain.from_iterable(found)), np.fromiter(map(len, found), np.int64, len(found))

    def _spell_pieces(self, pieces: list[str]) -> tuple[list[int], np.ndarray]:
        """Pieces have their normal form: the model takes them as byte letters."""
        tokenize, letters = self.tokenizer.model.tokenize, self.letters
        found = [[t.id for t in tokenize(p if p.isascii() else p.translate(letters))] for p in pieces]
        return list(chain.from_iterable(found)), np.fromiter(map(len, found), np.int64, len(found))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit arrays."""
        if not self.by_word:
            return [np.array(e.ids, np.uint32) for e in
                    self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        odd = [self.ODD.search(t) is not None or self.mark in t for t in texts]
        plain = self._runs(self.pieces, [self.PIECE.findall(t.lower()) for t, o in zip(texts, odd) if not o])
        other = self._runs(self.words, [[w.decode("utf-8", "surrogatepass") for w in t.encode("utf-8", "surrogatepass").split()]
                                        for t, o in zip(texts, odd) if o])
        return [next(other if o else plain) for o in odd]

    @staticmethod
    def _runs(known: Known, runs: list[list[str]]) -> Iterator[np.ndarray]:
        return iter(known.ids(list(chain.from_iterable(runs)), list(map(len, runs))))


def encoder_of(path: str) -> Encoder:
    """The worker's encoder, with the words it remembers."""
    return kept(("tokens", path), lambda: Encoder(path))


def id_type(vocabulary: int) -> str:
    """Little-endian unsigned, as narrow as the vocabulary allows."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for the serialized arrays; too few of them to train on are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:].ljust(8, b"\0")


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


BLOCK = ("part int, block int, first_id long, last_id long, dictionary string, id_type string, frames binary, "
         "doc_ids array<long>, ends array<long>, n_ids array<long>")


def _ids_of(path: str, end_id: int, kind: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(path)
        for pdf in batches:
            yield pd.DataFrame({"ids": [np.append(a, end_id).astype(kind).tobytes() for a in encoder.encode(pdf["text"].tolist())]})
    return run


def _blocks(path: str, end_id: int, kind: str, data: bytes, name: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(path)
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data), write_checksum=True)
        part, block = TaskContext.get().partitionId(), 0
        frames, ids, sizes, held = [], [], [], 0

        def closed() -> pd.DataFrame:
            known = [i for i in ids if i is not None]
            return pd.DataFrame([(part, block, min(known, default=None), max(known, default=None), name, kind,
                                  b"".join(frames), ids[:], np.cumsum([len(f) for f in frames]).tolist(), sizes[:])],
                                columns=BLOCK_COLUMNS).astype({"first_id": "Int64", "last_id": "Int64"})

        for pdf in batches:
            for k in range(0, len(pdf), 256):  # bounded lists of words
                piece = pdf.iloc[k:k + 256]
                for doc_id, found in zip(piece["doc_id"], encoder.encode(piece["text"].tolist())):
                    frames.append(squeeze.compress(np.append(found, end_id).astype(kind).tobytes()))
                    ids.append(None if pd.isna(doc_id) else int(doc_id))
                    sizes.append(len(found) + 1)
                    held += sizes[-1]
                    if len(ids) >= BLOCK_DOCS or held >= BLOCK_IDS:
                        yield closed()
                        block += 1
                        frames, ids, sizes, held = [], [], [], 0
        if ids:
            yield closed()
    return run


BLOCK_COLUMNS = [c.split()[0] for c in BLOCK.split(", ")]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> None:
    """Encode every text and write ``path``/dictionary and ``path``/blocks, in
    ascending order of the document id."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).select(F.col("doc_id"), "text")
    from tokenizers import Tokenizer
    kind = id_type(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True))
    samples = [bytes(r["ids"]) for r in bounded_sample(rows.select("text"), sample_rows).mapInPandas(
        _ids_of(tokenizer, end_id, kind), "ids binary").collect()]
    data = train_dictionary(samples)
    name = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(name, bytearray(data))], "hash string, bytes binary").coalesce(1).write.parquet(f"{path}/dictionary")
    (rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInPandas(_blocks(tokenizer, end_id, kind, data, name), BLOCK)
     .write.option("parquet.block.size", 32 << 20).parquet(f"{path}/blocks"))


def dictionary_of(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").head()
    return row["hash"], bytes(row["bytes"])


def _decoded(name: str, data: bytes, make):
    """For each document of each block: its place and what ``make`` gives for its ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        for pdf in batches:
            for b in pdf.itertuples(index=False):
                if b.dictionary != name:
                    raise ValueError(f"block written with dictionary {b.dictionary}, not {name}")
                rows, start, before = [], 0, 0
                for doc_id, end in zip(b.doc_ids, b.ends):
                    ids = np.frombuffer(expand.decompress(b.frames[start:end]), b.id_type)
                    rows.append((b.part, b.block, doc_id, before, make(ids)))
                    start, before = end, before + len(ids)
                out = pd.DataFrame(rows, columns=["part", "block", "doc_id", "before", "made"])
                out["doc_id"] = pd.array([None if pd.isna(i) else int(i) for i in b.doc_ids], "Int64")
                yield out
    return run


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids of every document."""
    name, data = dictionary_of(spark, path)
    return spark.read.parquet(f"{path}/blocks").mapInPandas(
        _decoded(name, data, lambda ids: ids.astype(np.int64).tolist()),
        "part int, block int, doc_id long, before long, made array<long>").select("doc_id", F.col("made").alias("ids"))


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """Rows of one document: the ranges of ids, which the files' statistics
    hold, leave the blocks around it; the index finds its frame."""
    name, data = dictionary_of(spark, path)

    def one(batches):
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        for pdf in batches:
            for b in pdf.itertuples(index=False):
                for k in [k for k, i in enumerate(b.doc_ids) if i == doc_id]:
                    raw = expand.decompress(b.frames[b.ends[k - 1] if k else 0:b.ends[k]])
                    yield pd.DataFrame({"doc_id": [doc_id], "ids": [np.frombuffer(raw, b.id_type).astype(np.int64).tolist()]})

    return spark.read.parquet(f"{path}/blocks").filter(
        (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).mapInPandas(one, "doc_id long, ids array<long>")


def index_and_checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document as read from the files.

    Block starts are a running sum in two levels (ranges, then blocks of a
    range): only one row per range meets in one task."""
    name, data = dictionary_of(spark, path)

    def checksum(ids: np.ndarray) -> tuple[int, int]:
        return {"n": len(ids), "crc": zlib.crc32(ids.astype("<u4").tobytes())}

    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = blocks.select("part", "block", F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("s", F.coalesce(F.sum("n").over(within), F.lit(0))).join(parts, "part").select(
        "part", "block", (F.col("s") + F.col("part_start")).alias("block_start"))
    docs = blocks.mapInPandas(_decoded(name, data, checksum),
                              "part int, block int, doc_id long, before long, made struct<n: long, crc: long>")
    return docs.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("before")).alias("start"), F.col("made.n").alias("n_tokens"),
        F.col("made.crc").alias("ids_crc32"))
