"""Sampled SentencePiece segmentations, reproducible and lossless.

The pieces of a model span a lattice over a text; a path through it is a
segmentation.  Forward filtering sums the weights of all paths up to each
position, backward sampling then draws pieces from the end, each with the
probability that the sums give it.  Draws are hashed from (seed, row key, word
number, step), so a row gets the same segmentation wherever and whenever it is
encoded.  Unigram models weigh a piece by its score; in merge models, whose
scores are ranks, by rank^-smoothing.  Characters without a piece become byte
pieces, so decoding gives every text back exactly.

No piece of the models crosses from a word to the space before the next, so
the lattice falls into words.  The sums of a word are computed once for all
its occurrences (for all new words of a batch together, as arrays), and the
draws of all words of a batch advance together.

Defined results: a null or empty text has no pieces; a null key counts as 0;
repeated rows get equal pieces; further columns are dropped by ``encode``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from starloom.llm.common import frames, id_and_text, kept

SPACE = "▁"
#: Stands for a space sign in the text itself, which is no space: a code that no text holds and no piece has.
SIGN = "\udfff"
#: Exponent of the rank of a merge piece; distinct words remembered; texts whose draws advance together.
SMOOTHING, CACHE, SLICE = 1.0, 150_000, 256


def _hashed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Grown:
    """An array that grows at its end without being copied each time."""

    def __init__(self, kind: type):
        self.room, self.n = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.room):
            room = np.zeros(2 * (self.n + len(more)), self.room.dtype)
            room[:self.n] = self.room[:self.n]
            self.room = room
        self.room[self.n:self.n + len(more)] = more
        self.n += len(more)


class PieceSampler:
    def __init__(self, model: str, smoothing: float = SMOOTHING, seed: int = 0):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(sp.get_piece_size())
        plain = {sp.id_to_piece(i): i for i in ids if not (
            sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.bytes_of = [b""] * len(ids)
        for piece, i in plain.items():
            self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte):
            self.bytes_of[i] = bytes([b])
        score = np.array([sp.get_score(i) for i in ids])
        ranked = bool(len(plain)) and all(float(score[i]).is_integer() for i in plain.values())
        lowest = score[list(plain.values())].min() if plain else 0.0
        self.log_weight = -smoothing * np.log(1.0 - score.clip(max=0)) if ranked else smoothing * score
        self.fallback = float(-smoothing * np.log(2.0 - lowest) if ranked else smoothing * (lowest - 10))
        self.seed = seed
        self._grow(plain)
        # Words end before a space that follows another character, and around newlines that no piece holds.
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in plain)
        newline = "" if any("\n" in p for p in plain) else "\n"
        self.words = re.compile(".+" if crossing else f"{SPACE}*[^{SPACE}{newline}]+|{SPACE}+|\n", re.DOTALL)
        self.prefix = sp.id_to_piece(sp.encode("a")[0]).startswith(SPACE)
        self.forget()

    def _grow(self, plain: dict[str, int]) -> None:
        """The pieces as a trie: a hash table from (node, character) to the child."""
        node, last, ends = {"": 0}, 0, {}
        for piece in plain:
            for k in range(1, len(piece) + 1):
                if piece[:k] not in node:
                    last += 1
                    node[piece[:k]] = last
        keys = {(node[p[:-1]] << 21) | ord(p[-1]): i for p, i in node.items() if p}
        self.shift = np.uint64(64 - max(4, (8 * len(keys)).bit_length()))
        self.slots = np.full(1 << (64 - int(self.shift)), -1, np.int64)
        self.child = np.full(len(self.slots), -1, np.int32)
        key, child = np.fromiter(keys, np.int64, len(keys)), np.fromiter(keys.values(), np.int32, len(keys))
        slot = self._slot(key)
        while len(key):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = key[free]  # of several keys for a slot the last one stays
            here = self.slots[slot] == key
            self.child[slot[here]] = child[here]
            key, child, slot = key[~here], child[~here], (slot[~here] + 1) % len(self.slots)
        self.piece_at = np.full(last + 1, -1, np.int32)
        for piece, i in plain.items():
            self.piece_at[node[piece]] = i

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The child of each node by its character, -1 where there is none."""
        key = (node << 21) | char
        slot = self._slot(key)
        held = self.slots[slot]
        child = self.child[slot]
        child[held != key] = -1
        at = np.flatnonzero((held != key) & (held >= 0))
        while len(at):  # another key's slot: the next one
            slot[at] = (slot[at] + 1) % len(self.slots)
            held = self.slots[slot[at]]
            hit = held == key[at]
            child[at[hit]] = self.child[slot[at[hit]]]
            at = at[~hit & (held >= 0)]
        return child

    def forget(self) -> None:
        """Nodes are positions of remembered words; edges into a node lie together."""
        self.at: dict[str, int] = {}
        self.end = Grown(np.int32)      # last node of a word
        self.first = Grown(np.int32)    # first edge into a node
        self.upto = Grown(np.float64)   # summed probability up to an edge
        self.source = Grown(np.int32)   # node that an edge comes from; -1 at a word's start
        self.piece = Grown(np.int32)    # its piece; below 0: byte pieces of character -1 - piece

    def remember(self, words: list[str]) -> None:
        new = list(set(words).difference(self.at))
        if self.at and len(self.at) + len(new) > CACHE:
            self.forget()
            new = list(set(words))
        if not new:
            return
        # Longest first, and characters by their place in the word: those of a place lie together,
        # the k-th being the k-th word's, so that the sums go over slices.
        new.sort(key=len, reverse=True)
        size = np.fromiter(map(len, new), np.int64, len(new))
        held = len(new) - np.searchsorted(size[::-1], np.arange(size[0]), side="right")  # words that have a place
        off = np.append(0, np.cumsum(held))
        place = np.repeat(np.arange(len(held)), held)
        before, after = np.arange(off[-1]), np.arange(off[-1])  # the same word's places before and after; -1: none
        before -= np.append(0, held)[place]
        before[:off[1]] = -1
        after += held[place]
        after[after - off[np.minimum(place + 1, len(held))] >= np.append(held[1:], 0)[place]] = -1
        chars = np.zeros(off[-1], np.int64)
        word = np.repeat(np.arange(len(new)), size)
        chars[off[np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)] + word] = np.frombuffer(
            "".join(new).encode("utf-32-le", "surrogatepass"), "<u4")
        # All pieces from all positions: walk the trie from everywhere at once.
        tail, source, node = np.arange(len(chars)), before, np.zeros(len(chars), np.int64)
        found, spread, single = [], np.zeros(len(chars), np.int64), np.zeros(len(chars), bool)
        while len(tail):
            child = self._step(node, chars[tail])
            ok = np.flatnonzero(child >= 0)
            tail, source, node = tail[ok], source[ok], child[ok].astype(np.int64)
            piece = self.piece_at[node]
            hit = np.flatnonzero(piece >= 0)
            found.append((tail[hit], source[hit], piece[hit], self.log_weight[piece[hit]]))
            spread[tail[hit]] += 1
            if len(found) == 1:
                single[tail[hit]] = True
            follow = after[tail]
            more = np.flatnonzero(follow >= 0)
            tail, source, node = follow[more], source[more], node[more]
        alone = np.flatnonzero(~single)
        width = 1 + (chars[alone] > 0x7F) + (chars[alone] > 0x7FF) + (chars[alone] > 0xFFFF)
        found.insert(0, (alone, before[alone], -1 - chars[alone], width * self.fallback))
        spread[alone] += 1
        # Edges into a node lie together, those of the longest pieces first.
        first = np.append(0, np.cumsum(spread))
        room = first[1:].copy()
        into, piece, weight = np.zeros(first[-1], np.int32), np.zeros(first[-1], np.int32), np.zeros(first[-1])
        for tail, source, which, log_weight in found:
            room[tail] -= 1
            at = room[tail]
            into[at], piece[at], weight[at] = source, which, log_weight
        # Forward sums, place by place; the one after the last stands for a word's start.
        total = np.zeros(len(chars) + 1)
        for p in range(len(held)):
            nodes, edges = slice(off[p], off[p + 1]), slice(first[off[p]], first[off[p + 1]])
            weight[edges] += total[into[edges]]
            cut = first[nodes] - edges.start
            top = np.maximum.reduceat(weight[edges], cut)
            total[nodes] = top + np.log(np.add.reduceat(np.exp(weight[edges] - np.repeat(top, spread[nodes])), cut))
        weight -= np.repeat(total[:-1], spread)
        upto = np.exp(weight, out=weight)
        # Sums of a node's own edges alone: no other word of the batch bears on their rounding.
        at, left = first[:-1], spread
        while len(at):
            go = np.flatnonzero(left > 1)
            at, left = at[go] + 1, left[go] - 1
            upto[at] += upto[at - 1]
        upto[first[1:] - 1] = 2.0  # the last edge takes what is left
        nodes, edges = self.first.n, self.piece.n
        self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
        self.end.add(nodes + off[size - 1] + np.arange(len(new)))
        self.first.add(edges + first[:-1])
        self.upto.add(upto)
        self.source.add(np.where(into < 0, -1, nodes + into))
        self.piece.add(piece)

    def encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Piece ids of each text, drawn for its key."""
        out = []
        for k in range(0, len(texts), SLICE):
            out += self._encode(texts[k:k + SLICE], keys[k:k + SLICE])
        return out

    def _encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        lead = SPACE if self.prefix else ""
        split = [self.words.findall(lead + t.replace(SPACE, SIGN).replace(" ", SPACE)) for t in texts]
        split = [ws if t else [] for ws, t in zip(split, texts)]
        every = [w for ws in split for w in ws]
        if not every:
            return [np.zeros(0, np.int64) for _ in texts]
        self.remember(every)
        counts = np.array([len(ws) for ws in split])
        word = np.fromiter(map(self.at.__getitem__, every), np.int64, len(every))
        own = _hashed(np.array([int(k or 0) & (2**64 - 1) for k in keys], np.uint64) ^ _hashed(np.array([self.seed], np.uint64)))
        number = np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts)
        stream = _hashed(np.repeat(own, counts) + number.astype(np.uint64))
        first, upto, source, piece_of = self.first.room, self.upto.room, self.source.room, self.piece.room
        node, who, steps = self.end.room[word], np.arange(len(word)), []
        step = 0
        while len(who):
            u = (_hashed(stream[who] + np.uint64(step)) >> np.uint64(11)) / float(1 << 53)
            edge = first[node]
            wait = np.flatnonzero(u >= upto[edge])
            while len(wait):
                edge[wait] += 1
                wait = wait[u[wait] >= upto[edge[wait]]]
            steps.append((who, piece_of[edge]))
            node = source[edge]
            go = np.flatnonzero(node >= 0)
            who, node, step = who[go], node[go], step + 1
        taken = np.zeros(len(word), np.int64)
        for who, _ in steps:
            taken[who] += 1
        after = np.cumsum(taken)
        ids = np.zeros(int(after[-1]), np.int64)
        for k, (who, piece) in enumerate(steps):  # the k-th draw is the k-th piece from the end
            ids[after[who] - 1 - k] = piece
        ends = np.append(0, after)[np.cumsum(counts)]
        return [self._spelled(a) for a in np.split(ids, ends[:-1])]

    def _spelled(self, ids: np.ndarray) -> np.ndarray:
        """Characters without a piece written as byte pieces."""
        ascii = (ids < 0) & (ids >= -128)
        ids[ascii] = self.byte[-1 - ids[ascii]]
        at = np.flatnonzero(ids < 0)
        if not len(at):
            return ids
        chars = [chr(-1 - i).replace(SIGN, SPACE).encode("utf-8", "surrogatepass") for i in ids[at].tolist()]
        more = np.ones(len(ids), np.int64)
        more[at] = [len(c) for c in chars]
        out = np.repeat(ids, more)
        out[np.repeat(ids < 0, more)] = self.byte[list(b"".join(chars))]
        return out

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        text = data.decode("utf-8", "surrogatepass")
        return text[1:] if self.prefix else text


def sampler_of(model: str, smoothing: float, seed: int) -> PieceSampler:
    """The worker's sampler, with the words it remembers."""
    return kept(("pieces", model, smoothing, seed), lambda: PieceSampler(model, smoothing, seed))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
           smoothing: float = SMOOTHING, seed: int = 0) -> DataFrame:
    """doc_id, ids (sampled pieces), n_pieces, ids_crc32 (of the ids as little-endian
    32-bit integers) and lossless (decoding gives the text back) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = sampler_of(model, smoothing, seed)

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            texts = pdf["text"].tolist()
            ids = sampler.encode(texts, [0 if pd.isna(i) else int(i) for i in pdf["doc_id"]])
            return pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"), "ids": [a.astype(np.int32) for a in ids],
                "n_pieces": [len(a) for a in ids], "ids_crc32": [zlib.crc32(a.astype("<u4").tobytes()) for a in ids],
                "lossless": [sampler.decode(a) == t for a, t in zip(ids, texts)]})

        for pdf in batches:
            for k in range(0, len(pdf), 1024):
                yield from frames([pdf.iloc[k:k + 1024]], one)

    return id_and_text(docs, id_col, text_col).mapInPandas(
        run, "doc_id long, ids array<int>, n_pieces long, ids_crc32 long, lossless boolean")
