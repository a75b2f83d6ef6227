"""Byte-level BPE encoding and decoding with a given rank table.

Texts are split by the table's pattern.  The distinct pieces of a slice of documents
that are not known yet are encoded together: pieces are put into buckets by length, a
bucket is one padded numpy matrix of token ids, and in each round every row merges its
leftmost pair of minimum rank.  Pairs are looked up in a hash table with open
addressing; rows that have no pair left leave the matrix, and the merged cell's
neighbour is squeezed out.  Pieces longer than ``LONG`` bytes, for which one merge per
round would be quadratic, take the same merges from a heap over a linked list.

A piece that is itself in the table is one token.  Decoding joins the bytes of the ids.

Defined results: NULL and empty texts have no tokens; very long texts and pieces are encoded
whole; of pairs of equal rank the leftmost merges first; repeated rows are encoded each; an
empty table gives an empty result; no special tokens exist, their strings are ordinary
text; further columns of the input are ignored.
"""

from __future__ import annotations

import base64
import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import map_documents

#: Bytes of a piece beyond which the heap replaces the matrix.
LONG = 128
#: Pieces a task remembers before it forgets them all; no result depends on it.
REMEMBERED = 200_000
NONE = np.int64(1) << 40


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The table in a rank file: base64 bytes and rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Vocabulary:
    """Lookup tables of one rank file."""

    def __init__(self, data: bytes):
        self.ranks = read_ranks(data)
        self.size = max(self.ranks.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self._hash_pairs()
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.flat = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)

    def _hash_pairs(self) -> None:
        keys, values = [], []
        get = self.ranks.get
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = get(token[:cut]), get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    values.append(rank)
        keys, values = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int64)
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int64)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            at, first = np.unique(slot[free], return_index=True)  # one key for each free slot
            who = np.flatnonzero(free)[first]
            self.keys[at], self.values[at] = keys[who], values[who]
            rest = np.ones(len(keys), dtype=bool)
            rest[who] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where it is no token or a side is padding."""
        keys = left * self.size + right
        out = np.full(keys.shape, NONE, dtype=np.int64)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = keys.ravel()[todo]
        slot = self._slot(keys)
        flat = out.ravel()
        while len(todo):
            there = self.keys[slot]
            hit = there == keys
            flat[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there != -1)
            todo, keys, slot = todo[on], keys[on], (slot[on] + 1) & self.mask
        return flat.reshape(out.shape)


def merge_matrix(vocabulary: Vocabulary, pieces: list[bytes]) -> list[tuple[int, ...]]:
    """Token ids of each piece; all go through one padded matrix."""
    width = max(map(len, pieces))
    ids = np.full((len(pieces), width), -1, dtype=np.int64)
    for row, piece in enumerate(pieces):
        ids[row, : len(piece)] = vocabulary.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
    out: list = [None] * len(pieces)
    who = np.arange(len(pieces))
    ranks = vocabulary.pair_ranks(ids[:, :-1], ids[:, 1:])
    while True:
        if ids.shape[1] > 1:
            at = ranks.argmin(axis=1)  # the leftmost of equal ranks
            best = ranks[np.arange(len(at)), at]
            done = best == NONE
        else:
            done = np.ones(len(ids), dtype=bool)
        for row in np.flatnonzero(done):
            out[who[row]] = tuple(ids[row][ids[row] >= 0].tolist())
        if done.all():
            return out
        go = ~done
        ids, ranks, who, at, best = ids[go], ranks[go], who[go], at[go], best[go]
        rows = np.arange(len(ids))
        ids[rows, at] = best
        keep = np.ones(ids.shape, dtype=bool)
        keep[rows, at + 1] = False
        ids = ids[keep].reshape(len(ids), -1)
        keep = np.ones(ranks.shape, dtype=bool)
        keep[rows, at] = False
        ranks = ranks[keep].reshape(len(ids), -1)
        left = np.flatnonzero(at > 0)
        ranks[left, at[left] - 1] = vocabulary.pair_ranks(ids[left, at[left] - 1], ids[left, at[left]])
        right = np.flatnonzero(at < ids.shape[1] - 1)
        ranks[right, at[right]] = vocabulary.pair_ranks(ids[right, at[right]], ids[right, at[right] + 1])


def merge_long(ranks: dict[bytes, int], piece: bytes) -> tuple[int, ...]:
    """The same merges for one long piece: least rank first, then leftmost."""
    parts: list = [piece[i : i + 1] for i in range(len(piece))]
    before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
    end = len(parts)
    heap = [
        (rank, i, piece[i : i + 2])
        for i in range(end - 1)
        if (rank := ranks.get(piece[i : i + 2])) is not None
    ]
    heapq.heapify(heap)
    while heap:
        _, i, token = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j >= end or parts[i] + parts[j] != token:
            continue  # a neighbour has merged since
        parts[i], parts[j] = token, None
        after[i] = after[j]
        if after[i] < end:
            before[after[i]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < end:
                pair = parts[left] + parts[right]
                if (rank := ranks.get(pair)) is not None:
                    heapq.heappush(heap, (rank, left, pair))
    return tuple(ranks[p] for p in parts if p is not None)


class Encoder:
    """Encodes texts; remembers the pieces it has met."""

    def __init__(self, data: bytes, pattern: str):
        import regex

        self.vocabulary = Vocabulary(data)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def learn(self, pieces: set[str]) -> None:
        ranks, known = self.vocabulary.ranks, self.known
        buckets: dict[int, list] = {}
        for piece in pieces:
            data = piece.encode()
            if (rank := ranks.get(data)) is not None:
                known[piece] = (rank,)
            elif len(data) > LONG:
                known[piece] = merge_long(ranks, data)
            else:
                buckets.setdefault((len(data) + 3) // 4, []).append((piece, data))
        for bucket in buckets.values():
            rows = merge_matrix(self.vocabulary, [data for _, data in bucket])
            known.update((piece, ids) for (piece, _), ids in zip(bucket, rows))

    def encode(self, texts: list[str | None]) -> pa.Array:
        """A list of token ids for each text."""
        split = [self.split(text) if text else [] for text in texts]
        new = set(chain.from_iterable(split)).difference(self.known)
        if new:
            if len(self.known) > REMEMBERED:
                self.known.clear()
                new = set(chain.from_iterable(split))
            self.learn(new)
        get = self.known.__getitem__
        ids, ends = [], [0]
        for pieces in split:
            own = np.fromiter(chain.from_iterable(map(get, pieces)), dtype=np.int32)
            ids.append(own)
            ends.append(ends[-1] + len(own))
        flat = np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def decode_lists(vocabulary: Vocabulary, lists: pa.Array) -> pa.Array:
    """The bytes of each list's tokens, joined."""
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    lengths = vocabulary.lengths[ids]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    offsets = np.repeat(vocabulary.starts[ids] - ends[:-1], lengths)
    data = vocabulary.flat[offsets + np.arange(ends[-1])]
    edges = ends[np.concatenate([[0], np.cumsum(counts)])].astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(lists), [None, pa.py_buffer(edges), pa.py_buffer(data)]
    ).cast(pa.binary())


_TABLES: dict = {}


def _once(kind: type, *content):
    """One table per Python worker and content, for all its tasks."""
    key = (kind, *content)
    if key not in _TABLES:
        _TABLES[key] = kind(*content)
    return _TABLES[key]


def rank_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids array<int>`` of each row of ``docs`` (doc_id, text).

    ``ranks`` is the content of a rank file: some hundred kilobytes, which Spark
    broadcasts to the workers.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def make():
        encoder = _once(Encoder, *shared.value)
        return lambda texts: [encoder.encode(texts.to_pylist())]

    return map_documents(docs.select("doc_id", "text"), make, "ids array<int>")


def round_trip(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded binary``, what the ids decode to, of each row of ``docs``.

    The same as ``decode(encode(...))``, in one pass: a task keeps one Python worker with one
    vocabulary, where two passes in a row keep two of each alive.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def make():
        encoder = _once(Encoder, *shared.value)

        def work(texts: pa.Array):
            ids = encoder.encode(texts.to_pylist())
            return ids, decode_lists(encoder.vocabulary, ids)

        return work

    return map_documents(docs.select("doc_id", "text"), make, "ids array<int>, decoded binary")


def decode(tokens: DataFrame, ranks: bytes) -> DataFrame:
    """``tokens`` (its last column ``ids``) with ``decoded binary`` in addition."""
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)

    def make():
        vocabulary = _once(Vocabulary, shared.value)
        return lambda lists: [decode_lists(vocabulary, lists)]

    kept = [c for c in tokens.columns if c != "ids"]
    return map_documents(tokens.select(*kept, "ids", tokens["ids"].alias("_ids")), make, "decoded binary")
