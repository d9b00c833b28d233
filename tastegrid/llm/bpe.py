"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by heap merges."""

from __future__ import annotations

import base64
from collections.abc import Iterable
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame

from tastegrid.llm.batches import map_slices, mix, spans

#: Pre-tokens a task remembers; it starts anew beyond that, which changes no result.
REMEMBERED = 300_000
_GAMMA = 2


@dataclass(frozen=True)
class PerfectHash:
    """Maps n known 64-bit values onto 0..n-1 without gaps; others anywhere or to -1.

    Each level places the values that have a slot of its bitmap to themselves and hands
    the rest on; a value's number is the rank of its bit.
    """

    sizes: tuple[int, ...]
    bits: np.ndarray
    ranks: np.ndarray

    @staticmethod
    def build(values: np.ndarray) -> PerfectHash:
        if len(np.unique(values)) != len(values):
            raise ValueError("two keys have one 64-bit hash")
        sizes, levels, left = [], [], values
        while len(left):
            size = max(64, _GAMMA * len(left))
            slot = _slots(left, len(sizes), size)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[slot]]
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        return PerfectHash(tuple(sizes), bits, (np.cumsum(bits) - 1).astype(np.int32))

    def find(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), -1, np.int32)
        left, start = np.arange(len(values)), 0
        for level, size in enumerate(self.sizes):
            slot = _slots(values[left], level, size) + start
            here = self.bits[slot]
            out[left[here]] = self.ranks[slot[here]]
            left, start = left[~here], start + size
        return out


def _slots(values: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (mix(values ^ seed) % np.uint64(size)).astype(np.int64)


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id, and the perfect hash over them."""

    tokens: tuple[bytes, ...]
    ids: dict[bytes, int]
    perfect: PerfectHash
    by_slot: np.ndarray
    pattern: str

    @staticmethod
    def build(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        keys = list(ranks)
        hashes = _hashes(keys)
        perfect = PerfectHash.build(hashes)
        by_slot = np.zeros(len(keys), np.int32)
        by_slot[perfect.find(hashes)] = [ranks[k] for k in keys]
        return Vocabulary(tuple(tokens), ranks, perfect, by_slot, pattern)

    @staticmethod
    def read(path: str, pattern: str) -> Vocabulary:
        """From a file with one base64 token and its rank a line."""
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return Vocabulary.build({base64.b64decode(t): int(r) for t, r in pairs}, pattern)


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def merge(piece: bytes, ids: dict[bytes, int]) -> list[int]:
    """Ids of a piece: always the neighbours of least rank merge first, the leftmost of
    equals. Parts form a linked list over the bytes; a heap holds the possible merges."""
    find, n = ids.get, len(piece)
    after = list(range(1, n + 1))  # 0 marks a byte that a part to its left has taken in
    before = list(range(-1, n))
    heap = [
        (rank, i, i + 2) for i in range(n - 1)
        if (rank := find(piece[i : i + 2])) is not None
    ]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        middle = after[i]
        if not middle or middle >= end or after[middle] != end:
            continue  # one of the two parts has grown since
        after[i], after[middle], before[end] = end, 0, i
        if end < n and (rank := find(piece[i : after[end]])) is not None:
            heappush(heap, (rank, i, after[end]))
        first = before[i]
        if first >= 0 and (rank := find(piece[first:end])) is not None:
            heappush(heap, (rank, first, end))
    out, i = [], 0
    while i < n:
        out.append(ids[piece[i : after[i]]])
        i = after[i]
    return out


class _Known(dict):
    """Numbers pre-tokens in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Encodes texts in one task; remembers the pre-tokens it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(vocabulary.pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        self.ids = np.zeros(0, np.int32)  # of all known pre-tokens, one after the other
        self.first = np.zeros(1, np.int64)

    def _learn(self) -> None:
        """Two tiers for new pre-tokens: the perfect hash, checked by the bytes; merges."""
        v, raw = self.vocabulary, [p.encode() for p in self.known.new]
        slots = v.perfect.find(_hashes(raw))
        wholes = np.where(slots >= 0, v.by_slot[slots], -1).tolist() if raw else []
        found = [
            [whole] if whole >= 0 and v.tokens[whole] == piece else merge(piece, v.ids)
            for piece, whole in zip(raw, wholes, strict=True)
        ]
        ends = self.first[-1] + np.cumsum([len(f) for f in found], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(found), np.int32)
        self.ids = np.concatenate([self.ids, flat])
        self.first = np.concatenate([self.first, ends])
        self.known.new.clear()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts one after the other, and each text's number."""
        if len(self.known) > REMEMBERED:
            self._forget()
        pieces = [self.split(t) for t in texts]
        sizes = np.array([len(p) for p in pieces], np.int64)
        number = np.fromiter(
            map(self.known.__getitem__, chain.from_iterable(pieces)), np.int64, int(sizes.sum())
        )
        self._learn()
        lengths = np.diff(self.first)[number]
        ids = self.ids[spans(self.first[number], lengths)]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(sizes)
        return ids, before[ends] - before[ends - sizes]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


def encode_decode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) of every row: the text's ids, and the bytes
    that decoding these ids gives.

    Each match of the vocabulary's pattern is encoded by itself, without special tokens. A
    null text counts as empty and has no ids. Whole texts count, however long; repeated
    rows are encoded each; only doc_id and text are read. The vocabulary, of fixed size,
    is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    encoders: list[Encoder] = []  # filled in each task, which unpickles its own list
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(piece: pa.RecordBatch) -> dict:
        if not encoders:
            encoders.append(Encoder(sent.value))
        encoder = encoders[0]
        ids, counts = encoder.encode(pc.fill_null(piece.column("text"), "").to_pylist())
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        decoded = [
            encoder.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:], strict=False)
        ]
        return {
            "doc_id": piece.column("doc_id"),
            "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
            "decoded": pa.array(decoded, pa.binary()),
        }

    return map_slices(
        docs, ["doc_id", "text"], work, f"doc_id {id_type}, ids array<int>, decoded binary"
    )
