"""Documents packed into training sequences of several context sizes, without padding.

A document goes to the tier of the least context size that holds it (what a longest
window takes whole is cut off first). Tiers are packed from the longest down: a window
begins with the longest document left of its tier, and its gap is filled with documents
of shorter tiers, whole ones first and at last the beginning of one.
"""

from __future__ import annotations

import heapq
import os
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tastegrid.llm.batches import map_slices, spans, split_words

TIERS = (2048, 1024, 512, 256)
#: Tokens of a training step, about.
STEP_TOKENS = 64 * 2048
#: Different words that a task remembers.
REMEMBERED = 1 << 19
_WORDS_A_TEXT, _LEARNT_AT_ONCE = 256, 1 << 14
_BLOCK_BYTES = 8 << 20

Piece = tuple[int, int, int]  # document, first token, number of tokens


class Words:
    """Token ids of words in one task, by a tokenizer that never joins words.

    White space parts pre-tokens, so a text's ids are those of its words one after the
    other; each different word is encoded once.
    """

    def __init__(self, tokenizer: str, end_id: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        self.tokenizer, self.end_id = Tokenizer.from_str(tokenizer), end_id
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())  # the word of entry 1, 2, ...
        self.ids = np.array([self.end_id], np.uint32)  # entry 0 ends a document
        self.first = np.array([0, 1], np.int64)

    def _learn(self, new: pa.Array) -> None:
        """Ids of new words, some words in one text; a token belongs to the word it starts in."""
        self.known = pa.concat_arrays([self.known, new])
        words = new.to_pylist()
        for start in range(0, len(words), _LEARNT_AT_ONCE):
            part = words[start : start + _LEARNT_AT_ONCE]
            groups = [part[k : k + _WORDS_A_TEXT] for k in range(0, len(part), _WORDS_A_TEXT)]
            found = self.tokenizer.encode_batch(
                [" ".join(g) for g in groups], add_special_tokens=False
            )
            ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32)
            starts = map(itemgetter(0), chain.from_iterable(e.offsets for e in found))
            at = np.fromiter(starts, np.int64, len(ids))
            sizes = np.fromiter(map(len, part), np.int64, len(part)) + 1
            # places of words and tokens as if all texts, each with a blank more, were one
            begin = np.cumsum(sizes) - sizes
            texts = begin[::_WORDS_A_TEXT]
            at += np.repeat(texts, [len(e) for e in found])
            counts = np.bincount(np.searchsorted(begin, at, "right") - 1, minlength=len(part))
            self.ids = np.concatenate([self.ids, ids])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts, each with the end id, and their numbers."""
        if len(self.known) > REMEMBERED:
            self._forget()
        starts, words = split_words(texts)
        coded = words.dictionary_encode()
        different, n = coded.dictionary, len(self.known)
        found = pc.index_in(different, value_set=self.known)
        self._learn(different.filter(found.is_null()))
        table = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        new = table < 0
        table[new] = n + np.arange(new.sum())
        entries = table[coded.indices.to_numpy(False)] + 1
        entries = np.insert(entries, starts[1:], 0)
        sizes = np.diff(self.first)[entries]
        before = np.concatenate([[0], np.cumsum(sizes)])
        at = before[starts + np.arange(len(starts))]
        return self.ids[spans(self.first[entries], sizes)], np.diff(at)


@dataclass
class Packer:
    """The documents of one block, in tiers; a tier is sorted by length."""

    tiers: tuple[int, ...] = TIERS
    pools: list[list[tuple[int, int, int]]] = field(default_factory=list)

    def pack(self, lengths: list[int]) -> list[list[Piece]]:
        """Windows of pieces. Each is as long as a context size, but those of the last
        window's rest, which are as long as the powers of two that sum up to it."""
        self.pools = [[] for _ in self.tiers]
        longest, out = self.tiers[0], []
        for doc, n in enumerate(lengths):
            whole = n - n % longest
            out += [[(doc, at, longest)] for at in range(0, whole, longest)]
            if n > whole:
                self.pools[self._tier(n - whole)].append((n - whole, doc, whole))
        for pool in self.pools:
            pool.sort()
        for tier, size in enumerate(self.tiers):
            while self.pools[tier]:
                n, doc, at = self.pools[tier].pop()
                window, gap = [(doc, at, n)], size - n
                while gap and (piece := self._fill(gap, tier)):
                    window.append(piece)
                    gap -= piece[2]
                out += _powers(window) if gap else [window]
        return out

    def _tier(self, n: int) -> int:
        """The tier of the least context size from ``n`` tokens on."""
        return max(k for k, size in enumerate(self.tiers) if size >= n)

    def _fill(self, gap: int, tier: int) -> Piece | None:
        """The longest document that fits into the gap; if none, the beginning of the
        shortest one there is, in a shorter tier if possible. The rest is routed anew."""
        fits = self._tier(gap)
        for k in range(fits, len(self.tiers)):
            at = bisect_right(self.pools[k], (gap, 1 << 62, 0)) if k == fits else len(self.pools[k])
            if at:
                n, doc, start = self.pools[k].pop(at - 1)
                return doc, start, n
        for k in range(fits, tier - 1, -1):
            at = bisect_left(self.pools[k], (gap, 0, 0))
            if at < len(self.pools[k]):
                n, doc, start = self.pools[k].pop(at)
                insort(self.pools[self._tier(n - gap)], (n - gap, doc, start + gap))
                return doc, start, gap
        return None


def _powers(window: list[Piece]) -> list[list[Piece]]:
    """The pieces of a window that stays short, in sequences of powers of two."""
    left, out = sum(n for *_, n in window), []
    pieces = iter(window)
    doc, at, n = next(pieces)
    while left:
        room, sequence = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            if not n:
                doc, at, n = next(pieces)
            take = min(n, room)
            sequence.append((doc, at, take))
            at, n, room = at + take, n - take, room - take
        out.append(sequence)
    return out


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """The step of each sequence: the longest first, each to the step with fewest tokens."""
    steps = max(1, round(sum(sizes) / step_tokens))
    loads = [(0, k) for k in range(steps)]
    out = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        load, step = loads[0]
        heapq.heapreplace(loads, (load + sizes[k], step))
        out[k] = step
    return out


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset, context, step).

    A row for every piece of a document of ``docs`` (doc_id, text). A document is the ids
    of its text by ``tokenizer`` (the JSON of a tokenizer that parts pre-tokens at white
    space), then ``end_id``. ``start`` counts its ids before the piece, ``ids`` are the
    piece's as little-endian unsigned 32-bit numbers, ``offset`` is its place in the sequence,
    ``context`` the length of the sequence and ``step`` its training step. ``tiers`` are
    powers of two, descending. A sequence is as long as a tier, so nothing is padded;
    what is left of a block at last is cut into sequences of lower powers of two.

    Blocks of about 8 MB of text are packed apart, in the task that reads them, without a
    shuffle: what packing could gain over blocks is at most one window's rest each. Steps
    hold sequences of one block, so near the same number of tokens; numbers of sequences
    and steps are unique, not gapless. A text of any length is one document, in the block
    of its own if it is longer. Null and empty texts are the end id alone, rows that
    repeat are packed each, null ids stay, other columns than doc_id and text are not read.
    """
    if list(tiers) != sorted(set(tiers), reverse=True) or any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are different powers of two, the longest first")
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)  # a vocabulary of fixed size
    id_type = docs.schema["doc_id"].dataType.simpleString()
    task: list = []  # filled in each task, which unpickles its own list

    def work(block: pa.RecordBatch) -> dict:
        if not task:
            first = TaskContext.get().partitionId() << 40
            task.extend([Words(sent.value, end_id), first, first])
        words, sequence0, step0 = task
        ids, counts = words.encode(block.column("text"))
        sequences = Packer(tiers).pack(counts.tolist())
        sizes = [sum(n for *_, n in s) for s in sequences]
        steps = step_groups(sizes, step_tokens)
        task[1], task[2] = sequence0 + len(sequences), step0 + max(steps, default=-1) + 1
        doc, start, length = np.array(
            [p for s in sequences for p in s], np.int64
        ).reshape(-1, 3).T
        owner = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
        before = np.cumsum(length) - length
        size = np.array(sizes, np.int64)
        begin = np.cumsum(size) - size
        at = (np.cumsum(counts) - counts)[doc] + start
        return {
            "doc_id": block.column("doc_id").take(pa.array(doc)),
            "start": start, "length": length,
            "ids": list(_bytes(ids.astype("<u4"), at, length)),
            "doc_tokens": counts[doc], "sequence_id": sequence0 + owner,
            "offset": before - begin[owner], "context": size[owner].astype(np.int32),
            "step": step0 + np.array(steps, np.int64)[owner],
        }

    return map_slices(
        docs, ["doc_id", "text"], work,
        f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long, context int, step long",
        limit=_BLOCK_BYTES,
    )


def _bytes(ids: np.ndarray, at: np.ndarray, length: np.ndarray) -> Iterator[bytes]:
    raw = memoryview(ids).cast("B")
    for a, n in zip(at.tolist(), length.tolist(), strict=True):
        yield bytes(raw[4 * a : 4 * (a + n)])
