"""Maximal periodic runs of words inside each text, by uniting suffix classes.

The suffixes of a text are put in order, and each two neighbours are joined by an edge as
heavy as their longest common prefix. Edges are taken from the heaviest down. A class of
united suffixes is an ordered set of positions; when two classes are united under prefix
length l, two positions that become neighbours in the set, d <= l words apart, begin a
stretch of smallest period d that ends exactly d + l words after the first one. All such
seeds of one run share its period and its end, and the first of them is the run's start.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tastegrid.llm.batches import map_slices, split_words

MIN_LENGTH, MIN_EXPONENT = 6, 4

Reorder = Callable[[list, np.ndarray], np.ndarray]


def least_prefix(min_length: int, min_exponent: int) -> int:
    """The shortest common prefix of a run's start and the place one period later."""
    periods = range(1, -(-min_length // min_exponent) + 1)
    return min(max(min_length, min_exponent * q) - q for q in periods)


class Suffixes:
    """Ordered suffixes of several texts at once, each text's own ones next to each other.

    ``codes`` holds the words' numbers from 1, with a 0 closing each text; ``last`` is the
    place of the closing 0 of each place's text. Ranks are refined for 2, 4, 8, ... words,
    each time only where suffixes still tie, and every refinement is kept.
    """

    def __init__(self, codes: np.ndarray, last: np.ndarray):
        self.codes, self.last, places = codes, last, np.arange(len(codes))
        wide = int(codes.max(initial=0)) + 1
        text = np.cumsum(codes == 0) - (codes == 0)
        key = (text * wide + codes) * wide + codes[np.minimum(places + 1, last)]
        self.order = np.argsort(key, kind="stable")
        self.ranks: list[np.ndarray] = []
        rank, tied, length = np.empty(len(codes), np.int32), places, 2
        key = key[self.order]
        while len(tied):
            new = np.concatenate([[True], key[1:] != key[:-1]])
            at = self.order[tied]
            rank = rank.copy()
            rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
            self.ranks.append(rank)
            tied = tied[~(new & np.append(new[1:], True))]
            at = self.order[tied]
            key = rank[at].astype(np.int64) << 32 | rank[np.minimum(at + length, last[at])]
            by = np.argsort(key, kind="stable")
            self.order[tied], key = at[by], key[by]
            length *= 2

    def edges(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, place, common prefix >= ``least``) of neighbours, heaviest first."""
        a, b = self.order[:-1], self.order[1:]
        near = self.last[a] == self.last[b]
        for k, rank in enumerate(self.ranks):
            if 2 << k <= least:
                near &= rank[a] == rank[b]
        a, b = a[near], b[near]
        i, j, common = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ranks))):
            step = (self.ranks[k][i] == self.ranks[k][j]) * np.int64(2 << k)
            i, j, common = i + step, j + step, common + step
        common += self.codes[i] == self.codes[j]
        heavy = np.flatnonzero(common >= least)
        heavy = heavy[np.argsort(-common[heavy], kind="stable")]
        return a[heavy], b[heavy], common[heavy]


def seeds(edges: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Rows (period, end, start): one for each two positions that become neighbours in an
    ordered set under a common prefix no shorter than their distance."""
    home: dict[int, list[int]] = {}
    found: list[tuple[int, int, int]] = []
    for a, b, common in zip(*(e.tolist() for e in edges), strict=True):
        large, small = home.get(a) or [a], home.get(b) or [b]
        if len(large) < len(small):
            large, small = small, large
        before = -1
        for n, x in enumerate(small):
            k = bisect_left(large, x)
            if k and large[k - 1] > before and x - large[k - 1] <= common:
                found.append((x - large[k - 1], x + common, large[k - 1]))
            if k < len(large) and large[k] - x <= common and (
                n + 1 == len(small) or large[k] < small[n + 1]
            ):
                found.append((large[k] - x, large[k] + common, x))
            before = x
        if len(small) == 1:
            large.insert(k, x)
        else:
            large += small
            large.sort()
        if len(large) == len(small) + 1:
            home[a] = home[b] = large
        for x in small:
            home[x] = large
    return np.array(found, np.int64).reshape(-1, 3)


def find_runs(
    codes: np.ndarray, last: np.ndarray, min_length: int, min_exponent: int
) -> np.ndarray:
    """Rows (start, length, period) of all runs of the texts, by start and period."""
    edges = Suffixes(codes, last).edges(least_prefix(min_length, min_exponent))
    found = seeds(edges)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    period, end, start = found[first].T
    length = end - start
    runs = np.stack([start, length, period], axis=1)
    runs = runs[length >= np.maximum(min_length, min_exponent * period)]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def periodic_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    reorder: Reorder | None = None,
) -> DataFrame:
    """(doc_id, n_words, runs, kept_text) of every row of ``docs`` (doc_id, text).

    ``runs``: array of (start, length, period), by start and period. A run is a stretch of
    words with smallest period q and at least ``max(min_length, min_exponent * q)`` words
    (``min_exponent`` from 2 on) that no neighbouring word extends. ``kept_text`` joins by
    blanks the words that no run repeats: those a run has after its first q are left out.
    ``reorder`` gets the ids and numbers of words of some rows and returns for each word
    the place, among all these rows' words, of the word to read instead.

    Words are compared themselves, not by hashes. Each row is worked on alone and in one
    piece, in about 100 bytes a word; short rows share a slice. A null or empty text has no
    words, no runs and the empty kept text. Rows that repeat give a row each, null ids
    stay, and columns other than doc_id and text are not read.
    """
    if min_exponent < 2:
        raise ValueError("a run repeats its period at least once: min_exponent >= 2")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(piece: pa.RecordBatch) -> dict:
        starts, words = split_words(piece.column("text"))
        counts, n = np.diff(starts), piece.num_rows
        if reorder is not None:
            words = words.take(pa.array(reorder(piece.column("doc_id").to_pylist(), counts)))
        numbers = words.dictionary_encode().indices.to_numpy(False)
        closing = starts[1:] + np.arange(n)  # places of words and closing zeros
        codes = np.insert(numbers.astype(np.int64) + 1, starts[1:], 0)
        runs = find_runs(codes, np.repeat(closing, counts + 1), min_length, min_exponent)
        owner = np.searchsorted(closing, runs[:, 0])
        change = np.zeros(len(codes) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        kept = np.delete(np.cumsum(change[:-1]) == 0, closing)
        left = np.concatenate([[0], np.cumsum(kept)])[starts]
        return {
            "doc_id": piece.column("doc_id"),
            "n_words": counts,
            "runs": pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32),
                pa.StructArray.from_arrays(
                    [pa.array(runs[:, 0] - (starts[:-1] + np.arange(n))[owner]),
                     pa.array(runs[:, 1]), pa.array(runs[:, 2])],
                    ["start", "length", "period"],
                ),
            ),
            "kept_text": pc.binary_join(
                pa.ListArray.from_arrays(left.astype(np.int32), words.filter(pa.array(kept))), " "
            ),
        }

    return map_slices(
        docs, ["doc_id", "text"], work,
        f"doc_id {id_type}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, kept_text string",
    )
