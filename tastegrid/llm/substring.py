"""Substring dedup: word windows that repeat across documents, found by doubling lengths."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.batches import (
    Runs,
    hash_words,
    map_slices,
    spans,
    split_words,
    window_starts,
)
from tastegrid.llm.exchange import answers_of, exchange, key_bits, map_blocks
from tastegrid.session import Scratch, stored

#: No window shorter than this is looked at.
LEAST = 20
_OWNERS = np.dtype([("low", "<i8"), ("width", "<i8")])
_FOUND = np.dtype([("ahead", "<i8"), ("repeated", "u1")])
_FIRST = (
    "ids array<long>, hashes array<long>, n_words array<long>, "
    "kept array<string>, counts binary, places binary, keys binary, total long"
)
_NEXT = (
    "ids array<long>, hashes array<long>, texts array<string>, "
    "counts binary, places binary, total long"
)
_PLACES = "doc_id long, text_hash long, places array<int>"
_CHANGED = "doc_id long, text_hash long, n_removed long, kept_sha256 string, kept_text string"


def lengths(window: int, least: int = LEAST) -> list[int]:
    """The window halved as long as it is not below ``least``, from the shortest."""
    out = [window]
    while -(-out[0] // 2) >= least:
        out.insert(0, -(-out[0] // 2))
    return out


def remove_repeats(docs: DataFrame, window: int = 50, least: int = LEAST) -> DataFrame:
    """(doc_id, text_hash, n_words, n_removed, kept_sha256, kept_text) of every row.

    Words lie between ASCII white space. A word is removed if it is in a window of
    ``window`` words whose sequence also starts in a document with a smaller doc_id; all
    windows are judged on the input. ``kept_text`` has the kept words joined by a blank,
    null where nothing is removed.

    Lengths double up to the window. At the first length only windows are asked for that
    are smallest by hash among their neighbours, so that every full window, wherever it
    repeats, holds the same one; at each next length only windows around those that repeat
    in two documents at the last one.

    A null text has no words. Rows with a null id stay as they are and remove nothing;
    rows with one id don't remove each other's words, and get each its own result. Texts
    with fewer words than the window stay. doc_id must be a whole number; other columns
    are not read.
    """
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    first, *later = lengths(window, least)
    scratch = Scratch(docs.sparkSession)
    blocks = scratch.stored(_first_windows(docs, first, window), "windows")
    rows = blocks.select(F.explode(F.arrays_zip("ids", "hashes", "n_words", "kept")).alias("r"))
    rows = stored(rows.select(
        F.col("r.ids").alias("doc_id"), F.col("r.hashes").alias("text_hash"),
        F.col("r.n_words").alias("n_words"), F.col("r.kept").alias("whole"),
    ), "rows")
    found = _asked(blocks, first, texts=False)
    if not later:
        raise ValueError("the window must be at least twice the least length")
    places = scratch.stored(
        map_blocks(found, _surviving_first, _PLACES).where("size(places) > 0"),
        "repeated",
    )
    length = first
    for longer in later:
        blocks = scratch.stored(_longer_windows(docs, places, length, longer), "longer-windows")
        found = _asked(blocks, longer, texts=True)
        if longer < window:
            places = scratch.stored(
                map_blocks(found, _survivors(longer), _PLACES).where("size(places) > 0"),
                "repeated",
            )
        length = longer
    changed = map_blocks(found, _removed(window), _CHANGED).where("n_removed > 0")
    changed = stored(changed.dropDuplicates(["doc_id", "text_hash"]), "changed")
    scratch.clear()
    return rows.join(changed, ["doc_id", "text_hash"], "left").select(
        "doc_id", "text_hash", "n_words",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "kept_text",
    )


def _numbered(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("block", F.monotonically_increasing_id())


def _first_windows(docs: DataFrame, length: int, window: int) -> DataFrame:
    def work(piece: pa.RecordBatch) -> dict:
        texts = pc.fill_null(piece.column("text"), "")
        starts, words = split_words(texts)
        sums = [
            hashlib.sha256(b" ".join(t.encode().split())).hexdigest() for t in texts.to_pylist()
        ]
        usable = piece.column("doc_id").is_valid().to_numpy(False)
        places, keys, counts = _smallest(hash_words(words), starts, length, window, usable)
        inside = places - np.repeat(starts[:-1], counts)
        return {
            "ids": [piece.column("doc_id").to_pylist()],
            "hashes": [piece.column("text_hash").to_pylist()],
            "n_words": [np.diff(starts)], "kept": [sums],
            "counts": [counts.astype(np.int32).tobytes()],
            "places": [inside.astype(np.int32).tobytes()], "keys": [keys.tobytes()],
            "total": [len(keys)],
        }

    return _numbered(map_slices(docs, ["doc_id", "text", "text_hash"], work, _FIRST))


def _smallest(
    hashes: np.ndarray, starts: np.ndarray, length: int, window: int, usable: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, keys, counts per row) of the runs that are smallest within some window."""
    n = len(starts) - 1
    wanted = window_starts(starts, window)
    owner = np.repeat(np.arange(n), np.maximum(np.diff(starts) - window + 1, 0))
    wanted, owner = wanted[usable[owner]], owner[usable[owner]]
    if not len(wanted):
        return wanted, np.zeros(0, np.uint64), np.zeros(n, np.int64)
    every = Runs(hashes).at(np.arange(starts[-1] - length + 1), length)
    view = np.lib.stride_tricks.sliding_window_view(every, window - length + 1)
    places = np.unique(wanted + view.argmin(axis=1)[wanted])
    counts = np.bincount(np.searchsorted(starts, places, "right") - 1, minlength=n)
    return places, every[places], counts


def _owners(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different keys, their smallest and largest ids, position of each key among them)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(keys) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    owners = np.zeros(len(at), _OWNERS)
    if len(at):
        owners["low"] = np.minimum.reduceat(ids[order], at)
        owners["width"] = np.maximum.reduceat(ids[order], at) - owners["low"]
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ranked[at], owners, inverse


def _settle(keys: np.ndarray, owners: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How far below the block's smallest id the smallest of all lies; whether two have it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    at = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    low = np.minimum.reduceat(owners["low"][order], at)
    high = np.maximum.reduceat((owners["low"] + owners["width"])[order], at)
    group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(keys))))
    out = np.zeros(len(keys), _FOUND)
    out["ahead"][order] = owners["low"][order] - low[group]
    out["repeated"][order] = (high > low)[group]
    return out


def _one(row: pa.RecordBatch, name: str, dtype) -> np.ndarray:
    return np.frombuffer(row.column(name)[0].as_buffer(), dtype)


def _windows_of(row: pa.RecordBatch, length: int, texts: bool):
    """(keys, owner id of each, row number of each, places) of a block."""
    counts = _one(row, "counts", np.int32).astype(np.int64)
    places = _one(row, "places", np.int32)
    number = np.repeat(np.arange(len(counts)), counts)
    ids = np.array(row.column("ids")[0].as_py(), dtype=object)
    owner = np.array([ids[i] for i in np.flatnonzero(counts)], np.int64)
    owner = np.repeat(owner, counts[counts > 0])
    if texts:
        starts, words = split_words(row.column("texts")[0].values)
        keys = Runs(hash_words(words)).at(starts[number] + places, length)
    else:
        keys = _one(row, "keys", np.uint64)
    return keys, owner, number, places


def _asked(blocks: DataFrame, length: int, texts: bool) -> DataFrame:
    total = blocks.agg(F.sum("total")).first()[0] or 0
    columns = ["ids", "counts", "places", "texts" if texts else "keys"]

    def ask(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        keys, owner, _, _ = _windows_of(row, length, texts)
        different, owners, _ = _owners(keys, owner)
        return different, owners

    return exchange(blocks, columns, ask, _settle, _OWNERS, _FOUND, key_bits(total))


def _kept_places(row: pa.RecordBatch, number: np.ndarray, places: np.ndarray) -> dict:
    ids, hashes = row.column("ids")[0].values, row.column("hashes")[0].values
    some, first = np.unique(number, return_index=True)
    offsets = np.append(first, len(number)).astype(np.int32)
    chosen = pa.array(some, pa.int64())
    return {
        "doc_id": ids.take(chosen), "text_hash": hashes.take(chosen),
        "places": pa.ListArray.from_arrays(pa.array(offsets), pa.array(places.astype(np.int32))),
    }


def _surviving_first(row: pa.RecordBatch) -> dict:
    keys, owner, number, places = _windows_of(row, 0, texts=False)
    _, _, inverse = _owners(keys, owner)
    repeated = answers_of(row, _FOUND)["repeated"][inverse] > 0
    return _kept_places(row, number[repeated], places[repeated])


def _survivors(length: int):
    def work(row: pa.RecordBatch) -> dict:
        keys, owner, number, places = _windows_of(row, length, texts=True)
        _, _, inverse = _owners(keys, owner)
        repeated = answers_of(row, _FOUND)["repeated"][inverse] > 0
        return _kept_places(row, number[repeated], places[repeated])

    return work


def _longer_windows(docs: DataFrame, places: DataFrame, length: int, longer: int) -> DataFrame:
    """Blocks of the documents with repeated windows, and the longer windows around those."""
    chosen = places.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places")
    )
    joined = docs.hint("merge").join(chosen, ["doc_id", "text_hash"])

    def work(piece: pa.RecordBatch) -> dict:
        starts, _ = split_words(piece.column("text"))
        last = np.diff(starts) - longer  # the last start inside each row
        lists = piece.column("places")
        at = lists.flatten().to_numpy(False).astype(np.int64)
        number = pc.list_parent_indices(lists).to_numpy(False).astype(np.int64)
        low = np.maximum(at - (longer - length), 0)
        high = np.minimum(at, last[number])
        # windows that an earlier place of the same row has given already are left out
        before = np.append(-1, high[:-1])
        before[np.append(True, number[1:] != number[:-1])] = -1
        low = np.maximum(low, before + 1)
        counts = np.maximum(high - low + 1, 0)
        found = spans(low, counts)
        per_row = np.bincount(np.repeat(number, counts), minlength=len(piece))
        return {
            "ids": [piece.column("doc_id").to_pylist()],
            "hashes": [piece.column("text_hash").to_pylist()],
            "texts": [piece.column("text").to_pylist()],
            "counts": [per_row.astype(np.int32).tobytes()],
            "places": [found.astype(np.int32).tobytes()], "total": [len(found)],
        }

    return _numbered(map_slices(joined, ["doc_id", "text_hash", "text", "places"], work, _NEXT))


def _removed(window: int):
    """Rows whose words are covered by windows that start in a smaller document."""
    def work(row: pa.RecordBatch) -> dict:
        keys, owner, number, places = _windows_of(row, window, texts=True)
        _, owners, inverse = _owners(keys, owner)
        smallest = owners["low"] - answers_of(row, _FOUND)["ahead"]
        covered = smallest[inverse] < owner
        number, places = number[covered], places[covered].astype(np.int64)
        some = np.unique(number)
        texts = row.column("texts")[0].values
        counts, sums, left = [], [], []
        for i in some.tolist():
            words = texts[i].as_py().encode().split()
            edges = np.zeros(len(words) + 1, np.int64)
            mine = places[number == i] if len(some) > 1 else places
            np.add.at(edges, mine, 1)
            np.add.at(edges, mine + window, -1)
            gone = np.cumsum(edges)[:-1] > 0
            kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
            counts.append(int(gone.sum()))
            sums.append(hashlib.sha256(kept).hexdigest())
            left.append(kept.decode())
        chosen = pa.array(some, pa.int64())
        return {
            "doc_id": row.column("ids")[0].values.take(chosen),
            "text_hash": row.column("hashes")[0].values.take(chosen),
            "n_removed": counts, "kept_sha256": sums, "kept_text": left,
        }

    return work

