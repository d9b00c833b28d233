"""Arrow batches of texts inside tasks: bounded slices, words, and hashes of word runs."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tastegrid.session import ship_package

SLICE_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def map_slices(
    df: DataFrame,
    columns: Sequence[str],
    work: Callable[[pa.RecordBatch], dict | None],
    schema: str | T.StructType,
    weight: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``work`` on slices of rows whose ``weight`` column holds about ``limit`` bytes.

    A longer single value is a slice of its own. ``work`` returns the columns of
    ``schema`` by name, or None for no rows.
    """
    ship_package(df.sparkSession)
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, weight, limit):
                found = work(piece)
                if found is not None:
                    yield record(found, target)
        give_back()

    return df.select(*columns).mapInArrow(run, schema)


def give_back() -> None:
    """Hand freed memory back to the system: a worker process lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_schema(schema: str | T.StructType) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def record(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [column(columns[f.name], f.type) for f in schema], schema=schema
    )


def column(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def slices(batch: pa.RecordBatch, weight: str, limit: int) -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.binary_length(batch.column(weight)), 0).to_numpy(False)
    start = total = 0
    for row, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """(starts, words): words between ASCII white space; row i has starts[i]:starts[i+1].

    A null text has no words. ``lower`` changes A-Z alone.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    words, owner = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(words), 0)
    words = words.filter(real)
    counts = np.bincount(owner.filter(real).to_numpy(False), minlength=len(texts))
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), words


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; each different word is hashed once."""
    coded = words.dictionary_encode()
    table = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()),
        np.uint64, len(coded.dictionary),
    )
    return table[coded.indices.to_numpy(False)] if len(words) else np.zeros(0, np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads all bits over the whole word (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Runs:
    """Hashes of word runs of any length in one slice, each from two running sums."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        powers = np.multiply.accumulate(np.full(n + 1, _BASE, np.uint64))
        self._undo = np.multiply.accumulate(np.full(n + 1, _INVERSE, np.uint64))
        self._sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:n])])

    def at(self, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """Hash of the run of ``length`` words from each start."""
        ends = starts + length
        value = (self._sums[ends] - self._sums[starts]) * self._undo[starts]
        return mix(value ^ np.asarray(length).astype(np.uint64))


def window_starts(starts: np.ndarray, length: int) -> np.ndarray:
    """Start of every run of ``length`` words that lies inside one row."""
    counts = np.maximum(np.diff(starts) - length + 1, 0)
    return spans(starts[:-1], counts)


def spans(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (counts[0] values), then the same for the next."""
    ends = np.cumsum(counts)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(first - (ends - counts), counts)


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per row: ``counts`` consecutive items of ``values`` each."""
    values = np.ascontiguousarray(values)
    offsets = np.concatenate([[0], np.cumsum(counts)]) * values.dtype.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(counts),
        [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values.view(np.uint8))],
    )


def items(binary: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(values, counts) of a column made by ``binaries``."""
    if isinstance(binary, pa.ChunkedArray):
        binary = binary.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(binary), 0).to_numpy(False).astype(np.int64)
    whole = b"".join(v.as_buffer() for v in binary if v.is_valid)
    return np.frombuffer(whole, dtype), sizes // np.dtype(dtype).itemsize
