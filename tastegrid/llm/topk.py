"""Exact top-k inner products over a bit-sliced index of quantised vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastegrid.session import ship_package, stored

BLOCK_ROWS = 1 << 15
CHUNK_QUERIES = 1 << 10
SCALE = 256
LARGEST_SCORE = 2.0**62
INDEX_SCHEMA = "block long, dim int, ids binary, base binary, bits binary, planes binary"
FOUND_SCHEMA = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, dim, q): floor(scale * x) per component, one row per vec_id (as bigint).

    Left out: null ids, vectors that are null, empty or hold null or non-finite
    components. Of several vectors with one id the smallest in array order stays.
    """
    x = F.col("embedding")
    ordinary = ~F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    )
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & (F.size(x) > 0) & ordinary
    )
    q = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    one = rows.groupBy("vec_id").agg(F.min(q).alias("q"))
    return one.select("vec_id", F.size("q").alias("dim"), "q")


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(False).reshape(len(column), -1)


def slice_block(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """(ids, base, bits, planes): bitmaps over rows in id order, 64 rows a word.

    Component d of a row is base[d] plus the number in its ``bits[d]`` planes.
    """
    order = np.argsort(ids)
    ids, rows = ids[order], rows[order]
    base = rows.min(axis=0)
    above = (rows - base).astype(np.uint64)
    bits = np.array([int(m).bit_length() for m in above.max(axis=0)], np.int32)
    words = -(-len(ids) // 64)
    planes = np.zeros((int(bits.sum()), words * 8), np.uint8)
    at = 0
    for d, width in enumerate(bits.tolist()):
        for b in range(width):
            packed = np.packbits((above[:, d] >> np.uint64(b)).astype(np.uint8) & 1,
                                 bitorder="little")
            planes[at, : len(packed)] = packed
            at += 1
    return ids, base, bits, planes.view(np.uint64)


def build_index(vectors: DataFrame, blocks: int) -> DataFrame:
    """One row per block of rows with vectors of one dimension; ids spread by hash."""
    ship_package(vectors.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        found = slice_block(table.column("vec_id").to_numpy(), _matrix(table.column("q")))
        return pa.table({
            "block": table.column("block")[:1], "dim": table.column("dim")[:1],
            **{k: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary())
               for k, v in zip(("ids", "base", "bits", "planes"), found, strict=True)},
        })

    placed = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    return placed.groupBy("block", "dim").applyInArrow(run, INDEX_SCHEMA)


def add_slices(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Sum of bitmaps, columns[w] holding those of weight 2**w: one bitmap per weight.

    Three bitmaps of a weight become one of it and one of the next (a full adder over
    64 rows a word), many triples at a time.
    """
    out: list[np.ndarray] = []
    w = 0
    while w < len(columns):
        have = columns[w]
        carries = []
        while len(have) > 1:
            k = len(have) // 3
            if k:
                a, b, c = have[:k], have[k : 2 * k], have[2 * k : 3 * k]
                half = a ^ b
                carries.append((a & b) | (half & c))
                have = np.concatenate([half ^ c, have[3 * k :]])
            else:
                carries.append((have[0] & have[1])[None])
                have = (have[0] ^ have[1])[None]
        if carries:
            if w + 1 == len(columns):
                columns.append(np.zeros((0, have.shape[1]), np.uint64))
            columns[w + 1] = np.concatenate([columns[w + 1], *carries])
        out.append(have[0] if len(have) else np.zeros(columns[w].shape[1], np.uint64))
        w += 1
    return out


class Block:
    """A block's slices, ready for queries."""

    def __init__(self, ids: np.ndarray, base: np.ndarray, bits: np.ndarray, planes: np.ndarray):
        self.ids, self.base, self.bits, self.planes = ids, base, bits, planes
        self.first = np.concatenate([[0], np.cumsum(bits)])
        rows = np.zeros(planes.shape[1] * 64, np.uint8)
        rows[: len(ids)] = 1
        self.all = np.packbits(rows, bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """(slices, least): the inner product of every row is least + its slices' number."""
        least = int(query @ self.base)
        by_weight: dict[int, list[int]] = {}
        flipped: dict[int, list[int]] = {}
        for d, q in enumerate(query.tolist()):
            width = int(self.bits[d])
            if q < 0:  # |q| times the complement, which the constant makes up for
                least += q * ((1 << width) - 1)
            into, q = (by_weight, q) if q > 0 else (flipped, -q)
            shift = 0
            while q:
                if q & 1:
                    for b in range(width):
                        into.setdefault(shift + b, []).append(int(self.first[d]) + b)
                q >>= 1
                shift += 1
        top = max([-1, *by_weight, *flipped])
        columns = [
            np.concatenate([self.planes[by_weight.get(w, [])], ~self.planes[flipped.get(w, [])]])
            for w in range(top + 1)
        ]
        return add_slices(columns), least

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows but the query's own, ties to smaller ids."""
        slices, least = self.scores(query)
        open_rows = self.all.copy()
        own = int(np.searchsorted(self.ids, query_id))
        if own < len(self.ids) and self.ids[own] == query_id:
            open_rows[own // 64] &= ~np.uint64(1 << (own % 64))
        sure = np.zeros_like(open_rows)
        held = 0
        for bitmap in reversed(slices):  # most significant first
            with_bit = open_rows & bitmap
            n = int(np.bitwise_count(with_bit).sum())
            if held + n > k:
                open_rows = with_bit
            else:
                sure |= with_bit
                held += n
                open_rows = open_rows & ~bitmap
                if held == k:
                    break
        rows = np.concatenate([_rows(sure), _rows(open_rows)[: k - held]])
        score = np.full(len(rows), least, np.int64)
        for w, bitmap in enumerate(slices):
            score += ((bitmap[rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)).astype(
                np.int64
            ) << w
        return self.ids[rows], score


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_k(
    vectors: DataFrame, is_query: Column, k: int, block_rows: int = BLOCK_ROWS,
    chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query, exactly.

    Rows lie in blocks as bitmaps, one per component and binary place. A query adds the
    bitmaps of its components' places with bitwise adders, so that the sums are bitmaps
    too; rows are chosen from the sums' most significant place downward, and rows that
    tie at the boundary by their smaller id. Each block meets each chunk of queries once;
    only k rows per query and block leave a task.

    Null and unusable vectors (see ``quantised``) take no part, vectors of another
    dimension don't meet, a query with fewer candidates than k has them all, an empty
    table gives no rows. Repeated rows count once. Other columns are not read.

    Scores are 64-bit numbers: a table whose largest quantised component c could make a
    score of ``dim * c * c >= 2**62`` is an error, not a wrong result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    whole = stored(quantised(vectors), "quantised")
    asked = whole.where(is_query)
    largest = F.array_max(F.transform("q", lambda v: F.abs(v.cast("double"))))
    n_rows, n_queries, dim, reach = whole.agg(
        F.count(F.lit(1)), F.count_if(is_query), F.max("dim"), F.max(largest)
    ).first()
    if n_rows and dim * reach * reach >= LARGEST_SCORE:
        raise ValueError(f"components up to {reach / SCALE:g} in {dim} dimensions: a score may "
                         "not fit 64 bits")
    blocks, chunks = -(-n_rows // block_rows) or 1, -(-n_queries // chunk_queries) or 1

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))

    packed = (
        asked.groupBy(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks)).alias("chunk"), "dim")
        .agg(F.sort_array(F.collect_list(F.struct("vec_id", "q"))).alias("asked"))
        .select("chunk", "dim", F.col("asked.vec_id").alias("query_ids"),
                F.flatten("asked.q").alias("queries"))
    )
    # blocks and chunks meet in a grid, about one pair to a task
    index, packed = (
        side.withColumn(name, each(count)).repartition(blocks * chunks, "block", "chunk", "dim")
        for side, name, count in (
            (build_index(whole, blocks), "chunk", chunks), (packed, "block", blocks),
        )
    )
    pairs = index.join(packed, ["block", "chunk", "dim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield _search(batch.slice(row, 1), k)

    found = pairs.mapInArrow(run, FOUND_SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search(row: pa.RecordBatch, k: int) -> pa.RecordBatch:
    def raw(name: str, dtype) -> np.ndarray:
        return np.frombuffer(row.column(name)[0].as_buffer(), dtype)

    bits = raw("bits", np.int32)
    planes = raw("planes", np.uint64)
    ids = raw("ids", np.int64)
    words = -(-len(ids) // 64)
    block = Block(ids, raw("base", np.int64), bits, planes.reshape(int(bits.sum()), words))
    query_ids = row.column("query_ids").flatten().to_numpy(False)
    queries = row.column("queries").flatten().to_numpy(False).reshape(len(query_ids), -1)
    found = [block.best(i, q, k) for i, q in zip(query_ids.tolist(), queries, strict=True)]
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(query_ids, [len(f[0]) for f in found])),
        pa.array(np.concatenate([f[0] for f in found])),
        pa.array(np.concatenate([f[1] for f in found])),
    ], names=["query_id", "vec_id", "score"])
