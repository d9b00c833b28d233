"""Questions of blocks about keys: each block asks by range of keys and gets its answers.

A block is a stored row that holds some rows' keys. It asks once for each of its different
keys, so a key that a third of all rows hold arrives at most once per block. The tasks
that answer hold one range of keys at a time, whose number follows the count of keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.batches import arrow_schema, give_back, items, record
from tastegrid.session import ship_package

#: Keys that one answering task holds at a time, about.
RANGE_KEYS = 1 << 18
_ASKED = "bucket int, block long, keys binary, extras binary"
_ANSWERED = "block long, bucket int, answers binary"

Ask = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]
Answer = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def key_bits(n_keys: int) -> int:
    """Leading bits of a key that give its range."""
    return max(0, int(n_keys // RANGE_KEYS)).bit_length()


def exchange(
    blocks: DataFrame, columns: list[str], ask: Ask, answer: Answer, extra, reply, bits: int
) -> DataFrame:
    """``blocks`` with ``answers``: the answers to a block's keys, in the order of the keys.

    ``ask`` gets one block (a batch of one row with ``columns``) and returns its keys,
    ascending, different and spread evenly over 64 bits, and one ``extra`` for each.
    ``answer`` gets keys and extras of all blocks in one range, and the number that each
    block sent; it returns one ``reply`` per key.
    """
    ship_package(blocks.sparkSession)
    extra, reply = np.dtype(extra), np.dtype(reply)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                keys, extras = ask(one)
                extras = np.ascontiguousarray(extras, extra)
                ranges = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
                # the ranges that occur, from the block's own keys
                first = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])[: len(keys)])
                cuts = list(zip(first, [*first[1:], len(keys)], strict=True)) if len(first) else []
                yield pa.RecordBatch.from_arrays([
                    pa.array(ranges[first].astype(np.int32)),
                    pa.array(np.full(len(first), one.column("block")[0].as_py(), np.int64)),
                    pa.array([keys[a:b].tobytes() for a, b in cuts], pa.binary()),
                    pa.array([extras[a:b].tobytes() for a, b in cuts], pa.binary()),
                ], names=["bucket", "block", "keys", "extras"])

    def settle(table: pa.Table) -> pa.Table:
        keys, counts = items(table.column("keys"), np.uint64)
        extras, _ = items(table.column("extras"), extra)
        found = np.ascontiguousarray(answer(keys, extras, counts), reply)
        ends = np.cumsum(counts)
        answers = [found[e - n : e].tobytes() for e, n in zip(ends, counts, strict=True)]
        del keys, extras, found
        give_back()
        return pa.table({
            "block": table.column("block"), "bucket": table.column("bucket"),
            "answers": pa.array(answers, pa.binary()),
        })

    asked = blocks.select("block", *columns).mapInArrow(send, _ASKED)
    answered = asked.groupBy("bucket").applyInArrow(settle, _ANSWERED)
    by_block = answered.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "answers"))).alias("a")
    ).select("block", F.col("a.answers").alias("answers"))
    return blocks.join(by_block, "block", "left")


def answers_of(row: pa.RecordBatch, reply) -> np.ndarray:
    """The answers of one block, in the order of its keys."""
    parts = row.column("answers")[0].values
    if parts is None or not len(parts):
        return np.zeros(0, np.dtype(reply))
    return items(parts, reply)[0]


def map_blocks(blocks: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``work`` on each block, a batch of one row; it returns the columns of ``schema``."""
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield record(work(batch.slice(row, 1)), target)
        give_back()

    return blocks.mapInArrow(run, schema)
