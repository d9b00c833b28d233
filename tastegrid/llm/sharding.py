"""Contiguous shards of near equal size over ordered groups that stay whole."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.session import ship_package, stored

#: Parts of a shard's fair size in which group starts are first looked at together.
RESOLUTION = 1000
#: Into how many parts a place is then divided where the search needs to know more.
FINER = 64


def shard_starts(sizes: np.ndarray, shards: int) -> tuple[int, np.ndarray]:
    """(capacity, first item of each shard): the smallest capacity with which the items,
    in order, fit into the shards, found by binary search with a greedy check.

    Within that capacity each cut is put as near to its fair share as the rest allows.
    """
    sums = np.concatenate([[0], np.cumsum(sizes)])
    n, total = len(sizes), int(sums[-1])

    def ends(capacity: int) -> list[int]:
        out, at = [], 0
        while at < n and len(out) < shards:
            at = int(np.searchsorted(sums, sums[at] + capacity, "right")) - 1
            out.append(at)
        return out

    low, high = max(int(sizes.max(initial=0)), -(-total // shards)), total
    while low < high:
        middle = (low + high) // 2
        if (ends(middle) or [n])[-1] >= n:
            high = middle
        else:
            low = middle + 1
    latest = [n]  # where the last shards, filled from the end, would have to begin
    for _ in range(shards - 1):
        latest.append(int(np.searchsorted(sums, sums[latest[-1]] - low, "left")))
    starts = [0]
    for k in range(1, shards):
        least = max(starts[-1], latest[shards - k])
        most = int(np.searchsorted(sums, sums[starts[-1]] + low, "right")) - 1
        fair = int(np.searchsorted(sums, total * k / shards, "left"))
        if fair and sums[fair] - total * k / shards > total * k / shards - sums[fair - 1]:
            fair -= 1
        starts.append(min(max(fair, least), most))
    return low, np.array(starts)


class Starts:
    """The starts of groups in ascending cells; of each cell the first and last are known.

    What lies between them is unknown, so answers are bounds. ``asked`` collects the
    cells for which bounds differ.
    """

    def __init__(self, first: np.ndarray, last: np.ndarray, total: int):
        self.first, self.last, self.total = first, last, total
        self.asked: set[int] = set()

    def upto(self, x: int, high: bool) -> int:
        """A bound of the greatest start that is not above ``x``; the end counts as one."""
        if x >= self.total:
            return self.total
        cell = int(np.searchsorted(self.first, x, "right")) - 1
        if x >= self.last[cell]:
            return int(self.last[cell])
        self.asked.add(cell)
        return int(x if high else self.first[cell])

    def since(self, x: int, high: bool) -> int:
        """A bound of the least start that is not below ``x``."""
        if x <= 0:
            return 0
        cell = int(np.searchsorted(self.first, x, "left"))
        if cell and x <= self.last[cell - 1]:
            if x == self.last[cell - 1]:
                return int(x)
            self.asked.add(cell - 1)
            return int(self.last[cell - 1] if high else x)
        return int(self.first[cell]) if cell < len(self.first) else self.total

    def capacity(self, shards: int, high: bool) -> int:
        """The least capacity for which a greedy cut by these bounds reaches the end."""
        def reaches(capacity: int) -> bool:
            at = 0
            for _ in range(shards):
                at, before = self.upto(at + capacity, high), at
                if at >= self.total or at <= before:
                    break
            return at >= self.total

        low, top = -(-self.total // shards), self.total
        while low < top:
            middle = (low + top) // 2
            if reaches(middle):
                top = middle
            else:
                low = middle + 1
        return low

    def cuts(self, shards: int, capacity: int, high: bool) -> list[int]:
        """Start of every shard but the first: within the capacity as near to its fair
        share as the shards behind it allow."""
        latest = [self.total]
        for _ in range(shards - 1):
            latest.append(self.since(latest[-1] - capacity, high))
        out = [0]
        for k in range(1, shards):
            fair = self.total * k / shards
            below, above = self.upto(int(fair), high), self.since(-(-self.total * k // shards), high)
            near = above if above - fair <= fair - below else below
            most = self.upto(out[-1] + capacity, high)
            out.append(min(max(near, out[-1], latest[shards - k]), most))
        return out[1:]


def exact_cuts(cells: Callable[[int, np.ndarray | None, int], Starts], shards: int, total: int):
    """(capacity, cuts): the smallest capacity with which the groups, in order, fit into the
    shards, and where to cut.

    ``cells(step, within, coarse)`` gives first and last start of each cell of ``step`` bytes,
    of those whose cell of ``coarse`` bytes is one of ``within`` if given. The search runs with
    upper and lower bounds; cells that make a difference to it are looked at in finer parts,
    until both bounds agree on the capacity and on every cut.
    """
    step = max(1, -(-total // (shards * RESOLUTION)))
    known = cells(step, None, 1)
    sizes = np.full(len(known.first), step)
    while True:
        known.asked.clear()
        low, high = known.capacity(shards, True), known.capacity(shards, False)
        known.asked.clear()  # what a search has asked on its way does not matter
        bounds = [known.cuts(shards, c, h) for c in {low, high} for h in (True, False)]
        if low == high and not known.asked:
            return low, bounds[0]
        # all that lies between the bounds of a cut, or was asked for on the way to them
        for k in range(shards - 1):
            span = [b[k] for b in bounds]
            a, b = np.searchsorted(known.first, [min(span), max(span)], "right") - 1
            known.asked.update(range(max(int(a), 0), int(b) + 1))
        at = np.array(sorted(known.asked))
        at = at[known.first[at] < known.last[at]]
        coarse = int(sizes[at].max(initial=0))
        at = at[sizes[at] == coarse]  # the coarsest first: then all are of a few sizes
        if not len(at):
            return high, bounds[-1]
        finer = max(1, coarse // FINER)
        found = cells(finer, np.unique(known.first[at] // coarse), coarse)
        keep = np.ones(len(known.first), bool)
        keep[at] = False
        first = np.concatenate([known.first[keep], found.first])
        order = np.argsort(first, kind="stable")
        last = np.concatenate([known.last[keep], found.last])[order]
        sizes = np.concatenate([sizes[keep], np.full(len(found.first), finer)])[order]
        known = Starts(first[order], last, total)


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows sorted by (key, doc_id), with their place and running bytes in their partition.

    ``part``, ``at``; ``group_at`` the bytes before the row's group in the partition, and
    ``first`` whether that group is the partition's first, so might have begun earlier.
    Stored, so that totals and rows come from the same partitions.
    """
    ship_package(rows.sparkSession)
    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, key string, size long, "
        "text_crc32 long, part int, at long, group_at long, first boolean"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        at = total = group_at = 0
        last, first = None, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.array(batch.column("key").to_pylist(), object)
            sizes = batch.column("size").to_numpy()
            before = total + np.concatenate([[0], np.cumsum(sizes)[:-1]])
            new = np.concatenate([[keys[0] != last], keys[1:] != keys[:-1]])
            run_start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            group = np.where(run_start >= 0, before[run_start], group_at)
            numbers = np.cumsum(new)
            firsts = (numbers == 0) & first if last is not None else numbers == 1
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("key"), batch.column("size"),
                batch.column("text_crc32"), pa.array(np.full(n, part, np.int32)),
                pa.array(at + np.arange(n)), pa.array(group), pa.array(firsts),
            ], names=["doc_id", "key", "size", "text_crc32", "part", "at", "group_at", "first"])
            first = bool(firsts[-1])
            at, total, group_at, last = at + n, int(before[-1] + sizes[-1]), int(group[-1]), keys[-1]

    ordered = rows.withColumn("tie", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange("key", "doc_id", "tie").sortWithinPartitions(
        "key", "doc_id", "tie"
    )
    return stored(ordered.drop("tie").mapInArrow(run, schema), "in-order")


def _offsets(rows: DataFrame) -> tuple[list[tuple], int]:
    """((part, rows before, bytes before, start of its first group), total bytes).

    One row per partition: a group that runs on from the last partition starts there.
    """
    parts = rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"),
        F.min_by("key", "at").alias("low"), F.max_by("key", "at").alias("high"),
        F.max("group_at").alias("last_group"),
    ).orderBy("part").collect()
    out, n, total, high, start = [], 0, 0, None, 0
    for p in parts:
        mine = start if p.low == high else total
        out.append((p.part, n, total, mine))
        start = mine if p.low == p.high else total + p.last_group
        n, total, high = n + p.n, total + p.bytes, p.high
    return out, total


def shard_documents(docs: DataFrame, shards: int, overhead: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text).

    The size is the UTF-8 length plus ``overhead``. Groups of equal texts are the items,
    in the order of their MD5; a shard is a run of them, and the largest shard is as small
    as possible. Rows are sorted by (MD5, doc_id) into range partitions, so the copies of
    one text spread over several. The search first gets where groups start in at most
    shards * RESOLUTION + 1 cells, then looks into the cells around possible cuts, so the
    driver holds a bounded number of cells, whatever the input, and the cuts are those of a
    search over all groups. ``slot`` counts a shard's rows from 0 in that order.

    A null text has no bytes, crc32 0, and is a group apart from the empty text. Texts of
    any length are read for their digests only. Null ids and repeated rows are rows like
    others. One group may be larger than a fair shard; it stays whole. With fewer groups
    than shards some shards stay empty.
    """
    spark = docs.sparkSession
    raw = F.col("text").cast("binary")
    rows = _in_order(docs.select(
        "doc_id", F.coalesce(F.md5(raw), F.lit("")).alias("key"),
        (F.coalesce(F.octet_length(raw), F.lit(0)) + overhead).cast("bigint").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0).cast("bigint")).alias("text_crc32"),
    ))
    offsets, total = _offsets(rows)
    known = spark.createDataFrame(offsets or [(0, 0, 0, 0)],
                                  "part int, row0 long, byte0 long, group0 long")
    start = F.when(F.col("first"), F.col("group0")).otherwise(F.col("byte0") + F.col("group_at"))
    placed = rows.join(F.broadcast(known), "part").select(
        "doc_id", "size", "text_crc32", (F.col("row0") + F.col("at")).alias("row"),
        start.cast("bigint").alias("start"),
    )

    def cells(step: int, within: np.ndarray | None, coarse: int) -> Starts:
        found = placed
        if within is not None:
            wanted = spark.createDataFrame([(int(c),) for c in within], "coarse long")
            found = placed.withColumn("coarse", F.expr(f"start DIV {coarse}")).join(
                F.broadcast(wanted), "coarse", "left_semi"  # a few cells around each cut
            )
        table = found.groupBy(F.expr(f"start DIV {step}").alias("cell")).agg(
            F.min("start").alias("first"), F.max("start").alias("last")
        ).orderBy("first").toArrow()
        return Starts(table["first"].to_numpy(), table["last"].to_numpy(), total)

    _, cuts = exact_cuts(cells, shards, total) if total else (0, [])
    shard = sum(((F.col("start") >= F.lit(c)).cast("int") for c in cuts), F.lit(0))
    sharded = placed.withColumn("shard", shard.cast("int"))
    first = sharded.groupBy("shard").agg(F.min("row").alias("row0"))  # one row per shard
    return sharded.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("row0")).alias("slot")
    )
