"""Records of JSON files, each one object or an array of objects, found in parallel.

Spark cuts the files into byte ranges and reads them as text that ends at each ``}``. Where
a range begins, only the quotes and brackets before it tell whether that place lies in a
string and how deep. So a first pass sums up the ranges of files that are cut at all: does
the range flip the quote state, and how much deeper does it lead from either state. Running
sums over the ranges of a file give each range its start, and the second pass finds
the records. A record that crosses ranges is put together from its pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tastegrid.session import Scratch, ship_package, stored

CORRUPT = "_corrupt_record"
#: Starts of so many ranges are sent to every task; more are joined to the text instead.
MAX_SENT_RANGES = 100_000
RECORD, OPEN, MIDDLE, CLOSE, REST = range(5)
_REST_BYTES = 8
_OUT_BYTES = 2 << 20
_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}

_RANGE = "file string, block long, flips int, plain_deeper long, quoted_deeper long, base int"
_START = "file string, block long, quoted int, depth long, base int"
_FOUND = (
    "file string, block long, place long, kind int, ok boolean, body binary, "
    "n_bytes long, size long, base int"
)
_FOUND_ARROW = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()), ("kind", pa.int32()),
    ("ok", pa.bool_()), ("body", pa.binary()), ("n_bytes", pa.int64()), ("size", pa.int64()), ("base", pa.int32()),
])


def _size(text: str) -> int:
    """Bytes named by a setting such as ``128m`` or ``4194304b``."""
    text = text.strip().lower().removesuffix("b") or "0"
    return int(text) if text[-1].isdigit() else int(text[:-1]) * _UNITS[text[-1]]


def _marks(data: np.ndarray, quoted: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(in a string, bracket step, quote state at the end) for the bytes after ``quoted``.

    The step is +1 for an opening and -1 for a closing bracket, in strings too.
    """
    quote = data == 34
    slash = data == 92
    if slash.any():  # a quote behind an odd number of backslashes does not count
        at = np.arange(len(data))
        run = at - np.maximum.accumulate(np.where(slash, -1, at))
        quote[1:] &= run[:-1] % 2 == 0
    inside = (np.cumsum(quote) + quoted) & 1
    step = ((data == 123) | (data == 91)).astype(np.int64)
    step -= (data == 125) | (data == 93)
    return inside, step, int(inside[-1])


def _base(data: bytes) -> int:
    """Depth at which a file's records begin: 1 in an array, else 0."""
    return int(data.lstrip(b" \t\r\n\xef\xbb\xbf")[:1] == b"[")


def _joined(values: pa.Array) -> bytes:
    """The text of some segments, each with the bracket that ended it."""
    return b"}".join(values.cast(pa.binary()).to_pylist()) + b"}"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, block, size of the file, text) of the segments of one range in one batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column("file").dictionary_encode()
        codes, blocks = files.indices.to_numpy(False), batch.column("block").to_numpy()
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield (
                files.dictionary[codes[a]].as_py(), int(blocks[a]),
                batch.column("size")[int(a)].as_py(), _joined(batch.column("value").slice(a, b - a)),
            )


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of ``_RANGE`` per range."""
    sums: dict[tuple[str, int], list] = {}
    for file, block, _, text in _runs(batches):
        total = sums.setdefault((file, block), [0, 0, 0, _base(text) if block == 0 else None])
        inside, step, flipped = _marks(np.frombuffer(text, np.uint8), total[0])
        total[0] = flipped
        total[1] += int(step[inside == 0].sum())
        total[2] += int(step[inside == 1].sum())
    rows = [(*key, *total) for key, total in sums.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(
            zip(*rows, strict=True) if rows else [[]] * 6,
            [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()], strict=True,
        )],
        names=["file", "block", "flips", "plain_deeper", "quoted_deeper", "base"],
    )


class _Range:
    """The records of one byte range, from a known start."""

    def __init__(self, file: str, block: int, size: int, quoted: int, depth: int, base: int | None):
        self.key, self.size = (file, block), size
        self.quoted, self.depth, self.base = quoted, depth, base
        self.first = block == 0  # no record of the file has begun yet
        self.place, self.n_bytes = 0, 0
        self.lead = b""  # text since the last record
        self.held: list[bytes] = []  # the record that is still open
        self.inside = base is not None and depth > base
        self.ok, self.began = True, False

    def feed(self, text: bytes) -> Iterator[tuple]:
        if self.base is None:
            self.base = _base(text)
        self.n_bytes += len(text)
        inside, step, self.quoted = _marks(np.frombuffer(text, np.uint8), self.quoted)
        step[inside == 1] = 0
        depth = self.depth + np.cumsum(step)
        self.depth = int(depth[-1])
        cross = np.flatnonzero(
            ((step > 0) & (depth == self.base + 1)) | ((step < 0) & (depth == self.base))
        )
        at = 0
        for edge in cross.tolist():
            if not self.inside:
                self._begin(self.lead + text[at:edge], text[edge : edge + 1])
                at = edge
            else:
                self.held.append(text[at : edge + 1])
                yield self._end(text[edge : edge + 1])
                at = edge + 1
        if self.inside:
            self.held.append(text[at:])
        else:
            self.lead = (self.lead + text[at:]).translate(None, b" \t\r\n")[:_REST_BYTES]

    def _begin(self, lead: bytes, bracket: bytes) -> None:
        if self.first:
            lead = lead.removeprefix(b"\xef\xbb\xbf")
        wanted = b"," if not self.first else b"[" if self.base else b""
        self.ok = lead.translate(None, b" \t\r\n") == wanted and bracket == b"{" and (
            self.first or self.base == 1
        )
        self.first, self.inside, self.began, self.lead = False, True, True, b""

    def _end(self, bracket: bytes) -> tuple:
        kind = RECORD if self.began else CLOSE
        row = self._row(kind, self.ok and bracket == b"}", b"".join(self.held))
        self.held, self.inside, self.ok = [], False, True
        self.place += 1
        return row

    def _row(self, kind: int, ok: bool, body: bytes, n_bytes: int | None = None) -> tuple:
        return (*self.key, self.place, kind, ok, body, n_bytes, self.size, self.base)

    def finish(self) -> Iterator[tuple]:
        """What is left at the end of the range."""
        if self.inside:
            yield self._row(OPEN if self.began else MIDDLE, self.ok, b"".join(self.held))
        yield self._row(REST, True, self.lead, self.n_bytes)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND_ARROW, strict=True)],
        schema=_FOUND_ARROW,
    )


def _find(batches: Iterator[pa.RecordBatch], start) -> Iterator[pa.RecordBatch]:
    """Rows of ``_FOUND`` for the ranges in ``batches``; ``start`` gives a range's start."""
    now: _Range | None = None
    rows: list[tuple] = []
    size = 0
    for file, block, whole, text in _runs(batches):
        if now is None or now.key != (file, block):
            if now is not None:
                rows += now.finish()
            now = _Range(file, block, whole, *start(file, block))
        rows += now.feed(text)
        size += len(text)
        if size >= _OUT_BYTES and rows:
            yield _batch(rows)
            rows, size = [], 0
    if now is not None:
        rows += now.finish()
    if rows:
        yield _batch(rows)


def _starts(ranges: DataFrame) -> DataFrame:
    """The state before each range: running sums over one short row per range of a file."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    quoted = F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2
    deeper = F.when(F.col("quoted") == 0, F.col("plain_deeper")).otherwise(F.col("quoted_deeper"))
    return ranges.withColumn("quoted", quoted.cast("int")).withColumn("deeper", deeper).select(
        "file", "block", "quoted",
        F.coalesce(F.sum("deeper").over(before), F.lit(0)).alias("depth"),
        F.first("base", ignorenulls=True).over(whole).alias("base"),
    ).where("block > 0")


def _segments(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .option("lineSep", "}").text(folder)
        .select(
            "value", F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_block_length").alias("block_length"),
            F.col("_metadata.file_size").alias("size"),
        )
    )


def _found(
    spark: SparkSession, segments: DataFrame, max_sent: int, scratch: Scratch
) -> DataFrame:
    """Rows of ``_FOUND`` of all ranges.

    Files below Spark's least range are never cut and need no first pass. The starts
    of all other ranges go to every task while their counted number is within the limit;
    otherwise text and starts meet by range, which moves the text once.
    """
    least = min(_size(spark.conf.get(f"spark.sql.files.{c}"))
                for c in ("openCostInBytes", "maxPartitionBytes"))
    cut = segments.where(
        (F.col("size") > least) & (F.col("block_length") < F.col("size"))
    ).drop("block_length")
    starts = scratch.stored(_starts(cut.mapInArrow(_sum_up, _RANGE)), "range-starts")
    text = segments.drop("block_length")
    if starts.count() <= max_sent:
        known = {(r.file, r.block): (r.quoted, r.depth, r.base) for r in starts.collect()}
        sent = spark.sparkContext.broadcast(known)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            starts = sent.value
            return _find(
                batches, lambda file, block: starts[file, block] if block else (0, 0, None)
            )

        return text.mapInArrow(find, _FOUND)

    def find_one(left: pa.Table, right: pa.Table) -> pa.Table:
        """One range, of bounded size as Spark has cut it."""
        row = right.to_pylist()[0] if right.num_rows else None
        begin = (row["quoted"], row["depth"], row["base"]) if row else (0, 0, None)
        ordered = left.sort_by("at").combine_chunks().to_batches()
        return pa.Table.from_batches(list(_find(iter(ordered), lambda *_: begin)), _FOUND_ARROW)

    numbered = text.withColumn("at", F.monotonically_increasing_id())
    return numbered.groupBy("file", "block").cogroup(
        starts.groupBy("file", "block")
    ).applyInArrow(find_one, _FOUND)


def _stitched(found: DataFrame) -> DataFrame:
    """(file, at, ok, body) of the records that cross ranges, from their pieces."""
    by_place = Window.partitionBy("file").orderBy("block", F.col("kind") != CLOSE)
    pieces = found.where(F.col("kind").isin(OPEN, MIDDLE, CLOSE)).withColumn(
        "group", F.sum((F.col("kind") == OPEN).cast("int")).over(by_place)
    )
    piece = F.struct("block", (F.col("kind") != CLOSE).alias("later"), "body")
    whole = (F.count_if(F.col("kind") == OPEN) == 1) & (F.count_if(F.col("kind") == CLOSE) == 1)
    return pieces.groupBy("file", "group").agg(
        F.max("block").alias("at"), (F.every("ok") & whole).alias("ok"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(piece)), lambda p: p.body.cast("string")
        ), "").alias("body"),
    ).select("file", "at", "ok", "body")


def _ends_well(total: Column, size: Column, base: Column, rest: Column, records: Column) -> Column:
    """Whether what follows a file's last record closes the file.

    Each segment counts its bytes and one bracket. If the last segment had none in the
    file, the sum is a byte too long and the rest ends with that bracket. A byte order
    mark is not counted.
    """
    ends_in_bracket = (total - size).isin(0, -3)
    empty = F.when(base == 1, F.lit("[]}")).otherwise(F.lit("}"))
    wanted = F.when(records == 0, empty).when(base == 1, F.lit("]}")).otherwise(F.lit("}"))
    return F.when(ends_in_bracket, (rest == "") & (base == 0) & (records > 0)).otherwise(
        rest == wanted
    )


def scan_records(
    spark: SparkSession, folder: str, pattern: str, schema: T.StructType,
    max_sent: int = MAX_SENT_RANGES,
) -> tuple[DataFrame, DataFrame]:
    """(records, broken) of all files below ``folder`` whose name fits ``pattern``.

    ``records``: the columns of ``schema``, ``source_file`` and ``_at``, which grows with the
    records of a file. ``broken``: (source_file, records), the files that are not exactly one
    JSON object or an array of objects, with the number of records that were found in
    them and do not parse or stand wrong (0 where only the end is wrong); of
    these files no record is kept. Empty and blank files have no records and are not broken.

    The files are UTF-8. A range is read by one task, so a file of any size is read by as
    many tasks as it has ranges; memory is bounded by a record. The parsed records are
    stored once in the shared folder, and both results read them there.
    """
    ship_package(spark)
    segments = _segments(spark, folder, pattern)
    scratch = Scratch(spark)
    found = scratch.stored(_found(spark, segments, max_sent, scratch), "json-pieces")
    records = found.where(F.col("kind") == RECORD).select(
        "file", (F.col("block") + F.col("place")).alias("at"), "ok",
        F.col("body").cast("string").alias("body"),
    ).unionByName(_stitched(found))
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = stored(records.select(
        F.col("file").alias("source_file"), F.col("at").alias("_at"), "ok",
        F.from_json("body", full, {"columnNameOfCorruptRecord": CORRUPT}).alias("r"),
    ).select("source_file", "_at", (F.col("ok") & F.col(f"r.{CORRUPT}").isNull()).alias("ok"),
             "r.*").drop(CORRUPT), "json-records")
    counts = parsed.groupBy(F.col("source_file").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("bad")
    )
    rest = F.col("body").cast("string")
    ends = found.where(F.col("kind") == REST).groupBy("file").agg(
        F.sum("n_bytes").alias("total"), F.max("size").alias("size"), F.max("base").alias("base"),
        F.max_by(rest, "block").alias("rest"),
        F.count_if(rest != "").alias("rests"),
    )
    judged = ends.join(counts, "file", "left").na.fill(0, ["n", "bad"])
    well = _ends_well(*(F.col(c) for c in ("total", "size", "base", "rest", "n"))) & (
        F.col("rests") == (F.col("rest") != "").cast("int")
    )
    broken = judged.where(~well | (F.col("bad") > 0)).select(
        F.col("file").alias("source_file"), F.col("bad").alias("records")
    )
    names = stored(broken, "broken-files")
    scratch.clear()
    good = parsed.drop("ok").join(names.select("source_file"), "source_file", "left_anti")
    return good.select(*schema.fieldNames(), "source_file", "_at"), names
