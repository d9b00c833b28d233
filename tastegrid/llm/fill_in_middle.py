"""Fill-in-the-middle: texts cut in three and put together in another order.

A text to be rearranged leaves its task as pieces of bounded size, keyed by its row and
their place in the output. They are repartitioned by row and sorted by place, so that a
task reads each output from its first piece to its last and feeds the digest as they
pass; no output is ever held whole. The same partitions, sorted once more by the places
that the marks in the output give, restore the text the same way.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tastegrid.llm.batches import arrow_schema, record, slices
from tastegrid.session import ship_package

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Place of a part in the text.
PARTS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
#: A piece holds at most so many units and so many bytes.
PIECE_UNITS, PIECE_BYTES = 512, 1 << 16
_SLICE_BYTES = 2 << 20
_HEAD = "n long, form string, prefix_chars long, middle_chars long"


def draws(doc_id, seed: int) -> list[int]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:doc_id`` as numbers."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4]) for k in range(0, 16, 4)]


def unit_ends(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ends, counts): the end of each unit within its text, and each text's number of units.

    A unit is a word with the white space before it, or white space that ends the text.
    """
    lengths = np.array([len(r) for r in raws], np.int64)
    data = np.frombuffer(b"".join(raws), np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    close = np.zeros(len(data), bool)
    close[np.cumsum(lengths[lengths > 0]) - 1] = True  # a text's last byte ends a unit
    close[:-1] |= ~blank[:-1] & blank[1:]
    ends = np.flatnonzero(close) + 1
    stops = np.cumsum(lengths)
    upto = np.searchsorted(ends, stops, "right")
    counts = np.diff(np.concatenate([[0], upto]))
    return ends - np.repeat(stops - lengths, counts), counts


class _Cutter:
    """Turns the rows of one task into pieces; remembers which rows it has seen."""

    def __init__(self, seed: int, rate: int, spm: int):
        self.seed, self.rate, self.spm = seed, rate, spm
        self.task = TaskContext.get().partitionId()
        self.seen: Counter = Counter()

    def row_key(self, doc_id, raw: bytes) -> bytes:
        """Differs for every row, and is the same when the task runs again in another order:
        equal rows are told apart by their number among themselves."""
        named = hashlib.sha256(b"%d:" % len(raw) + raw + repr(doc_id).encode()).digest()[:16]
        self.seen[named] += 1
        return named + b"%d.%d" % (self.task, self.seen[named])

    def form(self, doc_id, raw: bytes, h3: int, h4: int) -> str:
        if doc_id is None or not raw or h3 % 100 >= self.rate or any(m in raw for m in PARTS):
            return "plain"
        return "spm" if h4 % 100 < self.spm else "psm"

    def cut(self, batch: pa.RecordBatch) -> dict:
        ids = batch.column("doc_id").to_pylist()
        raws = pc.fill_null(batch.column("text"), "").cast(pa.binary()).to_pylist()
        ends, counts = unit_ends(raws)
        out: dict[str, list] = {c: [] for c in (
            "row", "place", "piece", "doc_id", "n", "form", "prefix_chars", "middle_chars",
            "output_sha256",
        )}

        def put(row, place, piece, *head):
            for name, value in zip(out, (row, place, piece, *(head or [None] * 6)), strict=True):
                out[name].append(value)

        for doc_id, raw, first, n in zip(
            ids, raws, (np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True
        ):
            row = self.row_key(doc_id, raw)
            h1, h2, h3, h4 = draws(doc_id, self.seed)
            form = self.form(doc_id, raw, h3, h4)
            if form == "plain":  # one piece, which is the output: nothing to put in order
                put(row, -1, None, doc_id, n, form, None, None, hashlib.sha256(raw).hexdigest())
                continue
            at = np.concatenate([[0], ends[first : first + n]])
            a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
            spans = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
            chars = {m: len(raw[at[s] : at[e]].decode()) for m, (s, e) in spans.items()}
            put(row, -1, None, doc_id, n, form, chars[PREFIX], chars[MIDDLE], None)
            place = 0
            for mark in ORDERS[form]:
                start, end = spans[mark]
                piece = mark  # a part's first piece begins with its mark
                for unit in range(start, end, PIECE_UNITS):
                    low, high = int(at[unit]), int(at[min(unit + PIECE_UNITS, end)])
                    for byte in range(low, high, PIECE_BYTES):
                        put(row, place, piece + raw[byte : min(byte + PIECE_BYTES, high)])
                        place, piece = place + 1, b""
                if piece:
                    put(row, place, piece)
                    place += 1
        return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batched(rows: Iterator[dict], schema: pa.Schema, text: str) -> Iterator[pa.RecordBatch]:
    """Batches of a few MB."""
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[text] or b"") + 200
        if size >= _SLICE_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _assembled(rows: Iterator[dict]) -> Iterator[dict]:
    """Sorted by (row, place): digests each output as it passes, and gives every piece the
    place in the text that the marks of the output tell: (part, place)."""
    head, digest, part = None, None, 0
    for r in rows:
        if r["place"] < 0:
            if digest is not None:
                yield {**head, "output_sha256": digest.hexdigest()}
            head, digest = {**r, "part": -1}, None
            if r["form"] == "plain":
                yield head
            else:
                digest = hashlib.sha256()
            continue
        piece = r["piece"]
        digest.update(piece)
        mark = piece[:3]
        if mark in PARTS:
            part, piece = PARTS[mark], piece[3:]
        yield {"row": r["row"], "part": part, "place": r["place"], "piece": piece}
    if digest is not None:
        yield {**head, "output_sha256": digest.hexdigest()}


def _restored(rows: Iterator[dict]) -> Iterator[dict]:
    """Sorted by (row, part, place): digests each text as it passes."""
    head, digest = None, None
    for r in rows:
        if r["part"] < 0:
            if head is not None:
                yield {**head, "restored_sha256": digest.hexdigest()}
            head, digest = r, hashlib.sha256()
            if r["form"] == "plain":
                yield {**head, "restored_sha256": r["output_sha256"]}
                head = None
        else:
            digest.update(r["piece"])
    if head is not None:
        yield {**head, "restored_sha256": digest.hexdigest()}


def pieces(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """(row, place, piece, doc_id, n, form, prefix_chars, middle_chars, output_sha256).

    For each row of ``docs`` a head (place -1, no piece), then the pieces of its output in
    the order of their places; of a plain text the head alone, with the digest, since its
    one piece need not move. ``row`` differs for every row, repeated ones included.
    """
    ship_package(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row binary, place long, piece binary, doc_id {id_type}, {_HEAD}, output_sha256 string"
    )
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(seed, rate, spm)
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                yield record(cutter.cut(part), target)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def in_output_order(found: DataFrame) -> DataFrame:
    """The pieces repartitioned by row and sorted by place: each output as one stream."""
    return found.repartition("row").sortWithinPartitions("row", "place")


def fill_in_middle(
    docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256).

    One row for every row of ``docs`` (doc_id, text). A text of n units, drawn by
    SHA-256 of ``seed:doc_id``: ``rate`` in 100 are rearranged, of those ``spm`` in 100 with
    the suffix first. Empty and null texts, texts that hold a mark, and rows without an id
    stay plain. The digests are those of the output and of the text restored from it;
    ``output_texts`` gives the outputs themselves.

    Whole texts count, however long: a piece holds at most 512 units and 64 kB, and only
    pieces of rearranged texts are shuffled, once; both orders are sorts inside the same
    partitions. Rows that repeat give a row each, and are dealt out like different rows.
    Columns other than doc_id and text are not read.
    """
    found = pieces(docs, seed, rate, spm)
    id_type = found.schema["doc_id"].dataType.simpleString()
    head = f"doc_id {id_type}, {_HEAD}, output_sha256 string"
    cut_schema = f"row binary, part int, place long, piece binary, {head}"
    done_schema = f"{head}, restored_sha256 string"
    cut_target, done_target = arrow_schema(cut_schema), arrow_schema(done_schema)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(_assembled(_rows(batches)), cut_target, "piece")

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(_restored(_rows(batches)), done_target, "form")

    outputs = in_output_order(found).mapInArrow(assemble, cut_schema)
    return outputs.sortWithinPartitions("row", "part", "place").mapInArrow(restore, done_schema)


def output_texts(
    docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80
) -> DataFrame:
    """(doc_id, form, output): the rearranged texts; plain ones are the texts of ``docs``.

    Here a row holds a whole output, as it holds a whole text in ``docs``.
    """
    found = pieces(docs, seed, rate, spm)
    id_type = found.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, form string, output string"
    target = arrow_schema(schema)

    def join(rows: Iterator[dict]) -> Iterator[dict]:
        head, held = None, []
        for r in rows:
            if r["place"] < 0:
                if head is not None:
                    yield {**head, "output": b"".join(held).decode()}
                head, held = r, []
            else:
                held.append(r["piece"])
        if head is not None:
            yield {**head, "output": b"".join(held).decode()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(join(_rows(batches)), target, "output")

    return in_output_order(found.where("form IS NULL OR form <> 'plain'")).mapInArrow(run, schema)
