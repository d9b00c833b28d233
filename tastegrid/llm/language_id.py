"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.batches import map_slices, slices
from tastegrid.session import ship_package

UNKNOWN = "und"
GRAM = 3
FEATURES = 1 << 16
CHUNK = 1 << 12
SLICE_BYTES = 1 << 20
SMOOTHING = 0.5
#: Below this confidence the two nearest codewords are too close to tell.
AMBIGUOUS = 0.6
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Model:
    """``codes`` [languages, bits] of -1/1, ``weights`` [features, bits], and how far each
    bit is trusted for each language (rows sum to 1)."""

    languages: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features, counts): hashed byte n-grams of each text; all but letters is one blank."""
    texts = pc.utf8_lower(pc.fill_null(texts, ""))
    sizes = pc.binary_length(texts).to_numpy(False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = _LETTERS[np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8)]
    data = data.astype(np.uint32)
    code = np.zeros(max(len(data) - GRAM + 1, 0), np.uint32)
    for k in range(GRAM):
        code = (code << np.uint32(8)) | data[k : len(code) + k]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    counts = np.maximum(sizes - GRAM + 1, 0)
    inside = np.ones(len(code), bool)
    for k in range(1, GRAM):
        last = offsets[1:] - k
        inside[last[(last >= 0) & (last < len(code))]] = False
    return code[inside], counts


def code_matrix(n: int) -> np.ndarray:
    """Codewords of -1/1 for n languages: every split of them into two where there are few
    languages, otherwise the most distant of some seeded random matrices."""
    if n <= 6:
        bits = 2 ** (n - 1) - 1
        splits = (np.arange(bits)[None] >> np.arange(n - 1)[:, None]) & 1
        return np.vstack([np.ones(bits, int), 2 * splits - 1])[:n].astype(np.int8)
    bits = 8 * int(np.ceil(np.log2(n)))
    rng = np.random.default_rng(0)
    drawn = [rng.choice(np.array([-1, 1], np.int8), (n, bits)) for _ in range(50)]

    def distance(m: np.ndarray) -> int:
        agree = m.astype(int) @ m.T.astype(int)
        np.fill_diagonal(agree, -bits)
        return -int(agree.max())

    codes = max(drawn, key=distance)
    return codes[:, np.abs(codes.sum(axis=0)) < n]  # a bit must tell some languages apart


def count_grams(docs: DataFrame) -> tuple[tuple[str, ...], np.ndarray]:
    """(languages, counts [languages, features]) of all rows (text, lang).

    A task sums up its own rows; the sums of the tasks meet by language and range of
    features. The driver gets the totals, whose size depends on the languages alone.
    """
    ship_package(docs.sparkSession)
    schema = "lang string, chunk int, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES):
                found, counts = grams(piece.column("text"))
                langs = piece.column("lang").dictionary_encode()
                owner = np.repeat(langs.indices.to_numpy(False).astype(np.int64), counts)
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    total = totals.setdefault(lang, np.zeros(FEATURES, np.int64))
                    total += np.bincount(found[owner == i], minlength=FEATURES)
        for lang, total in totals.items():
            parts = total.reshape(-1, CHUNK)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(parts)), pa.array(np.arange(len(parts), dtype=np.int32)),
                pa.array([p.tobytes() for p in parts], pa.binary()),
            ], names=["lang", "chunk", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_buffer(), np.int64) for v in table.column("counts"))
        return pa.table({"lang": table.column("lang")[:1], "chunk": table.column("chunk")[:1],
                         "counts": pa.array([total.tobytes()], pa.binary())})

    rows = (
        docs.select("text", "lang").mapInArrow(run, schema)
        .groupBy("lang", "chunk").applyInArrow(add, schema).toPandas()
    )
    languages = tuple(sorted(rows["lang"].unique()))
    counts = np.zeros((len(languages), FEATURES), np.int64)
    for lang, chunk, raw in rows.itertuples(index=False):
        start = chunk * CHUNK
        counts[languages.index(lang), start : start + CHUNK] = np.frombuffer(raw, np.int64)
    return languages, counts


def train(docs: DataFrame) -> Model:
    """Fits on all rows (text, lang) with both values; one pass counts, one weighs the bits.

    Each bit's classifier tells the languages of its two sides apart by the log ratio of
    their n-gram shares, every language counting alike. A bit is trusted for a language
    as often as it decides right on that language's training rows. Repeated rows count
    as often as they occur. Without any row the model knows no language.
    """
    docs = docs.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    languages, counts = count_grams(docs)
    shares = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * FEATURES)
    codes = code_matrix(len(languages)) if languages else np.zeros((0, 0), np.int8)
    weights = np.stack([
        np.log(shares[code > 0].mean(axis=0) / shares[code < 0].mean(axis=0))
        for code in codes.T
    ], axis=1).astype(np.float32) if codes.size else np.zeros((FEATURES, 0), np.float32)
    even = np.ones(codes.shape)
    model = Model(languages, codes, weights, even)
    return Model(languages, codes, weights, _trust(docs, model)) if codes.size else model


def _trust(docs: DataFrame, model: Model) -> np.ndarray:
    sent = docs.sparkSession.sparkContext.broadcast(model)
    bits = model.codes.shape[1]

    def work(piece: pa.RecordBatch) -> dict:
        known = sent.value
        at = {lang: i for i, lang in enumerate(known.languages)}
        row = np.array([at[v] for v in piece.column("lang").to_pylist()], np.int64)
        right = margins(piece.column("text"), known) * known.codes[row] > 0
        sums = np.zeros((len(at), bits + 1), np.int64)
        np.add.at(sums, row, np.column_stack([right, np.ones(len(row), bool)]).astype(np.int64))
        seen = np.flatnonzero(sums[:, -1])
        return {"language": seen.astype(np.int32), "sums": sums[seen].tolist()}

    parts = map_slices(docs, ["text", "lang"], work, "language int, sums array<long>",
                       limit=SLICE_BYTES)
    totals = parts.groupBy("language").agg(
        *[F.sum(F.col("sums")[b]).alias(f"s{b}") for b in range(bits + 1)]
    ).collect()
    trust = np.ones(model.codes.shape)
    for total in totals:
        trust[total[0]] = (np.array(total[1:-1]) + 1) / (total[-1] + 2)
    return trust / trust.sum(axis=1, keepdims=True)


def margins(texts: pa.Array, model: Model) -> np.ndarray:
    """[texts, bits]: summed log ratios over the root of the number of n-grams."""
    found, counts = grams(texts)
    out = np.zeros((len(counts), model.weights.shape[1]))
    full = np.flatnonzero(counts)
    if len(full) and out.size:
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        sums = np.add.reduceat(model.weights[found], starts, axis=0)
        out[full] = sums / np.sqrt(counts[full])[:, None]
    return out


def decode(margin: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(nearest language, confidence): codewords by their trust-weighted logistic loss.

    The confidence is the second smallest loss as a share of the two smallest.
    """
    loss = np.logaddexp(0, -margin[:, None, :] * model.codes[None])
    distance = (loss * model.trust[None]).sum(axis=2)
    if distance.shape[1] < 2:
        return np.zeros(len(margin), np.int64), np.ones(len(margin))
    order = np.argsort(distance, axis=1, kind="stable")
    first = np.take_along_axis(distance, order[:, :1], 1)[:, 0]
    second = np.take_along_axis(distance, order[:, 1:2], 1)[:, 0]
    both = first + second
    sure = np.divide(second, both, out=np.full(len(both), 0.5), where=both > 0)
    return order[:, 0], sure


def _told(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(language names, confidences) of texts, nulls included."""
    texts = pc.fill_null(texts, "")
    real = pc.match_substring_regex(texts, r"\p{L}").to_numpy(False)
    real &= len(model.languages) > 0
    best, sure = decode(margins(texts, model), model)
    names = np.array([*model.languages, UNKNOWN], object)
    return names[np.where(real, best, len(model.languages))], np.where(real, sure, 0.0)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every row.

    ``und`` with score 0 is returned for a null text, one without a letter, and by a model
    without languages; ties go to the first language in order. ``ambiguous`` marks
    confidences below ``AMBIGUOUS`` and ``und``. Whole texts count, however long; repeated
    rows are judged each; only doc_id and text are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(piece: pa.RecordBatch) -> dict:
        names, sure = _told(piece.column("text"), sent.value)
        return {"doc_id": piece.column("doc_id"), "lang_pred": names, "score": sure,
                "ambiguous": sure < AMBIGUOUS}

    return map_slices(
        docs, ["doc_id", "text"], work,
        f"doc_id {id_type}, lang_pred string, score double, ambiguous boolean",
        limit=SLICE_BYTES,
    )


def keep_told(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that ``predict`` neither calls ``und`` nor ambiguous."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(piece: pa.RecordBatch) -> dict:
        _, sure = _told(piece.column("text"), sent.value)
        kept = piece.filter(pa.array(sure >= AMBIGUOUS))
        return dict(zip(kept.schema.names, kept.columns, strict=True))

    return map_slices(docs, docs.columns, work, docs.schema, limit=SLICE_BYTES)


def held_out(modulus: int, remainder: int):
    """Whether crc32 of the doc_id as text leaves this remainder (null for a null id)."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder
