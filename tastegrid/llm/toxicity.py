"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.batches import binaries, map_slices, split_words

BUCKETS = 1 << 19
FACTORS = 4
STEM = 4
#: At most so many training rows of each label, those with the smallest hashed ids.
SAMPLE_ROWS = 5_000
EPOCHS = 12
BATCH_ROWS = 64
RATE = 0.3
#: A term's weight, or one of its factors, is 0 while the sum of its gradients is below this;
#: for factors this rises from 0 over the first epochs, since a pair shows only once both have any.
L1_WEIGHT, L1_FACTOR, RISING = 60.0, 240.0, 6
WEIGHT_RATE, FACTOR_RATE, FACTOR_START = 0.6, 0.1, 0.05
TOXIC = 0.7


@dataclass(frozen=True)
class Model:
    """y = bias + sum w_i + sum of <v_i, v_j> over pairs of a text's different terms."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts): each text's different terms, ascending.

    Terms are the words in lower case without what is not a letter or digit, and the
    first STEM characters of longer ones.
    """
    starts, words = split_words(pc.utf8_lower(pc.fill_null(texts, "")))
    n = len(starts) - 1
    coded = words.dictionary_encode()
    bare = pc.replace_substring_regex(coded.dictionary, r"[^\p{L}\p{N}]+", "")
    table = np.full((len(bare), 2), -1, np.int64)
    for i, word in enumerate(bare.to_pylist()):
        if word:
            table[i, 0] = xxhash.xxh3_64_intdigest(word) % BUCKETS
            if len(word) > STEM:
                table[i, 1] = xxhash.xxh3_64_intdigest(word[:STEM], seed=1) % BUCKETS
    owner = np.repeat(np.arange(n), np.diff(starts))
    each = np.unique(owner * max(len(bare), 1) + coded.indices.to_numpy(False).astype(np.int64))
    owner, code = each // max(len(bare), 1), each % max(len(bare), 1)
    found = table[code]
    keys = (owner[:, None] * BUCKETS + found)[found >= 0] if len(bare) else np.zeros(0, np.int64)
    keys = np.unique(keys)
    return (keys % BUCKETS).astype(np.int32), np.bincount(keys // BUCKETS, minlength=n)


def raw_scores(model: Model, found: np.ndarray, counts: np.ndarray):
    """(scores, factor sums) of texts with ``counts`` terms each."""
    full = np.flatnonzero(counts)
    starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]]).astype(np.int64)
    score = np.full(len(counts), model.bias)
    sums = np.zeros((len(counts), model.factors.shape[1]))
    if len(full):
        v = model.factors[found]
        sums[full] = np.add.reduceat(v, starts, axis=0)
        squares = np.add.reduceat((v * v).sum(axis=1), starts)
        score[full] += np.add.reduceat(model.weights[found], starts)
        score[full] += 0.5 * ((sums[full] ** 2).sum(axis=1) - squares)
    return score, sums


def fit(rows: list[tuple[np.ndarray, int]], seed: int = 0) -> Model:
    """Logistic loss over seeded mini-batches; the two labels weigh alike.

    Weights and factors of all terms are learnt together by FTRL-proximal with an L1
    penalty, so that no term is left out beforehand and chance terms end at 0.
    """
    rng = np.random.default_rng(seed)
    labels = np.array([label for _, label in rows], float)
    bias, seen_b = 0.0, 1e-2
    weights = np.zeros(BUCKETS)
    factors = rng.normal(0, FACTOR_START, (BUCKETS, FACTORS))
    if len(set(labels.tolist())) < 2:
        rate = (labels.sum() + 0.5) / (len(labels) + 1)
        return Model(float(np.log(rate / (1 - rate))), weights, np.zeros_like(factors))
    share = labels.mean()
    importance = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    sum_w, seen_w = np.zeros(BUCKETS), np.zeros(BUCKETS)
    sum_v, seen_v = -factors / FACTOR_RATE, np.zeros(factors.shape)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        l1_factor = L1_FACTOR * min(1.0, epoch / RISING)
        for start in range(0, len(order), BATCH_ROWS):
            chosen = order[start : start + BATCH_ROWS]
            counts = np.array([len(rows[i][0]) for i in chosen])
            found = np.concatenate([rows[i][0] for i in chosen])
            score, sums = raw_scores(Model(bias, weights, factors), found, counts)
            chance = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
            slope = (chance - labels[chosen]) * importance[chosen]
            step_b = slope.mean()
            seen_b += step_b**2
            bias -= RATE * step_b / np.sqrt(seen_b)
            if not len(found):
                continue
            each = np.repeat(slope, counts)
            used, at = np.unique(found, return_inverse=True)
            push = each[:, None] * (np.repeat(sums, counts, axis=0) - factors[found])
            step_w = np.bincount(at, each)
            step_v = np.stack([np.bincount(at, push[:, f]) for f in range(FACTORS)], axis=1)
            _follow(weights, sum_w, seen_w, used, step_w, WEIGHT_RATE, L1_WEIGHT)
            _follow(factors, sum_v, seen_v, used, step_v, FACTOR_RATE, l1_factor)
    known = np.zeros(BUCKETS, bool)
    known[np.concatenate([found for found, _ in rows])] = True
    factors[~known] = 0  # nothing was learnt of them
    return Model(bias, weights.astype(np.float32), factors.astype(np.float32))


def _follow(values: np.ndarray, sums: np.ndarray, seen: np.ndarray, used: np.ndarray,
            step: np.ndarray, rate: float, l1: float) -> None:
    """One FTRL-proximal update of the used rows, in place."""
    before, after = seen[used], seen[used] + step**2
    total = sums[used] + step - (np.sqrt(after) - np.sqrt(before)) / rate * values[used]
    sums[used], seen[used] = total, after
    values[used] = -np.sign(total) * np.maximum(np.abs(total) - l1, 0) * rate / (
        1 + np.sqrt(after)
    )


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on documents (doc_id, text) whose label (doc_id, toxic) is 0 or 1.

    A bounded sample is used: of each label the ``SAMPLE_ROWS`` rows with the smallest
    hashed ids. Only ids are chosen by the driver's sort; terms are taken in tasks from
    whole texts, and the driver gets the sample's term numbers. Rows without a text or
    label are not used; of several labels for one id the larger counts, of several texts
    the one with the smallest hash. Without both
    labels every score is the share of the label there is.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    halves = [
        known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
        for label in (0, 1)
    ]
    sample = halves[0].unionByName(halves[1])
    rows = docs.where("text IS NOT NULL").select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash")
    ).join(F.broadcast(sample), "doc_id")  # at most 2 * SAMPLE_ROWS short rows

    def work(piece: pa.RecordBatch) -> dict:
        found, counts = terms(piece.column("text"))
        return {"doc_id": piece.column("doc_id"), "toxic": piece.column("toxic"),
                "text_hash": piece.column("text_hash"), "terms": binaries(found, counts)}

    id_type = docs.schema["doc_id"].dataType.simpleString()
    table = map_slices(
        rows.withColumn("toxic", F.col("toxic").cast("int")), ["doc_id", "toxic", "text_hash", "text"],
        work, f"doc_id {id_type}, toxic int, text_hash long, terms binary",
    )
    got = table.groupBy("doc_id", "toxic").agg(
        F.min(F.struct("text_hash", "terms"))["terms"].alias("terms")
    ).collect()
    got.sort(key=lambda r: r.doc_id)
    return fit([(np.frombuffer(r.terms, np.int32), r.toxic) for r in got])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row: the chance that the label is 1, and whether
    it is at least ``TOXIC``.

    Whole texts count, however long; null and empty texts get the model's score for no
    terms. Repeated rows are scored each; only doc_id and text are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(piece: pa.RecordBatch) -> dict:
        raw, _ = raw_scores(sent.value, *terms(piece.column("text")))
        chance = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        return {"doc_id": piece.column("doc_id"), "score": chance,
                "predicted": (chance >= TOXIC).astype(np.int32)}

    return map_slices(
        docs, ["doc_id", "text"], work, f"doc_id {id_type}, score double, predicted int"
    )
