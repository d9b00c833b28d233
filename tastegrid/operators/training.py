"""Synchronous data-parallel training of the cross network.

The training rows are written once, cut into global batches by the hash of their key. An
epoch is one barrier stage: its tasks hold their share of a batch, gather each other's
gradient sums and make the same updates; the driver gets the weights once an epoch.
``gradient_sums`` adds up the gradient of any number of rows as an ordinary job.
"""

from __future__ import annotations

import base64
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.config import DomainConfig
from tastegrid.operators import evaluation as E
from tastegrid.operators import network as N
from tastegrid.operators.scoring import dense_block, score_rows
from tastegrid.session import remove, shared_path, ship_package, stored

#: Numbers of the gradient that one summing task adds up, and a driver gets as one row.
RANGE = 1 << 16
#: Rows of a batch, and rows in all, for which an epoch has a task, up to the slots there are.
#: Tasks of a barrier stage wait a second for each other's message, so a small batch is
#: faster in one of them.
STEP_ROWS, SHARE_ROWS = 1 << 16, 100_000_000
#: Rows of a block of a batch that is read in blocks; of those that are taken by themselves as
#: they have other columns than the next ones.
PASS_ROWS, ALIKE_ROWS = 2048, 1024
_COUNTS = ("n", "joint", "deep", "shallow", "tp", "fp", "fn", "tn")
_SUMS_DDL = (
    "range bigint, " + ", ".join(f"{c} double" for c in _COUNTS) + ", of_joint binary, of_own binary"
)


# -- weights as one flat vector ------------------------------------------------

def flatten(w: N.Weights) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def unflatten(flat: np.ndarray, like: N.Weights) -> N.Weights:
    out, at = {}, 0
    for k in sorted(like):
        size = like[k].size
        out[k] = flat[at:at + size].reshape(like[k].shape)
        at += size
    return out


# -- optimiser -----------------------------------------------------------------

@dataclass
class Adam:
    """Adam, or AdamW where ``decay`` is set; rate optionally along a cosine."""

    rate: float
    decay: float = 0.0
    cosine_period: int | None = None
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    step: int = 0
    epoch: int = 0
    first: N.Weights = field(default_factory=dict)
    second: N.Weights = field(default_factory=dict)

    @classmethod
    def of(cls, domain: DomainConfig) -> Adam:
        decay = domain.weight_decay if domain.optimiser == "adamw" else 0.0
        return cls(domain.learning_rate, decay, domain.cosine_period)

    def state(self) -> dict[str, np.ndarray]:
        """All that a training needs to go on from here."""
        moments = {f"first.{k}": a for k, a in self.first.items()}
        moments |= {f"second.{k}": a for k, a in self.second.items()}
        return moments | {"step": np.array([float(self.step)]), "epoch": np.array([float(self.epoch)])}

    def restore(self, state: dict[str, np.ndarray]) -> None:
        for k, a in state.items():
            kind, _, name = k.partition(".")
            if name:
                (self.first if kind == "first" else self.second)[name] = a
            else:
                setattr(self, kind, int(a[0]))

    def current_rate(self) -> float:
        if self.cosine_period is None:
            return self.rate
        return self.rate * (1 + math.cos(math.pi * self.epoch / self.cosine_period)) / 2

    def update(self, w: N.Weights, grad: N.Weights) -> N.Weights:
        self.step += 1
        rate, out = self.current_rate(), {}
        for k, value in w.items():
            g = grad[k]
            if N.is_statistic(k):
                out[k] = 0.9 * value + 0.1 * g
                continue
            m = self.first[k] = self.beta1 * self.first.get(k, 0.0) + (1 - self.beta1) * g
            v = self.second[k] = self.beta2 * self.second.get(k, 0.0) + (1 - self.beta2) * g * g
            scale = math.sqrt(1 - self.beta2**self.step)
            move = m / (1 - self.beta1**self.step) / (np.sqrt(v) / scale + self.eps)
            out[k] = value * (1 - rate * self.decay) - rate * move
        return out


# -- one step ------------------------------------------------------------------

def gradient_sums(
    rows: DataFrame, w: N.Weights, domain: DomainConfig, width: int, pos_weight: float, seed: int
) -> DataFrame:
    """Sums over ``rows`` (row_key, label, idx, val), a row per range of the flat gradient.

    The losses of the joint score and of the two branches are summed apart, as are their
    gradients, so that sums of any blocks add up to those of the whole batch. Tasks work
    in blocks of ``domain.batch_rows``; only batch statistics are those of a block. The
    tasks' sums meet by ranges of the gradient, and the counts travel with the first one.
    Batch statistics of the whole batch are those of ``epoch_pass``.
    """
    net, block_rows, size = domain.network, domain.batch_rows, RANGE
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(w)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= block_rows:
                table = pa.Table.from_batches(held).combine_chunks()
                full = n - n % block_rows
                yield from table.slice(0, full).to_batches(max_chunksize=block_rows)
                held, n = table.slice(full).to_batches(), n - full
        if n:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        sums, grads = np.zeros(len(_COUNTS)), None
        for block in blocks(batches):
            x = dense_block(block.column("idx"), block.column("val"), width)
            y = block.column("label").to_numpy(zero_copy_only=False).astype(float)
            draws = N.RowDraws(seed, block.column("row_key").to_numpy(zero_copy_only=False))
            losses, *found, score = N.loss_and_gradient_sums(x, y, w, net, pos_weight, draws)
            flat = np.stack([flatten(g) for g in found])
            grads = flat if grads is None else grads + flat
            hit = score > E.THRESHOLD
            sums += [len(y), *losses, (hit & (y == 1)).sum(), (hit & (y == 0)).sum(),
                     (~hit & (y == 1)).sum(), (~hit & (y == 0)).sum()]
        if grads is not None:
            parts = [grads[:, k : k + size] for k in range(0, grads.shape[1], size)]
            yield _sum_rows(0, sums, parts)

    def add(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        sums, grads = np.zeros(len(_COUNTS)), 0.0
        for batch in batches:
            for row in batch.to_pylist():
                grads = grads + np.stack([np.frombuffer(row[c]) for c in ("of_joint", "of_own")])
                sums += [row[c] for c in _COUNTS]
        yield _sum_rows(key[0].as_py(), sums, [grads])

    partial = rows.select("row_key", "idx", "val", "label").mapInArrow(run, _SUMS_DDL)
    return partial.groupBy("range").applyInArrow(add, _SUMS_DDL)


def _sum_rows(first: int, sums: np.ndarray, parts: list[np.ndarray]) -> pa.RecordBatch:
    """One row per part of the gradients, numbered from ``first``; part 0 has the counts."""
    rows = []
    for number, part in enumerate(parts, first):
        counts = sums if number == 0 else np.zeros(len(sums))
        rows.append({
            "range": number, **dict(zip(_COUNTS, counts.tolist(), strict=True)),
            "of_joint": part[0].tobytes(), "of_own": part[1].tobytes(),
        })
    kinds = [("range", pa.int64()), *[(c, pa.float64()) for c in _COUNTS],
             ("of_joint", pa.binary()), ("of_own", pa.binary())]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))


def read_sums(sums: DataFrame, like: N.Weights) -> tuple[dict[str, float], N.Weights | None]:
    """(counts with the batch's ``loss``, mean gradient); the driver gets one whole gradient."""
    found = sorted(sums.collect(), key=lambda r: r["range"])
    if not found:
        return dict.fromkeys(("loss", *_COUNTS), 0.0), None
    counts = {c: sum(r[c] for r in found) for c in _COUNTS}
    flat = [np.concatenate([np.frombuffer(bytes(r[c])) for r in found])
            for c in ("of_joint", "of_own")]
    losses = np.array([counts[c] for c in ("joint", "deep", "shallow")])
    loss, grad = N.combined(counts["n"], losses, *(unflatten(f, like) for f in flat))
    return {"loss": loss * counts["n"], **counts}, grad


class _Share:
    """A task's rows of one batch, read any number of times.

    Up to ``size`` rows stay in memory and are one block; more lie in a local file that has
    no name and goes with the task, and are read in blocks of ``PASS_ROWS`` at most.
    """

    def __init__(self, size: int):
        self.size, self.held, self.n_held, self.file, self.writer = size, [], 0, None, None

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.n_held += batch.num_rows
        if self.n_held <= self.size:
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
            self.writer = pa.ipc.new_stream(self.file, batch.schema)
        table = pa.Table.from_batches(self.held).combine_chunks()
        full = (self.n_held - 1) // self.size * self.size
        for block in table.slice(0, full).to_batches(max_chunksize=min(self.size, PASS_ROWS)):
            self.writer.write_batch(block)
        self.held = table.slice(full).to_batches()
        self.n_held -= full

    def whole(self) -> bool:
        """Whether one block holds all rows."""
        return self.file is None

    def blocks(self) -> Iterator[pa.Table]:
        if self.file is not None:
            if self.writer is not None:
                self.writer.close()
                self.writer = None
            self.file.seek(0)
            for block in pa.ipc.open_stream(self.file):
                yield pa.Table.from_batches([block])
        if self.held:
            rest = pa.Table.from_batches(self.held).combine_chunks()
            rows = rest.num_rows if self.whole() else min(self.size, PASS_ROWS)
            yield from (rest.slice(k, rows) for k in range(0, rest.num_rows, rows))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _steps(batches: Iterator[pa.RecordBatch], steps: int, size: int) -> Iterator[_Share]:
    """The rows of each step, from rows in the order of their ``batch``."""
    given, share = 0, _Share(size)
    for whole in batches:
        numbers = whole.column("batch").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                for _ in range(given, int(numbers[a])):
                    yield share
                    share.close()
                    share = _Share(size)
                given = int(numbers[a])
                share.add(whole.slice(a, b - a))
    for _ in range(given, steps):
        yield share
        share.close()
        share = _Share(size)


def _share_sums(
    share: _Share, w: N.Weights, domain: DomainConfig, width: int, pos_weight: float,
    seed: int, gather: Callable[[np.ndarray], list[np.ndarray]], tasks: int,
) -> np.ndarray:
    """Counts, losses and flat gradients of one task's share of a batch, block by block.

    A network without batch norm reads the rows once. Batch statistics take a pass for each
    layer forwards and backwards, and the tasks merge what a pass has found: the moments of
    a layer are needed before any block goes on to the next one.
    """
    net, size = domain.network, sum(a.size for a in w.values())
    passes = N.Alone() if share.whole() and tasks == 1 else N.Passes()

    def parts(block: pa.Table | None) -> Iterator[tuple[np.ndarray, ...]]:
        if block is None:
            yield np.zeros((0, width)), np.zeros(0), np.zeros(0, np.int64)
            return
        x = dense_block(block["idx"], block["val"], width)
        y, keys = block["label"].to_numpy().astype(float), block["row_key"].to_numpy()
        if isinstance(passes, N.Alone):
            yield x, y, keys
            return
        for at in N.alike(x, ALIKE_ROWS, max(PASS_ROWS, len(x))):
            yield x[at], y[at], keys[at]

    def one(x: np.ndarray, y: np.ndarray, keys: np.ndarray) -> np.ndarray:
        losses, *found, score = N.loss_and_gradient_sums(
            x, y, w, net, pos_weight, N.RowDraws(seed, keys), passes
        )
        hit = score > E.THRESHOLD
        counts = [len(y), *losses, (hit & (y == 1)).sum(), (hit & (y == 0)).sum(),
                  (~hit & (y == 1)).sum(), (~hit & (y == 0)).sum()]
        return np.concatenate([counts, *map(flatten, found)])

    while True:
        summed, waits = np.zeros(len(_COUNTS) + 2 * size), False
        for block in share.blocks() if share.n_held else [None]:
            for part in parts(block):
                try:
                    summed += one(*part)
                except N.Waits:
                    waits = True
        if not waits:
            return summed
        passes.settle(gather)


@dataclass
class Passed:
    """What an epoch leaves behind: sums over its rows, and its last batch's mean gradient."""

    weights: N.Weights
    optimiser: Adam
    totals: dict[str, float]
    gradient: N.Weights


def epoch_tasks(spark: SparkSession, n_rows: int, steps: int) -> int:
    """Tasks for an epoch of ``n_rows`` rows in so many steps."""
    wanted = max(-(-n_rows // steps // STEP_ROWS), -(-n_rows // SHARE_ROWS), 1)
    return min(wanted, spark.sparkContext.defaultParallelism)


def _dealt(rows: DataFrame, tasks: int) -> DataFrame:
    """The rows in so many even shares, by batch, and those with the same features together."""
    # a hash of many values: the numbers of the shares themselves would fall together
    share = F.xxhash64(F.lit("share"), "row_key")
    return rows.select("row_key", "idx", "val", "label", "batch").repartition(
        tasks, share
    ).sortWithinPartitions("batch", "idx")


def epoch_pass(
    rows: DataFrame, w: N.Weights, optimiser: Adam, domain: DomainConfig, width: int,
    pos_weight: float, steps: int, seed: int, tasks: int = 1,
) -> Passed:
    """One epoch over ``rows`` (row_key, label, idx, val, batch from 0 to ``steps`` - 1) as one
    barrier stage: a job for the epoch, whatever its number of steps.

    Each task has a share of every batch and reads its rows in the order of the batches, in
    blocks of ``domain.batch_rows`` at most, so it holds one block (``_Share``). Rows with the same
    features follow each other, as a block costs by the columns that its rows have. In a step the tasks
    gather each other's gradient sums (and in a network with batch norm the moments of the
    whole batch, forwards and backwards) and all make the same update. How many ``tasks`` follows the rows of a batch
    (``epoch_tasks``), as every message goes to all of them. A lost task starts the epoch
    again from the weights it began with.
    """
    spark, block_rows = rows.sparkSession, domain.batch_rows
    ship_package(spark)
    shared = spark.sparkContext.broadcast((w, optimiser))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()

        def gather(part: np.ndarray) -> list[np.ndarray]:
            """The arrays of all tasks, in the order of the tasks."""
            if tasks == 1:
                return [part]
            sent = base64.b64encode(np.ascontiguousarray(part, np.float64)).decode()
            return [np.frombuffer(base64.b64decode(m)) for m in context.allGather(sent)]

        w, optimiser = shared.value
        totals, grad = dict.fromkeys(("loss", *_COUNTS), 0.0), {}
        size = sum(a.size for a in w.values())
        for step, rows in enumerate(_steps(batches, steps, block_rows)):
            draws = (optimiser.epoch * steps + step) * 7919 + seed
            summed = sum(gather(
                _share_sums(rows, w, domain, width, pos_weight, draws, gather, tasks)
            ))
            n = summed[0]
            if not n:
                continue
            flat = summed[len(_COUNTS):].reshape(2, size)
            loss, grad = N.combined(n, summed[1:4], *(unflatten(f, w) for f in flat))
            w = optimiser.update(w, grad)
            totals["loss"] += loss * n
            for name, value in zip(_COUNTS, summed, strict=False):
                totals[name] += float(value)
        if context.partitionId() == 0:
            rows = [(kind, k, np.ascontiguousarray(a, np.float64).tobytes())
                    for kind, group in (("weight", w), ("optimiser", optimiser.state()),
                                        ("gradient", grad)) for k, a in group.items()]
            rows += [("total", k, np.float64(v).tobytes()) for k, v in totals.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t)
                 for i, t in enumerate((pa.string(), pa.string(), pa.binary()))],
                names=["kind", "name", "data"],
            )

    dealt = _dealt(rows, tasks)
    found: dict[str, dict[str, np.ndarray]] = {
        k: {} for k in ("weight", "optimiser", "gradient", "total")
    }
    passed = dealt.mapInArrow(run, "kind string, name string, data binary", barrier=True)
    for row in passed.collect():  # one set of weights and moments
        found[row.kind][row.name] = np.frombuffer(bytes(row.data))
    like = {f"{m}.{k}": a for k, a in w.items() for m in ("first", "second")}
    after = replace(optimiser, first={}, second={})
    after.restore({k: a.reshape(like[k].shape) if k in like else a
                   for k, a in found["optimiser"].items()})
    return Passed(
        {k: found["weight"][k].reshape(a.shape) for k, a in w.items()}, after,
        {k: float(a[0]) for k, a in found["total"].items()},
        {k: a.reshape(w[k].shape) for k, a in found["gradient"].items()},
    )


def batched_table(rows: DataFrame, steps: int, seed: int) -> tuple[DataFrame, str]:
    """(the rows as a table partitioned by batch, its path) in the shared folder."""
    spark = rows.sparkSession
    path = shared_path(spark, "batches")
    batch = F.pmod(F.xxhash64(F.lit(seed), "row_key"), F.lit(steps)).cast("int")
    batched = rows.select(
        "row_key", "idx", "val", F.col("label").cast("double").alias("label"),
        batch.alias("batch"),
    )
    if steps > 1:
        batched = batched.hint("rebalance", "batch")  # few, even files per batch
    batched.write.partitionBy("batch").parquet(path)
    return spark.read.parquet(path), path


# -- training loop -------------------------------------------------------------

@dataclass
class Model:
    weights: N.Weights
    feature_names: list[str]
    loss: float = math.inf
    round: int = 0
    epoch: int = 0
    optimiser: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def width(self) -> int:
        return int(self.weights["deep.fc_w"].shape[0])


HISTORY_SCHEMA = (
    "round int, epoch int, train_loss double, train_accuracy double, train_precision double, "
    "train_recall double, train_f1 double, train_auc double, val_loss double, accuracy double, precision double, recall double, "
    "f1 double, auc double"
)


def _ratio(top: float, bottom: float) -> float:
    return float(top / bottom) if bottom else 0.0


def validate(
    rows: DataFrame, w: N.Weights, domain: DomainConfig, width: int, pos_weight: float
) -> dict[str, float]:
    """Loss and metrics of the evaluation pass; the rows are scored once and stored."""
    found = evaluate(rows, w, domain, width, pos_weight).first().asDict()
    return {k: math.nan if v is None else float(v) for k, v in found.items()}


def evaluate(
    rows: DataFrame, w: N.Weights, domain: DomainConfig, width: int, pos_weight: float
) -> DataFrame:
    """One row: loss, accuracy, precision, recall, f1, auc."""
    scored = stored(score_rows(rows, w, domain.network, width, ["label"]), "scored")
    loss = E.tri_bce(scored, lambda p, n: (F.lit(float(pos_weight)), F.lit(1.0)))
    return loss.select("loss").crossJoin(  # one row each
        E.confusion(scored).select("accuracy", "precision", "recall", "f1")
    ).crossJoin(E.roc_auc(scored))


def train(
    split: DataFrame,
    feature_names: Sequence[str],
    domain: DomainConfig,
    pos_weight: float | None = None,
    rounds: int | None = None,
    epochs: int | None = None,
    batch_rows: int | None = None,
    earlier_loss: float = math.inf,
    seed: int = 42,
    weights: N.Weights | None = None,
    train_auc: bool = True,
    on_best: Callable[[Model], None] | None = None,
    resume: Model | None = None,
) -> tuple[Model | None, list[tuple]]:
    """Train on ``split`` (row_key, label, idx, val, split) and return the best model.

    Rounds continue the same weights and optimiser. Each has its own patience, and a
    model is kept only if it also beats the loss saved before the round began; ``on_best``
    is called with it at once. The second value is the history, one tuple per epoch
    (``HISTORY_SCHEMA``). Training metrics come from the gradient pass itself, except for
    the ROC area, which takes one more pass unless ``train_auc`` is off. An update is made
    for every ``batch_rows`` rows (the domain's, unless given), so the number of updates
    follows the rows. ``resume`` goes on from a model's weights and its optimiser's
    state, as if the training that saved it had not ended.
    """
    width = len(feature_names)
    w = weights if weights is not None else N.init_weights(width, domain.network, seed)
    optimiser = Adam.of(domain)
    if resume is not None:
        w = resume.weights
        optimiser.restore(resume.optimiser)
    if pos_weight is None:
        pos_weight = 1.0
    if not domain.weighted_loss:
        pos_weight = 1.0
    training = split.where(F.col("split") == "train")
    n_rows = training.count()
    steps = max(1, -(-n_rows // (batch_rows or domain.batch_rows)))
    tasks = epoch_tasks(split.sparkSession, n_rows, steps)
    train_rows, train_path = batched_table(training, steps, seed)
    val_rows, val_path = batched_table(split.where(F.col("split") == "validation"), 1, seed)
    best: Model | None = None
    history: list[tuple] = []
    try:
        for round_no in range(rounds or domain.rounds):
            best_in_round, waited = math.inf, 0
            saved_before = min(earlier_loss, best.loss if best else math.inf)
            for epoch in range(epochs or domain.epochs):
                passed = epoch_pass(
                    train_rows, w, optimiser, domain, width, pos_weight, steps, seed, tasks
                )
                w, optimiser, totals = passed.weights, passed.optimiser, passed.totals
                n, loss, tp, fp, fn, tn = (totals[k] for k in ("n", "loss", "tp", "fp", "fn", "tn"))
                precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
                v = validate(val_rows, w, domain, width, pos_weight)
                area = math.nan
                if train_auc:
                    area = validate(train_rows, w, domain, width, pos_weight)["auc"]
                optimiser.epoch += 1
                history.append((
                    round_no + 1, epoch + 1, _ratio(loss, n), _ratio(tp + tn, n), precision, recall,
                    _ratio(2 * tp, 2 * tp + fp + fn), area, v["loss"], v["accuracy"],
                    v["precision"], v["recall"], v["f1"], v["auc"],
                ))
                if v["loss"] < best_in_round:
                    best_in_round, waited = v["loss"], 0
                    if v["loss"] < saved_before:
                        best = Model(dict(w), list(feature_names), v["loss"], round_no + 1,
                                     epoch + 1, optimiser.state())
                        if on_best is not None:
                            on_best(best)
                else:
                    waited += 1
                    if waited >= domain.patience:
                        break
    finally:
        for path in (train_path, val_path):
            remove(split.sparkSession, path)
    return best, history


# -- stored models -------------------------------------------------------------

_META = (
    "saved bigint, version string, width int, feature_names array<string>, loss double, "
    "round int, epoch int"
)


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    """Weights and optimiser state as a new version; one appended row then points to it.

    A crash in between leaves the earlier version in force, never a mixture.
    """
    rows = [
        (kind, k, list(a.shape), a.ravel().tolist())
        for kind, group in (("weight", model.weights), ("optimiser", model.optimiser))
        for k, a in group.items()
    ]
    version, latest = uuid.uuid4().hex, latest_meta(spark, path)
    spark.createDataFrame(
        rows, "kind string, name string, shape array<int>, data array<double>"
    ).write.parquet(f"{path}/versions/{version}")
    spark.createDataFrame(
        [((latest.saved if latest else 0) + 1, version, model.width, model.feature_names,
          model.loss, model.round, model.epoch)], _META,
    ).coalesce(1).write.mode("append").parquet(f"{path}/meta")


def latest_meta(spark: SparkSession, path: str):
    """The row of the version in force, None if there is none."""
    from tastegrid.sources.tables import table_exists

    if not table_exists(spark, f"{path}/meta"):
        return None
    return spark.read.schema(_META).parquet(f"{path}/meta").orderBy(F.desc("saved")).first()


def load_model(spark: SparkSession, path: str, feature_names: Sequence[str]) -> Model:
    """Read a stored model; its features must be the given ones, in order."""
    meta = latest_meta(spark, path)
    if meta is None:
        raise FileNotFoundError(f"missing model at {path}")
    if list(meta.feature_names) != list(feature_names):
        raise ValueError(
            f"model was trained on {meta.width} features that differ from the "
            f"{len(feature_names)} given"
        )
    groups: dict[str, N.Weights] = {"weight": {}, "optimiser": {}}
    for row in spark.read.parquet(f"{path}/versions/{meta.version}").collect():
        groups[row.kind][row.name] = np.array(row.data).reshape(row.shape)
    return Model(groups["weight"], list(meta.feature_names), meta.loss, meta.round, meta.epoch,
                 groups["optimiser"])
