"""Network scores of feature rows, and the best items of every class of equal users.

Users with equal feature vectors are one class, which is scored once, however many
profiles belong to it. Classes x items is never written out as rows: a task scores a block
of classes against a block of items and emits the best ``n`` per class. Three plans give
the same rows:

* ``broadcast``: the encoded items fit the checked limit and travel once per executor;
  of the classes only their own short rows are shuffled, to spread the work.
* ``streamed``: the items exceed the limit, but the classes are one tile. The classes
  travel, and each task's items pass by in pieces; a task holds one piece and its lists.
* ``grid``: classes and items are cut into bounded tiles, each side is repeated along
  the other's tiles, and each pair of tiles meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.config import TOP_N, NetworkConfig
from tastegrid.operators import network as N
from tastegrid.operators.joins import splittable_join
from tastegrid.session import ship_package, stored

MAX_ITEM_BYTES = 128 * 1024 * 1024
TILE_CLASSES = 2_000
#: Pairs that one task of the broadcast plan scores with two layers, about.
TASK_PAIRS = 8_000_000
#: Items of a block of the grid plan, at least, in lists of the best ``n``.
BLOCK_LISTS = 256
PIECE_ITEMS = 4096
PIECE_CLASSES = 64
#: Classes that a deep network takes at once, as it brings those together that are alike.
DEEP_CLASSES = 512
DENSE_CELLS = 2_000_000
#: Digits that do not depend on how rows were blocked; ties beyond go to catalogue order.
SCORE_PLACES = 12

#: The 128-bit print of a feature vector: equal vectors are one class.
CLASS = ("class_a", "class_b")
IDS = ["content_id", "item_ord"]
BEST_SCHEMA = (
    "class_a bigint, class_b bigint, content_id string, item_ord bigint, score double"
)


def dense_block(idx: pa.Array, val: pa.Array, width: int) -> np.ndarray:
    """Rows of (positions, values) lists as one dense matrix."""
    if isinstance(idx, pa.ChunkedArray):
        idx, val = idx.combine_chunks(), val.combine_chunks()
    lengths = idx.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    x = np.zeros((len(idx), width))
    x[np.repeat(np.arange(len(idx)), lengths), idx.flatten().to_numpy(zero_copy_only=False)] = (
        val.flatten().to_numpy(zero_copy_only=False)
    )
    return x


def score_rows(
    rows: DataFrame, weights: N.Weights, net: NetworkConfig, width: int, keep: list[str]
) -> DataFrame:
    """``keep`` columns plus score, score_deep, score_shallow of each feature row."""
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, DENSE_CELLS // width)
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                block = dense_block(batch.column("idx"), batch.column("val"), width)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep],
                     *[pa.array(p) for p in N.scores(block, shared.value, net)]],
                    names=[*keep, "score", "score_deep", "score_shallow"],
                )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     for f in rows.select(*keep).schema.fields)
    return rows.select(*keep, "idx", "val").mapInArrow(
        run, f"{kept}, score double, score_deep double, score_shallow double"
    )


@dataclass
class ItemBlock:
    """One block of encoded items in catalogue order."""

    content_id: np.ndarray
    item_ord: np.ndarray
    x: np.ndarray

    def __len__(self) -> int:
        return len(self.content_id)

    def piece(self, start: int, end: int) -> ItemBlock:
        return ItemBlock(self.content_id[start:end], self.item_ord[start:end], self.x[start:end])


@dataclass
class SparseItems:
    """Encoded items, as positions and values; one piece is dense at a time. They are in
    catalogue order, or else ``order`` has each one's number there."""

    table: pa.Table
    width: int
    order: np.ndarray | None = None

    @classmethod
    def from_arrow(cls, table: pa.Table, width: int) -> SparseItems:
        order = [("item_ord", "ascending"), ("content_id", "ascending")]
        return cls(table.sort_by(order).combine_chunks(), width)

    def __len__(self) -> int:
        return self.table.num_rows

    def alike(self) -> SparseItems:
        """The items in the order of the columns that they have."""
        if not len(self) or self.order is not None:
            return self
        has = [np.packbits(self.piece(k, k + PIECE_ITEMS).x != 0, axis=1)
               for k in range(0, len(self), PIECE_ITEMS)]
        order = np.lexsort(np.concatenate(has).T[::-1])
        return SparseItems(self.table.take(pa.array(order)).combine_chunks(), self.width, order)

    def piece(self, start: int, end: int) -> ItemBlock:
        part = self.table.slice(start, end - start)
        return ItemBlock(
            part["content_id"].to_numpy(), part["item_ord"].to_numpy(),
            dense_block(part["idx"], part["val"], self.width),
        )


@dataclass
class _Side:
    """One side's share of the pair sums of one branch; users and items look alike.

    For a column of the value part z = A + C t, where t is the pair's projection (already
    centred if it enters normalised), so the sums over such columns of out*z and z*z are
    polynomials in t whose coefficients belong to one side. Padding columns are constant.
    """

    projection: np.ndarray  # rows x half
    units: np.ndarray       # units of the value-part columns on this side
    linear: np.ndarray      # out * C
    mixed: np.ndarray       # 2 A C
    squared: np.ndarray     # C * C
    top: np.ndarray         # sum of out * z where z is constant in t
    square: np.ndarray      # sum of z * z where z is constant in t
    largest: np.ndarray     # bound of |A| and of |C| per row


def _simple(net: NetworkConfig) -> bool:
    """Whether the pairs' scores come from products of the two sides."""
    return max(net.deep_layers, net.shallow_layers) == 1 and not net.gated and not net.batch_norm


class PairScorer:
    """Joint scores of profile rows against one item block.

    The projection of a pair is the sum of the two sides' projections. In a single-layer
    network a column that is 0 in a pair stays 0, and the value-part columns add up to
    matrix products of the sides; only the masked columns are visited one by one. No
    dense pair row is built. Deeper networks take the pairs in blocks that have few columns
    (``N.PairNetwork``).
    """

    def __init__(self, items: ItemBlock, user_width: int, weights: N.Weights, net: NetworkConfig):
        self.items, self.user_width, self.w, self.net = items, user_width, weights, net
        self.half = (user_width + items.x.shape[1]) // 2
        self.simple = _simple(net)
        if not self.simple:
            self.deep = N.PairNetwork(weights, net, user_width, items.x)
            return
        self.sides = {b: self._side(items.x, user_width, b) for b, _ in N.branches(net)}
        # Masked columns of each item: slot k holds the k-th one, value 0 where there is none.
        cols = np.arange(items.x.shape[1]) + user_width
        masked = cols[(cols >= self.half) & (cols < 2 * self.half)] - user_width
        rows, at = np.nonzero(items.x[:, masked])
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        slots = int(place.max()) + 1 if len(rows) else 0
        self.slot_cols = np.full((slots, len(items.x)), self.half, dtype=np.int64)
        self.slot_vals = np.zeros((slots, len(items.x)))
        self.slot_cols[place, rows] = masked[at] + user_width
        self.slot_vals[place, rows] = items.x[rows, masked[at]]

    def _side(self, x: np.ndarray, first_column: int, branch: str) -> _Side:
        w, net, half = self.w, self.net, self.half
        at, cols = f"{branch}.0", np.arange(x.shape[1]) + first_column
        projection = x @ w[f"{at}.w"][:, cols].T
        plain, gain = w[f"{at}.b"] + 1.0, np.ones(half)
        if net.normalise_cross:
            projection = projection - projection.mean(1, keepdims=True)
            gain = w[f"{at}.ln_g"]
        value = cols < half
        units, out = cols[value], w[f"{branch}.fc_w"]
        shift = plain[units] + (w[f"{at}.ln_b"][units] if net.normalise_cross else 0.0)
        a, c = x[:, value] * shift, x[:, value] * gain[units]
        pad = cols >= 2 * half
        z = np.clip(x[:, pad] * plain[cols[pad]], -net.clip, net.clip)
        return _Side(
            projection, units, c * out[units], 2 * a * c, c * c,
            a @ out[units] + z @ out[cols[pad]], (a * a).sum(1) + (z * z).sum(1),
            np.maximum(np.abs(a).max(axis=1, initial=0.0), np.abs(c).max(axis=1, initial=0.0)),
        )

    def __call__(self, users: np.ndarray) -> np.ndarray:
        """Scores [users, items]; users whose pairs need the dense network are scored apart."""
        plain = self._plain(users)
        joint = np.empty((len(users), len(self.items.x)))
        if plain.any():
            deep, shallow = (self._simple_branch(users[plain], b) for b, _ in N.branches(self.net))
            joint[plain] = N.sigmoid((deep + shallow) * 0.5)
        if not self.simple:
            joint = self.deep(users)
            plain[:] = True
        for row in np.flatnonzero(~plain):
            pairs = np.hstack([np.tile(users[row], (len(self.items.x), 1)), self.items.x])
            joint[row] = N.scores(pairs, self.w, self.net)[0]
        return np.round(joint, SCORE_PLACES)

    def _plain(self, users: np.ndarray) -> np.ndarray:
        """Users for which no value-part column can be clipped and no column is masked."""
        if not self.simple:
            return np.zeros(len(users), bool)
        out = ~(users[:, self.half:2 * self.half] != 0).any(axis=1)
        for b, _ in N.branches(self.net):
            u, v = self._side(users, 0, b), self.sides[b]
            if self.net.normalise_cross:
                reach = np.full(len(users), np.sqrt(self.half))
            else:
                reach = np.abs(u.projection).max(axis=1) + np.abs(v.projection).max(initial=0.0)
            bound = np.maximum(u.largest, v.largest.max(initial=0.0))
            out &= bound * (1.0 + reach) <= self.net.clip
        return out

    def _simple_branch(self, users: np.ndarray, branch: str) -> np.ndarray:
        w, net, half = self.w, self.net, self.half
        at, out = f"{branch}.0", w[f"{branch}.fc_w"]
        u, v = self._side(users, 0, branch), self.sides[branch]
        tu, tv = u.projection, v.projection
        cu, cv = tu - tu.mean(1, keepdims=True), tv - tv.mean(1, keepdims=True)
        var = (cu**2).mean(1)[:, None] + (cv**2).mean(1) + (cu @ cv.T) * (2.0 / half)
        inv_sd = 1.0 / np.sqrt(np.maximum(var, 0.0) + N.LN_EPS)
        rate = inv_sd if net.normalise_cross else 1.0

        def linear(pu: np.ndarray, pv: np.ndarray) -> np.ndarray:
            return (
                (pu * tu[:, u.units]).sum(1)[:, None] + (pv * tv[:, v.units]).sum(1)
                + np.hstack([pu, tu[:, v.units]]) @ np.hstack([tv[:, u.units], pv]).T
            )

        pu, pv, tu_v, tv_u = u.squared, v.squared, tu[:, v.units], tv[:, u.units]
        quadratic = (
            (pu * tu[:, u.units] ** 2).sum(1)[:, None] + (pv * tv[:, v.units] ** 2).sum(1)
            + np.hstack([pu, 2 * pu * tu[:, u.units], tu_v, tu_v**2])
            @ np.hstack([tv_u**2, tv_u, 2 * pv * tv[:, v.units], pv]).T
        )
        top = u.top[:, None] + v.top + rate * linear(u.linear, v.linear)
        square = u.square[:, None] + v.square + rate * (
            linear(u.mixed, v.mixed) + rate * quadratic
        )

        # Masked columns: z = x (1 + b + value * relu(normed)).
        gain, offset = w[f"{at}.ln_g"], w[f"{at}.ln_b"]
        each, normed, z = np.arange(len(tv)), np.empty(len(tv)), np.empty(len(tv))
        for cols, vals in zip(self.slot_cols, self.slot_vals, strict=True):
            unit = cols - half
            item_part, g, o = (cv[each, unit] * gain[unit], gain[unit], offset[unit])
            plain, weight, raw = vals * (w[f"{at}.b"][cols] + 1.0), out[cols], tv[each, unit]
            for p in range(len(users)):
                np.add(item_part, (cu[p] * gain)[unit], out=normed)
                normed *= inv_sd[p]
                normed += o
                value = normed if net.normalise_cross else raw + tu[p][unit]
                np.maximum(normed, 0.0, out=z)
                z *= value
                z *= vals
                z += plain
                np.maximum(z, -net.clip, out=z)
                np.minimum(z, net.clip, out=z)
                top[p] += z * weight
                z *= z
                square[p] += z
        return top / (np.sqrt(square) + N.NORM_EPS) + w[f"{branch}.fc_b"][0]


def largest(scores: np.ndarray, n: int, rank: np.ndarray | None = None) -> np.ndarray:
    """Positions of the ``n`` largest, ascending; of equal scores the first ones count, or
    those that ``rank`` (a number per position) puts first."""
    if n >= len(scores):
        return np.arange(len(scores))
    limit = np.partition(scores, len(scores) - n)[len(scores) - n]
    above = np.flatnonzero(scores > limit)
    at = np.flatnonzero(scores == limit)
    if rank is not None:
        at = at[np.argsort(rank[at])]
    return np.sort(np.concatenate([above, at[: n - len(above)]]))


def _scorers(
    items: ItemBlock | SparseItems, user_width: int, weights: N.Weights, net: NetworkConfig
) -> Iterator[tuple[int, PairScorer]]:
    """The items in pieces whose working arrays stay in the processor's cache, one at a time."""
    for start in range(0, len(items), PIECE_ITEMS):
        yield start, PairScorer(items.piece(start, start + PIECE_ITEMS), user_width, weights, net)


def _best_places(
    users: np.ndarray, scorers: Iterator[tuple[int, PairScorer]], n: int,
    ranks: Callable[[], np.ndarray | None] = lambda: None,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and scores of the best ``n`` items per user. The items come in catalogue order,
    or else ``ranks`` gives that order for the places of all items that have come."""
    best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in users]
    for start, scorer in scorers:
        rank, some = ranks(), PIECE_CLASSES if scorer.simple else DEEP_CLASSES
        for first in range(0, len(users), some):
            for p, scores in enumerate(scorer(users[first:first + some]), first):
                scores = np.where(np.isnan(scores), -np.inf, scores)
                own = None if rank is None else rank[start:start + len(scores)]
                chosen = largest(scores, n, own)
                at = np.concatenate([best[p][0], chosen + start])
                scores = np.concatenate([best[p][1], scores[chosen]])
                chosen = largest(scores, n, None if rank is None else rank[at])
                best[p] = (at[chosen], scores[chosen])
    return best


def _best_rows(
    classes: pa.Table, best: list[tuple[np.ndarray, np.ndarray]], ids: pa.Table
) -> Iterator[pa.RecordBatch]:
    """The found places as rows; ``ids`` holds content_id and item_ord of each place."""
    prints = [classes[c].to_numpy() for c in CLASS]
    for first in range(0, len(best), PIECE_CLASSES):
        part = best[first:first + PIECE_CLASSES]
        which = first + np.repeat(np.arange(len(part)), [len(a) for a, _ in part])
        at, score = (np.concatenate([x[i] for x in part]) for i in (0, 1))
        chosen = ids.take(pa.array(at))
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array(p[which]) for p in prints],
                *[c.combine_chunks().cast(t) for c, t in zip(
                    chosen.columns, (pa.string(), pa.int64()), strict=True)],
                pa.array(score, mask=np.isneginf(score)),
            ],
            schema=_BEST_ARROW,
        )


def _best_items(
    classes: pa.Table, items: SparseItems, weights: N.Weights, net: NetworkConfig,
    user_width: int, n: int,
) -> Iterator[pa.RecordBatch]:
    """The best ``n`` of ``items`` per class; a task holds one dense piece of each side."""
    if not len(items):
        return
    if not _simple(net):
        items = items.alike()
    rows = max(PIECE_CLASSES, DENSE_CELLS // max(user_width, 1))
    for some in (classes.slice(k, rows) for k in range(0, classes.num_rows, rows)):
        some, users = _users(some, user_width, net)
        best = _best_places(
            users, _scorers(items, user_width, weights, net), n, lambda: items.order
        )
        yield from _best_rows(some, best, items.table.select(IDS))


def _users(
    classes: pa.Table, width: int, net: NetworkConfig
) -> tuple[pa.Table, np.ndarray]:
    """Classes and their dense rows; for a deep network in the order of the columns they have."""
    users = dense_block(classes["idx"], classes["val"], width)
    if _simple(net) or not len(users):
        return classes, users
    order = np.lexsort(np.packbits(users != 0, axis=1).T[::-1])
    return classes.take(pa.array(order)), users[order]


def _best_streamed(
    classes: pa.Table, batches: Iterator[pa.RecordBatch], weights: N.Weights,
    net: NetworkConfig, user_width: int, item_width: int, n: int,
) -> Iterator[pa.RecordBatch]:
    """The same of items that pass by: of those gone by only ids are held. The items come in
    catalogue order, for a deep network in the order of the columns that they have."""
    ids: list[pa.Table] = []

    def scorers() -> Iterator[tuple[int, PairScorer]]:
        start = 0
        for batch in batches:
            items = SparseItems(pa.Table.from_batches([batch]), item_width)
            # taken, not sliced: a slice keeps the whole batch in memory
            ids.append(items.table.select(IDS).take(pa.array(np.arange(len(items)))))
            for at, scorer in _scorers(items, user_width, weights, net):
                yield start + at, scorer
            start += len(items)

    known: dict[int, np.ndarray] = {}

    def ranks() -> np.ndarray | None:
        if _simple(net):
            return None
        if len(ids) not in known:
            known.clear()
            order = pc.sort_indices(pa.concat_tables(ids), [
                ("item_ord", "ascending"), ("content_id", "ascending")]).to_numpy()
            known[len(ids)] = np.empty(len(order), np.int64)
            known[len(ids)][order] = np.arange(len(order))
        return known[len(ids)]

    classes, users = _users(classes, user_width, net)
    best = _best_places(users, scorers(), n, ranks)
    if ids:
        yield from _best_rows(classes, best, pa.concat_tables(ids).combine_chunks())


def _broadcast_plan(
    classes, items, weights, net, user_width, item_width, n, tasks
) -> DataFrame:
    block = SparseItems.from_arrow(items.toArrow(), item_width)
    if not _simple(net):
        block = block.alike()  # once, not in every task
    shared = classes.sparkSession.sparkContext.broadcast((block, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = shared.value
        held = list(batches)  # a task's classes follow its pairs
        if held:
            yield from _best_items(
                pa.Table.from_batches(held), block, weights, net, user_width, n
            )

    # Classes are few bytes and much work: the number of tasks follows the pairs.
    layers = net.deep_layers + net.shallow_layers
    tasks = tasks or max(1, -(-classes.count() * len(block) * layers // (2 * TASK_PAIRS)))
    if _simple(net):
        dealt = classes.repartition(tasks, *CLASS)
    else:  # a block of pairs costs by the columns that it has
        dealt = classes.repartitionByRange(tasks, "idx", *CLASS)
    return dealt.mapInArrow(run, BEST_SCHEMA)


def _streamed_plan(
    classes, items, weights, net, user_width, item_width, n, blocks
) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(
        (classes.select(*CLASS, "idx", "val").toArrow(), weights)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weights = shared.value
        yield from _best_streamed(held, batches, weights, net, user_width, item_width, n)

    if _simple(net):
        dealt = items.repartition(blocks, "content_id").sortWithinPartitions(
            "item_ord", "content_id"
        )
    else:  # items that have the same columns pass by together
        order = ("idx", "item_ord", "content_id")
        dealt = items.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, BEST_SCHEMA)


def _grid_plan(
    classes, items, weights, net, user_width, item_width, n, blocks, tiles
) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(weights)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], schema=_BEST_ARROW)
        block = SparseItems.from_arrow(right, item_width)
        return pa.Table.from_batches(
            list(_best_items(left, block, shared.value, net, user_width, n)), schema=_BEST_ARROW
        )

    spread_classes = classes.withColumn(
        "tile", F.pmod(F.xxhash64(*CLASS), F.lit(tiles))
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    spread_items = items.withColumn(
        "block", F.pmod(F.xxhash64("content_id"), F.lit(blocks))
    ).withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)).cast("array<bigint>")))
    # a task per pair of tiles, whatever their bytes
    spread_classes, spread_items = (
        side.repartition(tiles * blocks, "tile", "block") for side in (spread_classes, spread_items)
    )
    return (
        spread_classes.groupBy("tile", "block")
        .cogroup(spread_items.groupBy("tile", "block"))
        .applyInArrow(run, BEST_SCHEMA)
    )


_BEST_ARROW = pa.schema([
    ("class_a", pa.int64()), ("class_b", pa.int64()), ("content_id", pa.string()),
    ("item_ord", pa.int64()), ("score", pa.float64()),
])


def with_class(rows: DataFrame) -> DataFrame:
    """Rows with the class of their feature vector (``idx``, ``val``)."""
    return rows.withColumns({
        "class_a": F.xxhash64("idx", "val"), "class_b": F.xxhash64(F.lit(1), "idx", "val"),
    })


def classes_of(rows: DataFrame) -> DataFrame:
    """(class, idx, val): one row per class; copies combine before the shuffle."""
    return rows.groupBy(*CLASS).agg(F.first("idx").alias("idx"), F.first("val").alias("val"))


def best_of_classes(
    classes: DataFrame,
    items: DataFrame,
    weights: N.Weights,
    net: NetworkConfig,
    user_width: int,
    item_width: int,
    n: int = TOP_N,
    max_item_bytes: int = MAX_ITEM_BYTES,
    tile_classes: int = TILE_CLASSES,
    tasks: int | None = None,
) -> DataFrame:
    """(class, content_id, item_ord, score): the best ``n`` items per class, in the streamed
    and the grid plan the best ``n`` of each block of items.

    ``classes``: a stored table of class, idx, val, as it is counted and read. ``items``:
    content_id, item_ord, idx, val, one row per content. The number of items is counted
    to choose the plan.
    """
    ship_package(classes.sparkSession)
    items = items.select("content_id", "item_ord", "idx", "val")
    width = weights["deep.fc_w"].shape[0]
    if width != user_width + item_width:
        raise ValueError(f"model width {width}, features {user_width} + {item_width}")
    n_items = items.count()
    size = n_items * width * 16
    if size <= max_item_bytes:
        return _broadcast_plan(classes, items, weights, net, user_width, item_width, n, tasks)
    # a block gives its best n of each class, so blocks of few items would give all pairs
    most, n_classes = max(1, n_items // (BLOCK_LISTS * n)), classes.count()
    by_bytes = -(-size // max_item_bytes)
    if n_classes <= tile_classes:
        layers = net.deep_layers + net.shallow_layers
        by_pairs = -(-n_classes * n_items * layers // (2 * TASK_PAIRS))
        return _streamed_plan(
            classes, items, weights, net, user_width, item_width, n,
            int(min(max(by_bytes, by_pairs), most)),
        )
    return _grid_plan(
        classes, items, weights, net, user_width, item_width, n, int(min(by_bytes, most)),
        max(1, int(-(-n_classes // tile_classes))),
    )


def best_pairs(profiles: DataFrame, items: DataFrame, *model, **plan) -> DataFrame:
    """(profile_id, username, content_id, item_ord, score): the best items per row of
    ``profiles`` (profile_id, username, idx, val). Arguments as in ``best_of_classes``."""
    rows = with_class(profiles)
    best = best_of_classes(stored(classes_of(rows), "classes"), items, *model, **plan)
    return splittable_join(
        rows.select("profile_id", "username", *CLASS), best, CLASS
    ).drop(*CLASS)
