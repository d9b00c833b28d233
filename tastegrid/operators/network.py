"""The two-branch cross network on one dense block of rows (numpy).

These helpers run inside Spark tasks; Spark decides which rows meet which weights.
Weights are a flat ``{name: array}`` so that they can be stored, summed and updated
without knowing the shape of the network.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

from tastegrid.config import NetworkConfig

LN_EPS = 1e-5
BN_EPS = 1e-5
NORM_EPS = 1e-12

Weights = dict[str, np.ndarray]


def branches(net: NetworkConfig) -> tuple[tuple[str, int], ...]:
    return (("deep", net.deep_layers), ("shallow", net.shallow_layers))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700, 700)))


def init_weights(width: int, net: NetworkConfig, seed: int = 42) -> Weights:
    rng = np.random.default_rng(seed)
    half = width // 2

    def linear(rows: int, cols: int) -> np.ndarray:
        fan = cols if net.init == "kaiming" else rows + cols
        limit = np.sqrt(6.0 / max(fan, 1))
        return rng.uniform(-limit, limit, (rows, cols))

    w: Weights = {}
    for branch, layers in branches(net):
        for layer in range(layers):
            at = f"{branch}.{layer}"
            w[f"{at}.w"] = linear(half, width)
            w[f"{at}.b"] = rng.uniform(0.0, 1.0, width)
            w[f"{at}.ln_g"], w[f"{at}.ln_b"] = np.ones(half), np.zeros(half)
            if net.gated:
                w[f"{at}.gate_w"], w[f"{at}.gate_b"] = linear(half, half), np.zeros(half)
            if net.batch_norm:
                w[f"{at}.bn_g"], w[f"{at}.bn_b"] = np.ones(half), np.zeros(half)
                w[f"{at}.bn_mean"], w[f"{at}.bn_var"] = np.zeros(half), np.ones(half)
        w[f"{branch}.fc_w"], w[f"{branch}.fc_b"] = linear(1, width)[0], np.zeros(1)
    return w


def is_statistic(name: str) -> bool:
    """Running batch-norm statistics are tracked, not trained."""
    return name.endswith(("bn_mean", "bn_var"))


def _standardise(h: np.ndarray, eps: float) -> np.ndarray:
    """Each row by its own mean and deviation."""
    return (h - h.mean(axis=1, keepdims=True)) / np.sqrt(h.var(axis=1, keepdims=True) + eps)


class Waits(Exception):
    """A block needs something of the whole batch that is not known yet."""


class Alone:
    """A block that is the whole batch."""

    def __init__(self):
        self.maps: dict[str, Maps] = {}

    def knows(self, key: tuple) -> bool:
        return True

    def merged(self, key: tuple, part: np.ndarray, merge) -> np.ndarray:
        return merge([part])


class Passes:
    """Blocks of a batch that is read several times. A pass takes each block as far as what
    is known of the whole batch reaches, and merges what the blocks say of the next step."""

    def __init__(self):
        self.maps: dict[str, Maps] = {}
        self.known: dict[tuple, np.ndarray] = {}
        self.parts: dict[tuple, tuple] = {}

    def knows(self, key: tuple) -> bool:
        return key in self.known

    def merged(self, key: tuple, part: np.ndarray, merge) -> np.ndarray:
        if key not in self.known:
            if key in self.parts:
                part = merge([self.parts[key][0], part])
            self.parts[key] = (part, merge)
            raise Waits
        return self.known[key]

    def settle(self, gather) -> bool:
        """Merge the parts of this pass over all tasks, in one message; False if there are none."""
        keys, parts = sorted(self.parts), self.parts
        self.parts = {}
        if keys:
            told = gather(np.concatenate([parts[k][0].ravel() for k in keys]))
            at = 0
            for k in keys:
                part, merge = parts[k]
                self.known[k] = merge([t[at:at + part.size].reshape(part.shape) for t in told])
                at += part.size
        return bool(keys)


def _merged_moments(parts: list[np.ndarray]) -> np.ndarray:
    """(rows, mean, sum of squared deviations) of several blocks as those of one."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / np.maximum(n, 1.0)
    return np.stack([n, mean, sum(p[2] + p[0] * (p[1] - mean) ** 2 for p in parts)])


def _batch_moments(
    x: np.ndarray, weight: np.ndarray, peers, key: tuple
) -> tuple[float, np.ndarray, np.ndarray]:
    """(rows, mean, sum of squared deviations) of the batch's ``weight @ x``, merged from those
    of its blocks, each from the mean and the products of the block's columns."""
    mean = x.mean(axis=1) if x.shape[1] else np.zeros(len(x))
    off = x - mean[:, None]
    square = np.maximum(((weight @ (off @ off.T)) * weight).sum(axis=1), 0.0)
    own = np.stack([np.full(len(weight), float(x.shape[1])), weight @ mean, square])
    n, overall, square = peers.merged(key, own, _merged_moments)
    return n[0] or 1.0, overall, square


def branch_logit(x0, w: Weights, net: NetworkConfig, branch: str, layers: int):
    """Logit of one branch in evaluation mode, and the last layer's rows."""
    x, half = x0, x0.shape[1] // 2
    for layer in range(layers):
        at = f"{branch}.{layer}"
        h = x @ w[f"{at}.w"].T
        if net.batch_norm:
            z = (h - w[f"{at}.bn_mean"]) / np.sqrt(w[f"{at}.bn_var"] + BN_EPS)
            h = z * w[f"{at}.bn_g"] + w[f"{at}.bn_b"]
        normed = _standardise(h, LN_EPS) * w[f"{at}.ln_g"] + w[f"{at}.ln_b"]
        value = normed if net.normalise_cross else h
        if net.gated:
            value = h * sigmoid(h @ w[f"{at}.gate_w"].T + w[f"{at}.gate_b"])
        cross = np.zeros_like(x)
        cross[:, :half], cross[:, half:2 * half] = value, value * np.maximum(normed, 0.0)
        factor = x if (branch == "deep" and net.chain_deep) else x0
        bounded = np.clip(factor * (cross + w[f"{at}.b"]) + x, -net.clip, net.clip)
        x = bounded / (np.linalg.norm(bounded, axis=1, keepdims=True) + NORM_EPS)
    return x @ w[f"{branch}.fc_w"] + w[f"{branch}.fc_b"][0], x


# -- blocks of rows that share their zero columns ------------------------------

# A column that is 0 in a row is 0 after every layer, as both terms of the rule have it as a
# factor; it adds nothing to a projection and gets no gradient. One-hot rows have few others,
# so a block of rows takes part with the columns that any of them has. Rows are columns here,
# so that sums over features run along the rows, and a last 1 stands for all constants.


@dataclass
class Maps:
    """A layer's linear maps of a row and 1: the projection after batch norm, the same less its
    mean over units, the input of the gates, and the standardised projection."""

    h: np.ndarray
    centred: np.ndarray
    gates: np.ndarray | None
    z: np.ndarray | None

    @classmethod
    def of(cls, w: Weights, net: NetworkConfig, at: str, mean=None, var=None) -> Maps:
        h, gates, z = np.pad(w[f"{at}.w"], ((0, 0), (0, 1))), None, None
        if net.batch_norm:
            sd = np.sqrt(var + BN_EPS)
            h[:, -1] = -mean
            z = h / sd[:, None]
            h = z * w[f"{at}.bn_g"][:, None]
            h[:, -1] += w[f"{at}.bn_b"]
        if net.gated:
            gates = w[f"{at}.gate_w"] @ h
            gates[:, -1] += w[f"{at}.gate_b"]
        return cls(h, h - h.mean(axis=0), gates, z)


class Columns:
    """The columns that a block's rows take part with, and the units that these read."""

    def __init__(self, cols: np.ndarray, width: int):
        self.cols, self.half = cols, width // 2
        self.with_one = np.append(cols, width)
        low, mid = cols[cols < self.half], cols[(cols >= self.half) & (cols < 2 * self.half)]
        self.low, self.mid = low, mid - self.half
        self.units = np.concatenate([self.low, self.mid])

    def rows(self, maps: Maps, net: NetworkConfig) -> np.ndarray:
        """The maps' rows that a layer needs: values, gates, and all units for their deviation."""
        wanted = [maps.h[self.units]]
        if net.gated:
            wanted.append(maps.gates[self.units])
        if len(self.normed(net)):
            wanted.append(maps.centred)
        return np.concatenate(wanted)[:, self.with_one]

    def normed(self, net: NetworkConfig) -> np.ndarray:
        """Units whose layer-normed projection enters the cross term."""
        return self.units if net.normalise_cross and not net.gated else self.mid


@dataclass
class _Layer:
    """What the gradient needs of a layer's forward pass."""

    x: np.ndarray
    value: np.ndarray
    h: np.ndarray
    gate: np.ndarray | None
    sd: np.ndarray | None
    ln_z: np.ndarray | None
    mask: np.ndarray | None
    through: np.ndarray | None
    factor: np.ndarray
    inside: np.ndarray | None
    bounded: np.ndarray
    norm: np.ndarray
    kept: np.ndarray | None = None
    maps: Maps | None = None
    moments: tuple | None = None


def _layer(
    x: np.ndarray, x0: np.ndarray, c: Columns, rows: np.ndarray, w: Weights,
    net: NetworkConfig, at: str, taped: bool,
) -> tuple[np.ndarray, _Layer | None]:
    """The next rows of a block (columns and 1 x rows), and what the gradient needs."""
    s, n, n_low = len(c.cols), len(c.units), len(c.low)
    y = rows @ x
    h, gate, sd, ln_z, mask = y[:n], None, None, None, None
    value, done = h, n
    if net.gated:
        gate, done = y[n:2 * n], 2 * n
        np.negative(gate, out=gate)
        np.exp(np.minimum(gate, 700.0, out=gate), out=gate)
        gate += 1.0
        np.divide(1.0, gate, out=gate)
        value = h * gate if taped else np.multiply(h, gate, out=h)
    units = c.normed(net)
    if len(units):
        centred = y[done:]
        sd = np.sqrt(np.einsum("ij,ij->j", centred, centred) / c.half + LN_EPS)
        ln_z = centred[units]
        ln_z /= sd
        normed = ln_z * w[f"{at}.ln_g"][units, None]
        normed += w[f"{at}.ln_b"][units, None]
        if len(units) == n and not net.gated and net.normalise_cross:
            value = normed
            normed = normed[n_low:]
        mask = np.maximum(normed, 0.0)
    chained = at.startswith("deep") and net.chain_deep
    factor = x if chained else x0
    out = np.zeros_like(x)
    z = out[:s]
    z[:n_low] = value[:n_low]
    if n > n_low:
        np.multiply(value[n_low:], mask, out=z[n_low:n])
    z += w[f"{at}.b"][c.cols, None]
    through = z + 1.0 if taped and chained else None
    z *= factor[:s]
    z += x[:s]
    inside = None
    if taped:
        inside = np.abs(z) <= net.clip
        inside = None if inside.all() else inside
    np.minimum(np.maximum(z, -net.clip, out=z), net.clip, out=z)
    norm = np.sqrt(np.einsum("ij,ij->j", z, z))
    bounded = z.copy() if taped else z
    z *= 1.0 / (norm + NORM_EPS)
    out[s] = 1.0
    if not taped:
        return out, None
    return out, _Layer(x, value, h, gate, sd, ln_z, mask, through, factor, inside, bounded, norm)


def _block_logit(
    x0: np.ndarray, c: Columns, w: Weights, net: NetworkConfig, branch: str, layers: int,
    draws, tape: list[_Layer], peers,
) -> tuple[np.ndarray, np.ndarray]:
    """Logit and last rows of one branch for a block of training rows; units are dropped, and
    the statistics are those of the batch, of which the rows are one block among ``peers``."""
    x, width = x0, w[f"{branch}.fc_w"].shape[0]
    taped = not net.batch_norm or peers.knows((branch, layers - 1, "moments"))
    for layer in range(layers):
        at, moments = f"{branch}.{layer}", None
        if net.batch_norm:
            moments = _batch_moments(
                x[:-1], w[f"{at}.w"][:, c.cols], peers, (branch, layer, "moments")
            )
        if at not in peers.maps:
            stats = (moments[1], moments[2] / moments[0]) if moments else ()
            peers.maps[at] = Maps.of(w, net, at, *stats)
        maps = peers.maps[at]
        x, t = _layer(x, x0, c, c.rows(maps, net), w, net, at, taped)
        kept = None
        if net.dropout > 0:
            kept = draws.uniform(at, width)[:, c.cols].T >= net.dropout
            kept = kept / (1.0 - net.dropout)
            x[:-1] *= kept
        if taped:
            t.maps, t.moments, t.kept = maps, moments, kept
            tape.append(t)
    return w[f"{branch}.fc_w"][c.cols] @ x[:-1] + w[f"{branch}.fc_b"][0], x


def _block_gradient(
    grad_logit, last_x, c: Columns, w: Weights, net: NetworkConfig, branch: str,
    tape: list[_Layer], out, peers, of: str,
):
    """Add the branch's weight gradients to ``out``, last layer first; ``of`` names the loss.

    The gradient of a projection is a sum of few rows (values, gates, normed units, a mean) and
    a multiple of the centred projection, which is a map of the layer's rows. So its
    products with these are sums of products over the block's columns.
    """
    half, n_low, n, units = c.half, len(c.low), len(c.units), c.normed(net)

    def put(name: str, at, found: np.ndarray) -> None:
        out[name] = np.zeros_like(w[name])
        out[name][at] = found

    def by_unit(name: str, found: np.ndarray) -> None:
        """A unit may be read by two columns."""
        out[name] = np.zeros_like(w[name])
        np.add.at(out[name], c.units if len(found) == n else c.mid, found)

    put(f"{branch}.fc_w", c.cols, last_x[:-1] @ grad_logit)
    out[f"{branch}.fc_b"] = np.array([grad_logit.sum()])
    grad = w[f"{branch}.fc_w"][c.cols, None] * grad_logit
    for layer in reversed(range(len(tape))):
        at, t = f"{branch}.{layer}", tape[layer]
        if t.kept is not None:
            grad *= t.kept
        size = t.norm + NORM_EPS
        along = np.einsum("ij,ij->j", grad, t.bounded)
        grad *= 1.0 / size
        grad -= t.bounded * (along / (np.maximum(t.norm, NORM_EPS) * size**2))
        if t.inside is not None:
            grad *= t.inside
        g_cross = grad * t.factor[:-1]
        put(f"{at}.b", c.cols, g_cross.sum(axis=1))
        g_value, g_normed = g_cross[:n], None
        if n > n_low:
            g_normed = g_value[n_low:] * t.value[n_low:]
            g_normed *= t.mask > 0
            g_value[n_low:] *= t.mask
        # the parts of the projection's gradient: rows, and how they spread over the units
        parts, spread = [], []
        identity = np.zeros((half, n))
        identity[c.units, np.arange(n)] = 1.0
        if net.gated:
            direct = g_value * t.gate
            pre = direct * t.h
            pre *= 1.0 - t.gate
            by_unit(f"{at}.gate_w", (pre @ t.x.T) @ t.maps.h[:, c.with_one].T)
            by_unit(f"{at}.gate_b", pre.sum(axis=1))
            parts, spread = [direct, pre], [identity, w[f"{at}.gate_w"][c.units].T]
        elif net.normalise_cross:
            whole = g_value.copy()
            if g_normed is not None:
                whole[n_low:] += g_normed
            g_normed = whole
        else:
            parts, spread = [g_value], [identity]
        centred = None
        if len(units):
            by_unit(f"{at}.ln_g", np.einsum("ij,ij->i", g_normed, t.ln_z))
            by_unit(f"{at}.ln_b", g_normed.sum(axis=1))
            g_normed *= w[f"{at}.ln_g"][units, None]
            mean = g_normed.sum(axis=0)
            mean /= -half * t.sd
            centred = np.einsum("ij,ij->j", g_normed, t.ln_z)
            centred /= half * t.sd**2
            g_normed /= t.sd
            parts += [g_normed, mean[None]]
            spread += [identity[:, n - len(units):], np.ones((half, 1))]
            centred = centred * t.x
        else:
            out[f"{at}.ln_g"], out[f"{at}.ln_b"] = np.zeros(half), np.zeros(half)
        weight = w[f"{at}.w"][:, c.cols]
        parts = np.concatenate(parts) if parts else np.zeros((0, grad.shape[1]))
        spread = np.concatenate(spread, axis=1) if spread else np.zeros((half, 0))
        products = spread @ (parts @ t.x.T)
        if centred is not None:
            to_units = t.maps.centred[:, c.with_one]
            products -= to_units @ (centred @ t.x.T)
        scale = np.ones(half)
        if net.batch_norm:
            z, (rows, mean, square) = t.maps.z[:, c.with_one], t.moments
            gain, sd = w[f"{at}.bn_g"], np.sqrt(square / rows + BN_EPS)
            out[f"{at}.bn_g"], out[f"{at}.bn_b"] = (products * z).sum(axis=1), products[:, -1].copy()
            out[f"{at}.bn_mean"], out[f"{at}.bn_var"] = mean, square / max(rows - 1.0, 1.0)
            of_z, along_z = peers.merged(
                (branch, layer, of),
                np.stack([gain * out[f"{at}.bn_b"], gain * out[f"{at}.bn_g"]]), sum,
            )
            scale = gain / sd
            back = z * (along_z / rows / sd)[:, None]
            back[:, -1] += of_z / rows / sd
            products = products * scale[:, None] - back @ (t.x @ t.x.T)
        put(f"{at}.w", (slice(None), c.cols), products[:, :-1])
        if layer:
            if t.through is not None:
                grad *= t.through
            scaled = weight.T * scale
            grad += (scaled @ spread) @ parts
            if centred is not None:
                grad -= (scaled @ to_units) @ centred
            if net.batch_norm:
                grad -= (weight.T @ back) @ t.x


def scores(x: np.ndarray, w: Weights, net: NetworkConfig):
    """(joint, deep, shallow) probabilities of a dense block, evaluation mode."""
    deep, shallow = (branch_logit(x, w, net, b, n)[0] for b, n in branches(net))
    return sigmoid((deep + shallow) * 0.5), sigmoid(deep), sigmoid(shallow)


def alike(x: np.ndarray, least: int, most: int) -> Iterator[np.ndarray]:
    """The rows' numbers in groups of rows that have few columns between them: in the order
    of their nonzero columns, a group ends where these change, once it has ``least`` rows, or
    at ``most`` rows."""
    has = np.packbits(x != 0, axis=1)
    order = np.lexsort(has.T[::-1])
    changes = (has[order][1:] != has[order][:-1]).any(axis=1)
    first = 0
    for end in [*(np.flatnonzero(changes) + 1).tolist(), len(x)]:
        while end - first > most:
            yield order[first:first + most]
            first += most
        if end - first >= least:
            yield order[first:end]
            first = end
    if first < len(x):
        yield order[first:]


class PairNetwork:
    """Joint scores of users' pairs with a block of items, evaluation mode, any depth.

    The same rule as ``branch_logit``, in blocks of pairs of users and of items that have the
    same nonzero columns, or few between them. Batch norm is part of the projection.
    """

    #: Pairs of a block at most, whose working arrays stay in the cache; a block of fewer than
    #: ``LEAST`` takes further items in, of other columns. Users that are brought together.
    PAIRS, LEAST, USERS = 4096, 1024, 16

    def __init__(self, w: Weights, net: NetworkConfig, user_width: int, items: np.ndarray):
        self.w, self.net, self.user_width, self.items = w, net, user_width, items
        self.groups: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    @cached_property
    def maps(self) -> dict[str, Maps]:
        w, stats = self.w, ("bn_mean", "bn_var") if self.net.batch_norm else ()
        return {
            at: Maps.of(w, self.net, at, *[w[f"{at}.{k}"] for k in stats])
            for b, layers in branches(self.net) for at in (f"{b}.{k}" for k in range(layers))
        }

    def _groups(self, n_users: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Groups of items for so many users: their numbers, and their columns."""
        if n_users not in self.groups:
            least, most = -(-self.LEAST // n_users), max(1, self.PAIRS // n_users)
            self.groups[n_users] = [
                (at, np.flatnonzero((self.items[at] != 0).any(axis=0)))
                for at in alike(self.items, min(least, most), most)
            ]
        return self.groups[n_users]

    def __call__(self, users: np.ndarray) -> np.ndarray:
        """Scores of the items for one user, or [users, items]."""
        if users.ndim == 1:
            return self(users[None])[0]
        out = np.empty((len(users), len(self.items)))
        for who in alike(users, self.USERS, self.PAIRS):
            some = users[who]
            own = np.flatnonzero((some != 0).any(axis=0))
            for at, cols in self._groups(len(who)):
                c = Columns(np.append(own, cols + self.user_width),
                            self.user_width + self.items.shape[1])
                x = np.ones((len(c.cols) + 1, len(who), len(at)))
                x[:len(own)] = some[:, own].T[:, :, None]
                x[len(own):-1] = self.items[np.ix_(at, cols)].T[:, None]
                x = x.reshape(len(x), -1)
                logits = [self._logit(x, c, b, layers) for b, layers in branches(self.net)]
                out[np.ix_(who, at)] = sigmoid((logits[0] + logits[1]) * 0.5).reshape(
                    len(who), len(at)
                )
        return out

    def _logit(self, x0: np.ndarray, c: Columns, branch: str, layers: int) -> np.ndarray:
        w, x = self.w, x0
        for at in (f"{branch}.{layer}" for layer in range(layers)):
            x, _ = _layer(x, x0, c, c.rows(self.maps[at], self.net), w, self.net, at, False)
        return w[f"{branch}.fc_w"][c.cols] @ x[:-1] + w[f"{branch}.fc_b"][0]


class RowDraws:
    """Uniform numbers that depend on a row's key, a layer and a unit, and on nothing else."""

    def __init__(self, seed: int, row_keys: np.ndarray):
        self.seed, self.keys = seed, row_keys.astype(np.int64).view(np.uint64)

    def uniform(self, at: str, width: int) -> np.ndarray:
        unit = _mixed(np.arange(width, dtype=np.uint64) + np.uint64(zlib.crc32(at.encode()) << 20))
        unit = _mixed(unit ^ np.uint64(self.seed % 2**64))
        return (_mixed(_mixed(self.keys)[:, None] ^ unit) >> np.uint64(11)) * 2.0**-53


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads each bit over all others."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def loss_and_gradient_sums(
    x: np.ndarray, y: np.ndarray, w: Weights, net: NetworkConfig, pos_weight: float, draws,
    peers=None,
) -> tuple[np.ndarray, Weights, Weights, np.ndarray]:
    """Sums over one block, which add up over blocks: the joint, deep and shallow losses, the
    gradient of the joint loss, the gradients of each branch's own loss; and the scores.

    Blocks that are ``peers`` share their batch statistics; where these are not known yet,
    both branches go as far as they get, and it ``Waits``."""
    peers = peers or Alone()
    tapes, logits, lasts, waits = {}, {}, {}, False
    c = Columns(np.flatnonzero((x != 0).any(axis=0)), x.shape[1])
    x0 = np.ones((len(c.cols) + 1, len(x)))
    x0[:-1] = x.T[c.cols]
    for b, layers in branches(net):
        tapes[b] = []
        try:
            logits[b], lasts[b] = _block_logit(x0, c, w, net, b, layers, draws, tapes[b], peers)
        except Waits:
            waits = True
    if waits:
        raise Waits
    weight = np.where(y == 1, pos_weight, 1.0)
    joint = sigmoid((logits["deep"] + logits["shallow"]) * 0.5)

    def loss(p):
        with np.errstate(divide="ignore"):
            hit, miss = np.maximum(np.log(p), -100.0), np.maximum(np.log(1 - p), -100.0)
        return float((-weight * (y * hit + (1 - y) * miss)).sum())

    losses, of_joint, of_own = [loss(joint)], {}, {}
    for b in logits:
        p = sigmoid(logits[b])
        losses.append(loss(p))
        for of, grad, out in (("joint", (joint - y) * 0.5, of_joint), ("own", p - y, of_own)):
            try:
                _block_gradient(weight * grad, lasts[b], c, w, net, b, tapes[b], out, peers, of)
            except Waits:
                waits = True
    if waits:
        raise Waits
    for k in of_joint:
        if is_statistic(k):  # a block's statistic counts with its rows
            of_joint[k], of_own[k] = of_joint[k] * len(y), np.zeros_like(of_own[k])
    return np.array(losses), of_joint, of_own, joint


def combined(
    n: float, losses: np.ndarray, of_joint: Weights, of_own: Weights
) -> tuple[float, Weights]:
    """Loss of the whole batch and its gradient, from the summed parts of its blocks.

    Each branch adds its own loss times how far it lies above the joint loss; these factors
    are those of the whole batch.
    """
    base, deep, shallow = losses / n
    total, slope, slopes = base, 1.0, {}
    for b, own in (("deep", deep), ("shallow", shallow)):
        excess = max(own - base, 0.0)
        total += own * excess
        slope -= own if excess > 0 else 0.0
        slopes[b] = 2 * own - base if excess > 0 else 0.0
    return float(total), {
        k: (g if is_statistic(k) else slope * g + slopes[k.split(".")[0]] * of_own[k]) / n
        for k, g in of_joint.items()
    }


def loss_and_gradient(
    x: np.ndarray, y: np.ndarray, w: Weights, net: NetworkConfig, pos_weight: float, draws
):
    """Joint-plus-branches loss of one block, its gradient, and the joint scores."""
    losses, of_joint, of_own, joint = loss_and_gradient_sums(x, y, w, net, pos_weight, draws)
    return *combined(len(y), losses, of_joint, of_own), joint
