import math

import numpy as np
import pytest

from tastegrid.config import DOMAINS, NetworkConfig
from tastegrid.operators import network as N

VARIANTS = {name: DOMAINS[name].network for name in ("movie", "clip", "all")}


def slow_logit(x, w, net: NetworkConfig, branch, layers):
    """The layer rule for one row, written with plain loops."""
    d = len(x)
    h = d // 2
    x0, x = list(x), list(x)
    for layer in range(layers):
        def get(name, at=f"{branch}.{layer}"):
            return w[f"{at}.{name}"]

        proj = [sum(get("w")[j][i] * x[i] for i in range(d)) for j in range(h)]
        if net.batch_norm:
            proj = [(proj[j] - get("bn_mean")[j]) / math.sqrt(get("bn_var")[j] + 1e-5)
                    * get("bn_g")[j] + get("bn_b")[j] for j in range(h)]
        mean = sum(proj) / h
        var = sum((p - mean) ** 2 for p in proj) / h
        normed = [(p - mean) / math.sqrt(var + 1e-5) * get("ln_g")[j] + get("ln_b")[j]
                  for j, p in enumerate(proj)]
        value = normed if net.normalise_cross else proj
        if net.gated:
            value = [proj[j] / (1 + math.exp(-(sum(get("gate_w")[j][k] * proj[k]
                                                   for k in range(h)) + get("gate_b")[j])))
                     for j in range(h)]
        cross = [*value, *[v * max(n, 0.0) for v, n in zip(value, normed, strict=True)],
                 *[0.0] * (d - 2 * h)]
        factor = x if branch == "deep" and net.chain_deep else x0
        z = [factor[i] * (cross[i] + get("b")[i]) + x[i] for i in range(d)]
        z = [min(max(v, -net.clip), net.clip) for v in z]
        size = math.sqrt(sum(v * v for v in z)) + 1e-12
        x = [v / size for v in z]
    return sum(a * b for a, b in zip(x, w[f"{branch}.fc_w"], strict=True)) + w[f"{branch}.fc_b"][0]


def random_weights(d, net, seed):
    rng = np.random.default_rng(seed)
    w = N.init_weights(d, net, seed)
    for k in w:
        if not k.endswith("bn_var"):
            w[k] = w[k] + rng.normal(0, 0.3, w[k].shape)
    return w


@pytest.mark.parametrize("width", [4, 5])
@pytest.mark.parametrize("name", list(VARIANTS))
def test_forward_follows_the_layer_rule(name, width):
    net = VARIANTS[name]
    w = random_weights(width, net, 1)
    x = np.random.default_rng(2).normal(size=(6, width)) * 3
    joint, deep, shallow = N.scores(x, w, net)
    for i, row in enumerate(x):
        d = slow_logit(row, w, net, "deep", net.deep_layers)
        s = slow_logit(row, w, net, "shallow", net.shallow_layers)
        assert deep[i] == pytest.approx(1 / (1 + math.exp(-d)))
        assert shallow[i] == pytest.approx(1 / (1 + math.exp(-s)))
        assert joint[i] == pytest.approx(1 / (1 + math.exp(-(d + s) / 2)))


class SameDraws:
    """Drops the same units on every call."""

    def uniform(self, at, width):
        return np.random.default_rng(1).random((20, width))


@pytest.mark.parametrize("width", [6, 7])
@pytest.mark.parametrize("name", list(VARIANTS))
def test_gradient_matches_differences(name, width):
    net = VARIANTS[name]
    rng = np.random.default_rng(0)
    w = random_weights(width, net, 3)
    x = rng.normal(size=(20, width))
    y = (rng.random(20) > 0.5).astype(float)
    _, grad, _ = N.loss_and_gradient(x, y, w, net, 1.7, SameDraws())
    for k in w:
        if N.is_statistic(k):
            continue
        at = tuple(rng.integers(0, n) for n in w[k].shape)
        kept, sides = w[k][at], []
        for step in (1e-6, -1e-6):
            w[k][at] = kept + step
            sides.append(N.loss_and_gradient(x, y, w, net, 1.7, SameDraws())[0])
        w[k][at] = kept
        assert grad[k][at] == pytest.approx((sides[0] - sides[1]) / 2e-6, abs=1e-6), k


@pytest.mark.parametrize("name", list(VARIANTS))
def test_blocks_take_part_with_the_columns_that_they_have(name, monkeypatch):
    """One-hot rows: sums of blocks with few columns each are those of all rows in one block."""
    net, width, rng = VARIANTS[name], 41, np.random.default_rng(5)
    w = random_weights(width, net, 3)
    x, y = np.zeros((120, width)), (rng.random(120) > 0.5).astype(float)
    x[:, 0] = rng.normal(size=120)
    for k in range(1, 119):  # the last row has no column at all
        x[k, [1 + k % 20, 21 + k % 19]] = 1.0
    x[119] = 0.0
    losses, *wanted, scores = N.loss_and_gradient_sums(
        x, y, w, net, 1.7, N.RowDraws(5, np.arange(120)))
    seen, made = [], N.Columns
    monkeypatch.setattr(N, "Columns", lambda cols, width: seen.append(len(cols)) or made(cols, width))
    groups, passes = [*N.alike(x, 1, 50)], N.Passes()
    assert sorted(np.concatenate(groups)) == list(range(120))
    while True:
        found, waits = [], False
        for at in groups:
            try:
                found.append(N.loss_and_gradient_sums(
                    x[at], y[at], w, net, 1.7, N.RowDraws(5, at), passes))
            except N.Waits:
                waits = True
        if not waits:
            break
        passes.settle(lambda part: [part])
    assert max(seen) <= 3
    assert sum(f[0] for f in found) == pytest.approx(losses)
    for of in (0, 1):
        for k in w:
            assert sum(f[1 + of][k] for f in found) == pytest.approx(wanted[of][k], abs=1e-9), k
    assert np.concatenate([f[3] for f in found]) == pytest.approx(scores[np.concatenate(groups)])


def test_alike_rows_come_together():
    x = np.array([[1.0, 0, 0], [0, 2, 0], [3, 0, 0], [0, 0, 4], [0, 5, 0], [0, 0, 0]])
    found = [sorted(g.tolist()) for g in N.alike(x, 1, 9)]
    assert sorted(found) == [[0, 2], [1, 4], [3], [5]]
    assert [len(g) for g in N.alike(x, 3, 9)] == [4, 2] and [*N.alike(x[:0], 1, 9)] == []
    assert max(len(g) for g in N.alike(np.ones((7, 2)), 1, 3)) == 3
