import numpy as np
import pyarrow as pa
import pytest

from tastegrid.config import DOMAINS, NetworkConfig
from tastegrid.operators import network as N
from tastegrid.operators import ranking as R
from tastegrid.operators import scoring as S

USER_WIDTH, ITEM_WIDTH = 5, 14


def sparse(x):
    at = np.flatnonzero(x)
    return [int(i) for i in at], [float(x[i]) for i in at]


@pytest.fixture(scope="module")
def sides():
    rng = np.random.default_rng(4)
    users = np.where(rng.random((9, USER_WIDTH)) < 0.6, rng.normal(size=(9, USER_WIDTH)), 0.0)
    items = np.where(rng.random((60, ITEM_WIDTH)) < 0.5, rng.normal(size=(60, ITEM_WIDTH)), 0.0)
    items[7] = items[3]  # equal scores
    return users, items


@pytest.fixture(scope="module")
def frames(spark, sides):
    users, items = sides
    profiles = spark.createDataFrame(
        [(100 + i // 2, f"u{i}", *sparse(x)) for i, x in enumerate(users)],
        "profile_id bigint, username string, idx array<int>, val array<double>")
    contents = spark.createDataFrame(
        [(f"c{i}", i, *sparse(x)) for i, x in enumerate(items)],
        "content_id string, item_ord bigint, idx array<int>, val array<double>")
    return profiles, contents


def brute_force(sides, w, net, n):
    users, items = sides
    best = {}
    for u, x in enumerate(users):
        s = np.round(N.scores(np.hstack([np.tile(x, (len(items), 1)), items]), w, net)[0],
                     S.SCORE_PLACES)
        for i, score in enumerate(s):
            key = (100 + u // 2, i)
            best[key] = max(best.get(key, -1.0), score)
    out = {}
    for pid in {p for p, _ in best}:
        order = sorted((i for p, i in best if p == pid), key=lambda i: (-best[pid, i], i))[:n]
        out[pid] = [(f"c{i}", best[pid, i]) for i in order]
    return out


NETS = {**{k: DOMAINS[k].network for k in ("movie", "clip", "all")},
        "tight": NetworkConfig(1, 1, clip=0.7, dropout=0.0, normalise_cross=True)}


@pytest.mark.parametrize("plan", [
    {}, {"tasks": 1}, {"max_item_bytes": 6_000, "tile_classes": 4}])
@pytest.mark.parametrize("name", list(NETS))
def test_top_n_equals_brute_force(spark, sides, frames, name, plan, monkeypatch):
    net = NETS[name]
    w = N.init_weights(USER_WIDTH + ITEM_WIDTH, net, 8)
    w = {k: v if N.is_statistic(k) else v * 1.5 for k, v in w.items()}
    pairs = S.best_pairs(*frames, w, net, USER_WIDTH, ITEM_WIDTH, 8, **plan)
    rows = R.top_n(pairs, 8).orderBy("profile_id", "rank").collect()
    got = {}
    for r in rows:
        got.setdefault(r.profile_id, []).append((r.content_id, r.score))
    wanted = brute_force(sides, w, net, 8)
    assert {p: [c for c, _ in v] for p, v in got.items()} == {
        p: [c for c, _ in v] for p, v in wanted.items()}
    for p, v in got.items():
        assert [s for _, s in v] == pytest.approx([s for _, s in wanted[p]])


@pytest.mark.parametrize("piece", [7, 4096])
def test_pieces_do_not_change_the_best(sides, monkeypatch, piece):
    monkeypatch.setattr(S, "PIECE_ITEMS", piece)
    users, items = sides
    net = NETS["movie"]
    w = N.init_weights(USER_WIDTH + ITEM_WIDTH, net, 8)
    block = S.ItemBlock(np.array([f"c{i}" for i in range(60)], dtype=object), np.arange(60), items)
    joined = np.hstack([s(users) for _, s in S._scorers(block, USER_WIDTH, w, net)])
    dense = np.vstack([N.scores(np.hstack([np.tile(u, (60, 1)), items]), w, net)[0] for u in users])
    assert np.abs(joined - dense).max() <= 0.51 * 10.0**-S.SCORE_PLACES


def test_largest_keeps_the_first_of_equals():
    assert list(S.largest(np.array([1.0, 3.0, 3.0, 0.0, 3.0]), 2)) == [1, 2]
    assert list(S.largest(np.array([1.0, 2.0]), 5)) == [0, 1]


def test_fewer_items_than_n(spark, frames):
    net = NETS["movie"]
    w = N.init_weights(USER_WIDTH + ITEM_WIDTH, net, 8)
    few = frames[1].where("item_ord < 3")
    assert S.best_pairs(frames[0], few, w, net, USER_WIDTH, ITEM_WIDTH, 8).count() == 27


def test_width_must_match(frames):
    net = NETS["movie"]
    w = N.init_weights(USER_WIDTH + ITEM_WIDTH + 1, net, 8)
    with pytest.raises(ValueError, match="model width"):
        S.best_pairs(*frames, w, net, USER_WIDTH, ITEM_WIDTH, 8)


def test_scores_do_not_depend_on_partitions(spark, frames):
    net = NETS["all"]
    w = N.init_weights(ITEM_WIDTH, net, 8)
    one = S.score_rows(frames[1].coalesce(1), w, net, ITEM_WIDTH, ["content_id"]).collect()
    many = S.score_rows(frames[1].repartition(6), w, net, ITEM_WIDTH, ["content_id"]).collect()
    a, b = ({r.content_id: tuple(r)[1:] for r in rows} for rows in (one, many))
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k]) and all(0 < s < 1 for s in a[k])


@pytest.mark.parametrize("items_at_once", [5, 512])
@pytest.mark.parametrize("name", list(NETS))
def test_pair_network_follows_the_layer_rule(sides, name, items_at_once, monkeypatch):
    monkeypatch.setattr(N.PairNetwork, "PAIRS", items_at_once)
    users, items = sides
    w = N.init_weights(USER_WIDTH + ITEM_WIDTH, NETS[name], 8)
    rng = np.random.default_rng(4)
    w = {k: v + rng.uniform(0.0, 0.3, v.shape) for k, v in w.items()}
    scorer = N.PairNetwork(w, NETS[name], USER_WIDTH, items)
    for user in users:
        pairs = np.hstack([np.tile(user, (len(items), 1)), items])
        assert np.abs(scorer(user) - N.scores(pairs, w, NETS[name])[0]).max() < 1e-14


def test_blocks_of_few_items_do_not_give_all_pairs(frames, monkeypatch):
    """However small a block may be, what blocks give is a small share of the pairs."""
    net, made = NETS["movie"], []
    plan = S._grid_plan
    monkeypatch.setattr(
        S, "_grid_plan", lambda *a: made.append(a[-2]) or plan(*a))
    w = N.init_weights(USER_WIDTH + ITEM_WIDTH, net, 8)
    for lists, blocks in ((256, 1), (10, 3)):
        monkeypatch.setattr(S, "BLOCK_LISTS", lists)
        pairs = S.best_pairs(*frames, w, net, USER_WIDTH, ITEM_WIDTH, 2, max_item_bytes=1,
                             tile_classes=3)
        assert pairs.count() == frames[0].count() * blocks * 2 and made[-1] == blocks


def test_few_classes_stream_past_blocks_of_items(spark, frames, sides):
    """Few classes, many items: no group of items is brought together in a task's Python."""
    net, piece = NETS["movie"], 7
    w = N.init_weights(USER_WIDTH + ITEM_WIDTH, net, 8)
    classes = S.stored(S.classes_of(S.with_class(frames[0])), "classes")
    plan = {"max_item_bytes": 6_000, "tile_classes": 1_000}
    found = S.best_of_classes(classes, frames[1], w, net, USER_WIDTH, ITEM_WIDTH, 8, **plan)
    assert "CoGroup" not in found._jdf.queryExecution().optimizedPlan().toString()
    columns = (*S.CLASS, "rank", "content_id", "score")
    wanted = S.best_of_classes(classes, frames[1], w, net, USER_WIDTH, ITEM_WIDTH, 8)
    got, want = ({tuple(r[c] for c in columns) for r in R.top_n(x, 8, by=S.CLASS).collect()}
                 for x in (found, wanted))
    assert got == want and len(got) == 8 * classes.count()

    block = pa.table({
        "content_id": [f"c{i:02}" for i in range(60)], "item_ord": list(range(60)),
        "idx": pa.array([np.flatnonzero(x) for x in sides[1]], pa.list_(pa.int32())),
        "val": pa.array([x[x != 0] for x in sides[1]], pa.list_(pa.float64())),
    })
    held = classes.toArrow()
    whole = S._best_items(held, S.SparseItems(block, ITEM_WIDTH), w, net, USER_WIDTH, 8)
    pieces = S._best_streamed(
        held, iter(block.to_batches(max_chunksize=piece)), w, net, USER_WIDTH, ITEM_WIDTH, 8)
    assert pa.Table.from_batches(pieces).equals(pa.Table.from_batches(whole))


@pytest.fixture(scope="module")
def one_hot():
    """Rows of few columns each, many of them equal: (users, items, wanted lists of 8)."""
    rng, net = np.random.default_rng(9), NETS["all"]
    users, items = np.zeros((40, 12)), np.zeros((600, 60))
    for k, u in enumerate(users):
        u[[0, 1 + k % 11]] = rng.normal(), 1.0
    for k, i in enumerate(items):
        i[[0, 1 + k % 20, 21 + k % 38]] = 1 + k % 4, 1.0, 1.0
    w = N.init_weights(72, net, 8)
    w = {k: v + rng.uniform(0.0, 0.3, v.shape) for k, v in w.items()}
    wanted = []
    for u in users:
        pairs = np.hstack([np.tile(u, (600, 1)), items])
        s = np.round(N.scores(pairs, w, net)[0], S.SCORE_PLACES)
        order = (np.arange(600) * 7) % 600  # of the catalogue
        wanted.append({(f"c{order[i]:03}", s[i]) for i in np.lexsort((order, -s))[:8]})
    return users, items, w, wanted


def as_lists(x):
    return {"idx": pa.array([np.flatnonzero(r) for r in x], pa.list_(pa.int32())),
            "val": pa.array([r[r != 0] for r in x], pa.list_(pa.float64()))}


@pytest.mark.parametrize("streamed", [True, False])
@pytest.mark.parametrize("piece", [50, 4096])
def test_deep_lists_of_items_that_come_by_their_columns(one_hot, streamed, piece, monkeypatch):
    """Equal scores go by catalogue order though items do not come in it."""
    users, items, w, wanted = one_hot
    monkeypatch.setattr(S, "PIECE_ITEMS", piece)
    order = (np.arange(600) * 7) % 600
    table = pa.table({"content_id": [f"c{k:03}" for k in order], "item_ord": order, **as_lists(items)})
    held = pa.table({"class_a": np.arange(40), "class_b": np.arange(40), **as_lists(users)})
    seen, logit = [], N.PairNetwork._logit

    def counted(self, x0, c, branch, layers):
        seen.append((branch, x0.shape[1], len(c.cols)))
        return logit(self, x0, c, branch, layers)

    monkeypatch.setattr(N.PairNetwork, "_logit", counted)
    monkeypatch.setattr(N.PairNetwork, "LEAST", 1)
    monkeypatch.setattr(N.PairNetwork, "USERS", 1)
    if streamed:
        by = S.SparseItems(table, 60).alike().table.combine_chunks()
        found = S._best_streamed(held, iter(by.to_batches(max_chunksize=piece)), w, NETS["all"],
                                 12, 60, 8)
    else:
        found = S._best_items(held, S.SparseItems.from_arrow(table, 60), w, NETS["all"], 12, 8)
    got = {}
    for r in pa.Table.from_batches(found).to_pylist():
        got.setdefault(r["class_a"], set()).add((r["content_id"], r["score"]))
    for k, best in enumerate(wanted):
        assert {c for c, _ in got[k]} == {c for c, _ in best}
        assert sorted(s for _, s in got[k]) == pytest.approx(sorted(s for _, s in best))
    assert max(n for _, _, n in seen) <= 5  # of 72
    for branch in ("deep", "shallow"):
        assert sum(n for b, n, _ in seen if b == branch) == 40 * 600


def test_deep_streamed_plan_gives_the_lists_of_the_broadcast_plan(spark, one_hot):
    users, items, w, wanted = one_hot
    order = (np.arange(600) * 7) % 600
    classes = S.stored(spark.createDataFrame(
        [(k, k, *sparse(u)) for k, u in enumerate(users)],
        "class_a bigint, class_b bigint, idx array<int>, val array<double>"), "classes")
    contents = spark.createDataFrame(
        [(f"c{order[k]:03}", int(order[k]), *sparse(i)) for k, i in enumerate(items)],
        "content_id string, item_ord bigint, idx array<int>, val array<double>")
    for plan in ({}, {"max_item_bytes": 6_000, "tile_classes": 1_000}):
        best = S.best_of_classes(classes, contents, w, NETS["all"], 12, 60, 8, **plan)
        got = {}
        for r in R.top_n(best, 8, by=S.CLASS).collect():
            got.setdefault(r.class_a, set()).add(r.content_id)
        assert [got[k] for k in range(40)] == [{c for c, _ in b} for b in wanted]
