"""Stored tables that know what they were made from, and scoring that goes on where it ended."""

import numpy as np
import pytest

from tastegrid.config import DOMAINS
from tastegrid.operators import network as N
from tastegrid.operators import scoring as S
from tastegrid.operators.encoding import Encoder, user_spec
from tastegrid.plans import recommend, score_store
from tastegrid.plans.feature_build import Features
from tastegrid.sources import manifests

USER_WIDTH, ITEM_WIDTH = 5, 14


def test_tables_are_built_again_when_something_changed(spark, tmp_path):
    folder, table, built = tmp_path / "in", str(tmp_path / "t"), []
    folder.mkdir()
    (folder / "a.txt").write_text("1")

    def read(stale="rebuild", **settings):
        now = manifests.origin(spark, {"files": (str(folder), "*.txt")}, **settings)

        def build():
            built.append(settings)
            return spark.range(len(built))

        return manifests.build_if_changed(spark, table, now, build, stale).count()

    assert [read(year=1), read(year=1), read(year=2), read(year=2)] == [1, 1, 2, 2]
    (folder / "b.txt").write_text("2")
    (folder / "c.json").write_text("not an input")
    with pytest.raises(manifests.StaleTable, match="other files"):
        read("fail", year=2)
    assert read("keep", year=2) == 2 and read(year=2) == 3 and read("fail", year=2) == 3
    (folder / "b.txt").write_text("a longer text")
    assert read(year=2) == 4
    with pytest.raises(ValueError, match="stale"):
        read("maybe")


def test_a_table_whose_build_ended_early_counts_as_changed(spark, tmp_path):
    table = str(tmp_path / "t")
    now = {"x": "1"}
    manifests.build_if_changed(spark, table, now, lambda: spark.range(3))

    def fails():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        manifests.build_if_changed(spark, table, {"x": "2"}, fails)
    assert manifests.made_from(spark, table) is None and manifests.changed(spark, table, now) == ["x"]
    spark.range(9).write.mode("overwrite").parquet(table)  # by someone else, without a note
    assert manifests.build_if_changed(spark, table, now, lambda: spark.range(4)).count() == 4


def test_rows_print_does_not_depend_on_order_but_on_repeats(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, "c")], "k int, v string")
    one = manifests.rows_print(rows, "k", "v")
    assert manifests.rows_print(rows.orderBy("v").repartition(3), "k", "v") == one
    assert manifests.rows_print(rows.unionAll(rows), "k", "v") != one
    assert manifests.rows_print(rows.limit(0), "k", "v").startswith("0 rows")


@pytest.fixture(scope="module")
def world(spark):
    """Forty users of twelve classes, some of whom share a profile."""
    rng = np.random.default_rng(3)

    def sparse(x):
        at = np.flatnonzero(x)
        return [int(i) for i in at], [float(x[i]) for i in at]

    kinds = np.where(rng.random((12, USER_WIDTH)) < 0.7, rng.normal(size=(12, USER_WIDTH)), 0.0)
    things = np.where(rng.random((50, ITEM_WIDTH)) < 0.5, rng.normal(size=(50, ITEM_WIDTH)), 0.0)
    users = spark.createDataFrame(
        [(f"u{k}", *sparse(kinds[k % 12])) for k in range(40)],
        "username string, idx array<int>, val array<double>")
    items = spark.createDataFrame(
        [(f"c{k}", k, *sparse(x)) for k, x in enumerate(things)],
        "content_id string, item_ord bigint, idx array<int>, val array<double>")
    log = spark.createDataFrame(
        [(f"u{k}", 100 + k // 2 if k < 10 else 100 + k, ) for k in range(40)] * 3,
        "username string, profile_id bigint")
    net = DOMAINS["movie"].network
    weights = N.init_weights(USER_WIDTH + ITEM_WIDTH, net, 8)

    class Width(Encoder):
        width = 0

    user, item = (Width(user_spec(), None, {}) for _ in range(2))
    user.width, item.width = USER_WIDTH, ITEM_WIDTH
    return log, Features(user, item, users, items), weights


def lists(ranking):
    return sorted(map(tuple, ranking.by_profile().collect()))


def test_profiles_share_the_lists_of_their_class(world):
    log, features, weights = world
    found = recommend.rank_profiles(log, features, weights, DOMAINS["movie"], 6)
    assert found.classes.select(*S.CLASS).distinct().count() == 12
    assert found.mixed.count() == 5 and found.alike.count() == 30
    assert len(lists(found)) == 35 * 6
    # by rows: every user of a profile scored, the best of each content
    from tastegrid.operators import ranking as R
    pairs = S.best_pairs(
        R.profile_features(log, features.users), features.items, weights,
        DOMAINS["movie"].network, USER_WIDTH, ITEM_WIDTH, 6)
    columns = ("profile_id", "content_id", "score", "item_ord", "rank")
    assert lists(found) == sorted(map(tuple, R.top_n(pairs, 6).select(*columns).collect()))


def test_a_run_that_ended_half_way_is_completed(spark, world, tmp_path, monkeypatch):
    log, features, weights = world
    domain, path = DOMAINS["movie"], str(tmp_path / "ranks")
    asked, lost = [], []
    best = S.best_of_classes

    def counted(classes, *rest, **plan):
        asked.append(classes.count())
        if len(asked) == 3 and not lost:
            lost.append(True)
            raise RuntimeError("executors lost")
        return best(classes, *rest, **plan)

    monkeypatch.setattr(S, "best_of_classes", counted)

    def run(log, features=features, weights=weights, n=6):
        store = score_store.ScoreStore.of(spark, path, features.items, weights, n, wave_pairs=100)
        return store, recommend.rank_profiles(log, features, weights, domain, n, store=store)

    with pytest.raises(RuntimeError, match="lost"):
        run(log)
    done = sum(asked[:2])
    assert 0 < done < 12
    _, found = run(log)
    assert sum(asked[3:]) == 12 - done
    once = recommend.rank_profiles(log, features, weights, domain, 6)
    assert lists(found) == lists(once)
    asked.clear()
    store, again = run(log)
    assert asked == [] and lists(again) == lists(once)

    # one user changes: only the class that is new is scored
    from pyspark.sql import functions as F
    changed = Features(
        features.user_encoder, features.item_encoder,
        features.users.withColumn("val", F.when(
            F.col("username") == "u39", F.transform("val", lambda v: v + 1.0)
        ).otherwise(F.col("val"))), features.items)
    run(log, changed)
    assert asked == [1]
    asked.clear()

    # other items, another model or another number of places share nothing with it
    run(log, n=5)
    assert sum(asked) == 12 and store.committed().count() == 13 * 6
    store.forget_others()
    asked.clear()
    run(log)
    assert asked == []


def test_waves_are_bounded(spark, world, tmp_path, monkeypatch):
    log, features, weights = world
    monkeypatch.setattr(score_store, "MAX_WAVES", 3)
    store = score_store.ScoreStore.of(
        spark, str(tmp_path / "ranks"), features.items, weights, 6, wave_pairs=1)
    found = recommend.rank_profiles(log, features, weights, DOMAINS["movie"], 6, store=store)
    assert store._log().count() == 3 and sum(r.classes for r in store._log().collect()) == 12
    once = recommend.rank_profiles(log, features, weights, DOMAINS["movie"], 6)
    assert lists(found) == lists(once)


def test_an_empty_log_and_no_items(spark, world):
    log, features, weights = world
    empty = recommend.rank_profiles(log.limit(0), features, weights, DOMAINS["movie"], 6)
    assert lists(empty) == []
    none = Features(features.user_encoder, features.item_encoder, features.users,
                    features.items.limit(0))
    assert lists(recommend.rank_profiles(log, none, weights, DOMAINS["movie"], 6)) == []
