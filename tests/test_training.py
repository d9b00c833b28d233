import dataclasses
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastegrid.config import DOMAINS, NetworkConfig
from tastegrid.operators import network as N
from tastegrid.operators import training as T
from tastegrid.plans.fit_model import fit_model
from tastegrid.session import checkpoint_dir

WIDTH = 8
NAMES = [f"f{i}" for i in range(WIDTH)]
HISTORY = [c.split()[0] for c in T.HISTORY_SCHEMA.split(", ")]


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, WIDTH))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.1 * rng.normal(size=900) > 0).astype(int)
    rows = [(i, int(y[i]), list(range(WIDTH)), [float(v) for v in x[i]]) for i in range(900)]
    return spark.createDataFrame(
        rows, "row_key bigint, label int, idx array<int>, val array<double>").cache()


def domain(name, **changes):
    return dataclasses.replace(DOMAINS[name], batch_rows=64, **changes)


@pytest.mark.parametrize("name", ["movie", "all"])
def test_training_learns_a_planted_signal(matrix, name):
    config = domain(name, learning_rate=0.05)
    kept = []
    model, history = fit_model(matrix, NAMES, config, rounds=1, epochs=4, batch_rows=180,
                               train_auc=name == "movie", on_best=kept.append)
    losses = [h[HISTORY.index("val_loss")] for h in history]
    assert len(history) == 4 and losses[-1] < losses[0]
    assert history[-1][-1] > 0.75  # validation AUC
    assert model.loss == min(losses) and kept[-1] is model
    if name == "movie":
        assert history[-1][HISTORY.index("train_auc")] > 0.75


@pytest.mark.parametrize("name,dropout", [("movie", 0.0), ("movie", 0.3), ("music", 0.1)])
def test_gradient_does_not_depend_on_partitions(matrix, name, dropout):
    config = dataclasses.replace(
        DOMAINS[name], batch_rows=100,
        network=dataclasses.replace(DOMAINS[name].network, dropout=dropout))
    w = N.init_weights(WIDTH, config.network, 1)
    ordered = matrix.orderBy("row_key").collect()
    x = np.array([r.val for r in ordered])
    y = np.array([r.label for r in ordered], dtype=float)
    draws = N.RowDraws(7, np.array([r.row_key for r in ordered]))
    loss, wanted, _ = N.loss_and_gradient(x, y, w, config.network, 1.3, draws)
    for parts in (1, 8, 32):
        sums, grad = T.read_sums(
            T.gradient_sums(matrix.repartition(parts), w, config, WIDTH, 1.3, 7), w)
        assert sums["n"] == 900 and sums["loss"] / 900 == pytest.approx(loss)
        for k in w:
            assert grad[k] == pytest.approx(wanted[k], abs=1e-9), (parts, k)


@pytest.mark.parametrize("name,steps,counts", [
    ("movie", 4, (1, 3)), ("batch norm", 2, (1, 2)), ("all", 4, (1,))])
def test_an_epoch_is_the_loop_over_its_steps(matrix, name, steps, counts):
    """Whatever the number of tasks, also where batch statistics are those of all of them."""
    config = domain("all" if name == "batch norm" else name, learning_rate=0.02)
    if name == "batch norm":
        config = dataclasses.replace(config, network=NetworkConfig(
            1, 1, clip=10.0, dropout=0.1, batch_norm=True, gated=True))
    tenth = F.pmod("row_key", F.lit(10))
    rows = matrix.withColumn("batch", F.when(tenth < 6, 0).when(
        (tenth < 9) | (F.lit(steps) < 4), 1).otherwise(3))  # no rows in step 2
    w = N.init_weights(WIDTH, config.network, 1)
    ordered = rows.orderBy("row_key").collect()
    adam, now, loss = T.Adam.of(config), dict(w), 0.0
    for step in range(steps):
        some = [r for r in ordered if r.batch == step]
        if some:
            draws = N.RowDraws(step * 7919 + 5, np.array([r.row_key for r in some]))
            part, grad, _ = N.loss_and_gradient(
                np.array([r.val for r in some]), np.array([r.label for r in some], float), now,
                config.network, 1.3, draws)
            now, loss = adam.update(now, grad), loss + part * len(some)
    for tasks in counts:
        passed = T.epoch_pass(rows, w, T.Adam.of(config), config, WIDTH, 1.3, steps, 5, tasks)
        assert passed.totals["loss"] == pytest.approx(loss) and passed.totals["n"] == 900
        assert passed.optimiser.step == adam.step == min(steps, 3)
        for k in w:
            assert passed.weights[k] == pytest.approx(now[k], abs=1e-9), (tasks, k)
            assert passed.gradient[k] == pytest.approx(grad[k], abs=1e-9), (tasks, k)
        for k, a in adam.state().items():
            assert passed.optimiser.state()[k] == pytest.approx(a, abs=1e-9)


@pytest.mark.parametrize("name", ["movie", "all"])
@pytest.mark.parametrize("size", [64, 450, 900])
def test_a_batch_of_any_size_is_read_in_blocks(name, size, monkeypatch):
    """A task holds one block of a batch, also where batch statistics are those of all rows."""
    config = dataclasses.replace(DOMAINS[name], batch_rows=size)
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(900, WIDTH)), (rng.random(900) > 0.5).astype(float)
    w = N.init_weights(WIDTH, config.network, 1)
    loss, wanted, _ = N.loss_and_gradient(x, y, w, config.network, 1.3,
                                          N.RowDraws(11, np.arange(900)))
    whole = pa.RecordBatch.from_pydict({
        "row_key": np.arange(900), "idx": [list(range(WIDTH))] * 900, "val": x.tolist(),
        "label": y, "batch": np.zeros(900, np.int32)})
    seen, sums = [], N.loss_and_gradient_sums
    monkeypatch.setattr(N, "loss_and_gradient_sums",
                        lambda x, *more: seen.append(len(x)) or sums(x, *more))
    batches = [whole.slice(k, 130) for k in range(0, 900, 130)]
    shares = T._steps(iter(batches), 2, config.batch_rows)
    found = T._share_sums(next(shares), w, config, WIDTH, 1.3, 11, lambda part: [part], 1)
    assert max(seen) == min(size, 900) and found[0] == 900
    if name == "movie":
        assert sum(seen) == 900  # one pass
    n = sum(a.size for a in w.values())
    flat = found[len(T._COUNTS):].reshape(2, n)
    got_loss, got = N.combined(900, found[1:4], *(T.unflatten(f, w) for f in flat))
    assert got_loss == pytest.approx(loss)
    for k in w:
        assert got[k] == pytest.approx(wanted[k], abs=1e-9), k
    empty = T._share_sums(next(shares), w, config, WIDTH, 1.3, 11, lambda part: [part], 1)
    assert not empty.any()


def test_an_epoch_is_one_job_whatever_its_steps(spark, matrix):
    config, tracker = domain("movie"), spark.sparkContext.statusTracker()
    w = N.init_weights(WIDTH, config.network, 1)
    jobs = []
    for steps in (2, 30):
        rows = matrix.withColumn("batch", F.pmod("row_key", F.lit(steps)))
        group = f"epoch of {steps}"
        spark.sparkContext.setJobGroup(group, group)
        T.epoch_pass(rows, w, T.Adam.of(config), config, WIDTH, 1.0, steps, 5)
        jobs.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_gradient_in_ranges(matrix, monkeypatch):
    config = domain("movie", network=dataclasses.replace(DOMAINS["movie"].network, dropout=0.0))
    w = N.init_weights(WIDTH, config.network, 1)
    _, whole = T.read_sums(T.gradient_sums(matrix, w, config, WIDTH, 1.0, 7), w)
    monkeypatch.setattr(T, "RANGE", 10)
    sums = T.gradient_sums(matrix, w, config, WIDTH, 1.0, 7)
    counts, parts = T.read_sums(sums, w)
    assert counts["n"] == 900
    assert all(parts[k] == pytest.approx(whole[k]) for k in w)


def test_row_draws_are_uniform_and_independent():
    draws = N.RowDraws(3, np.arange(4000)).uniform("deep.0", 20)
    assert abs(draws.mean() - 0.5) < 0.01 and 0 <= draws.min() and draws.max() < 1
    assert abs(np.corrcoef(draws.T) - np.eye(20)).max() < 0.1
    assert not np.array_equal(draws, N.RowDraws(3, np.arange(4000)).uniform("deep.1", 20))


def test_batch_tables_are_removed(spark, matrix):
    split = matrix.selectExpr("*", "IF(row_key % 5 = 0, 'validation', 'train') AS split")
    T.train(split, NAMES, domain("movie"), rounds=1, epochs=1, batch_rows=2_000)
    folder = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))

    def left():
        return [s.getPath().getName() for s in folder.getFileSystem(
            spark._jsc.hadoopConfiguration()).listStatus(folder)
            if s.getPath().getName().startswith("batches-")]

    assert left() == []

    def fails(_):
        raise RuntimeError("ended")

    with pytest.raises(RuntimeError, match="ended"):
        T.train(split, NAMES, domain("movie"), rounds=1, epochs=1, batch_rows=2_000, on_best=fails)
    assert left() == []


def test_patience_ends_a_round_and_an_earlier_better_model_stays(matrix):
    config = domain("movie", learning_rate=0.0, patience=2)
    split = matrix.selectExpr("*", "IF(row_key % 5 = 0, 'validation', 'train') AS split")
    model, history = T.train(split, NAMES, config, rounds=2, epochs=9, batch_rows=2_000,
                             earlier_loss=-1.0)
    assert model is None and [h[:2] for h in history] == [(1, 1), (1, 2), (1, 3),
                                                          (2, 1), (2, 2), (2, 3)]


def test_optimisers():
    w, grad = {"a": np.array([1.0])}, {"a": np.array([0.5])}
    adam = T.Adam(0.1)
    assert adam.update(w, grad)["a"][0] == pytest.approx(1.0 - 0.1 * 0.5 / (0.5 + 1e-8))
    decayed = T.Adam(0.1, decay=0.01).update(w, grad)["a"][0]
    assert decayed == pytest.approx(1.0 * (1 - 0.001) - 0.1)
    cosine = T.Adam(0.1, cosine_period=30)
    assert cosine.current_rate() == pytest.approx(0.1)
    cosine.epoch = 15
    assert cosine.current_rate() == pytest.approx(0.05)
    cosine.epoch = 30
    assert cosine.current_rate() == pytest.approx(0.0)
    stat = {"x.bn_mean": np.array([1.0])}
    assert adam.update(stat, {"x.bn_mean": np.array([2.0])})["x.bn_mean"][0] == pytest.approx(1.1)


def test_save_and_load(spark, tmp_path):
    w = N.init_weights(WIDTH, DOMAINS["all"].network, 2)
    model = T.Model(w, NAMES, 0.25, 1, 3, {"first.deep.fc_b": np.array([0.5])})
    T.save_model(spark, model, str(tmp_path / "m"))
    loaded = T.load_model(spark, str(tmp_path / "m"), NAMES)
    assert (loaded.loss, loaded.round, loaded.epoch, loaded.width) == (0.25, 1, 3, WIDTH)
    assert all(np.array_equal(loaded.weights[k], w[k]) for k in w)
    assert loaded.optimiser["first.deep.fc_b"][0] == 0.5
    later = T.Model({k: v + 1 for k, v in w.items()}, NAMES, 0.125, 2, 1)
    T.save_model(spark, later, str(tmp_path / "m"))
    loaded = T.load_model(spark, str(tmp_path / "m"), NAMES)
    assert loaded.loss == 0.125 and all(np.array_equal(loaded.weights[k], w[k] + 1) for k in w)
    with pytest.raises(ValueError, match="differ"):
        T.load_model(spark, str(tmp_path / "m"), NAMES[::-1])
    with pytest.raises(FileNotFoundError):
        T.load_model(spark, str(tmp_path / "none"), NAMES)


def test_a_stored_training_goes_on_as_if_it_had_not_ended(spark, matrix, tmp_path):
    config = domain("movie", learning_rate=0.05)
    split = matrix.selectExpr("*", "IF(row_key % 5 = 0, 'validation', 'train') AS split")
    options = dict(rounds=1, batch_rows=360, train_auc=False)
    path = str(tmp_path / "m")
    _, whole = T.train(split, NAMES, config, epochs=4, **options)
    T.train(split, NAMES, config, epochs=2, **options,
            on_best=lambda m: T.save_model(spark, m, path))
    model = T.load_model(spark, path, NAMES)
    assert model.epoch == 2
    _, rest = T.train(split, NAMES, config, epochs=2, **options, resume=model)
    for a, b in zip(whole[2:], rest, strict=True):
        assert a[2:] == pytest.approx(b[2:], nan_ok=True, rel=1e-9)
    _, anew = T.train(split, NAMES, config, epochs=1, **options, weights=model.weights)
    assert anew[0][2:] != pytest.approx(rest[0][2:], nan_ok=True, rel=1e-9)


def test_flat_weights_round_trip():
    w = N.init_weights(5, DOMAINS["movie"].network, 2)
    back = T.unflatten(T.flatten(w), w)
    assert all(np.array_equal(back[k], w[k]) for k in w) and not math.isnan(T.flatten(w).sum())


def test_shares_of_a_batch_are_even(spark):
    rows = spark.range(8_000).selectExpr(
        "id AS row_key", "array(int(id % 3)) AS idx", "array(1D) AS val", "1D AS label",
        "int(id % 2) AS batch")
    for tasks in (2, 5, 8):
        dealt = T._dealt(rows, tasks)
        assert dealt.rdd.getNumPartitions() == tasks
        counts = [r[1] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert len(counts) == tasks and max(counts) < 1.2 * 8_000 / tasks
    order = [(r.batch, r.idx) for r in T._dealt(rows, 1).collect()]
    assert order == sorted(order)


def test_a_block_is_cut_where_its_columns_change(monkeypatch):
    """Rows in the order of their features take few columns at a time, whatever the width."""
    config = dataclasses.replace(DOMAINS["all"], batch_rows=300)
    rng, width = np.random.default_rng(6), 30
    idx = [[0, 1 + k // 100] for k in range(1200)]
    whole = pa.RecordBatch.from_pydict({
        "row_key": np.arange(1200), "idx": pa.array(idx, pa.list_(pa.int32())),
        "val": rng.normal(size=(1200, 2)).tolist(),
        "label": (rng.random(1200) > 0.5).astype(float), "batch": np.zeros(1200, np.int32)})
    w, seen, sums = N.init_weights(width, config.network, 1), [], N.loss_and_gradient_sums
    monkeypatch.setattr(T, "ALIKE_ROWS", 100)
    monkeypatch.setattr(
        N, "loss_and_gradient_sums",
        lambda x, *more: seen.append((x != 0).any(axis=0).sum()) or sums(x, *more))
    found = T._share_sums(
        next(T._steps(iter([whole]), 1, 300)), w, config, width, 1.3, 11, lambda part: [part], 1)
    assert found[0] == 1200 and max(seen) == 2
