import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegrid.operators import evaluation as E

SCORED = "label int, score double, score_deep double, score_shallow double"


def test_auc_of_a_tie(spark):
    rows = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.4), (1, 0.8)], "label int, score double")
    assert E.roc_auc(rows).first().auc == pytest.approx(0.875)


@pytest.mark.parametrize("places", [1, 2, 9])
def test_auc_equals_all_pairs(spark, places):
    rng = random.Random(places)
    rows = [(int(rng.random() < 0.4), round(rng.random() ** 3, places)) for _ in range(400)]
    pos, neg = ([s for lab, s in rows if lab == k] for k in (1, 0))
    wanted = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    got = E.roc_auc(spark.createDataFrame(rows, "label int, score double").repartition(5))
    assert got.first().auc == pytest.approx(wanted)


def test_auc_with_most_rows_at_one_score(spark):
    rows = spark.range(5000).select(
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 3 > 0, 0.5).otherwise(F.col("id") / 5000).alias("score"))
    pdf = rows.toPandas()
    pos, neg = pdf[pdf.label == 1].score.values, pdf[pdf.label == 0].score.values
    wanted = ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / len(pos) / len(neg)
    assert E.roc_auc(rows).first().auc == pytest.approx(wanted)


def test_auc_of_one_class_is_null(spark):
    rows = spark.createDataFrame([(1, 0.3)], "label int, score double")
    assert E.roc_auc(rows).first().auc is None


def test_confusion_is_strict_at_the_threshold(spark):
    rows = spark.createDataFrame(
        [(1, 0.5), (1, 0.6), (0, 0.7), (0, 0.1), (1, 0.9)], "label int, score double")
    got = E.confusion(rows).first()
    assert (got.tp, got.fp, got.fn, got.tn) == (2, 1, 1, 1)
    assert got.accuracy == pytest.approx(0.6) and got.f1 == pytest.approx(2 / 3)
    empty = E.confusion(rows.where("score < 0.2")).first()
    assert (empty.precision, empty.recall, empty.f1) == (0.0, 0.0, 0.0)


def bce(p, y):
    return -(y * np.maximum(np.log(p), -100) + (1 - y) * np.maximum(np.log(1 - p), -100))


def test_tri_bce_plain_weighted_and_balanced(spark):
    rng = np.random.default_rng(0)
    y = np.array([1, 0, 0, 1, 0, 0, 0])
    p = rng.uniform(0.05, 0.95, (3, len(y)))
    rows = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(y, p.T)], SCORED)

    def combined(weight):
        joint, deep, shallow = ((weight * bce(q, y)).mean() for q in p)
        return joint + deep * max(deep - joint, 0) + shallow * max(shallow - joint, 0)

    assert E.tri_bce(rows).first().loss == pytest.approx(combined(np.ones(7)))
    weighted = E.tri_bce(rows, lambda p, n: (F.lit(1.7), F.lit(1.0)))
    assert weighted.first().loss == pytest.approx(combined(np.where(y == 1, 1.7, 1)))
    balanced = E.tri_bce(rows, E.balanced_weights)
    assert balanced.first().loss == pytest.approx(combined(np.where(y == 1, 5 / 7, 2 / 7)))


def test_balanced_weight_counts_each_class_at_least_once(spark):
    of_pos, of_neg = E.balanced_weights(F.lit(0.0), F.lit(2.0))
    row = spark.range(1).select(of_pos.alias("p"), of_neg.alias("n")).first()
    assert (row.p, row.n) == (pytest.approx(2 / 3), pytest.approx(1 / 3))


def test_weighted_loss_scores_rows_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def score(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(1, .4, .5, .6), (0, .3, .2, .1), (0, .9, .8, .7)], SCORED)
    scored = rows.mapInArrow(score, rows.schema)
    assert E.tri_bce(scored, E.root_weights).first().loss > 0
    assert calls.value == 3


def test_auc_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(E, "RANGE_SCORES", 40)
    rows = spark.range(1000).select(
        ((F.col("id") * 7919) % 3 == 0).cast("int").alias("label"),
        ((F.col("id") * 104729) % 701 / 701).alias("score"))
    pdf = rows.toPandas()
    pos, neg = pdf[pdf.label == 1].score.values, pdf[pdf.label == 0].score.values
    wanted = ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / len(pos) / len(neg)
    assert E.roc_auc(rows).first().auc == pytest.approx(wanted)


def test_bce_of_certain_scores_is_bounded(spark):
    rows = spark.createDataFrame([(1.0, 0.0), (0.0, 1.0), (1.0, 1.0)], "y double, s double")
    got = [r.b for r in rows.select(E.bce(F.col("s"), F.col("y")).alias("b")).collect()]
    assert got == [100.0, 100.0, 0.0] and not any(math.isnan(b) for b in got)


def test_estimates_from_merged_sketches(spark):
    from tastegrid.operators import diagnostics as D

    def side(start, n, *names):
        return spark.range(start, start + n).select(*[F.col("id").cast("string").alias(c)
                                                      for c in names])

    log = side(0, 60_000, "username", "content_id")
    parts = [D.id_sketches(log.where(F.col("username").cast("int") % 3 <= k), ["username", "content_id"])
             for k in range(3)]  # overlapping parts
    whole = D.merged_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    users, items = side(30_000, 50_000, "username"), side(59_000, 1_500, "content_id")
    got = D.join_estimates(
        whole, D.id_sketches(users, ["username"]), D.id_sketches(items, ["content_id"])).first()
    assert got.contents == 1_500  # exact below 4,096
    error = 4 / 64  # four standard errors
    assert got.log_usernames == pytest.approx(60_000, rel=error)
    assert got.usernames == pytest.approx(50_000, rel=error)
    assert got.shared_usernames == pytest.approx(30_000, abs=error * 60_000)
    assert got.shared_contents == pytest.approx(1_000, abs=error * 60_000)
    none = D.id_sketches(log.limit(0), ["username", "content_id"])
    empty = D.join_estimates(none, D.id_sketches(users, ["username"]),
                             D.id_sketches(items, ["content_id"])).first()
    assert (empty.log_rows, empty.log_usernames, empty.shared_contents) == (0, 0, 0)
