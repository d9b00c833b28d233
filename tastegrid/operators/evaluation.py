"""Metrics and losses of a scored table (label, score[, score_deep, score_shallow])."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastegrid.session import stored

THRESHOLD = 0.5
#: Different scores that one window of the ROC area holds, about.
RANGE_SCORES = 1 << 16


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def confusion(scored: DataFrame, score: str = "score") -> DataFrame:
    """One row: tp, fp, fn, tn, accuracy, precision, recall, f1 (0 where undefined)."""
    hit, pos = F.col(score) > THRESHOLD, F.col("label") == 1

    def count(cond: Column) -> Column:
        return F.sum(cond.cast("bigint"))

    counts = scored.agg(
        count(hit & pos).alias("tp"), count(hit & ~pos).alias("fp"),
        count(~hit & pos).alias("fn"), count(~hit & ~pos).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "tp", "fp", "fn", "tn",
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_auc(scored: DataFrame, score: str = "score") -> DataFrame:
    """One row: area under the ROC curve, ties at mid-rank.

    Equal scores combine first and are stored, so that the rows are scored once. The
    different scores are then cut into ranges whose number follows their count; each
    window holds one range, and the ranges chain through their summed negatives. Where
    the cuts fall does not change the result.
    """
    by_score = stored(
        scored.where(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("s"))
        .agg(
            F.sum((F.col("label") == 1).cast("double")).alias("p"),
            F.sum((F.col("label") != 1).cast("double")).alias("n"),
        ),
        "scores",
    )
    ranges = 1 + by_score.count() // RANGE_SCORES
    ranged = by_score.repartitionByRange(ranges, "s").withColumn("r", F.spark_partition_id())
    within = Window.partitionBy("r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ranged.withColumn("b", F.coalesce(F.sum("n").over(within), F.lit(0.0)))
        .groupBy("r")
        .agg(
            F.sum("p").alias("p"), F.sum("n").alias("n"),
            F.sum(F.col("p") * (F.col("b") + F.col("n") / 2)).alias("area"),
        )
    )
    before = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.withColumn("b", F.coalesce(F.sum("n").over(before), F.lit(0.0)))
        .agg(
            (F.sum(F.col("area") + F.col("p") * F.col("b"))
             / F.nullif(F.sum("p") * F.sum("n"), F.lit(0.0))).alias("auc")
        )
    )


def bce(score: Column, label: Column) -> Column:
    """Per-row binary cross entropy, logarithms floored at -100."""
    floor = F.lit(-100.0)
    hit = F.when(score <= 0, floor).otherwise(F.greatest(F.log(score), floor))
    miss = F.when(score >= 1, floor).otherwise(F.greatest(F.log(1 - score), floor))
    return -(label * hit + (1 - label) * miss)


def root_weights(positives: Column, negatives: Column) -> tuple[Column, Column]:
    """(weight of positives, of negatives): the root of negatives over positives, and one."""
    return F.sqrt(F.try_divide(negatives, positives)), F.lit(1.0)


def balanced_weights(positives: Column, negatives: Column) -> tuple[Column, Column]:
    """Each class weighs the other's share, each count taken as at least one."""
    p, n = F.greatest(positives, F.lit(1.0)), F.greatest(negatives, F.lit(1.0))
    return n / (p + n), p / (p + n)


def tri_bce(
    scored: DataFrame, weights: Callable[[Column, Column], tuple[Column, Column]] | None = None
) -> DataFrame:
    """One row: joint, deep, shallow mean losses and their combination ``loss``.

    Each branch adds its own loss times how far it lies above the joint loss. ``weights``
    gives the classes' weights from their counts; they are applied to the classes' summed
    losses, so that the rows are scored once.
    """
    label = F.col("label").cast("double")
    branches = (("score", "loss_joint"), ("score_deep", "loss_deep"),
                ("score_shallow", "loss_shallow"))

    def total(value: Column, wanted: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("label") == wanted, value)), F.lit(0.0))

    sums = scored.agg(
        total(F.lit(1.0), 1).alias("pos"), total(F.lit(1.0), 0).alias("neg"),
        *[total(bce(F.col(c), label), 1).alias(f"{name}_pos") for c, name in branches],
        *[total(bce(F.col(c), label), 0).alias(f"{name}_neg") for c, name in branches],
    )
    pos, neg = F.col("pos"), F.col("neg")
    of_pos, of_neg = weights(pos, neg) if weights else (F.lit(1.0), F.lit(1.0))
    means = sums.select(*[
        F.try_divide(
            F.coalesce(of_pos * F.col(f"{name}_pos"), F.lit(0.0)) + of_neg * F.col(f"{name}_neg"),
            pos + neg,
        ).alias(name)
        for _, name in branches
    ])
    joint, deep, shallow = F.col("loss_joint"), F.col("loss_deep"), F.col("loss_shallow")
    zero = F.lit(0.0)
    return means.withColumn(
        "loss",
        joint + deep * F.greatest(deep - joint, zero) + shallow * F.greatest(shallow - joint, zero),
    )
