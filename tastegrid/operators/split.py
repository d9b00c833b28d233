"""Class shares, class weight and the exact stratified split."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_BITS = 16


def class_distribution(rows: DataFrame) -> DataFrame:
    """(label, n, percent)."""
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.select("label", "n", (F.col("n") * 100.0 / total).alias("percent"))


def positive_weight(rows: DataFrame) -> DataFrame:
    """One row: the root of negatives over positives."""
    positives = F.sum("label")
    return rows.agg(
        F.sqrt((F.count("label") - positives) / F.nullif(positives, F.lit(0))).alias("pos_weight")
    )


def validation_sizes(counts: dict[int, int], share: float) -> dict[int, int]:
    """Rows per class: the total rounds up, then goes out by largest remainder."""
    total = sum(counts.values())
    wanted = math.ceil(share * total)
    exact = {k: wanted * n / total for k, n in counts.items()} if total else {}
    sizes = {k: math.floor(v) for k, v in exact.items()}
    by_remainder = sorted(exact, key=lambda k: (sizes[k] - exact[k], k))
    for k in by_remainder[: wanted - sum(sizes.values())]:
        sizes[k] += 1
    return sizes


def _unsigned_prefix(h: Column, bits: int) -> Column:
    """The leading ``bits`` of a 64-bit hash, in the order of the unsigned value."""
    return F.shiftrightunsigned(h, 64 - bits)


def stratified_split(
    rows: DataFrame,
    share: float,
    key: Sequence[str] = ("row_key",),
    label: str = "label",
    seed: int = 42,
) -> DataFrame:
    """Add ``split``: exactly the wanted number of rows per class is ``validation``.

    Rows are drawn by the hash of their key, so the choice is a pure expression that
    any retry repeats. The class's cut hash is found from counts per hash prefix, one
    level deeper until the prefix ends at the cut: no class is ever sorted or brought
    into one task, and the driver gets at most 2**PREFIX_BITS counts per class and level.
    Keys must be unique for exact sizes; rows with one key stay together.
    """
    h = F.xxhash64(F.lit(seed), *key)
    hashed = rows.select(F.col(label).alias("_label"), h.alias("_h"))
    prefix: dict[int, int] = {}
    wanted: dict[int, int] = {}
    cut: dict[int, int | None] = {}
    bits = 0
    while bits < 64:
        bits += PREFIX_BITS
        at_cut = F.lit(bits == PREFIX_BITS)
        for k, p in prefix.items():
            at_cut = at_cut | (
                (F.col("_label") == k) & (_unsigned_prefix(F.col("_h"), bits - PREFIX_BITS) == p)
            )
        groups = (
            hashed.where(at_cut)
            .groupBy("_label", _unsigned_prefix(F.col("_h"), bits).alias("p"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        if bits == PREFIX_BITS:
            totals: dict[int, int] = {}
            for g in groups:
                totals[g["_label"]] = totals.get(g["_label"], 0) + g["n"]
            wanted = validation_sizes(totals, share)
            cut = {k: None for k in totals}
            open_labels = {k for k in totals if wanted[k] > 0}
        else:
            open_labels = set(prefix)
        prefix = {}
        for k in open_labels:
            taken = 0
            mine = (g for g in groups if g["_label"] == k)
            for g in sorted(mine, key=lambda g: g["p"] % 2**bits):
                if taken + g["n"] >= wanted[k]:
                    wanted[k] -= taken
                    cut[k] = ((g["p"] % 2**bits) + 1) * 2 ** (64 - bits) - 1
                    if g["n"] > wanted[k]:
                        prefix[k] = g["p"]
                    break
                taken += g["n"]
        if not prefix:
            break

    # Compare as unsigned: flip the sign bit of both sides.
    flipped = h.bitwiseXOR(F.lit(-(2**63)))
    chosen = F.lit(False)
    for k, last in cut.items():
        if last is not None:
            chosen = chosen | ((F.col(label) == k) & (flipped <= F.lit(last - 2**63)))
    return rows.withColumn("split", F.when(chosen, "validation").otherwise("train"))


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))
