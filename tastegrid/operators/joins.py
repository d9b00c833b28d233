"""Joins with an aggregated side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable_join(
    rows: DataFrame, aggregated: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on ``keys`` that adaptive execution can split where one key holds most rows.

    A small side is broadcast by its measured size. Otherwise a hot key is split only if
    both sides come straight out of a shuffle, and a side aggregated by ``keys`` would
    not: it is partitioned already. Joining on the keys and their hash gives that side,
    one short row per key, a shuffle of its own. A later sum by the keys gets its own, too,
    and so shares no task with the join.
    """
    hashed = F.xxhash64(*keys)
    return (
        rows.withColumn("_hash", hashed)
        .join(aggregated.withColumn("_hash", hashed), [*keys, "_hash"], how)
        .drop("_hash")
    )
