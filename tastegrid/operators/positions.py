"""Row positions without a single-task window, and what is cut by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastegrid.session import cut_lineage

_LOW_BITS = (1 << 33) - 1


def _offsets(sizes: DataFrame, order: str) -> DataFrame:
    """Running start and total over one small row per file or partition."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return sizes.select(
        order,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(everything).alias("_total"),
    )


def read_with_positions(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Parquet rows with ``position`` (0-based, files by name, rows as stored) and ``total``.

    The reader supplies the row index inside each file, so nothing is sorted or
    shuffled; only one row per file is summed up and joined back.
    """
    rows = spark.read.parquet(*([paths] if isinstance(paths, str) else paths)).select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    return (
        rows.join(_offsets(sizes, "_file"), "_file")
        .select(*columns, (F.col("_start") + F.col("_row")).alias("position"),
                F.col("_total").alias("total"))
    )


def with_positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``position`` and ``total`` in the total order of the ``order`` columns.

    Range partitions are sorted separately and numbered from their summed sizes. The
    sorted rows are checkpointed, so sizes and rows come from the same partitions even
    when executors are lost. ``order`` must tell all rows apart; copies need a further
    column (their place in the file, say), which also keeps them from one partition.
    """
    ranged = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_id", 33))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    return (
        ranged.join(_offsets(sizes, "_part"), "_part")
        .withColumn("position", F.col("_start") + F.col("_id").bitwiseAND(_LOW_BITS))
        .withColumnRenamed("_total", "total")
        .drop("_id", "_part", "_start")
    )


def slice_number(slices: int = 5) -> Column:
    """Slice of a positioned row: equal shares by position, the rest in the last one."""
    size = F.floor(F.col("total") / slices)
    last = F.lit(slices - 1).cast("bigint")
    return F.when(size == 0, last).otherwise(
        F.least(last, F.floor(F.col("position") / F.greatest(size, F.lit(1))))
    )
