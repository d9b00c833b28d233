"""Plain parquet tables: users, rules, fitted state, build-if-absent results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def require_table(spark: SparkSession, path: str, what: str) -> DataFrame:
    if not table_exists(spark, path):
        raise FileNotFoundError(f"missing {what} at {path}")
    return spark.read.parquet(path)


def build_if_absent(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], refresh: bool = False
) -> DataFrame:
    """Read the table, first building and writing it if absent or to be refreshed."""
    if refresh or not table_exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """(rule_ord, LIST_TAGS_ID, RULE_ID); the order is that of the stored rows."""
    from tastegrid.operators.positions import read_with_positions

    return read_with_positions(spark, path, ["LIST_TAGS_ID", "RULE_ID"]).select(
        F.col("position").cast("int").alias("rule_ord"), "LIST_TAGS_ID",
        F.col("RULE_ID").cast("bigint").alias("RULE_ID"),
    )
