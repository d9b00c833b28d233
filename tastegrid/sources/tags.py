"""Tag dictionary: JSON files exactly one folder below the given one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAG_SCHEMA = "TAG_ID bigint, TAG_NAME string"


def read_tags(spark: SparkSession, folder: str) -> DataFrame:
    """(TAG_ID, TAG_NAME, source_order); unlike the other scans a broken file is an error."""
    return (
        spark.read.schema(TAG_SCHEMA)
        .option("multiLine", "true")
        .option("mode", "FAILFAST")
        .json(f"{folder}/*/*.json")
        .select(
            "TAG_ID", "TAG_NAME",
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.monotonically_increasing_id().alias("at"),
            ).alias("source_order"),
        )
    )
