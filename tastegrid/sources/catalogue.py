"""Catalogue: JSON files below a folder, each one object or an array of objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tastegrid.config import DomainConfig
from tastegrid.sources.json_records import scan_records

# The catalogue's columns, all read as text.
CATALOGUE_COLUMNS = (
    "content_id", "content_name", "tag_names", "type_id", "content_duration", "content_status",
    "VOD_CODE", "content_cate_id", "content_publish_year", "content_country", "content_single",
)


def catalogue_schema(extra: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*CATALOGUE_COLUMNS, *extra)])


def read_catalogue(
    spark: SparkSession, folder: str, domain: DomainConfig, extra: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(catalogue, broken files): every record of the domain's files at any depth.

    One scan for all patterns of the domain, in byte ranges, so that one large file is
    read by many tasks. Each record has its ``source_file`` and ``_at``, its order in the
    file. A file that does not parse is left out whole and listed with the ``records`` in it
    that are at fault. ``extra`` names further keys to read as text.
    """
    pattern = "{" + ",".join(domain.catalogue_globs) + "}"
    return scan_records(spark, folder, pattern, catalogue_schema(extra))
