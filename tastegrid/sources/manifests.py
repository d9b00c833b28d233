"""What a stored table was made from, so that it is built again when that has changed."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.session import remove
from tastegrid.sources.tables import table_exists

#: Name of an input or a setting -> its print.
Origin = dict[str, str]
_SCHEMA = "name string, print string"
_PARTS = ("functions", "operators", "plans", "sources")


class StaleTable(RuntimeError):
    """A stored table was made from something else than what is there now."""


@cache
def code_print() -> str:
    """Of the modules that tables are built by."""
    package = Path(__file__).resolve().parents[1]
    files = sorted(p for part in _PARTS for p in (package / part).glob("*.py"))
    digest = hashlib.sha256()
    for path in [package / "config.py", *files]:
        digest.update(path.read_bytes())
    return digest.hexdigest()[:16]


def files_print(spark: SparkSession, path: str, pattern: str = "*") -> str:
    """Of the names, lengths and times of all files below a folder; no file is opened."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")
    )
    found = files.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.coalesce(F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.lit(0)).alias("h"),
    ).first()
    return f"{found.n} files, {found.bytes} bytes, {found.h & (2**64 - 1):016x}"


def rows_print(rows: DataFrame, *columns: str) -> str:
    """Of the rows as a set, whatever their order and files."""
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(F.xxhash64(*columns)), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.xxhash64(F.lit(1), *columns).cast("decimal(38,0)")), F.lit(0)).alias("b"),
    ).first()
    return f"{found.n} rows, {found.a & (2**64 - 1):016x}, {int(found.b) & (2**64 - 1):016x}"


def origin(
    spark: SparkSession, inputs: Mapping[str, str | tuple[str, str]], **settings: object
) -> Origin:
    """Prints of the inputs (a path, or a path and a pattern of names), the settings and
    the code."""
    found = {"code": code_print()}
    for name, place in inputs.items():
        path, pattern = place if isinstance(place, tuple) else (place, "*")
        found[name] = files_print(spark, path, pattern)
    return found | {name: repr(value) for name, value in settings.items()}


def _path(table: str) -> str:
    return f"{table.rstrip('/')}_made_from"


def made_from(spark: SparkSession, table: str) -> Origin | None:
    """The origin noted for a table; None if there is none, so also while it is built."""
    if not table_exists(spark, table) or not table_exists(spark, _path(table)):
        return None
    return {r.name: r.print for r in spark.read.schema(_SCHEMA).parquet(_path(table)).collect()}


def changed(spark: SparkSession, table: str, now: Origin) -> list[str]:
    """Names of what differs from the table's noted origin; all of them if it has none."""
    then = made_from(spark, table)
    if then is None:
        return sorted(now)
    return sorted(k for k in now.keys() | then.keys() if now.get(k) != then.get(k))


def build_if_changed(
    spark: SparkSession, table: str, now: Origin, build: Callable[[], DataFrame],
    stale: str = "rebuild",
) -> DataFrame:
    """The table, built and written first unless it was made from ``now``.

    ``stale`` says what becomes of a stored table with another origin, or with none:
    ``rebuild`` it, ``fail``, or ``keep`` it as it is. The origin is noted last, and
    the old note goes first: a run that ends in between leaves a table that counts as changed.
    """
    if stale not in ("rebuild", "fail", "keep"):
        raise ValueError(f"stale={stale!r}: rebuild, fail or keep")
    exists = table_exists(spark, table)
    if exists and stale == "keep":
        return spark.read.parquet(table)
    differing = changed(spark, table, now)
    if exists and differing and stale == "fail":
        raise StaleTable(f"{table} was made from other {', '.join(differing)}")
    if differing:
        remove(spark, _path(table))
        build().write.mode("overwrite").parquet(table)
        spark.createDataFrame(sorted(now.items()), _SCHEMA).coalesce(1).write.parquet(_path(table))
    return spark.read.parquet(table)
