"""Watch logs: a flat folder of parquet files, some of them unusable."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.config import LOG_COLUMNS

REPORT_SCHEMA = "path string, status string, signature string"
# Column types of the log as read here.
LOG_TYPES = {
    "username": "string", "content_id": "string", "duration": "double", "profile_id": "bigint",
}
GROUP_READERS = 8
# What the parquet reader says of a file whose bytes are wrong. Anything else,
# such as a store that does not answer, is an error of the job.
PARSE_ERRORS = (
    "is not a Parquet file", "CANNOT_READ_FILE_FOOTER", "Could not read footer",
    "UNABLE_TO_INFER_SCHEMA", "could not read page", "Could not read page", "can not read class",
    "don't know what type", "Required field", "ParquetDecodingException", "could not decompress",
    "FAILED_TO_UNCOMPRESS", "PARSING_ERROR", "expected magic number", "could not verify CRC",
    "Failed to decompress", "ParquetCryptoRuntimeException", "Unrecognized type",
)
# Names in exception classes that speak of the store and not of the bytes.
STORE_ERRORS = (
    "IOException", "Timeout", "Connect", "java.net.", "javax.net.", "java.nio.file.", "UnknownHost",
    "AccessControl", "AccessDenied", "Unauthorized", "amazonaws", "awssdk", "azure", "google.cloud",
    "hadoop.fs.", "hadoop.hdfs.", "hadoop.ipc.", "hadoop.security.", "httpclient", "FileNotFound",
)
MERGE_ERRORS = ("CANNOT_MERGE_SCHEMAS", "FAILED_MERGE_FIELDS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")
_CAUSE = re.compile(r"(?:^|Caused by: |: )((?:[a-z][\w$]*\.)+[A-Z][\w$]*)(?::[ \t]*(.*))?", re.M)


def _causes(error: Exception) -> list[tuple[str, str]]:
    """(class, message) of an error and of what lies below it.

    What a task threw reaches the driver as a stack trace in the message, the rest as
    causes of the Java exception.
    """
    said, found = [str(error)], []
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        found.append((str(cause.getClass().getName()), str(cause.getMessage())))
        said.append(str(cause.getMessage()))
        cause = cause.getCause()
    for text in said:
        found += [(m[1], m[2] or "") for m in _CAUSE.finditer(text)]
    return found


def _parse_error(error: Exception) -> bool:
    """Whether the file's bytes are at fault.

    An exception of the store anywhere among the causes outweighs what the reader says
    around it, unless its own message says that bytes are wrong.
    """
    causes = _causes(error)
    for kind, message in causes:
        of_store = any(name in kind for name in STORE_ERRORS) and not kind.endswith("EOFException")
        if of_store and not any(text in message for text in PARSE_ERRORS):
            return False
    said = "\n".join([str(error), *(f"{kind}: {message}" for kind, message in causes)])
    return any(text in said for text in PARSE_ERRORS)


def _merged(spark: SparkSession, paths: Sequence[str]) -> dict[str, str] | None:
    """Columns and types of all the files together, whose footers one distributed job
    reads; None if a footer is bad or types differ."""
    try:
        found = spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if _parse_error(error) or any(text in str(error) for text in MERGE_ERRORS):
            return None
        raise
    return {f.name: f.dataType.simpleString() for f in found}


def _alike(spark: SparkSession, paths: Sequence[str]) -> list[tuple[Sequence[str], dict | None]]:
    """(files, their columns) of groups that can be read together; None for a bad footer.

    A group that fails is halved. So the number of jobs grows with the bad files and with
    the places, along the names, where a stored type changes, and not with the files.
    """
    groups: list[tuple[Sequence[str], dict | None]] = []
    open_groups = [paths] if paths else []
    with ThreadPoolExecutor(GROUP_READERS) as pool:
        while open_groups:
            found = list(pool.map(lambda group: _merged(spark, group), open_groups))
            halves = []
            for group, columns in zip(open_groups, found, strict=True):
                if columns is None and len(group) > 1:
                    middle = len(group) // 2
                    halves += [group[:middle], group[middle:]]
                else:
                    groups.append((group, columns))
            open_groups = halves
    return sorted(groups, key=lambda g: g[0][0])


def _footer(spark: SparkSession, path: str) -> tuple[str, str, str]:
    """(path, status, signature) of one file."""
    return _status(path, _merged(spark, [path]))


def _status(path: str, columns: dict[str, str] | None) -> tuple[str, str, str]:
    if columns is None:
        return path, "unreadable", ""
    missing = [c for c in LOG_COLUMNS if c not in columns]
    if missing:
        return path, f"missing {','.join(missing)}", ""
    return path, "ok", ",".join(columns[c] for c in LOG_COLUMNS)


def _decodes(spark: SparkSession, path: str) -> bool:
    """Whether the needed columns of one file can be read to the end."""
    try:
        spark.read.parquet(path).select(*LOG_COLUMNS).write.format("noop").mode("overwrite").save()
    except (PySparkException, Py4JJavaError) as error:
        if _parse_error(error):
            return False
        raise
    return True


def _suspects(
    spark: SparkSession, names: dict[str, str], columns: dict[str, str]
) -> tuple[list[str], list[str]]:
    """(files that may lack a column, files that may be damaged) of a group read together.

    One scan counts rows by the footers alone, one those that decode, and the values of each
    column: a column that a file lacks has none there. A file without rows may be either.
    ``names`` are the files by the name that a scan gives them; a row per file is fetched.
    """
    schema = ", ".join(f"`{c}` {t}" for c, t in columns.items())

    def rows(*found: Column) -> DataFrame:
        read = spark.read.schema(schema).option("ignoreCorruptFiles", "true")
        return read.parquet(*names.values()).groupBy(F.col("_metadata.file_path").alias("name")).agg(
            F.count(F.lit(1)).alias("n"), *found
        )

    # the hash makes the reader decode every value of the columns
    fewest = F.array_min(F.array(*[F.count(c) for c in columns]))
    decoded = rows(F.max(F.xxhash64(*columns)).alias("seen"), fewest.alias("filled"))
    promised = {r.name: r.n for r in rows().collect()}
    found = {r.name: r for r in decoded.collect()}
    short = [p for name, p in names.items()
             if name not in found or found[name].n < promised.get(name, 0)]
    hollow = [p for name, p in names.items() if name not in found or not found[name].filled]
    return hollow, short


def inspect_log_files(spark: SparkSession, folder: str, suffix: str = "*.parquet") -> DataFrame:
    """(path, status, signature) per file.

    ``status`` is ``ok``, ``missing <columns>``, ``unreadable`` (the footer) or ``damaged``
    (some rows cannot be decoded); ``signature`` lists the stored types of the needed
    columns. Only what the reader calls wrong bytes makes a file bad; an error of the
    store ends the job. Files are looked at in groups; one file alone only if its group
    leaves it open whether it lacks a column or is damaged, or if it has no rows.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", suffix).load(folder).select(
        "path", F.col("_metadata.file_path").alias("name")
    ).collect()
    name_of = {r.path: r.name for r in listed}
    paths = sorted(name_of)
    report: dict[str, tuple[str, str, str]] = {}
    alike: dict[tuple, list[str]] = {}
    for group, columns in _alike(spark, paths):
        report |= {path: _status(path, columns) for path in group}
        needed = [(c, columns[c]) for c in LOG_COLUMNS if c in columns] if columns else []
        if needed:
            alike.setdefault(tuple(needed), []).extend(group)
    with ThreadPoolExecutor(GROUP_READERS) as pool:
        for needed, group in alike.items():
            hollow, short = _suspects(spark, {name_of[p]: p for p in group}, dict(needed))
            report |= {r[0]: r for r in pool.map(lambda p: _footer(spark, p), hollow)}
            short = [p for p in short if report[p][1] == "ok"]
            for path, fine in zip(short, pool.map(lambda p: _decodes(spark, p), short), strict=True):
                if not fine:
                    report[path] = (path, "damaged", report[path][2])
    return spark.createDataFrame([report[p] for p in paths], REPORT_SCHEMA)


def read_watch_log(
    spark: SparkSession, folder: str, suffix: str = "*.parquet"
) -> tuple[DataFrame, DataFrame]:
    """(log, report). A file is read whole or listed as bad and left out whole.

    The driver handles file names and footers, as any scan does, and no rows. Files that
    store a column in different types are read apart, one scan per combination, and cast.
    A file that is found bad only later fails the job.
    """
    report = inspect_log_files(spark, folder, suffix)
    by_signature: dict[str, list[str]] = {}
    for row in report.where(F.col("status") == "ok").collect():
        by_signature.setdefault(row.signature, []).append(row.path)
    if not by_signature:
        raise FileNotFoundError(f"no usable watch log in {folder}")
    parts = [_read_alike(spark, sorted(paths)) for paths in by_signature.values()]
    return reduce(DataFrame.unionByName, parts), report


def _read_alike(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    rows = spark.read.parquet(*paths)
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in LOG_TYPES.items()])


def skipped_files(report: DataFrame) -> DataFrame:
    """(status, files): how many files were left out, and why."""
    return (
        report.where(F.col("status") != "ok").groupBy("status")
        .agg(F.count(F.lit(1)).alias("files"))
    )
