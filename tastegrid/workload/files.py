"""Queries that go through files: the given tables are written as the inputs a user has,
read through ``sources``, and the results are written through ``sinks`` and read back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.config import DOMAINS, DomainConfig
from tastegrid.operators import ranking as R
from tastegrid.operators import rules as G
from tastegrid.plans import jobs
from tastegrid.session import shared_path, stored
from tastegrid.sinks import results as K
from tastegrid.sources import catalogue as C
from tastegrid.sources import logs, manifests, tables
from tastegrid.sources import tags as T
from tastegrid.workload import adapters as A

Query = Callable[[SparkSession, str], DataFrame]
#: Items of one catalogue file.
FILE_ITEMS = 1000
RULE_ROWS = 500


def on_files(name: str) -> DomainConfig:
    """The domain, with the names that Spark gives to files."""
    return replace(DOMAINS[name], catalogue_globs=("part-*.txt",))


def write_log(spark: SparkSession, d: str, folder: str) -> None:
    """The dense log in files of one folder: one type apart, one without a needed column."""
    log = A.watch_log_dense(spark, d)
    third = F.col("profile_id") % 3
    numbers = log.withColumn("content_id", F.col("content_id").cast("bigint"))
    for rows in (
        log.where(third == 0), numbers.where(third == 1), log.where(third == 2).drop("duration")
    ):
        rows.write.mode("append").parquet(folder)


def write_catalogue(spark: SparkSession, d: str, folder: str) -> None:
    write_catalogue_rows(A.catalogue(spark, d), folder)


def write_catalogue_rows(catalogue: DataFrame, folder: str) -> None:
    """Files at some depth, each an array of objects; their number follows the items."""
    part = F.floor(F.col("item_ord") / FILE_ITEMS).alias("part")
    objects = catalogue.groupBy(part).agg(
        F.to_json(F.sort_array(F.collect_list(F.struct(*catalogue.columns)))).alias("value")
    )
    objects.write.mode("append").partitionBy("part").text(folder)


def write_rules(rules: DataFrame, folder: str) -> None:
    """Rules in their order: files follow each other by name, rows inside them by place."""
    part = F.format_string("%09d", F.floor(F.col("rule_ord") / RULE_ROWS))
    rows = rules.withColumn("part", part)
    rows.repartitionByRange("part").sortWithinPartitions("part", "rule_ord").drop(
        "rule_ord"
    ).write.partitionBy("part").parquet(folder)


def write_tags(tags: DataFrame, folder: str) -> None:
    """One object a file, each in a folder of its own."""
    tags.withColumn("part", F.xxhash64("TAG_ID", "TAG_NAME")).write.partitionBy("part").json(folder)


def file_log(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_path(spark, "log")
    write_log(spark, d, folder)
    return logs.read_watch_log(spark, folder)[0]


def file_log_report(spark: SparkSession, d: str) -> DataFrame:
    """How the columns of the usable and unusable files are stored, with their rows."""
    folder = shared_path(spark, "log")
    write_log(spark, d, folder)
    report = logs.inspect_log_files(spark, folder)
    kinds: dict[tuple[str, str], list[str]] = {}
    for row in report.collect():
        kinds.setdefault((row.status, row.signature), []).append(row.path)
    rows = [(*kind, spark.read.parquet(*paths).count()) for kind, paths in kinds.items()]
    return spark.createDataFrame(rows, "status string, signature string, n_rows bigint")


def file_users(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "users")
    A.users(spark, d).write.parquet(path)
    return tables.read_table(
        spark, path, ["username", "birthday", "sex", "package_code"]
    )


def file_catalogue(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_path(spark, "catalogue")
    write_catalogue(spark, d, folder)
    good, _ = C.read_catalogue(spark, folder, on_files("all"))
    return good.select(*C.CATALOGUE_COLUMNS)


def file_tags(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_path(spark, "tags")
    write_tags(A.tags(spark, d).distinct(), folder)
    return G.tag_map(T.read_tags(spark, folder), "source_order")


def file_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rule lists that repeat: the first place and the last id of each."""
    path = shared_path(spark, "rules")
    write_rules(A.many_rules(spark, d), path)
    return G.rule_map(tables.read_rules(spark, path)).select(
        F.col("rule_ord").cast("bigint").alias("rule_ord"), "list_tags_id", "rule_id"
    )


def layout(spark: SparkSession, d: str) -> jobs.Layout:
    """All inputs of a domain's jobs as files below one new folder."""
    out = jobs.Layout.under(shared_path(spark, "inputs"))
    A.watch_log_dense(spark, d).write.parquet(out.log)
    A.users(spark, d).write.parquet(out.users)
    write_catalogue(spark, d, out.catalogue)
    write_tags(A.tags(spark, d).distinct(), out.tags)
    write_rules(A.rules(spark), out.rules)
    return out


def file_merged_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """The stored catalogue of a domain, with gapless places."""
    domain = on_files("all")
    found = jobs.merged_catalogue(spark, layout(spark, d), domain)
    places = found.agg(F.min("item_ord").alias("low"), F.max("item_ord").alias("high"),
                       F.count_distinct("item_ord").alias("places"))
    return found.crossJoin(places).select(  # one row
        "content_id", "content_name", "type_id", "low", "high", "places"
    )


def file_catalogue_grown(spark: SparkSession, d: str) -> DataFrame:
    """The stored catalogue after its first build, unchanged, and when files were added:
    (step, rebuilt, content_id)."""
    domain, place = on_files("all"), jobs.Layout.under(shared_path(spark, "inputs"))
    even = F.col("item_ord") % 2 == 0
    write_catalogue_rows(A.catalogue(spark, d).where(even), place.catalogue)
    parts, before = [], None
    for step in ("first", "same", "grown"):
        if step == "grown":
            write_catalogue_rows(A.catalogue(spark, d).where(~even), place.catalogue)
        table = jobs.merged_catalogue(spark, place, domain)
        files = sorted(table.inputFiles())
        rows = table.select(F.lit(step).alias("step"), F.lit(files != before).alias("rebuilt"),
                            "content_id")
        parts.append(stored(rows, "step"))  # a rebuilt table replaces the one read here
        before = files
    return reduce(DataFrame.unionByName, parts)


def tag_map_stored(spark: SparkSession, d: str) -> DataFrame:
    """The tag mapping as a stored table that must be up to date when it is read again."""
    folder, path = shared_path(spark, "tags"), shared_path(spark, "tag-map")
    write_tags(A.tags(spark, d).distinct(), folder)
    now = manifests.origin(spark, {"tags": folder})

    def build() -> DataFrame:
        return G.tag_map(T.read_tags(spark, folder), "source_order")

    manifests.build_if_changed(spark, path, now, build)
    return manifests.build_if_changed(spark, path, now, build, stale="fail")


def file_training_set(spark: SparkSession, d: str) -> DataFrame:
    """Training rows built by the job from files: encoders, encoded tables, matrix."""
    domain = on_files("movie")
    rows, _ = jobs.build_training_set(spark, layout(spark, d), domain, A.AS_OF_YEAR)
    weighted = F.aggregate(
        F.zip_with("idx", "val", lambda i, v: (i + 1) * v), F.lit(0.0), lambda a, x: a + x
    )
    return rows.select(
        "username", "content_id", "profile_id", "label",
        F.size("idx").cast("bigint").alias("entries"), F.round(weighted, 5).alias("weighted"),
    )


def file_vocab(spark: SparkSession, d: str) -> DataFrame:
    """The vocabulary that training stores."""
    domain, files = on_files("movie"), layout(spark, d)
    jobs.build_training_set(spark, files, domain, A.AS_OF_YEAR)
    stored = [spark.read.parquet(f"{files.of(domain, side)}_encoder/vocab")
              for side in ("user", "item")]
    return stored[0].unionByName(stored[1]).withColumn("ordinal", F.col("ordinal").cast("bigint"))


def content_meta_repeated(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of a catalogue in which every id occurs several times."""
    return R.content_meta(A.catalogue(spark, d).withColumn(
        "content_id", (F.col("item_ord") % 97).cast("string")
    ))


def tag_map_repeated(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary in which every name has many ids: the last one counts."""
    return G.tag_map(A.repeated_tags(spark, d))


def item_rules_many(spark: SparkSession, d: str) -> DataFrame:
    """Items under as many rules as there are parts, lists repeating."""
    meta = R.content_meta(A.catalogue(spark, d))
    shown = R.with_meta(meta.select("content_id"), meta)
    return G.assign_rules(shown, G.tag_map(A.tags(spark, d)), A.many_rules(spark, d))


def sink(write: Callable[[DataFrame, str], None], read: Callable[[SparkSession, str], DataFrame],
         results: Query) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        path = shared_path(spark, "sink")
        write(results(spark, d), path)
        return read(spark, path)

    return run


def read_rulename(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("pid bigint, d string").json(path)


def read_rule_content(spark: SparkSession, path: str) -> DataFrame:
    line = F.col("value")
    return spark.read.text(path).select(
        F.substring_index(line, "|", 1).cast("bigint").alias("pid"), line.alias("line")
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(profile_id, username, content_id, …): the lines parsed back, one row per content."""
    entry = (
        "struct<content_name:string,tag_names:string,type_id:string,score:double,rule_id:bigint>"
    )
    document = (
        f"map<string,struct<suggested_content:map<string,{entry}>,"
        "user:struct<username:string,profile_id:bigint>>>"
    )
    by_profile = spark.read.text(path).select(F.explode(F.from_json("value", document)))
    return by_profile.select(
        F.col("key").cast("bigint").alias("profile_id"),
        F.col("value.user.username").alias("username"),
        F.explode("value.suggested_content").alias("content_id", "e"),
    ).select("profile_id", "username", "content_id", "e.*").withColumn(
        "score", F.round("score", 7)
    )


def file_queries(results: Query) -> dict[str, Query]:
    return {
        "file_log": file_log,
        "file_log_report": file_log_report,
        "file_users": file_users,
        "file_catalogue": file_catalogue,
        "file_tags": file_tags,
        "file_rules": file_rules,
        "file_merged_catalogue": file_merged_catalogue,
        "file_catalogue_grown": file_catalogue_grown,
        "tag_map_stored": tag_map_stored,
        "file_training_set": file_training_set,
        "file_vocab": file_vocab,
        "content_meta_repeated": content_meta_repeated,
        "tag_map_repeated": tag_map_repeated,
        "item_rules_many": item_rules_many,
        "sink_results": sink(K.write_results, read_documents, results),
        "sink_rulename": sink(K.write_rulename, read_rulename, results),
        "sink_rule_content": sink(K.write_rule_content, read_rule_content, results),
    }
