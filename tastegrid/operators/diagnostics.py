"""Counts along the joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.interactions import distinct_views
from tastegrid.operators.joins import splittable_join

SKETCH_LG_K = 12


def join_diagnostics(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """One row: rows and distinct ids of the log and after each join.

    Every number is a sum over log rows grouped by (username, content_id), so the joins
    and the distinct counts see each pair once however often it was watched.
    """
    user_n = users.groupBy("username").agg(F.count(F.lit(1)).alias("_u"))
    item_n = items.groupBy("content_id").agg(F.count(F.lit(1)).alias("_i"))
    pairs = log.groupBy(
        F.col("username").cast("string").alias("username"),
        F.col("content_id").cast("string").alias("content_id"),
    ).agg(F.count(F.lit(1)).alias("_n"))
    with_user = splittable_join(pairs, user_n, ["username"])
    with_item = splittable_join(with_user, item_n, ["content_id"])
    distinct_rows = (
        distinct_views(log)
        .join(users.distinct().select("username"), "username")
        .join(items.distinct().select("content_id"), "content_id")
    )
    parts = [
        pairs.agg(F.sum("_n").alias("log_rows"),
                  F.count_distinct("content_id").alias("log_contents")),
        users.agg(F.count(F.lit(1)).alias("user_rows"),
                  F.count_distinct("username").alias("usernames")),
        items.agg(F.count(F.lit(1)).alias("item_rows"),
                  F.count_distinct("content_id").alias("contents")),
        with_user.agg(F.sum(F.col("_n") * F.col("_u")).alias("rows_after_users"),
                      F.count_distinct("username").alias("usernames_after_users")),
        with_item.agg(F.sum(F.col("_n") * F.col("_u") * F.col("_i")).alias("rows_after_items"),
                      F.count_distinct("content_id").alias("contents_after_items")),
        distinct_rows.agg(F.count(F.lit(1)).alias("rows_after_distinct")),
    ]
    found = F.struct(*[
        part.select(F.struct(*part.columns)).scalar().alias(f"p{i}")
        for i, part in enumerate(parts)
    ])
    return log.sparkSession.range(1).select(F.inline(F.array(found))).select(*[
        F.coalesce(F.col(f"p{i}.{c}"), F.lit(0)).cast("bigint").alias(c)
        for i, part in enumerate(parts) for c in part.columns
    ])


def id_sketches(df: DataFrame, keys: Sequence[str], lg_k: int = SKETCH_LG_K) -> DataFrame:
    """One row: ``rows``, and for each key a theta sketch of its different values.

    One scan; sketches of parts of a table (files, days) stay mergeable, see
    ``merged_sketches``, so a log that grows needs only its new part read.
    """
    sketches = [F.theta_sketch_agg(F.col(k).cast("string"), lg_k).alias(k) for k in keys]
    return df.agg(F.count(F.lit(1)).alias("rows"), *sketches)


def merged_sketches(parts: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """The sketches of a whole from those of its parts, which may overlap in their values."""
    keys = [c for c in parts.columns if c != "rows"]
    return parts.agg(
        F.sum("rows").alias("rows"), *[F.theta_union_agg(k, lg_k).alias(k) for k in keys]
    )


def join_estimates(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """One row: different ids of the log, the users and the catalogue, and how many they share.

    ``log``, ``users`` and ``items`` are sketches. Up to 2**lg_k values a number is exact;
    beyond, its standard error is 1 / sqrt(2**lg_k) of it (1.6 % by default), of a shared
    number that share of the larger side. ``join_diagnostics`` counts exactly, for six passes.
    """
    sides = log.select(F.col("rows").alias("log_rows"), F.col("username").alias("lu"),
                       F.col("content_id").alias("lc"))
    sides = sides.crossJoin(users.select(F.col("username").alias("u")))  # one row each
    sides = sides.crossJoin(items.select(F.col("content_id").alias("c")))
    shared = {"shared_usernames": F.theta_intersection("lu", "u"),
              "shared_contents": F.theta_intersection("lc", "c")}
    found = {"log_usernames": F.col("lu"), "log_contents": F.col("lc"),
             "usernames": F.col("u"), "contents": F.col("c"), **shared}
    return sides.select("log_rows", *[
        F.theta_sketch_estimate(sketch).cast("bigint").alias(name) for name, sketch in found.items()
    ])


def scoring_counts(
    log: DataFrame, profiles: DataFrame, items: DataFrame, catalogue: DataFrame
) -> DataFrame:
    """One row: profile rows, items, the pairs that scoring them takes, and what is left
    out: log rows without a profile, catalogue rows without an id; and a few content ids."""
    rows = profiles.agg(F.count(F.lit(1)).alias("profile_rows"))
    found = rows.crossJoin(items.agg(F.count(F.lit(1)).alias("items")))  # one row each
    found = found.crossJoin(log.agg(
        F.count_if(F.col("profile_id").isNull()).alias("null_profiles")
    )).crossJoin(catalogue.agg(F.count_if(F.col("content_id").isNull()).alias("null_items")))
    sample = sample_ids(items).agg(F.array_sort(F.collect_list("content_id")).alias("sample"))
    return found.crossJoin(sample).select(
        "profile_rows", "items", (F.col("profile_rows") * F.col("items")).alias("scored_pairs"),
        "null_profiles", "null_items", F.array_join("sample", ",").alias("sample"),
    )


def content_overlap(log: DataFrame, items: DataFrame) -> DataFrame:
    """Content ids that occur in both the log and the catalogue."""
    return log.select(F.col("content_id").cast("string").alias("content_id")).intersect(
        items.select("content_id")
    )


def sample_ids(df: DataFrame, column: str = "content_id", n: int = 5) -> DataFrame:
    """A few ids to look at, in order."""
    return df.select(column).distinct().orderBy(column).limit(n)
