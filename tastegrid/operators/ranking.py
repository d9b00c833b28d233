"""Profiles, content metadata, top-N and result shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastegrid.config import DEFAULT_RULE, TOP_N
from tastegrid.functions import text as X
from tastegrid.operators.joins import splittable_join

META_COLUMNS = ("content_name", "tag_names", "type_id")


def profiles(log: DataFrame) -> DataFrame:
    """Distinct (username, profile_id) with a profile; copies combine before the shuffle."""
    return log.where(F.col("profile_id").isNotNull()).select(
        F.col("username").cast("string").alias("username"),
        F.col("profile_id").cast("bigint").alias("profile_id"),
    ).distinct()


def profile_features(log: DataFrame, users: DataFrame) -> DataFrame:
    """Profiles with their user's columns."""
    return profiles(log).join(users, "username")


def first_per_content(items: DataFrame, order: str = "item_ord") -> DataFrame:
    """One row per content id: the first in ``order``, the smallest row on a tie.

    A partial aggregate and no window, so repeats of one id combine before the shuffle.
    """
    others = [c for c in items.columns if c not in ("content_id", order)]
    return items.groupBy("content_id").agg(
        F.min(F.struct(order, *others)).alias("_m")
    ).select("content_id", "_m.*")


def content_meta(catalogue: DataFrame, order: str = "item_ord") -> DataFrame:
    """(content_id, content_name, tag_names, type_id), one row per content id."""
    picked = catalogue.select("content_id", order, *META_COLUMNS)
    return first_per_content(picked, order).select("content_id", *META_COLUMNS)


def top_n(
    pairs: DataFrame, n: int = TOP_N, order: str = "item_ord",
    by: Sequence[str] = ("profile_id",),
) -> DataFrame:
    """The ``n`` best contents per profile with ``rank`` from 1; ties in catalogue order.

    A content scored for several usernames of a profile counts once, at its best. Missing
    scores rank last. The rank filter is applied before and after the shuffle.
    """
    best = pairs.groupBy(*by, "content_id").agg(
        F.max(X.no_nan(F.col("score"))).alias("score"), F.min(order).alias(order)
    )
    by_score = Window.partitionBy(*by).orderBy(
        F.col("score").desc_nulls_last(), F.col(order), F.col("content_id")
    )
    return best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= n)


def profile_usernames(profile_rows: DataFrame) -> DataFrame:
    """(profile_id, username): the smallest username of each profile."""
    return profile_rows.groupBy("profile_id").agg(F.min("username").alias("username"))


def with_meta(ranked: DataFrame, meta: DataFrame) -> DataFrame:
    """Metadata as text: a missing value reads ``None``, an unknown content is empty."""
    found = meta.withColumn("_found", F.lit(True))
    joined = splittable_join(ranked, found, ["content_id"], "left")

    def shown(c: str) -> Column:
        return F.when(F.col("_found"), X.text_or_none(F.col(c))).otherwise(F.lit("")).alias(c)

    return joined.select(*ranked.columns, *[shown(c) for c in META_COLUMNS])


def item_lists(ranked: DataFrame, by: Sequence[str] = ("profile_id",)) -> DataFrame:
    """(by, items): items in rank order.

    ``ranked`` holds at most N rows per group, so the collected list is bounded.
    """
    item = F.struct(
        "rank", "content_id", "content_name", "tag_names", "type_id", "score", "rule_id"
    )
    return ranked.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("items"))


def results(ranked: DataFrame, usernames: DataFrame) -> DataFrame:
    """(profile_id, username, items): one row per profile, items in rank order."""
    return item_lists(ranked).join(usernames, "profile_id", "left").select(
        "profile_id", "username", "items"
    )


def rule_groups(result_rows: DataFrame) -> DataFrame:
    """(profile_id, rules): contents with a rule grouped by it, best rank first.

    Works inside each result row, so it needs no shuffle. A profile without any ruled
    item keeps an empty list.
    """
    ruled = F.filter("items", lambda i: i.rule_id != DEFAULT_RULE)
    order = F.array_distinct(F.transform(ruled, lambda i: i.rule_id))
    return result_rows.select("profile_id", ruled.alias("_ruled"), order.alias("_order")).select(
        "profile_id",
        F.transform(
            "_order",
            lambda r: F.struct(
                r.alias("rule_id"),
                F.filter("_ruled", lambda i: i.rule_id == r).alias("items"),
            ),
        ).alias("rules"),
    )


def rulename(groups: DataFrame) -> DataFrame:
    """(pid, d): the profile's rule ids, comma separated."""
    return groups.select(
        F.col("profile_id").alias("pid"),
        F.array_join(F.transform("rules", lambda g: g.rule_id.cast("string")), ",").alias("d"),
    )


def rule_content(groups: DataFrame, rule_sep: str = "") -> DataFrame:
    """(pid, line): ``pid|rule$type#content$type#content;rule$…``."""
    def one(g: Column) -> Column:
        contents = F.transform(
            g.items, lambda i: F.concat(F.lit("$"), i.type_id, F.lit("#"), i.content_id)
        )
        return F.concat(g.rule_id.cast("string"), F.lit(rule_sep), F.array_join(contents, ""))

    return groups.select(
        F.col("profile_id").alias("pid"),
        F.concat(
            F.col("profile_id").cast("string"), F.lit("|"),
            F.array_join(F.transform("rules", one), ";"),
        ).alias("line"),
    )
