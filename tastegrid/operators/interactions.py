"""Watch log x users x items -> labelled interactions.

The full-row distinct of the joined set equals the join of the distinct inputs, as
the joined rows keep every column of all three. So the distinct of the log runs on its
four columns, before any user or item column is attached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.config import LOG_COLUMNS, DomainConfig
from tastegrid.functions import text as X
from tastegrid.operators.joins import splittable_join

ENCODED = ("idx", "val", "usable")
#: Tasks that share the rows of one (profile, content) pair while they are counted.
PAIR_PARTS = 16


def distinct_views(log: DataFrame) -> DataFrame:
    """Each (username, content, duration, profile) once. Copies combine before the shuffle."""
    return log.select(
        F.col("username").cast("string").alias("username"),
        F.col("content_id").cast("string").alias("content_id"),
        F.col("duration").cast("double").alias("duration"),
        F.col("profile_id").cast("bigint").alias("profile_id"),
    ).distinct()


def label(domain: DomainConfig) -> Column:
    """1 where the watched share or the watch count reaches the domain's limit."""
    hit = F.lit(False)
    if domain.min_share is not None:
        hit = hit | F.coalesce(F.col("share") >= domain.min_share, F.lit(False))
    if domain.min_count is not None:
        hit = hit | F.coalesce(F.col("watch_count") >= domain.min_count, F.lit(False))
    return hit.cast("int")


def _user_counts(views: DataFrame, users: DataFrame) -> DataFrame:
    """(profile_id, content_id, _n): joined rows of views and users; null keys count apart.

    The rows are shuffled before they are summed, so that no task holds this sum and the one
    that makes the views distinct. A pair's rows go to up to ``PAIR_PARTS`` tasks.
    """
    pair = ["profile_id", "content_id"]
    user_rows = users.groupBy("username").agg(F.count(F.lit(1)).alias("_u"))
    part = F.pmod(F.xxhash64(*views.columns), F.lit(PAIR_PARTS)).cast("int")
    rows = splittable_join(
        views.select(*pair, "username", part.alias("_part")), user_rows, ["username"]
    ).select(*pair, "_part", "_u")
    return rows.repartition(*pair, "_part").groupBy(*pair).agg(F.sum("_u").alias("_n"))


def _item_rows(items: DataFrame) -> DataFrame:
    return items.groupBy("content_id").agg(F.count(F.lit(1)).alias("_i"))


def watch_counts(views: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """(profile_id, content_id, watch_count): joined rows of each pair.

    The views meet only how many rows their user has; a pair's sum is multiplied by how
    many rows its item has. Pairs with a null key have no count.
    """
    known = views.where(F.col("profile_id").isNotNull() & F.col("content_id").isNotNull())
    return splittable_join(_user_counts(known, users), _item_rows(items), ["content_id"]).select(
        "profile_id", "content_id", (F.col("_n") * F.col("_i")).alias("watch_count")
    )


def labelled_views(
    log: DataFrame, users: DataFrame, items: DataFrame, domain: DomainConfig
) -> DataFrame:
    """Joined distinct rows with watched share, watch count and label.

    ``users`` (by username) and ``items`` (by content_id, with content_duration) carry
    any further columns and must be free of repeated rows. The number of rows of an item
    comes with the item, so that the pairs need no join with the items for it.
    """
    views = distinct_views(log).where("username is not null and content_id is not null")
    # The null-safe key keeps both uses of the views the same plan, which is then run once.
    key = F.xxhash64("profile_id", "content_id")
    counts = _user_counts(views, users).select(
        F.col("profile_id").alias("_p"), F.col("content_id").alias("_c"), key.alias("_hash_of"),
        F.when(F.col("profile_id").isNotNull(), F.col("_n")).alias("_n"),
    )
    views = views.withColumn("_hash", key)
    counted = views.join(
        counts,
        F.col("profile_id").eqNullSafe(F.col("_p")) & (F.col("content_id") == F.col("_c"))
        & (F.col("_hash") == F.col("_hash_of")),
        "left",
    ).drop("_p", "_c", "_hash", "_hash_of")
    rows = splittable_join(items, _item_rows(items), ["content_id"])
    joined = counted.join(users, "username").join(rows, "content_id").withColumn(
        "watch_count", F.col("_n") * F.col("_i")
    ).drop("_n", "_i")
    share = X.no_nan(F.col("duration")) / F.col("content_duration")
    return joined.withColumn("share", X.no_nan(share)).withColumn("label", label(domain))


def training_rows(
    log: DataFrame, users: DataFrame, items: DataFrame, domain: DomainConfig
) -> DataFrame:
    """The training set: ids, user and item columns, label; duration logged if configured."""
    rows = labelled_views(log, users, items, domain).drop("duration", "share", "watch_count")
    if domain.log_duration:
        rows = rows.withColumn("content_duration", F.log("content_duration"))
    return rows


def sparse_training_rows(
    log: DataFrame, users: DataFrame, items: DataFrame, user_width: int, domain: DomainConfig
) -> DataFrame:
    """Training matrix rows: ids, label, row_key and one sparse feature vector.

    ``users`` and ``items`` are sparse-encoded. ``row_key`` hashes the distinct view, so
    it tells rows apart after the watched duration has gone; the split and the batches
    are drawn from it. Rows with text in a numeric feature leave after the count.
    """
    users = users.select("username", *[F.col(c).alias(f"_u{c}") for c in ENCODED])
    items = items.select(
        "content_id", "content_duration", *[F.col(c).alias(f"_i{c}") for c in ENCODED]
    )
    return (
        labelled_views(log, users, items, domain)
        .where(F.col("_uusable") & F.col("_iusable"))
        .select(
            "username", "content_id", "profile_id", "label",
            F.xxhash64(*LOG_COLUMNS, "_uidx", "_uval", "_iidx", "_ival").alias("row_key"),
            F.concat(
                "_uidx", F.transform("_iidx", lambda i: i + F.lit(user_width))
            ).alias("idx"),
            F.concat("_uval", "_ival").alias("val"),
        )
    )
