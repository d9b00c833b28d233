"""Profiles x items -> top-N with metadata and rules -> result rows."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.config import DEFAULT_RULE, TOP_N, DomainConfig
from tastegrid.operators import ranking as R
from tastegrid.operators import rules as G
from tastegrid.operators import scoring as S
from tastegrid.operators.joins import splittable_join
from tastegrid.operators.network import Weights
from tastegrid.plans.feature_build import Features
from tastegrid.plans.score_store import ScoreStore
from tastegrid.session import stored


def item_info(
    items: DataFrame, catalogue: DataFrame, tags: DataFrame, rules: DataFrame,
    order: str = "item_ord", tag_order: str | None = None,
) -> DataFrame:
    """(content_id, metadata as text, rule_id) per scored item, rules judged on that text."""
    shown = R.with_meta(
        items.select("content_id").distinct(), R.content_meta(catalogue, order)
    )
    return shown.join(G.assign_rules(shown, G.tag_map(tags, tag_order), rules), "content_id")


def with_info(ranked: DataFrame, info: DataFrame) -> DataFrame:
    """Ranked rows with the metadata and rule of their item; every ranked row stays."""
    return splittable_join(ranked, info, ["content_id"], "left").select(
        *ranked.columns, *[F.coalesce(c, F.lit("")).alias(c) for c in R.META_COLUMNS],
        F.coalesce("rule_id", F.lit(DEFAULT_RULE)).cast("bigint").alias("rule_id"),
    )


@dataclass(frozen=True)
class Ranking:
    """The best items of all profiles, without repeating a class's list for each of them.

    ``classes``: ranked items of each class of equal users. ``alike``: (profile_id,
    username, class) of the profiles whose users are all of one class, so that its list is
    theirs. ``mixed``: (profile_id, username) and ``mixed_ranked`` the ranked items of the
    profiles whose users differ, each content at its best score.
    """

    classes: DataFrame
    alike: DataFrame
    mixed: DataFrame
    mixed_ranked: DataFrame

    def by_profile(self) -> DataFrame:
        """(profile_id, content_id, score, item_ord, rank) of every profile."""
        columns = ("profile_id", "content_id", "score", "item_ord", "rank")
        return splittable_join(self.alike, self.classes, S.CLASS).select(*columns).unionByName(
            self.mixed_ranked.select(*columns)
        )


def rank_profiles(
    log: DataFrame, features: Features, weights: Weights, domain: DomainConfig,
    n: int = TOP_N, store: ScoreStore | None = None, **plan,
) -> Ranking:
    """Classes of the log's users are scored and ranked once; a profile only meets its class.

    Feature vectors stay with the classes: a profile row carries the class's print. Only
    profiles that several different users share have lists of their own to merge. With a
    ``store`` only classes without a list there are scored.
    """
    users = S.with_class(features.users.select("username", "idx", "val"))
    rows = R.profile_features(log, users.select("username", *S.CLASS))
    members = stored(rows.distinct(), "members")
    wanted = members.select(*S.CLASS).distinct()
    classes = stored(S.classes_of(users).join(wanted, [*S.CLASS], "left_semi"), "classes")

    def rank(some: DataFrame) -> DataFrame:
        best = S.best_of_classes(
            some, features.items, weights, domain.network,
            features.user_encoder.width, features.item_encoder.width, n, **plan,
        )
        return R.top_n(best, n, by=S.CLASS)

    if store is None:
        ranked = stored(rank(classes), "class-ranks")
    else:
        ranked = store.complete(classes, rank)
    profiles = stored(members.groupBy("profile_id").agg(
        F.min("username").alias("username"),
        F.min(F.struct(*S.CLASS)).alias("low"), F.max(F.struct(*S.CLASS)).alias("high"),
    ), "profiles")
    mixed = profiles.where("low <> high").select("profile_id", "username")
    theirs = members.join(mixed.select("profile_id"), "profile_id", "left_semi")
    pairs = splittable_join(theirs, ranked.drop("rank"), S.CLASS)
    return Ranking(
        ranked, profiles.where("low = high").select("profile_id", "username", "low.*"),
        mixed, R.top_n(pairs, n),
    )


def recommend(
    log: DataFrame, features: Features, weights: Weights, domain: DomainConfig, info: DataFrame,
    n: int = TOP_N, order: str = "item_ord", **plan,
) -> DataFrame:
    """(profile_id, username, items) for every profile of the log.

    Item lists with their information are put together per class, then given to profiles.
    """
    renamed = replace(features, items=features.items.withColumnRenamed(order, "item_ord"))
    found = rank_profiles(log, renamed, weights, domain, n, **plan)
    lists = R.item_lists(with_info(found.classes, info), S.CLASS)
    alike = splittable_join(found.alike, lists, S.CLASS)
    return alike.select("profile_id", "username", "items").unionByName(
        R.results(with_info(found.mixed_ranked, info), found.mixed)
    )
