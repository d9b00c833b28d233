"""Inputs -> encoded user and item tables -> labelled training rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.config import DomainConfig
from tastegrid.operators import cleaning, interactions, ranking
from tastegrid.operators.encoding import Encoder, item_spec, user_spec


@dataclass(frozen=True)
class Features:
    """Fitted encoders and the encoded tables."""

    user_encoder: Encoder
    item_encoder: Encoder
    users: DataFrame
    items: DataFrame

    @property
    def width(self) -> int:
        return self.user_encoder.width + self.item_encoder.width

    @property
    def names(self) -> list[str]:
        return [*self.user_encoder.feature_names, *self.item_encoder.feature_names]


def _item_columns(domain: DomainConfig) -> tuple[list[str], str | None]:
    return ["content_duration"], "content_duration" if domain.log_duration else None


def encode(
    users: DataFrame, items: DataFrame, user_encoder: Encoder, item_encoder: Encoder,
    domain: DomainConfig, extra: tuple[str, ...] = (),
) -> Features:
    """Cleaned tables through fitted encoders; the same transform trains and scores."""
    keep, log_of = _item_columns(domain)
    return Features(
        user_encoder, item_encoder, user_encoder.sparse(users),
        item_encoder.sparse(items, keep=[*keep, *extra], log_of=log_of),
    )


def fit_features(
    users: DataFrame, catalogue: DataFrame, domain: DomainConfig, as_of_year: int,
) -> Features:
    """Clean both tables, fit the encoders on all rows, encode each distinct row once."""
    clean_users = cleaning.clean_users(users, as_of_year)
    clean_items = cleaning.clean_items(catalogue, domain)
    return encode(
        clean_users.distinct(), cleaning.distinct_items(clean_items, domain),
        Encoder.fit(clean_users, user_spec(cleaning.extra_numeric(users))),
        Encoder.fit(clean_items, item_spec(domain)),
        domain,
    )


def apply_features(
    users: DataFrame, catalogue: DataFrame, user_encoder: Encoder, item_encoder: Encoder,
    domain: DomainConfig, as_of_year: int, num_users: int = -1, num_items: int = -1,
    year_mean: float | None = None, order: str = "item_ord",
) -> Features:
    """Clean and encode new tables with fitted encoders, for scoring.

    ``num_users`` and ``num_items`` keep the first rows only (-1: all); with a limit the
    items are also restricted to active ones. One row per content id remains; items
    without an id cannot be recommended and leave before they are scored.
    """
    clean_users = cleaning.head(
        cleaning.clean_users(users, as_of_year), num_users, ["username"]
    )
    clean_items = cleaning.clean_items(catalogue, domain, year_mean, keep=[order])
    if num_items != -1:
        clean_items = cleaning.head(cleaning.active_items(clean_items), num_items, [order])
    clean_items = ranking.first_per_content(
        clean_items.where(F.col("content_id").isNotNull()), order
    )
    return encode(clean_users, clean_items, user_encoder, item_encoder, domain, (order,))


def training_matrix(log: DataFrame, features: Features, domain: DomainConfig) -> DataFrame:
    return interactions.sparse_training_rows(
        log, features.users, features.items, features.user_encoder.width, domain
    )
