"""Cleaning of the user and catalogue tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegrid.config import DomainConfig
from tastegrid.functions import text as X

USER_DROPPED = ("tentinh", "province")


def fill_missing(df: DataFrame) -> DataFrame:
    """Every null (and NaN) becomes 0, as text in text columns."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            col = F.coalesce(col, F.lit("0"))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.coalesce(X.no_nan(col), F.lit(0).cast(field.dataType))
        elif isinstance(field.dataType, T.NumericType):
            col = F.coalesce(col, F.lit(0).cast(field.dataType))
        columns.append(col.alias(field.name))
    return df.select(*columns)


def clean_users(users: DataFrame, as_of_year: int) -> DataFrame:
    """Fill, birth year, sex flag; region columns dropped, other columns kept."""
    return (
        fill_missing(users)
        .withColumn("birthday", X.birth_year(F.col("birthday"), as_of_year))
        .withColumn("sex", X.sex_flag(F.col("sex")))
        .drop(*USER_DROPPED)
    )


def extra_numeric(users: DataFrame) -> tuple[str, ...]:
    """Numeric user columns besides the known ones; they pass through as features."""
    known = {"username", "birthday", "sex", "package_code", *USER_DROPPED}
    return tuple(
        f.name for f in users.schema.fields
        if f.name not in known and isinstance(f.dataType, T.NumericType)
    )


def clean_items(
    catalogue: DataFrame,
    domain: DomainConfig,
    year_mean: float | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows with a positive duration, the domain's columns, missing years filled.

    Missing years take ``year_mean``, or else the mean over the kept rows of this
    batch: one scalar subquery, so no join and no second shuffle of the catalogue.
    """
    items = (
        catalogue.withColumn("content_id", F.col("content_id").cast("string"))
        .withColumn("content_duration", X.numeric_text(F.col("content_duration")))
        .where(X.positive(F.col("content_duration")))
        .select(*domain.item_columns, *keep)
    )
    if "content_publish_year" not in domain.item_columns:
        return items
    year = X.year_of(F.col("content_publish_year"))
    if year_mean is None:
        mean = items.select(year.alias("y")).agg(F.avg("y")).scalar()
    else:
        mean = F.lit(float(year_mean))
    return items.withColumn("content_publish_year", F.coalesce(year, mean))


def distinct_items(items: DataFrame, domain: DomainConfig) -> DataFrame:
    """Catalogue rows that encode differently, each once; tags are no feature.

    The category list is put in order first, as only its set of categories is encoded.
    """
    cats = F.array_sort(F.array_distinct(X.category_list(F.col(domain.multi_hot))))
    return (
        items.drop("tag_names").withColumn(domain.multi_hot, F.array_join(cats, ",")).distinct()
    )


def active_items(items: DataFrame) -> DataFrame:
    """Active status and a tag text with at least one word character."""
    return items.where(
        (F.col("content_status") == "1") & X.has_word(F.col("tag_names"))
    ).na.drop(subset=["tag_names"])


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the given order; -1 keeps all."""
    return df if n == -1 else df.orderBy(*order).limit(n)
