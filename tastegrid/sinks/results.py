"""Writers of the result shapes; each is one distributed job and one write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators import ranking as R


def result_documents(results: DataFrame) -> DataFrame:
    """(profile_id, document): contents keyed by id, and the user, as one JSON text."""
    entries = F.transform(
        "items",
        lambda i: F.struct(
            i.content_id.alias("key"),
            F.struct(
                i.content_name.alias("content_name"), i.tag_names.alias("tag_names"),
                i.type_id.alias("type_id"), i.score.alias("score"), i.rule_id.alias("rule_id"),
            ).alias("value"),
        ),
    )
    user = F.struct("username", "profile_id")
    return results.select(
        "profile_id",
        F.to_json(
            F.struct(F.map_from_entries(entries).alias("suggested_content"), user.alias("user")),
            {"ignoreNullFields": "false"},
        ).alias("document"),
    )


def write_results(results: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON line per profile: ``{"<profile id>": {suggested_content, user}}``."""
    result_documents(results).select(
        F.concat(
            F.lit('{"'), F.col("profile_id").cast("string"), F.lit('": '), F.col("document"),
            F.lit("}"),
        ).alias("value")
    ).write.mode(mode).text(path)


def write_rulename(results: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON line per profile: ``{"pid": …, "d": "rule,rule"}``."""
    R.rulename(R.rule_groups(results)).write.mode(mode).json(path)


def write_rule_content(
    results: DataFrame, path: str, rule_sep: str = "", mode: str = "errorifexists"
) -> None:
    """One text line per profile."""
    lines = R.rule_content(R.rule_groups(results), rule_sep)
    lines.select(F.col("line").alias("value")).write.mode(mode).text(path)


def write_log_slices(positioned: DataFrame, path: str, slices: int = 5,
                     mode: str = "errorifexists") -> None:
    """The log cut by position into numbered parts, a folder for each."""
    from tastegrid.operators.positions import slice_number

    positioned.withColumn("part", slice_number(slices) + 1).drop("position", "total").write.mode(
        mode
    ).partitionBy("part").parquet(path)
