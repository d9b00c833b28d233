"""Tag dictionary, rule table and first-matching-rule assignment.

Rules depend on the item only, so they are assigned once per item and joined to
results, never evaluated per (profile, item).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.config import DEFAULT_RULE
from tastegrid.functions import text as X
from tastegrid.operators.joins import splittable_join
from tastegrid.session import ship_package, stored

#: Items, and rules, of one anchor that meet in a task.
GROUP_ITEMS, GROUP_RULES = 100_000, 200_000
#: Items of a group that are Python objects at a time.
PIECE_ITEMS = 4_096


def tag_map(tags: DataFrame, order: str | None = None) -> DataFrame:
    """(tag_name, tag_id): one row per name, the last id in source order wins.

    Without an order column the largest id counts as the last.
    """
    tags = tags.toDF(*[c.lower() for c in tags.columns])
    last = order.lower() if order else "tag_id"
    return (
        tags.groupBy("tag_name", "tag_id").agg(F.min(last).alias("_at"))
        .groupBy("tag_name").agg(F.max_by("tag_id", F.struct("_at", "tag_id")).alias("tag_id"))
    )


def rule_map(rules: DataFrame) -> DataFrame:
    """(rule_ord, rule_tags, rule_id): a repeated list keeps its first place, its last id."""
    return rules.groupBy(F.col("LIST_TAGS_ID").alias("list_tags_id")).agg(
        F.min("rule_ord").alias("rule_ord"),
        F.max_by("RULE_ID", "rule_ord").alias("rule_id"),
    ).select("rule_ord", "list_tags_id", "rule_id",
             X.rule_tag_set(F.col("list_tags_id")).alias("rule_tags"))


def item_tags(items: DataFrame, tag_names: DataFrame) -> DataFrame:
    """(content_id, tag): the tag ids as text of each item; an unknown name reads ``None``."""
    names = items.select(
        "content_id", F.explode(X.tag_name_set(F.col("tag_names"))).alias("tag_name")
    )
    return splittable_join(names, tag_names, ["tag_name"], "left").select(
        "content_id", X.text_or_none(F.col("tag_id")).alias("tag")
    )


def _first_rule(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("content_id").agg(
        F.min(F.struct("rule_ord", "rule_id")).alias("m")
    ).select("content_id", F.col("m.rule_id").alias("rule_id"))


def _with_default(items: DataFrame, matched: DataFrame) -> DataFrame:
    return items.select("content_id").distinct().join(matched, "content_id", "left").select(
        "content_id", F.coalesce("rule_id", F.lit(DEFAULT_RULE)).cast("bigint").alias("rule_id")
    )


def _tag_sets(items: DataFrame, tag_names: DataFrame) -> DataFrame:
    tags = item_tags(items, tag_names)
    return tags.groupBy("content_id").agg(F.collect_set("tag").alias("tags"))


def contains_all(outer: Column, inner: Column) -> Column:
    return F.size(F.array_except(inner, outer)) == 0


def _anchored(items: DataFrame, tag_names: DataFrame, rules: DataFrame) -> DataFrame:
    """(rule_ord, rule_id, path, tag, n_items): each rule's tags from the rarest on.

    ``tag`` is the rarest, the rule's anchor, which ``n_items`` items carry. Of rules with
    the same tag set only the first can ever win, so the others leave, and so do rules
    with a tag that no item carries.
    """
    tags = item_tags(items, tag_names).distinct()
    frequency = tags.groupBy("tag").agg(F.count(F.lit(1)).alias("_f"))
    first_of_set = (
        rule_map(rules)
        .groupBy(F.array_sort("rule_tags").alias("rule_tags"))
        .agg(F.min(F.struct("rule_ord", "rule_id")).alias("m"))
        .select("m.*", "rule_tags")
    )
    return (
        first_of_set
        .select("rule_ord", "rule_id", F.size("rule_tags").alias("n"),
                F.explode("rule_tags").alias("tag"))
        .join(frequency, "tag")
        .groupBy("rule_ord", "rule_id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("_f", "tag"))).alias("path"))
        .where(F.size("path") == F.col("n"))
        .select("rule_ord", "rule_id", F.col("path.tag").alias("path"),
                F.col("path")[0].tag.alias("tag"), F.col("path")[0]._f.alias("n_items"))
    )


class _Trie:
    """Rules as paths of tags; each node knows the first rule at and below it."""

    def __init__(self):
        self.children: dict[str, _Trie] = {}
        self.first, self.own = _NO_RULE, _NO_RULE

    def add(self, path: list[str], rule: tuple[int, int]) -> None:
        node = self
        node.first = min(node.first, rule)
        for tag in path:
            node = node.children.setdefault(tag, _Trie())
            node.first = min(node.first, rule)
        node.own = min(node.own, rule)

    def best(self, tags: list[str], found: tuple) -> tuple:
        """The first rule whose path lies in ``tags``, if it comes before ``found``.

        Children are looked up by the item's tags, the most promising first; a branch that
        holds no earlier rule is not entered.
        """
        found = min(found, self.own)
        if self.children:
            near = [c for t in tags if (c := self.children.get(t)) and c.first < found]
            for child in sorted(near, key=lambda c: c.first):
                if child.first >= found:
                    break
                found = child.best(tags, found)
        return found


_NO_RULE = (1 << 62, 0)
_MATCH = "content_id string, rule_ord int, rule_id bigint"


def _walk(left: pa.Table, right: pa.Table) -> pa.Table:
    """The first rule of each item (content_id, tags) among some rules of one anchor."""
    trie = _Trie()
    for path, rule_ord, rule_id in zip(
        *(right.column(c).to_pylist() for c in ("path", "rule_ord", "rule_id")), strict=True
    ):
        trie.add(path, (rule_ord, rule_id))
    ids, rules = [], []
    for part in left.select(["content_id", "tags"]).to_batches(max_chunksize=PIECE_ITEMS):
        for content_id, tags in zip(*(c.to_pylist() for c in part.columns), strict=True):
            found = trie.best(tags, _NO_RULE)
            if found is not _NO_RULE:
                ids.append(content_id)
                rules.append(found)
    return pa.table({
        "content_id": pa.array(ids, pa.string()),
        "rule_ord": pa.array([r[0] for r in rules], pa.int32()),
        "rule_id": pa.array([r[1] for r in rules], pa.int64()),
    })


def assign_rules(
    items: DataFrame, tag_names: DataFrame, rules: DataFrame,
    group_items: int = GROUP_ITEMS, group_rules: int = GROUP_RULES,
) -> DataFrame:
    """(content_id, rule_id): the first rule whose tags the item has, else the default.

    Rules are anchored at the tag that the fewest items carry. The rules of an anchor are
    put into a trie over their other tags in order of rarity, and each item that carries
    the anchor walks it once, guided by its own tags: the work follows the item's tags and
    not the number of rules. The items of a hot anchor are split into groups of about
    ``group_items``, each with the rules; many rules of one anchor are split, too. So a
    task holds at most so many of either, whatever tag is common.
    """
    ship_package(items.sparkSession)
    rules = stored(_anchored(items, tag_names, rules), "anchored-rules")
    splits = rules.groupBy("tag").agg(
        F.ceil(F.max("n_items") / group_items).cast("int").alias("salts"),
        F.ceil(F.count(F.lit(1)) / group_rules).cast("int").alias("parts"),
    )

    def spread(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def place(key: str, n: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(n)).cast("int")

    carried = splittable_join(
        _tag_sets(items, tag_names).select("content_id", "tags", F.explode("tags").alias("tag")),
        splits, ["tag"],
    ).withColumn("salt", place("content_id", "salts")).withColumn("part", spread("parts"))
    tries = rules.join(splits, "tag").withColumn("part", place("rule_ord", "parts")).withColumn(
        "salt", spread("salts")
    )
    key = ("tag", "salt", "part")
    matched = carried.select(*key, "content_id", "tags").groupBy(*key).cogroup(
        tries.select(*key, "path", "rule_ord", "rule_id").groupBy(*key)
    ).applyInArrow(_walk, _MATCH)
    return _with_default(items, _first_rule(matched))


def assign_rules_by_join(
    items: DataFrame, tag_names: DataFrame, rules: DataFrame
) -> DataFrame:
    """The same rows by a join on the anchors and a check of containment, all in SQL.

    For few rules an anchor: each rule meets all items that carry its rarest tag.
    """
    candidates = (
        _tag_sets(items, tag_names).select("content_id", "tags", F.explode("tags").alias("tag"))
        .join(_anchored(items, tag_names, rules), "tag")
        .where(contains_all(F.col("tags"), F.col("path")))
    )
    return _with_default(items, _first_rule(candidates))
