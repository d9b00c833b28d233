"""URL verdicts: host and path rules, then a list of canonical URLs behind a Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
WORDS = 8
KEYS_PER_BLOCK = 16
BROADCAST_BYTES = 16 << 20


@dataclass(frozen=True)
class Rule:
    """Holds for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.``, path without its last slash; no query or fragment."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/$", ""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)


def apply_rules(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule name, verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):  # the longest ends up outermost
        name = F.when(fits(rule, host, path), rule.name).otherwise(name)
        verdict = F.when(fits(rule, host, path), rule.verdict).otherwise(verdict)
    return name, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column, word: int) -> Column:
    """The one bit of 64 that the key sets in this word of its block."""
    place = F.shiftrightunsigned(F.xxhash64(key, F.lit(1)), 6 * word).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def build_bloom(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w7): one row of eight 64-bit words per block, a bit per key and word."""
    return keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(
        *[F.bit_or(_mask(F.col(key), w)).alias(f"w{w}") for w in range(WORDS)]
    )


def may_hold(bloom: DataFrame, rows: DataFrame, key: str, blocks: int, size: int) -> DataFrame:
    """``rows`` with ``maybe``: false only for keys that are surely not in the filter."""
    small = F.broadcast(bloom) if size <= BROADCAST_BYTES else bloom
    bits = [
        F.col(f"w{w}").bitwiseAND(_mask(F.col(key), w)) == _mask(F.col(key), w)
        for w in range(WORDS)
    ]
    hit = bits[0]
    for bit in bits[1:]:
        hit = hit & bit
    return (
        rows.withColumn("block", _block(F.col(key), blocks)).join(small, "block", "left")
        .withColumn("maybe", F.coalesce(hit, F.lit(False)))
        .drop("block", *[f"w{w}" for w in range(WORDS)])
    )


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    Where no rule fits, a page is blocked if its canonical URL is in ``listed`` (column
    ``url``, canonical already). A blocked Bloom filter, sized by the number of listed
    URLs, passes the possible hits; only those meet the list in an exact hash join. The
    filter's table is broadcast if its size is within ``BROADCAST_BYTES``, else joined by
    block, which hashes spread evenly.

    A null url, or one without ``://``, has an empty host and path, no rule, and counts
    as not listed; null or empty listed URLs are ignored. Repeated pages are judged each,
    repeated listed URLs count once, an empty list or table is fine, other columns are
    not read.
    """
    listed = stored(
        listed.select(F.col("url").alias("listed_url")).where("listed_url <> ''").distinct(),
        "listed-urls",
    )
    blocks = max(1, listed.count() // KEYS_PER_BLOCK)
    url = F.col("url")
    name, verdict = apply_rules(rules, F.col("host"), F.col("path"))
    rows = (
        pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
        .select("*", name.alias("rule"), verdict.alias("verdict"),
                canonical(F.col("host"), F.col("path")).alias("key"))
    )
    bloom = build_bloom(listed, "listed_url", blocks)
    probed = may_hold(bloom, rows, "key", blocks, blocks * (WORDS + 1) * 8)
    open_hit = F.col("maybe") & F.col("rule").isNull()
    settled = probed.where(~open_hit).withColumn("listed", F.lit(False))
    exact = probed.where(open_hit).join(
        listed.hint("shuffle_hash"), F.col("key") == F.col("listed_url"), "left"
    ).withColumn("listed", F.col("listed_url").isNotNull()).drop("listed_url")
    return settled.unionByName(exact).select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("listed"), "block").otherwise("allow"))
        .alias("verdict"),
    )


def tracked_urls(pages: DataFrame) -> DataFrame:
    """(url): canonical URLs that occur with a tracking tag (``utm_``) in their query."""
    url = F.col("url")
    return pages.where(url.rlike(r"(?s)\?[^#]*utm_")).select(
        canonical(host_of(url), path_of(url)).alias("url")
    )
