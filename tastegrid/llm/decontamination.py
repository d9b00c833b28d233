"""Benchmark passages in documents: spaced-seed hits, then a check that tolerates changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.session import stored

#: Token offsets that each mask looks at; the others inside its span may differ. Chosen by
#: measured recall: of items of which 60 % of the tokens are left, at random places, some mask
#: hits 94 % of those of 15 tokens and over 98 % of longer ones.
MASKS = ((0, 1, 2, 4), (0, 2, 5, 6), (0, 3, 5, 6))
SPAN = 7
#: A passage counts if this share of the whole item agrees on one alignment,
MIN_OVERLAP = 0.6
#: or if so many tokens of a stretch of the item do.
STRETCH, MIN_STRETCH = 13, 11
BROADCAST_BYTES = 32 << 20


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; none for null."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(parts, "")


def seeds(df: DataFrame, key: str, words: str) -> DataFrame:
    """(key, at, mask, seed): for each window of SPAN tokens one hash per mask.

    The token hashes are shifted against each other as arrays, so that a window is one
    row of numbers and no row ever holds the text.
    """
    coded = df.select(key, F.transform(words, lambda w: F.xxhash64(w)).alias("h"))
    count = F.size("h") - (SPAN - 1)
    shifted = [F.slice("h", k + 1, F.greatest(count, F.lit(0))).alias(f"t{k}") for k in range(SPAN)]
    rows = coded.where(count > 0).select(
        key, F.posexplode(F.arrays_zip(*shifted)).alias("at", "w")
    )
    hashes = [
        F.xxhash64(F.lit(m), *[F.col(f"w.t{k}") for k in mask]) for m, mask in enumerate(MASKS)
    ]
    return rows.select(key, "at", F.posexplode(F.array(*hashes)).alias("mask", "seed"))


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast where the counted rows are within the limit."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def alignments(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, found): the (item_id, start, n) that share a seed with a text.

    ``start`` is the token of the document opposite the item's first token, possibly < 0;
    the item has ``n`` tokens.
    """
    items = benchmark.where("item_id IS NOT NULL").select(
        "item_id", tokens(F.col("text")).alias("words")
    )
    named = items.select(F.struct("item_id", F.size("words").alias("n")).alias("item"), "words")
    wanted = stored(
        seeds(named, "item", "words").select("seed", "item.*", F.col("at").alias("item_at")),
        "benchmark-seeds",
    )
    keyed = docs.select(
        F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("key"),
        tokens(F.col("text")).alias("words"),
    )
    return seeds(keyed, "key", "words").join(small(wanted, 64), "seed").select(
        "key.doc_id", "key.text_hash", "item_id", (F.col("at") - F.col("item_at")).alias("start"),
        "n",
    ).distinct().groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("item_id", "start", "n")).alias("found")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, n_tokens, n_matched, overlap) of passages found in documents.

    Tokens are lower-cased runs of letters and digits. Masks that skip some tokens give
    seeds; a seed shared by an item and a document fixes an alignment, and on it all tokens
    of the item are compared with those of the document. A pair is returned, with its best
    alignment (most equal tokens, then the smallest start), if at least ``MIN_OVERLAP`` of
    the item agrees or ``MIN_STRETCH`` of some ``STRETCH`` tokens of it.

    The documents are read a second time for that, by a sort-merge join with the hits
    whatever their size: texts of any length are shuffled once, and only the tokens
    opposite an item go on from there. Null and empty texts give no rows, nor do items of fewer than ``SPAN`` tokens, which
    are too short to tell a passage from chance. Repeated rows and ids count as one
    document or item (each of its texts is compared); other columns are not read.
    """
    docs, benchmark = docs.select("doc_id", "text"), benchmark.select("item_id", "text")
    found = stored(alignments(docs, benchmark), "alignments").withColumnRenamed(
        "doc_id", "found_id"
    )
    same = docs["doc_id"].eqNullSafe(found["found_id"]) & (
        F.xxhash64(docs["text"]) == found["text_hash"]
    )
    opposite = F.transform("found", lambda f: F.struct(
        f.item_id.alias("item_id"), f.start.alias("start"),
        F.slice("words", F.greatest(f.start, F.lit(0)) + 1, f.n + F.least(f.start, F.lit(0)))
        .alias("part"),
    ))
    placed = (
        docs.join(found.hint("merge"), same)
        .select("doc_id", tokens(docs["text"]).alias("words"), "found")
        .select("doc_id", F.inline(opposite))
    )
    items = benchmark.select("item_id", tokens(F.col("text")).alias("item")).distinct()
    n_bytes = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return _best(_compared(placed.join(
        F.broadcast(items) if n_bytes <= BROADCAST_BYTES else items, "item_id"
    )))


def _compared(rows: DataFrame) -> DataFrame:
    """``equal``: the item's tokens, counted from 0, that are the document's opposite ones."""
    first = F.greatest(-F.col("start"), F.lit(0))
    opposite = F.zip_with(
        F.slice("item", first + 1, F.size("item")), "part", lambda a, b: a.eqNullSafe(b)
    )
    numbered = F.transform(opposite, lambda same, k: F.when(same, k + first))
    return rows.select(
        "doc_id", "item_id", "start", F.size("item").cast("bigint").alias("n_tokens"),
        F.array_compact(numbered).alias("equal"),
    )


def _best(rows: DataFrame) -> DataFrame:
    n_matched = F.size("equal").cast("bigint")
    near = F.exists("equal", lambda first: F.size(F.filter(
        "equal", lambda x: (x >= first) & (x < first + STRETCH)
    )) >= MIN_STRETCH)
    best = F.max(F.struct("n_matched", (-F.col("start")).alias("back"), "n_tokens"))
    return (
        rows.withColumn("n_matched", n_matched)
        .where((F.col("n_matched") >= MIN_OVERLAP * F.col("n_tokens")) | near)
        .groupBy("doc_id", "item_id").agg(best.alias("b"))
        .select(
            "doc_id", "item_id", (-F.col("b.back")).cast("bigint").alias("start"),
            F.col("b.n_tokens").alias("n_tokens"), F.col("b.n_matched").alias("n_matched"),
            (F.col("b.n_matched") / F.col("b.n_tokens")).alias("overlap"),
        )
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose doc_id holds no benchmark passage.

    Rows with a null doc_id can't be named by a finding and stay.
    """
    bad = stored(
        contaminated(docs, benchmark).select("doc_id").distinct(), "contaminated"
    )
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
