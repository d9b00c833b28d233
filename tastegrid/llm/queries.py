"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from pathlib import Path

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.llm import (
    bpe,
    decontamination,
    fill_in_middle,
    language_id,
    language_model,
    ngram_join,
    packing,
    periodic_runs,
    sharding,
    substring,
    topk,
    toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 40
RANK_FILE = "byte_bpe_50k.tiktoken"
PACKING_FILE = "word_bpe_49k.json"
URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, d, "documents"), 4, 85).select(
        "doc_id", F.col("n_grams").alias("n_shingles"), "component_id"
    )


def op2_minimax_shards(spark: SparkSession, d: str) -> DataFrame:
    found = sharding.shard_documents(table(spark, d, "documents"), SHARDS)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    held_out = language_id.held_out(10, 0)
    docs = table(spark, d, "documents").withColumn("train", ~held_out)
    return language_model.score_documents(docs).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )


def op4_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = language_id.train(docs.where(~language_id.held_out(4, 2)))
    found = language_id.predict(docs, model)
    return found.select(
        "doc_id", language_id.held_out(4, 2).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op5_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, d, "documents"), table(spark, d, "benchmark")
    )


def op6_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    return url_filter.filter_urls(pages, url_filter.tracked_urls(pages), URL_RULES)


def op7_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, d, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def vocabulary(path: str | None = None) -> bpe.Vocabulary:
    return bpe.Vocabulary.read(
        path or public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    )


def op8_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, d, "documents"), vocabulary())
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    held_out = language_id.held_out(3, 1)
    model = toxicity.train(
        docs.where(~held_out), table(spark, d, "labels").where(~held_out)
    )
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def op10_bit_sliced_topk(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op11_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(table(spark, d, "documents"))


def with_periodic_tails(ids: list, counts: np.ndarray) -> np.ndarray:
    """The places of the words to read, by the query's contract: in one of ten documents
    the words from ``a`` on repeat ``p`` words. Rows without an id stay as they are."""
    places = np.arange(int(counts.sum()))
    for doc_id, first, n in zip(ids, np.cumsum(counts) - counts, counts.tolist(), strict=True):
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            places[first + a : first + n] = first + a + np.arange(n - a) % p
    return places


def op12_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    found = periodic_runs.periodic_runs(
        table(spark, d, "documents"), reorder=with_periodic_tails
    )
    zero = F.lit(0).cast("bigint")
    none = F.struct(*[zero.alias(c) for c in ("start", "length", "period")])
    best = F.reduce("runs", none, lambda top, r: F.when(
        (top.period == 0) | (r.length * top.period > top.length * r.period), r
    ).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")
    ))
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def op13_packing(spark: SparkSession, d: str) -> DataFrame:
    tokenizer = Path(public_tokenizers.path(PACKING_FILE)).read_text()
    found = packing.packed(table(spark, d, "documents"), tokenizer)
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "context", "step",
    )


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_minimax_shards": op2_minimax_shards,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_url_filter": op6_url_filter,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_bit_sliced_topk": op10_bit_sliced_topk,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_packing": op13_packing,
}
