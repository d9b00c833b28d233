"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns rows.

All but the last keep the columns of documents. Rows that share a doc_id stay or go
together; null ids and other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.llm import bpe, substring
from tastegrid.llm import decontamination as D
from tastegrid.llm import language_id as L
from tastegrid.llm import ngram_join as join
from tastegrid.llm.queries import table, vocabulary
from tastegrid.session import stored

NEAR_WORDS, NEAR_PERCENT = 5, 80
WINDOW = 50


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier, fitted on their labels, tells clearly.

    Null texts, texts without a letter and ambiguous ones go.
    """
    return L.keep_told(docs, L.train(docs))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shared 5-word shingles the document with the smallest id."""
    found = join.jaccard_components(docs, NEAR_WORDS, NEAR_PERCENT)
    copies = stored(
        found.where("doc_id <> component_id").select("doc_id").distinct(), "copies"
    )
    return docs.join(copies.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages that start in a document with a smaller id, too.

    A changed text has its kept words joined by blanks, and ``n_chars`` follows it. A
    document of which nothing is left goes; all others stay as they are.
    """
    changed = substring.remove_repeats(docs, WINDOW).where("kept_text IS NOT NULL").select(
        F.col("doc_id").alias("changed_id"), "text_hash", "kept_text"
    ).dropDuplicates(["changed_id", "text_hash"])
    kept = changed["kept_text"]
    same = (docs["doc_id"] == changed["changed_id"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == changed["text_hash"]
    )
    joined = docs.join(changed.hint("merge"), same, "left").where(kept.isNull() | (kept != ""))
    length = F.when(kept.isNull(), docs["n_chars"]).otherwise(F.length(kept))
    new = {
        "text": F.coalesce(kept, docs["text"]),
        "n_chars": length.cast(docs.schema["n_chars"].dataType),
    }
    return joined.select(*[new.get(c, docs[c]).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return D.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): each document's token ids, and what they decode to."""
    return bpe.encode_decode(docs, vocabulary()).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        F.col("decoded").cast("string").alias("text"),
    )
