"""Corpus pipeline: documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.llm import byte_gru, ngram_join, ordinal_quality, packing, pii
from sunset_engine.operators.joins import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Documents whose language has at least this probability stay. Below it a text is hardly in any language learned:
# so many times what an even spread over the languages gives, but no more than the other bound.
LEAST_LANGUAGE_RATIO, MOST_LANGUAGE_BAR = 1.6, 0.4
PACKING_RUN_BYTES, PACKING_KEPT_WORDS = 1 << 19, 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are more likely toxic or of low quality than good; null and blank texts go too.

    The model learns from the labelled documents among ``docs``.
    """
    rated = ordinal_quality.rate(docs.select(*COLUMNS), ordinal_quality.learned(spark, sf_dir, docs))
    blank = F.coalesce(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    return rated.where(ordinal_quality.kept() & ~blank).select(*COLUMNS)


def language_bar(languages: int) -> float:
    """The least probability of a document's language among ``languages``."""
    return min(MOST_LANGUAGE_BAR, LEAST_LANGUAGE_RATIO / max(1, languages))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language: without a letter, or read as several at once.

    The labels of ``docs`` train the model, but for those on held-out ids. Without a usable
    label there is no model, and every text with a letter stays.
    """
    learn = docs.where(F.col("doc_id").isNotNull() & ~byte_gru.held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    model = byte_gru.train(learn)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    told = byte_gru.identify(docs.select(*COLUMNS), model, keep_text=True)
    sure = (F.col("lang_pred") != byte_gru.UNDETERMINED) & (F.col("score") >= language_bar(len(model.languages)))
    return told.where(sure).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares shingles of five words to 0.8 or more: the one with the smallest id."""
    docs = docs.select(*COLUMNS)
    return ngram_join.keep_one(docs, materialize(ngram_join.near_duplicates(docs, k=5, percent=80), "pipeline-groups")).select(*COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms; n_chars follows the text."""
    done = pii.pseudonymize(docs.select(*COLUMNS))
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens.

    Executors come to this stage with the memory of those before it, so its tasks take small runs of texts.
    """
    return packing.pack_documents(docs, run_bytes=PACKING_RUN_BYTES, kept_words=PACKING_KEPT_WORDS).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("packing", packed),
]

# No stage but the fourth works row by row on what SQL can express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
