"""The corpus pipeline: what stays of ``documents``, as token ids.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. Its result is written and read again as the next one's input. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import saved, table
from tidemark.llm.decontaminate import drop_leaks
from tidemark.llm.exact_dedup import drop_copies
from tidemark.llm.jaccard_join import drop_similar
from tidemark.llm.language import learn, recognised
from tidemark.llm.pieces import decode, encode

LEAST_SHARE = 0.5  # a language must be likelier than all others together


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model is learned from those with a language."""
    return recognised(docs, learn(docs), least=LEAST_SHARE)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest doc_id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones (shingles of five words, Jaccard 0.8), that with the smallest doc_id."""
    return drop_similar(docs, width=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """row, doc_id, chunk, n_chunks, ids, round_trip: the tokens of every document that stayed, and whether they decode to their text.

    ``row`` tells texts of several chunks apart that have the same doc_id.
    """
    same = (F.col("decoded") == F.col("source")).alias("round_trip")
    encoded = saved(encode(docs), "pipeline-encoded")  # else a task holds two Python workers, each with a model
    return decode(encoded).select("row", "doc_id", "chunk", "n_chunks", "ids", same)


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("decontaminated", decontaminated),
    ("pieces", pieces),
]

ORACLE_SQL = None  # a trained model and a tokenizer are no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
