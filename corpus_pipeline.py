"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleanspark.llm import bpe
from cleanspark.llm.base import table, written
from cleanspark.llm.decontaminate import decontaminate as without_hits
from cleanspark.llm.exact_dedup import exact_dedup as first_copies
from cleanspark.llm.language_id import keep_identified
from cleanspark.llm.near_dedup import near_dedup as one_of_each_class

#: A document goes when its text has no letter, or when fewer of its letter n-grams than this share (false positives
#: of the filter taken off) belong to its best language. Mixed and noisy prose scores above 0.6.
MIN_LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages learned from ``docs``; all columns as they are."""
    return keep_identified(docs, MIN_LANGUAGE_SCORE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white-space runs as one space) the row with the smallest doc_id stays."""
    return first_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one with the smallest doc_id."""
    return one_of_each_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return without_hits(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, and its text as the ids spell it: ``doc_id, lang, source, text, n_tokens, ids``."""
    found = bpe.round_trip(docs, keep=("lang", "source"))
    return found.select("doc_id", "lang", "source", F.col("bytes").cast("string").alias("text"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("tokenize", tokenize)]

#: Learned language filters, hashed darts and token ids have no SQL form; tests/llm hold brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; the result of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
