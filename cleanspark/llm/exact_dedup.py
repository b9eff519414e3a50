"""Exact dedup by skew-safe combining.

Texts are equal when they are identical after each run of white space became one space. Combining happens in three
steps, and each groups by the whole content beside its digest, so a digest shared by two contents never merges them:

1. every task reduces its own rows to one row per content (Spark's partial aggregate: no shuffle);
2. the task winners of a digest meet per salt, the salt being dealt by task: a text that fills a third of all rows
   reaches each of ``salts`` reducers as one row per map task;
3. the at most ``salts`` winners of a content meet globally.

Only groups of two rows or more are then joined to the rows, on digest and a second hash; singletons need no partner.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import SPACE_CLASS, c, two_columns

SALTS = 16


def normalized(text: Column) -> Column:
    """Each white-space run as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", " ")


def _sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                 digest=_sha256) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256`` (``text_sha256`` holds ``digest``).

    ``keep_id`` is the smallest id of the rows with equal normalised text, ``group_size`` their number. Null texts
    equal empty ones. A null id loses against any other; in a group of null ids only, ``keep_id`` is null and all are
    kept. Rows that repeat id and text share their verdict, each is counted. An empty table gives an empty result.
    """
    rows = (two_columns(df, id_col, text_col)
            .select("doc_id", normalized(F.col("text")).alias("content"))
            .withColumn("digest", digest(F.col("content"))))
    salted = (rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
              .groupBy("digest", "salt", "content").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")))
    groups = (salted.groupBy("digest", "content")
              .agg(F.min("first_id").alias("keep_id"), F.sum("n").alias("group_size"))
              .filter(F.col("group_size") > 1)
              .select("digest", F.xxhash64("content").alias("check"), "keep_id", "group_size"))
    members = rows.select("doc_id", "digest", F.xxhash64("content").alias("check"))
    return members.join(groups, ["digest", "check"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), F.lit(True)).otherwise(
            F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``df``, all columns as they are, that stay: the smallest id of each normalised text.

    A row goes when the groups name another id for its text; rows whose text is alone are not looked up twice."""
    gone = exact_groups(df, id_col, text_col, salts).filter(~F.col("kept")).select(
        F.col("doc_id").alias("__gone_id"), F.col("text_sha256").alias("__gone_digest"))
    digest = _sha256(normalized(c(text_col).cast("string")))
    return df.join(gone.distinct(), c(id_col).eqNullSafe(F.col("__gone_id")) & (digest == F.col("__gone_digest")), "left_anti")
