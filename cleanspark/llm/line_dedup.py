"""Line dedup: lines found in many documents stay only in the document with the largest id.

Only 128-bit hashes of line keys travel, never lines. They are range-partitioned by (hash, piece), sorted by document
(largest first) and position inside each, and a window streams over them and marks the first occurrence in each
document. The piece is a hash of the document, so a line that a third of all documents hold is spread over ``pieces``
ranges; its piece totals then meet in one small aggregate. Decisions return as run-length keep bitmaps, one short
array per document, which are joined to the texts.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import LOWER, SPACE_CHARS, UPPER, c, written

PIECES = 16


def split_lines(text: Column) -> Column:
    """The lines of a text; null and empty give one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE_CHARS)), UPPER, LOWER)


def drop_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
                 pieces: int = PIECES) -> DataFrame:
    """``doc_id, text_hash, drop_runs`` of the documents that lose lines: ``drop_runs`` is the run-length form of the
    bitmap, an ordered array of (first, last) line numbers from 0 that go."""
    text = c(text_col).cast("string")
    docs = df.select(c(id_col).alias("doc_id"), text.alias("text"))
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key")).filter(
        F.length("key") >= min_chars)
    # written once: range bounds, the stream and the join read it, and lines are split and hashed a single time
    occurrences = written(keyed.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), F.col("key")).alias("h2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(pieces)).cast("int").alias("piece"), "doc_id", "text_hash", "pos"), "lines")
    ranged = (occurrences.repartitionByRange("h1", "h2", "piece")
              .sortWithinPartitions("h1", "h2", "piece", F.desc_nulls_last("doc_id"), "text_hash", "pos"))
    stream = Window.partitionBy("h1", "h2", "piece").orderBy(F.desc_nulls_last("doc_id"), "text_hash", "pos")
    # the first row of a document: no row before it, or one of another document
    first = F.row_number().over(stream).eqNullSafe(F.lit(1)) | ~F.lag("doc_id").over(stream).eqNullSafe(F.col("doc_id"))
    per_piece = (ranged.withColumn("is_first", first).filter("is_first").groupBy("h1", "h2", "piece")
                 .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc")))
    common = (per_piece.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))
              .filter(F.col("n_docs") >= min_docs)
              .select("h1", "h2", "last_doc", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece")))
    gone = (occurrences.join(common, ["h1", "h2", "piece"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("last_doc"))).select("doc_id", "text_hash", "pos"))
    return (gone.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
            .select("doc_id", "text_hash", F.arrays_zip(
                F.expr("filter(gone, (x, i) -> i = 0 OR gone[i - 1] < x - 1)"),
                F.expr("filter(gone, (x, i) -> i = size(gone) - 1 OR gone[i + 1] > x + 1)")).cast("array<struct<first:int,last:int>>").alias("drop_runs")))


def kept_text(text: Column, drop_runs: Column) -> Column:
    """The text without the lines of ``drop_runs`` (null: nothing goes)."""
    starts = F.concat(F.array(F.lit(0)), F.transform(drop_runs, lambda r: r["last"] + 1))
    ends = F.transform(drop_runs, lambda r: r["first"])

    def joined(lines: Column) -> Column:  # bound once; inside the lambda the split would run per run
        return F.array_join(F.flatten(F.zip_with(starts, F.concat(ends, F.array(F.size(lines))),
                                                 lambda s, e: F.slice(lines, s + 1, e - s))), "\n")

    return F.when(drop_runs.isNull(), F.coalesce(text, F.lit(""))).otherwise(
        F.transform(F.array(split_lines(text)), joined)[0])


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
               pieces: int = PIECES) -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_dropped, text``, the text without the dropped lines.

    A key of at least ``min_chars`` code points that at least ``min_docs`` documents (distinct ids; null is one of
    them, and the smallest) hold loses all its lines except those of the largest id. A line repeated inside that
    document stays as often as it is there. Rows that share an id are one document for the count, each keeps its own
    bitmap. When every line goes, the text is empty. An empty table gives an empty result."""
    bitmaps = drop_bitmaps(df, id_col, text_col, min_chars, min_docs, pieces)
    docs = df.select(c(id_col).alias("doc_id"), c(text_col).cast("string").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    marked = docs.alias("d").join(
        bitmaps.alias("b"), F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.text_hash") == F.col("b.text_hash")),
        "left")
    n_gone = F.coalesce(F.aggregate(F.col("drop_runs"), F.lit(0), lambda a, r: a + r["last"] - r["first"] + 1), F.lit(0))
    return marked.select(
        F.col("d.doc_id").alias("doc_id"), F.size(split_lines(F.col("d.text"))).cast("long").alias("n_lines"),
        n_gone.cast("long").alias("n_dropped"), kept_text(F.col("d.text"), F.col("drop_runs")).alias("text"))
