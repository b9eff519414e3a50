"""MinHash near-dedup with DartMinHash signatures (Christiani 2020) and banded joins.

A text is the bag of its five-word shingles. An element of weight w is a strip of w unit cells; every cell receives
hashed darts, a Poisson process over rank that depends on nothing but the element and the cell. A text throws only the
darts up to a rank that makes about k ln k + 4 k of them, in whatever number of cells it has, and keeps the earliest
dart per coordinate. Two texts agree in a coordinate with a probability equal to their weighted Jaccard similarity.

From signatures to classes, in Spark and without listing the pairs of a group:

texts with equal words are one node; a node sends a row to each of its band buckets, and ``classes.py`` compares what
shares a bucket exactly and forms the classes.
"""
from __future__ import annotations

import functools
import math
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanspark.session import ship_package

from . import words as W
from .base import c, frugal, written
from .classes import bucket_classes, class_rows, components  # noqa: F401

SHINGLE_WORDS, THRESHOLD = 5, 0.8
#: 24 bands of 6 coordinates: a pair of similarity 0.8 shares a bucket with probability 0.9993, one of 0.5 with 0.31.
BANDS, BAND_ROWS = 24, 6
SLICE_BYTES = 1 << 19
#: Scripts written without spaces between words, in RE2's names, and the marks that lengthen kana.
UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\x{30FC}\x{FF70}\p{Bopomofo}\p{Yi}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tai_Tham}\p{Javanese}"
_U = np.uint64


@functools.lru_cache(maxsize=1)
def _apart() -> str:
    """The pattern of an unspaced character (group 1) or a punctuation mark or space beyond ASCII."""
    ranges, last = [], -2
    for i in range(128, sys.maxunicode + 1):
        if unicodedata.category(chr(i))[0] in "PZ":
            if i == last + 1:
                ranges[-1][1] = i
            else:
                ranges.append([i, i])
            last = i
    return f"([{UNSPACED}])|[{''.join(f'\\x{{{a:X}}}-\\x{{{b:X}}}' for a, b in ranges)}]"


def spaced(column: pa.Array) -> pa.Array:
    """Texts with a blank on both sides of each unspaced character and for punctuation and spaces beyond ASCII."""
    column = column.cast(pa.large_string())
    if pc.all(pc.string_is_ascii(column)).as_py() is not False:
        return column
    return pc.replace_substring_regex(column, _apart(), r" \1 ")


def dart_signatures(elements: np.ndarray, weights: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """Signatures (texts x k) of weighted sets: ``elements`` are 64-bit hashes, distinct within a text, with positive
    ``weights``; text i has elements bounds[i] to bounds[i + 1]. A text without elements has a row of zeros.

    Coordinates of different texts agree with the probability of their weighted Jaccard similarity."""
    n = len(bounds) - 1
    cells_of = np.ceil(weights).astype(np.int64)
    element = np.repeat(elements, cells_of)
    number = np.arange(len(element)) - np.repeat(np.cumsum(cells_of) - cells_of, cells_of)
    part = np.minimum(1.0, np.repeat(weights, cells_of) - number)  # the last cell of a fractional weight is cut
    cell = W.mix(element + W.mix(number.astype(_U) + _U(0x51ED270B9F4A7C15)))
    owner = np.repeat(np.repeat(np.arange(n), np.diff(bounds)), cells_of)
    total = np.bincount(owner, weights=part, minlength=n)
    limit = (k * math.log(max(2, k)) + 4 * k) / np.maximum(total, 1e-12)
    none = ~_U(0)
    table = np.full(n * k, none)
    todo = total > 0
    while todo.any():
        own = todo[owner]
        at, who, cut = cell[own], owner[own], part[own]
        rank, i = np.zeros(len(at)), 0
        while len(at):
            u = W.mix(at + _U((2 * i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            rank = rank - np.log(((u >> _U(11)).astype(np.float64) + 1) * 2.0 ** -53)
            near = rank <= limit[who]
            at, who, cut, rank, u = at[near], who[near], cut[near], rank[near], u[near]
            dart = W.mix(u ^ at)
            hit = ((dart >> _U(32)).astype(np.float64) * 2.0 ** -32) < cut  # the dart's place across the cell
            value = (rank.astype(np.float32).view(np.uint32).astype(_U) << _U(32)) | (W.mix(dart) >> _U(32))
            np.minimum.at(table, who[hit] * k + (dart[hit] & _U(0xFFFFFFFF)).astype(np.int64) % k, value[hit])
            i += 1
        todo &= (table.reshape(n, k) == none).any(axis=1)  # a coordinate was missed: throw up to twice the rank
        limit = limit * 2
    return np.where(total[:, None] > 0, table.reshape(n, k), _U(0))


def shingle_bags(words: np.ndarray, bounds: np.ndarray, size: int):
    """Distinct shingles of each text with their counts: (elements, counts, bounds). A text of fewer than ``size``
    words, but not none, is one shingle."""
    n = len(bounds) - 1
    length = np.diff(bounds)
    h, whole = W.grams(words, bounds, size)
    owner = np.repeat(np.arange(n), length)
    element, of = h[whole], owner[whole]
    short = np.flatnonzero((length > 0) & (length < size))
    if len(short):
        element = np.concatenate([element, sequence_hash(words, bounds, 3)[short]])
        of = np.concatenate([of, short])
    order = np.lexsort((element, of))
    element, of = element[order], of[order]
    first = np.ones(len(element), bool)
    first[1:] = (element[1:] != element[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(element)))
    return element[at], counts, np.searchsorted(of[at], np.arange(n + 1))


def sequence_hash(words: np.ndarray, bounds: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each text's words in order; 0 without words."""
    position = (np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds))).astype(_U)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(W.mix(words ^ W.mix(position * _U(8) + _U(seed))))])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _scan(rows: DataFrame, id_type: str, size: int, bands: int, band_rows: int) -> DataFrame:
    """``row`` (unique), ``doc_id``, ``c1``/``c2`` (a 128-bit hash of the words), ``n`` (shingles with repeats), band
    buckets, and ``shingles``: a 32-bit hash per shingle occurrence, distinct, for the exact comparison."""
    schema = f"row bigint, doc_id {id_type}, c1 bigint, c2 bigint, n int, buckets array<bigint>, shingles array<int>"
    k = bands * band_rows

    def run(batches):
        base, count = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            raw, ends = W.text_bytes(spaced(batch.column(1)))
            for a, b in W.row_slices(ends, SLICE_BYTES):
                words, bounds = W.word_hashes(raw[ends[a]:ends[b]], ends[a:b + 1] - ends[a])
                element, counts, of = shingle_bags(words, bounds, size)
                signature = dart_signatures(element, counts.astype(np.float64), of, k)
                bucket = np.zeros((b - a, bands), _U)
                for j in range(band_rows):
                    bucket = W.mix((bucket + signature[:, j::band_rows]) * _U(0xD1342543DE82EF95) + np.arange(bands, dtype=_U))
                n = np.add.reduceat(np.append(counts, 0), of[:-1]) * (np.diff(of) > 0)
                number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                occurrence = W.mix(np.repeat(element, counts) + number.astype(_U)) >> _U(32)
                lists = lambda flat, sizes, kind: pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat, kind))
                some = np.where(n > 0, bands, 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(base + count, base + count + b - a)), batch.column(0).slice(a, b - a),
                    pa.array(sequence_hash(words, bounds, 1).view(np.int64)), pa.array(sequence_hash(words, bounds, 2).view(np.int64)),
                    pa.array(n.astype(np.int32)), lists(bucket[n > 0].ravel().view(np.int64), some, pa.int64()),
                    lists(occurrence.astype(np.uint32).view(np.int32), n, pa.int32())],
                    names=["row", "doc_id", "c1", "c2", "n", "buckets", "shingles"])
                count += b - a

    return rows.mapInArrow(frugal(run), schema)


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS,
                 threshold: float = THRESHOLD, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """One row per input row: ``doc_id, class_id, class_size, kept``.

    Texts are linked when the Jaccard similarity of their bags of ``size``-word shingles is at least ``threshold``
    (words as in ``words.py``: A-Z lower-cased, punctuation and white space apart; here also those beyond ASCII, and each
    character of a script without spaces is a word); classes are what links connect.
    ``class_id`` is the smallest id of the class, whose row is ``kept``: of null ids, or rows that repeat the id, any
    one. A text of fewer words than a shingle is one shingle. Texts without words, null ones too, are each a class of
    their own. An empty table gives an empty result.

    Links are found through band buckets, so a pair at the threshold is missed with a probability of
    (1 - threshold^band_rows)^bands (0.0007), unless other texts connect it; what shares a bucket is decided exactly
    (on 32-bit hashes of shingle occurrences)."""
    ship_package(df.sparkSession)
    rows = df.select(c(id_col).alias("doc_id"), c(text_col).cast("string").alias("text"))
    scan = written(_scan(rows, rows.schema["doc_id"].dataType.simpleString(), size, bands, band_rows), "signatures")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")

    same = scan.filter("n > 0").groupBy("c1", "c2").agg(F.min(order).alias("m"), F.count(F.lit(1)).alias("copies"))
    copies = written(same.filter("copies > 1").select("c1", "c2", F.col("m.row").alias("node")), "copies")
    nodes = scan.select("row", "n", "buckets").join(same.select(F.col("m.row").alias("row")), "row", "left_semi")
    members = written(nodes.select(F.explode("buckets").alias("bucket"), "row", "n"), "members")
    classes = written(bucket_classes(members, scan.select("row", F.col("shingles").alias("elements")), threshold), "classes")
    return class_rows(scan, classes, copies, order).select(
        "doc_id", F.when(F.col("m").isNull(), F.col("doc_id")).otherwise(F.col("m.doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        (F.col("m").isNull() | (F.col("m.row") == F.col("row"))).alias("kept"))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df``, all columns as they are, without those of each class but the kept one. Rows that share an
    id stay when one of them is kept."""
    verdicts = near_classes(df, id_col, text_col, **options)
    gone = verdicts.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("NOT kept").select(F.col("doc_id").alias("__gone_id"))
    return df.join(gone, c(id_col).eqNullSafe(F.col("__gone_id")), "left_anti")
