"""Exact Jaccard join of word n-grams by partitioning the universe (Arasu et al. 2006, Deng et al. 2015).

Two sets of sizes s <= t with a Jaccard similarity of at least d differ in at most H = (s + t)(1 - d) / (1 + d) elements.
A hash cuts the universe into H + 1 segments, so in one segment at least the two agree: each set is indexed by the
digests of its segments, and sets that share one are compared exactly. Sizes form bands in which the number of
segments is fixed; the partner of a set lies in its band or the next, so every set is indexed in its own band and the
one below.

The budget of H + 1 is allocated by cost. A segment where a set holds few elements agrees with many unrelated sets, an
empty one with all: it is given nothing. In return the set's other segments are given two: they are
also indexed by their one-deletion neighbourhood (the digests without one of their elements), and so agree where they differ
in one element. That finds every pair whose numbers of segments without budget add up to no more than the number of
segments: where both sets hold few elements, or none, the pair has lost a unit and gains one elsewhere; where only one
does, the segment differs and costs nothing. A set with more than half of its segments so keeps the budget of all. Up to
which size a segment is given nothing is chosen for each band, from the counted sets of the band: the expected rows of
deletions against the expected comparisons of unrelated sets.

Equal sets are one node. ``classes.py`` compares what shares a digest and forms the components, without listing the pairs
of a group. Texts are cut anew in each pass instead of keeping their hashes, which take more room than the texts: a first
pass counts the sets of the bands, a second the sets of each digest, a third lists the sets of the digests that occur
more than once, a fourth makes the elements of the sets that are compared. Bloom filters hold back what the joins
would throw away.
"""
from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanspark.session import ship_package

from . import words as W
from .base import bound_batches, c, frugal, written
from .bloom import bloom_filter, held
from .classes import bucket_classes, class_rows
from .near_dedup import shingle_bags

SHINGLE_WORDS, PERCENT = 3, 90
SLICE_BYTES = 1 << 19
#: Elements whose digests are made at once.
SLICE_ELEMENTS = 1 << 18
#: Segments of up to this many elements may be given no budget; the assumed share of a set's elements that an unrelated
#: set of its band holds; and what comparing a pair costs, in index rows.
MOST_SKIPPED, SHARED, PAIR_COST = 3, 1 / 32, 20
_U = np.uint64
_LARGEST = 1 << 31


@functools.lru_cache(maxsize=1)
def _blank_codes() -> np.ndarray:
    """Byte -> its code in a word of anything but white space, A-Z lower-cased; 0 for white space, so NUL takes a code
    that is free."""
    code = np.arange(256, dtype=np.uint8)
    code[65:91] += 32
    code[0] = 32
    code[[32, *range(9, 14)]] = 0
    return code


@functools.lru_cache(maxsize=8)
def bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least size of each band, its segments (1: only equal sets are similar) and the largest partner of its sets."""
    least = [1, 2]
    while least[-1] < _LARGEST:
        least.append(max(least[-1] + 1, 100 * (least[-1] - 1) // percent + 1))
    least = np.array(least, np.int64)
    last = least[1:] - 1
    partner = 100 * last // percent
    return least[:-1], (last + partner) * (100 - percent) // (100 + percent) + 1, partner


def skipped_sizes(counts: dict[int, int], percent: int = PERCENT) -> np.ndarray:
    """For each band the largest segment that is given nothing (-1: none, not even empty ones, where all sets of a band
    are in one segment), of least expected cost; ``counts`` are the sets of each band."""
    least, segments, _ = bands(percent)
    out = np.zeros(len(least), np.int64)
    for band, m in enumerate(segments):
        n = counts.get(band, 0) + counts.get(band + 1, 0)
        size = float(least[band])
        chance = [math.exp(-size / m) * (size / m) ** j / math.factorial(j) for j in range(40)]  # of j elements in a segment

        def cost(most: int) -> float:
            deletions = n * size * min(1.0, m * sum(chance[:most + 1]))
            return deletions + PAIR_COST * m * sum((n * p) ** 2 / 2 * SHARED ** j for j, p in enumerate(chance) if j > most)

        out[band] = min(range(MOST_SKIPPED + 1), key=cost) if m > 1 else -1
    return out


def _sets(rows: DataFrame, size: int, schema: str, emit) -> DataFrame:
    """What ``emit(position, elements, bounds, sums)`` gives for each slice of ``rows`` (doc_id, text), as rows of ``schema``: the distinct
    shingles' 64-bit hashes of each text, sorted, where each text's begin, and two 64-bit hashes of each set; ``position`` is
    the ids' array."""
    def run(batches):
        for batch in batches:
            raw, ends = W.text_bytes(batch.column(1))
            for a, b in W.row_slices(ends, SLICE_BYTES):
                words, bounds = W.word_hashes(raw[ends[a]:ends[b]], ends[a:b + 1] - ends[a], _blank_codes())
                element, _, of = shingle_bags(words, bounds, size)
                sums = [np.concatenate([np.zeros(1, _U), np.cumsum(W.mix(element ^ _U(seed)))])[of] for seed in (0x3C6EF372FE94F82B, 0xA54FF53A5F1D36F1)]
                for arrays in emit(batch.column(0).slice(a, b - a), element, of, [s[1:] - s[:-1] for s in sums]):
                    yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in schema.split(", ")])

    return rows.mapInArrow(frugal(run), schema)


def _identities(rows: DataFrame, id_type: str, size: int) -> DataFrame:
    """``row`` (unique), ``doc_id``, ``c1``/``c2`` (a 128-bit hash of the set) and ``n``, its elements."""
    def emit(ids, element, of, sums):
        yield [ids, *(pa.array(s.view(np.int64)) for s in sums), pa.array(np.diff(of).astype(np.int32))]

    found = _sets(rows, size, f"doc_id {id_type}, c1 bigint, c2 bigint, n int", emit)
    return found.select(F.monotonically_increasing_id().alias("row"), "*")


def _keys(rows: DataFrame, size: int, percent: int, skip: np.ndarray, bloom=None) -> DataFrame:
    """``bucket, c1, c2, n``: the index keys of every set, in its own band and the one below; with ``bloom`` (a broadcast filter) only
    those that it may hold."""
    least, segments, partner = bands(percent)

    def emit(_ids, element, of, sums):
        n = np.diff(of)
        band = np.searchsorted(least, n, "right") - 1
        for below in (0, 1):
            at = band - below
            use = (n > 0) & (at >= 0) & (segments[np.maximum(at, 0)] > 1) & ((below == 0) | (n <= partner[np.maximum(at, 0)]))
            for a, b in W.row_slices(np.concatenate([[0], np.cumsum(np.where(use, n, 0))]), SLICE_ELEMENTS):
                some = a + np.flatnonzero(use[a:b])
                if not len(some):
                    continue
                inside = np.repeat(use[a:b], n[a:b])
                keys, owner = band_keys(element[of[a]:of[b]][inside], np.concatenate([[0], np.cumsum(n[some])]), at[some], segments, skip)
                if bloom is not None:
                    through = held(bloom.value, keys)
                    keys, owner = keys[through], owner[through]
                of_key = some[owner]
                yield [pa.array(x) for x in (keys.view(np.int64), *(s[of_key].view(np.int64) for s in sums), n[of_key].astype(np.int32))]

    return _sets(rows, size, "bucket bigint, c1 bigint, c2 bigint, n int", emit)


def _elements(rows: DataFrame, size: int, bloom) -> DataFrame:
    """``c1, c2, elements`` of the sets whose ``c1`` the filter may hold."""
    def emit(_ids, element, of, sums):
        some = np.flatnonzero((np.diff(of) > 0) & held(bloom.value, sums[0]))
        n = np.diff(of)[some]
        flat = element[np.repeat(of[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat.view(np.int64)))
        yield [*(pa.array(s[some].view(np.int64)) for s in sums), lists]

    return _sets(rows, size, "c1 bigint, c2 bigint, elements array<bigint>", emit)


def band_keys(element: np.ndarray, bounds: np.ndarray, band: np.ndarray, segments: np.ndarray, skip: np.ndarray):
    """Index keys of sets in their bands: (keys, set of each). Set i has the hashes bounds[i] to bounds[i + 1]."""
    m = segments[band]
    first = np.cumsum(m) - m
    total = int(m.sum())
    owner = np.repeat(np.arange(len(m)), np.diff(bounds))
    seed = W.mix(band.astype(_U) + _U(0x510E527FADE682D1))
    slot = first[owner] + (W.mix(element ^ seed[owner]) % m[owner].astype(_U)).astype(np.int64)
    value = W.mix(element * _U(0xD1342543DE82EF95) + _U(0x9B05688C2B3E6C1F))
    digest = np.zeros(total, _U)
    np.add.at(digest, slot, value)
    within = np.bincount(slot, minlength=total)
    of_slot = np.repeat(np.arange(len(m)), m)
    small = within <= skip[band][of_slot]
    lacking = np.bincount(of_slot[small], minlength=len(m))
    place = W.mix(((band[of_slot].astype(_U) << _U(32)) + (np.arange(total) - first[of_slot]).astype(_U)) * _U(0x9E3779B97F4A7C15))
    kept = ~small | (2 * lacking > m)[of_slot]
    deleted = (lacking > 0)[owner] & ~small[slot]
    return (np.concatenate([W.mix(digest[kept] + place[kept]), W.mix(digest[slot[deleted]] - value[deleted] + place[slot[deleted]])]),
            np.concatenate([of_slot[kept], owner[deleted]]))


def similar_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    A text's set is its distinct shingles of ``size`` words (runs of anything but white space, A-Z lower-cased); a text of fewer
    words is one shingle, a text without words (a null one too) has none and is a component of its own. Texts are linked when
    100 x their common shingles are at least ``percent`` x those of either. ``component_id`` is the smallest doc_id that links lead
    to (null ids last). Rows may repeat; an empty table gives an empty result. Sets are compared by 64-bit hashes of their
    shingles; no pair is lost otherwise (see the module)."""
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    spark = df.sparkSession
    rows = df.select(c(id_col).alias("doc_id"), c(text_col).cast("string").alias("text"))
    scan = written(_identities(rows, rows.schema["doc_id"].dataType.simpleString(), size), "sets")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    same = scan.filter("n > 0").groupBy("c1", "c2").agg(F.min(order).alias("m"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"))
    same = written(same.select("c1", "c2", F.col("m.row").alias("node"), "copies", "n"), "nodes")
    copies = same.filter("copies > 1").select("c1", "c2", "node")

    edges = bands(percent)[0]
    band = F.size(F.filter(F.lit(edges.tolist()), lambda x: x <= F.col("n"))) - 1
    counts = {r["band"]: r["sets"] for r in same.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("sets")).collect()}  # a row a band
    skip = skipped_sizes(counts, percent)

    # digests that occur more than once, the sets that have them, and those sets' elements
    several = written(_keys(rows, size, percent, skip).groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("bucket"), "several")
    through = spark.sparkContext.broadcast(bloom_filter(several, "bucket", several.count()))
    listed = _keys(rows, size, percent, skip, through).distinct().join(several, "bucket", "left_semi")
    members = written(listed.join(same.select("c1", "c2", "node"), ["c1", "c2"]).select("bucket", F.col("node").alias("row"), "n", "c1", "c2"), "members")
    compared = written(members.select("row", "c1", "c2").distinct(), "compared")
    wanted = spark.sparkContext.broadcast(bloom_filter(compared, "c1", compared.count()))
    elements = _elements(rows, size, wanted).groupBy("c1", "c2").agg(F.first("elements").alias("elements"))
    sets = written(elements.join(compared, ["c1", "c2"]).select("row", "elements"), "elements")

    classes = written(bucket_classes(members.select("bucket", "row", "n"), sets, percent / 100), "classes")
    return class_rows(scan, classes, copies, order).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("m").isNull(), F.col("doc_id")).otherwise(F.col("m.doc_id")).alias("component_id"))
