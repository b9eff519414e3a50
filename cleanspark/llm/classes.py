"""Classes of similar sets from shared buckets, without listing the pairs of a group.

1. in each bucket every member is compared with the bucket's first member, exactly; links form classes;
2. where members of a bucket are still in different classes, they are compared across classes. The buckets with the
   same most frequent class (the hub) are one group; its rows of other classes (the queries) are compared with each
   other and with the hub's rows, never two rows of the hub: both are cut into parts, and each pair of parts is compared
   through an inverted index by one task, which returns links between classes only. So no pair of a bucket is left
   between two classes without having been compared, and the work is queries x (queries + hub rows). It grows with the
   square of a group only where that scatters around the threshold without being a class;
3. links of both rounds form the final classes, by label propagation with pointer jumping.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import HOT_KEYS, spread_join, written
from .bloom import bloom_filter, held

#: Rows and elements of a part of a large group; two parts are compared in one piece of work.
PART_ROWS, PART_ELEMENTS = 2_000, 1_000_000


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``edges`` (a, b): the smallest node of its connected component.

    Each round takes the smallest label among neighbours, then the label's own label; rounds grow with the logarithm
    of a component's width. Every round is written to the shared folder."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        moved = written(step.join(above, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("above", "label")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels


def sets_of(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """``sets`` without nearly all rows that ``rows`` (row, may repeat) does not name, held back where they are read: their
    elements need not be moved for a join that throws them away."""
    rows = written(rows.select(F.xxhash64("row").alias("hash")).distinct(), "wanted")
    bloom = sets.sparkSession.sparkContext.broadcast(bloom_filter(rows, "hash", rows.count()))

    @F.pandas_udf("boolean")
    def may_be_held(hashes: pd.Series) -> pd.Series:
        return pd.Series(held(bloom.value, hashes.to_numpy().view(np.uint64)))

    return sets.where(may_be_held(F.xxhash64("row")))


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) of rows of ``sets`` (row, elements: distinct) with their Jaccard similarity ``sim``; ``pairs`` is a
    written table, one of its ends may be that of all pairs."""
    sets = sets_of(sets, pairs.select(F.explode(F.array("a", "b")).alias("row")))
    left = sets.select(F.col("row").alias("a"), F.col("elements").alias("of_a"))
    right = sets.select(F.col("row").alias("b"), F.col("elements").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return spread_join(pairs, left, ["a"], "b").join(right, "b").select(
        "a", "b", (shared / (F.size("of_a") + F.size("of_b") - shared)).alias("sim"))


def near(shared, union, threshold: float):
    """Whether shared / union is at least the threshold, for thresholds of a few digits."""
    return shared + 1e-9 * union >= threshold * union


def bucket_classes(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``node, class`` of each row that is similar to another: ``members`` (bucket, row, n: elements of the row) and ``sets``
    (row, elements) are written tables; rows are linked where they share a bucket and their similarity reaches
    ``threshold``. The class is its smallest row."""
    firsts = members.groupBy("bucket").agg(F.min(F.struct("row", "n")).alias("f"), F.count(F.lit(1)).alias("size")).filter(
        "size > 1").select("bucket", F.col("f.row").alias("first"), F.col("f.n").alias("first_n"), "size")
    full = written(spread_join(members, firsts, ["bucket"], "row"), "buckets")
    comparable = F.least("n", "first_n") >= F.lit(threshold - 1e-9) * F.greatest("n", "first_n")  # a similarity needs sizes this close
    pairs = written(full.filter((F.col("row") != F.col("first")) & comparable).select(F.col("first").alias("a"), F.col("row").alias("b")).distinct(), "pairs")
    compared = written(similarities(pairs, sets), "compared")
    labels = components(compared.filter(F.col("sim") >= threshold - 1e-9))

    # buckets of three members or more, whose members other than the first are in several classes
    others = written(full.filter((F.col("size") > 2) & (F.col("row") != F.col("first")))
                     .join(labels.withColumnRenamed("node", "row"), "row", "left")
                     .select("bucket", "row", "n", F.coalesce("label", "row").alias("label")), "others")
    joined = components(_links_between(others, sets, threshold))
    return (labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left")
            .select("node", F.coalesce("top", "label").alias("class"))
            .union(joined.join(labels, "node", "left_anti").select("node", F.col("label").alias("class"))))


def _links_between(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links ``a, b`` between labels, of rows that share a bucket (``bucket, row, n, label``) under different labels."""
    counts = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("rows"))
    hubs = counts.groupBy("bucket").agg(F.max(F.struct("rows", "label")).alias("m"), F.count(F.lit(1)).alias("labels")).filter(
        "labels > 1").select("bucket", F.col("m.label").alias("hub"))
    group = written(spread_join(members, hubs, ["bucket"], "row").select("hub", "row", "n", "label").distinct(), "groups")
    parts = lambda query: F.greatest(F.ceil(F.count_if(query) / F.lit(PART_ROWS)),
                                     F.ceil(F.sum(F.when(query, F.col("n")).otherwise(0)) / F.lit(PART_ELEMENTS))).cast("int")
    query = F.col("label") != F.col("hub")
    sizes = group.groupBy("hub").agg(parts(query).alias("q"), F.greatest(parts(~query), F.lit(0)).alias("h"))
    large = written(sizes.filter("q > 1 OR h > 1"), "parts")  # groups of one part each need no lookup
    if large.count() <= HOT_KEYS:
        sized = group.join(F.broadcast(large), "hub", "left")
    else:
        sized = spread_join(group, large, ["hub"], "row", "left")
    q, h, other = F.coalesce("q", F.lit(1)), F.coalesce("h", F.lit(1)), F.col("other")
    deal = lambda n: F.pmod(F.xxhash64("row"), F.greatest(n, F.lit(1))).cast("int")
    # query parts are numbered first, then hub parts; a query row meets all parts, a hub row those of the queries
    parted = written(sized.select("hub", "row", "n", "label", F.when(query, deal(q)).otherwise(q + deal(h)).alias("part"),
                                  F.when(query, q + h).otherwise(q).alias("meets")), "parts")
    load = parted.agg(F.coalesce(F.sum(F.col("n").cast("long") * F.col("meets")), F.lit(0)).alias("n")).collect()[0]["n"]
    cells = (parted.join(sets_of(sets, parted), "row").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("meets") - 1)))
             .select(F.pmod(F.xxhash64("hub", F.least("part", other), F.greatest("part", other)), F.lit(1 + load // PART_ELEMENTS)).alias("task"),
                     "hub", F.least("part", other).alias("i"), F.greatest("part", other).alias("j"), "part", "label", "elements"))

    def compare(rows):
        out = set()
        for (_, i, j), cell in rows.groupby(["hub", "i", "j"], sort=False):
            one, two = (cell[cell["part"] == x] for x in (i, j))
            out.update(_cell_links(one["label"].to_numpy(), [np.asarray(x) for x in one["elements"]],
                                   two["label"].to_numpy(), [np.asarray(x) for x in two["elements"]], threshold))
        a, b = zip(*out) if out else ((), ())
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return cells.groupBy("task").applyInPandas(compare, "a bigint, b bigint").distinct()


def _cell_links(labels: np.ndarray, sets: list[np.ndarray], other_labels: np.ndarray, others: list[np.ndarray], threshold: float):
    """Pairs of different labels, one of ``sets`` and one of ``others``, whose similarity reaches ``threshold``."""
    if not len(sets) or not len(others):
        return
    size = np.array([len(x) for x in others], np.int64)
    element = np.concatenate(others)
    order = np.argsort(element, kind="stable")
    element, owner = element[order], np.repeat(np.arange(len(others)), size)[order]
    for label, own in zip(labels, sets):
        low, high = np.searchsorted(element, own, "left"), np.searchsorted(element, own, "right")
        run = high - low
        at = np.repeat(low - (np.cumsum(run) - run), run) + np.arange(run.sum())
        shared = np.bincount(owner[at], minlength=len(others))
        hit = near(shared, len(own) + size - shared, threshold) & (other_labels != label)
        for x in np.unique(other_labels[hit]):
            yield int(label), int(x)


def class_rows(rows: DataFrame, classes: DataFrame, copies: DataFrame, order) -> DataFrame:
    """``row, doc_id, n`` of ``rows`` (row, doc_id, c1, c2, n) with ``m``, the least row of their class by ``order`` (a struct with ``row`` and
    ``doc_id``; null for a class of one), and ``class_size``. ``copies`` (c1, c2, node) names the node of equal sets, ``classes``
    (node, class) the class of nodes. Rows without elements are classes of their own. A class of a third of all rows is
    looked up in as many copies as it asks for."""
    rows = written(rows.select("row", "doc_id", "c1", "c2", "n"), "rows")
    of_copies = copies.join(classes, "node", "left").select("c1", "c2", F.coalesce("class", "node").alias("of_copies"))
    placed = written(
        spread_join(rows, of_copies, ["c1", "c2"], "row", "left").join(classes.select(F.col("node").alias("row"), F.col("class").alias("own")), "row", "left")
        .select("row", "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("of_copies", "own", "row")).otherwise(F.col("row")).alias("class")), "placed")
    groups = placed.groupBy("class").agg(F.min(order).alias("m"), F.count(F.lit(1)).alias("class_size")).filter("class_size > 1")
    return spread_join(placed, groups, ["class"], "row", "left")
