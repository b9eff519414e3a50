"""Benchmark decontamination by winnowing.

Of every ``window - k + 1`` consecutive k-word hashes the smallest is a fingerprint, on both sides. Two texts that
share ``window`` words in a row share the fingerprint of that span, so joining fingerprints finds every shared span.
A fingerprint carries the words around it, as many as a window can reach; after the join the match is extended over
them, and a run of ``window`` words is a hit. Items shorter than a window are matched as a whole: they are fingerprints
of their own length.

Only fingerprints that a fixed-size Bloom filter of the benchmark lets through leave a document's task, so what is
shuffled follows the contamination, not the corpus. The filter's size does not depend on the benchmark: a larger
benchmark lets more fingerprints through, the join still decides.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleanspark.session import ship_package

from . import words as W
from .base import c, written

#: Words of a fingerprint's gram.
K = 5
#: Bits of the Bloom filter (4 MB).
BLOOM_BITS = 1 << 25
#: Benchmark fingerprints that are broadcast at most (about 200 bytes each); beyond, both sides are shuffled.
BROADCAST_FINGERPRINTS = 50_000
#: Bytes of text handled at once.
SLICE_BYTES = 1 << 20

_PRINTS = "array<struct<kind:int,fp:bigint,pos:int,around:array<bigint>>>"


def winnow(words: np.ndarray, bounds: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes, and which of them are the smallest of some window that lies in one text (ties: all)."""
    h, _ = W.grams(words, bounds, k)
    n, span = len(words), window - k + 1
    chosen = np.zeros(n, bool)
    if n < window:
        return h, chosen
    whole = (np.arange(n) + window <= np.repeat(bounds[1:], np.diff(bounds)))[:n - window + 1]
    least = h[:n - window + 1].copy()
    for j in range(1, span):
        np.minimum(least, h[j:n - window + 1 + j], out=least)
    for j in range(span):
        chosen[j:n - window + 1 + j] |= (h[j:n - window + 1 + j] == least) & whole
    return h, chosen


def _around(words: np.ndarray, bounds: np.ndarray, at: np.ndarray, before: int, length: int, pad: int) -> np.ndarray:
    """For each position the ``length`` words from ``before`` words ahead of it; ``pad`` outside of its text."""
    text = np.searchsorted(bounds, at, "right") - 1
    where = at[:, None] - before + np.arange(length)
    inside = (where >= bounds[text][:, None]) & (where < bounds[text + 1][:, None])
    return np.where(inside, words[np.clip(where, 0, max(0, len(words) - 1))], np.uint64(pad)).astype(np.int64)


def _probes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(BLOOM_BITS - 1)
    return h & mask, (h >> np.uint64(32)) & mask


def _prints(words, bounds, window, k, lengths, pad, bloom):
    """Fingerprints of all texts, ordered by kind; each kind's positions, hashes and surrounding words."""
    for kind in (window, *lengths):
        if kind == window:
            h, chosen = winnow(words, bounds, k, window)
            before, length = window - k, 2 * window - k
        else:
            h, chosen = W.grams(words, bounds, kind)
            before, length = 0, kind
        at = np.flatnonzero(chosen)
        h = h[at]
        if bloom is not None and len(at):
            a, b = _probes(h)
            through = (bloom[a >> np.uint64(3)] >> (a & np.uint64(7)).astype(np.uint8)) & (bloom[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1
            at, h = at[through == 1], h[through == 1]
        yield kind, at, h.astype(np.int64), _around(words, bounds, at, before, length, pad)


def _struct_lists(rows: int, bounds: np.ndarray, parts) -> pa.Array:
    """One list of fingerprint structs per text, ordered by position."""
    kind = np.concatenate([np.full(len(p[1]), p[0], np.int32) for p in parts])
    at = np.concatenate([p[1] for p in parts])
    fp = np.concatenate([p[2] for p in parts])
    order = np.argsort(at, kind="stable")
    width = np.concatenate([np.full(len(p[1]), p[3].shape[1]) for p in parts])
    flat = np.concatenate([p[3].ravel() for p in parts])
    begin = (np.cumsum(width) - width)[order]
    width = width[order]
    ends = np.cumsum(width)
    index = np.repeat(begin - (ends - width), width) + np.arange(ends[-1] if len(ends) else 0)
    text = np.searchsorted(bounds, at[order], "right") - 1
    structs = pa.StructArray.from_arrays(
        [pa.array(kind[order]), pa.array(fp[order]), pa.array((at[order] - bounds[text]).astype(np.int32)),
         pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat[index]))],
        names=["kind", "fp", "pos", "around"])
    per_text = np.searchsorted(at[order], bounds).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(per_text), structs)


def _scan(rows: DataFrame, kind_of_id: str, window: int, k: int, lengths: tuple[int, ...], item_side: bool, bloom=None) -> DataFrame:
    """``row`` (unique in this scan), ``id``, ``n_words`` and the fingerprints of each text of ``rows`` (id, text).

    On the item side a short text is fingerprinted with its own length only."""
    schema = f"row bigint, id {kind_of_id}, n_words int, prints {_PRINTS}"

    def run(batches):
        table = None if bloom is None else np.frombuffer(bloom.value, np.uint8)
        base, count = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            raw_all, bounds_all = W.text_bytes(batch.column(1))
            for a, b in W.row_slices(bounds_all, SLICE_BYTES):
                hashes, bounds = W.word_hashes(raw_all[bounds_all[a]:bounds_all[b]], bounds_all[a:b + 1] - bounds_all[a])
                sizes = np.diff(bounds)
                parts = []
                for kind, at, fp, around in _prints(hashes, bounds, window, k, lengths, 1 if item_side else 0, table):
                    if kind != window:
                        whole = W.grams(hashes, bounds, kind)[1][at] if len(at) else np.zeros(0, bool)
                        if item_side and len(at):
                            whole &= sizes[np.searchsorted(bounds, at, "right") - 1] == kind
                        at, fp, around = at[whole], fp[whole], around[whole]
                    parts.append((kind, at, fp, around))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(base + count, base + count + b - a)), batch.column(0).slice(a, b - a),
                     pa.array(sizes.astype(np.int32)), _struct_lists(b - a, bounds, parts)],
                    names=["row", "id", "n_words", "prints"])
                count += b - a

    return rows.mapInArrow(run, schema)


def _bloom(prints: DataFrame) -> bytes:
    """The filter's bits: set bits are combined per 64-bit word in Spark, at most BLOOM_BITS / 64 rows come back."""
    mask = BLOOM_BITS - 1
    bits = prints.select(F.explode(F.array(
        F.col("fp").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("fp", 32).bitwiseAND(F.lit(mask)))).alias("bit"))
    cells = (bits.groupBy(F.shiftright("bit", 6).alias("cell"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).toArrow())
    out = np.zeros(BLOOM_BITS // 64, np.int64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return out.tobytes()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10, k: int = K) -> DataFrame:
    """One row per document row: ``doc_id, n_words, n_hit, item_ids, spans``.

    ``n_hit`` counts the document's words inside any occurrence of ``window`` consecutive words of an item, or of a
    whole item with fewer words; ``item_ids`` are the items with such occurrences (as strings, sorted, distinct),
    ``spans`` the matched runs as (first word, word after the last), which may overlap. Null and empty texts have no
    words. Items without words match nothing; items under one id are one item; a null item id hits but is not listed.
    Document rows that repeat are each judged. Empty tables: no documents, no rows; no items, no hits."""
    if not 1 <= k <= window:
        raise ValueError("a gram must fit into the window")
    spark = docs.sparkSession
    ship_package(spark)
    items = benchmark.select(c(item_col).alias("id"), c(item_text_col).cast("string").alias("text"))
    item_id = items.schema["id"].dataType.simpleString()
    scanned = written(_scan(items, item_id, window, k, tuple(range(1, window)), True)
                      .select("id", F.explode("prints").alias("p")).select("id", "p.kind", "p.fp", "p.around"), "item-prints")
    n_prints = scanned.count()
    lengths = tuple(sorted(r[0] for r in scanned.select("kind").distinct().collect() if r[0] != window))  # < window
    bloom = spark.sparkContext.broadcast(_bloom(scanned))
    item_side = scanned.select(F.col("kind").alias("i_kind"), F.col("fp").alias("i_fp"), F.col("around").alias("i_around"),
                               F.col("id").cast("string").alias("item"))
    if n_prints <= BROADCAST_FINGERPRINTS:
        item_side = F.broadcast(item_side)

    rows = docs.select(c(id_col).alias("id"), c(text_col).cast("string").alias("text"))
    doc_id = rows.schema["id"].dataType.simpleString()
    prints = _scan(rows, doc_id, window, k, lengths, False, bloom).select(
        "row", "id", "n_words", F.explode_outer("prints").alias("p")).select(
        "row", "id", "n_words", F.col("p.pos").alias("pos"), F.col("p.around").alias("around"),
        # a document without prints joins nothing; its own number instead of null spreads these rows over the tasks
        F.coalesce("p.kind", F.lit(0)).alias("kind"), F.coalesce("p.fp", "row").alias("fp"))
    joined = prints.join(item_side, (F.col("kind") == F.col("i_kind")) & (F.col("fp") == F.col("i_fp")), "left")

    reach = window - k
    same = F.zip_with("around", "i_around", lambda a, b: a == b)
    matched = joined.withColumn("same", F.when(F.col("i_around").isNotNull(), same))

    def run_of(flags: Column) -> Column:  # equal words before the first difference
        at = F.array_position(flags, False)
        return F.when(at == 0, F.lit(reach)).otherwise(at - 1).cast("int")

    left = run_of(F.reverse(F.slice("same", 1, reach))) if reach else F.lit(0)
    right = run_of(F.slice("same", window + 1, reach)) if reach else F.lit(0)
    core = ~F.array_contains(F.slice("same", reach + 1, k), False)
    whole = ~F.array_contains("same", False)
    span = F.when((F.col("kind") == window) & core & (left + right + k >= window),
                  F.struct((F.col("pos") - left).alias("first"), (F.col("pos") + k + right).alias("end"))).when(
        (F.col("kind") < window) & whole, F.struct(F.col("pos").alias("first"), (F.col("pos") + F.col("kind")).alias("end")))
    hits = matched.select("row", "id", "n_words", span.alias("span"), "item")
    found = hits.groupBy("row", "id").agg(
        F.first("n_words").alias("n_words"), F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.collect_set(F.when(F.col("span").isNotNull(), F.col("item")))).alias("item_ids"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["first"], s["end"]))).alias("n"),
                              F.greatest(s["end"], x["end"]).alias("end")), lambda s: s["n"])
    return found.select(F.col("id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"),
                        covered.cast("long").alias("n_hit"), "item_ids", "spans")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without a hit. Rows that share an id go together."""
    hit = contamination(docs, benchmark, id_col, text_col, **options).filter("n_hit > 0").select(
        F.col("doc_id").alias("__hit_id")).distinct()
    return docs.join(hit, c(id_col).eqNullSafe(F.col("__hit_id")), "left_anti")
