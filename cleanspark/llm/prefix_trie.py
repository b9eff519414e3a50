"""The prefix trie of conversations, by ROLLUP over positional turn-id columns.

Conversations are cut into blocks of ``COLUMNS`` turns. A block is one row: the node that the block starts from (its
key), and a column for each of its turns. One ``GROUP BY block, key, ROLLUP (turn 1, ..., turn n)`` then makes all nodes
of all blocks together, and ``grouping`` tells the depth of each; a longer conversation goes on in the next block, keyed
by the last node of the block before. Sums over subtrees are a second ROLLUP, over the nodes that several conversations
share: below those a path of one conversation is one leaf that saves nothing. What lies in later blocks is added up
first, by pointer doubling over the blocks, so a trie of depth d takes about log2(d / COLUMNS) rounds.

A turn is 128 bits of the SHA-256 of its role and text, a node 128 bits of the SHA-256 of its block's key and turns. A
node of a third of all conversations is one row of each map task (partial aggregates); its children look it up
in as many copies as their counted number asks for; the ids of those that end there are listed in slices of
``SLICE`` ids and hashed slice after slice. One conversation is streamed, sorted, through one task that keeps a block.
"""
from __future__ import annotations

import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import SPACE_CLASS, bound_batches, c, frugal, written

#: Turns of a block, conversations of a family (its head's first turns are shared) and turns that may be shared.
COLUMNS, FAMILY, HEADS = 8, 20, 4
#: Consecutive ids whose conversations are listed as one piece of text.
SLICE = 1 << 16
#: Children that look up one copy of their parent; more, where over HOT_PARENTS parents would have as many.
CHILDREN, HOT_PARENTS = 10_000, 100_000
ROOT = bytes(16)
_ROWS = 4096


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``family, conv_id, turn, t, w`` of every turn: its 128 bits and the words of its text."""
    rows = df.filter(c(conv_col).isNotNull()).select(
        c(conv_col).cast("long").alias("conv_id"), c(turn_col).alias("turn"),
        F.coalesce(c(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(c(text_col).cast("string"), F.lit("")).alias("text"))
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.select((F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), "conv_id", "turn",
                       F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("t"),
                       F.regexp_count("text", F.lit(SPACE_CLASS.replace("[", "[^") + "+")).cast("int").alias("w"),
                       (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int").alias("h"))


def _rebuilt(rows):
    """Of sorted (family, conv_id, t, w, h) rows: each conversation's id and an iterator over its rebuilt turns."""
    for family, members in itertools.groupby(rows, key=lambda r: r[0]):
        heads = []
        for conv, own in itertools.groupby(members, key=lambda r: r[1]):
            if conv == family:  # sorted first
                head = list(itertools.islice(own, HEADS - 1))
                heads = [(t, w) for _, _, t, w, _ in head]
                own = itertools.chain(head, own)
            first = next(own)
            turns = itertools.chain([first], own)
            yield conv, itertools.chain(heads[:first[4]], ((t, w) for _, _, t, w, _ in itertools.islice(turns, first[4], None)))


def _blocks(turns: DataFrame, columns: int) -> DataFrame:
    """``conv_id, k, key, more, n, t1, w1, ...``: a row for each block of a rebuilt conversation, at least one; ``more``
    says whether a further block follows, ``n`` is the number of its turns."""
    names = ["conv_id", "k", "key", "more", "n", *itertools.chain.from_iterable((f"t{i}", f"w{i}") for i in range(1, columns + 1))]
    kinds = ["bigint", "int", "binary", "boolean", "int", *["binary", "int"] * columns]
    types = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}

    def blocks(rows):
        for conv, turns_of in _rebuilt(rows):
            k, key = 0, ROOT
            part = list(itertools.islice(turns_of, columns))
            while True:
                following = list(itertools.islice(turns_of, columns)) if len(part) == columns else []
                yield conv, k, key, bool(following), len(part), *itertools.chain.from_iterable(part + [(None, None)] * (columns - len(part)))
                if not following:
                    break
                key = hashlib.sha256(key + b"".join(t for t, _ in part)).digest()[:16]
                k, part = k + 1, following

    def run(batches):
        rows = itertools.chain.from_iterable(zip(*(x.to_pylist() for x in batch.columns)) for batch in batches)
        made = blocks(rows)
        while out := list(itertools.islice(made, _ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(x, types[kind]) for x, kind in zip(zip(*out), kinds)], names=names)

    ordered = turns.repartition("family").sortWithinPartitions(
        "family", F.col("conv_id") != F.col("family"), "conv_id", F.col("turn").asc_nulls_first(), "t")
    return ordered.select("family", "conv_id", "t", "w", "h").mapInArrow(frugal(run), ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def _rollup(rows: DataFrame, columns: int, aggregates: str, words: bool) -> DataFrame:
    """All prefixes of the blocks of ``rows`` with ``aggregates``, their depth ``j`` within the block and node ``id``."""
    levels = ", ".join(f"(t{i}, w{i})" if words else f"t{i}" for i in range(1, columns + 1))
    depth = " + ".join(f"(1 - grouping(t{i}))" for i in range(1, columns + 1))
    kept = ", ".join(f"t{i}" + (f", w{i}" if words else "") for i in range(1, columns + 1))
    found = rows.sparkSession.sql(
        f"SELECT k, key, {kept}, CAST({depth} AS INT) AS j, {aggregates} FROM {{rows}} GROUP BY k, key, ROLLUP ({levels})", rows=rows)
    last = _by_depth(columns, lambda i: F.col(f"t{i}"), F.col("key"))
    # a set of more columns than the block has turns repeats a shorter one; a later block's key is the last node of the former
    return found.filter(last.isNotNull() & ((F.col("j") > 0) | (F.col("k") == 0))).withColumn("id", _node(columns, F.col("j")))


def _by_depth(columns: int, of, root: Column) -> Column:
    out = F.when(F.col("j") == 0, root)
    for i in range(1, columns + 1):
        out = out.when(F.col("j") == i, of(i))
    return out


def _node(columns: int, depth: Column) -> Column:
    """128 bits of the block's key and its first ``depth`` turns; without any, the key itself."""
    turns = [F.when(depth >= i, F.coalesce(F.col(f"t{i}"), F.lit(b""))).otherwise(F.lit(b"")) for i in range(1, columns + 1)]
    return F.when(depth <= 0, F.col("key")).otherwise(F.substring(F.unhex(F.sha2(F.concat("key", *turns), 256)), 1, 16))


def _ends(blocks: DataFrame, columns: int, slice_ids: int) -> DataFrame:
    """``id, ends_sha256`` of every node where conversations end: of their decimal ids, ascending, joined by commas."""
    listed = blocks.filter("NOT more").select(_node(columns, F.col("n")).alias("id"), F.floor(F.col("conv_id") / slice_ids).alias("slice"), "conv_id")
    pieces = written(listed.groupBy("id", "slice").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
                     .select("id", "slice", F.array_join("ids", ",").alias("piece")), "ends")
    counts = pieces.groupBy("id").agg(F.count(F.lit(1)).alias("pieces"), F.min("piece").alias("piece"))
    single = counts.filter("pieces = 1").select("id", F.sha2("piece", 256).alias("ends_sha256"))

    def run(batches):
        node, digest = None, None
        for batch in batches:
            done = []
            for i, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i != node:
                    done += [(node, digest.hexdigest())] if node else []
                    node, digest = i, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done])], names=["id", "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["id", "ends_sha256"])

    several = pieces.join(counts.filter("pieces > 1").select("id"), "id", "left_semi")
    streamed = several.repartition("id").sortWithinPartitions("id", "slice").select("id", "piece").mapInArrow(frugal(run), "id binary, ends_sha256 string")
    return single.union(streamed)


def _below(shared: DataFrame) -> DataFrame:
    """``key, leaves, saved``: the sums of each block of ``shared`` but the first, with all blocks below it."""
    blocks = shared.filter("k > 0").groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    above = shared.filter("k > 0").select(F.col("id").alias("key"), F.col("key").alias("up"))
    tree = written(blocks.join(above, "key", "left"), "blocks")
    while not tree.filter("up IS NOT NULL").isEmpty():
        more = tree.filter("up IS NOT NULL").groupBy("up").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")).withColumnRenamed("up", "key")
        higher = tree.select(F.col("key").alias("up"), F.col("up").alias("next"))
        tree = written(tree.join(more, "key", "left").join(higher, "up", "left").select(
            "key", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
            F.col("next").alias("up")), "blocks")
    return tree.drop("up")


def prefix_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                columns: int = COLUMNS, slice_ids: int = SLICE, children: int = CHILDREN) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations of ``df``: ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256`` and ``node``, its 128 bits.

    A conversation's turns are ordered by ``turn`` (nulls first; of equal turns by the SHA-256 of ``length(role):role
    text``); a null role or text is empty. The first h turns, h = crc32(decimal id) modulo 4, are replaced by those of
    the family's head, conversation id - id % 20 (none where it is absent). Rows without a conversation id belong to no
    conversation; repeated rows are turns of their own; an empty table has no node, not even the root. Ids are whole
    numbers (other values of a text column count as null)."""
    bound_batches(df.sparkSession)
    turns = _turns(df.withColumn(conv_col, c(conv_col).try_cast("long")) if dict(df.dtypes)[conv_col] == "string" else df,
                   conv_col, turn_col, role_col, text_col)
    blocks = written(_blocks(turns, columns), "blocks")
    words = _by_depth(columns, lambda i: F.col(f"w{i}"), F.lit(0))
    nodes = written(_rollup(blocks, columns, "min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS turns, max(more) AS more", words=True).select(
        "id", F.when(F.col("j") > 0, _node(columns, F.col("j") - 1)).alias("parent"), "k", "key", "j", *[f"t{i}" for i in range(1, columns + 1)],
        (F.col("k") * columns + F.col("j")).cast("long").alias("depth"), words.cast("long").alias("words"), "conv_id", "n_convs",
        # of a node of one conversation: whether that goes on
        (F.col("j") < F.col("turns")).alias("inner"), F.col("more")), "nodes")

    is_shared = (F.col("n_convs") > 1) | (F.col("depth") == 0)
    limit = max(children, nodes.count() // HOT_PARENTS)
    kids = written(nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single")), "children")
    shared = written(nodes.filter(is_shared).join(kids, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumn(
        "leaves", F.coalesce("single", F.lit(0)) + F.when(F.col("n_children") == 0, 1).otherwise(0)).withColumn(
        "saved", (F.col("n_convs") - 1) * F.col("words")), "shared")

    below = _below(shared).withColumnRenamed("key", "id").withColumnsRenamed({"leaves": "more_leaves", "saved": "more_saved"})
    full = shared.join(below, "id", "left").withColumn("leaves", F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).withColumn(
        "saved", F.col("saved") + F.coalesce("more_saved", F.lit(0)))
    sums = _rollup(full, columns, "sum(leaves) AS n_leaves, sum(saved) AS saved_tokens", words=False).select("id", "n_leaves", "saved_tokens")

    # parents, in as many copies as their children ask for (at most HOT_PARENTS parents are repeated)
    copies = F.ceil(F.col("n_children") / limit).cast("int")
    hot = kids.filter(F.col("n_children") > limit).select(F.col("id").alias("parent"), copies.alias("copies"))
    parents = shared.filter("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
                                                     F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    placed = (nodes.join(F.broadcast(hot), "parent", "left")
              .withColumn("copy", F.pmod(F.xxhash64("id"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
              .join(parents, ["parent", "copy"], "left")
              .withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))))

    none = F.sha2(F.lit("").cast("binary"), 256)
    ends_here = ~F.col("inner") & ~F.col("more")
    paths = placed.filter(~is_shared).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.when(ends_here, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(ends_here, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(none).alias("ends_sha256"), F.col("id").alias("node"))
    rest = (placed.filter(is_shared).join(shared.select("id", "n_children"), "id").join(sums, "id").join(_ends(blocks, columns, slice_ids), "id", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", none).alias("ends_sha256"), F.col("id").alias("node")))
    return paths.union(rest)
