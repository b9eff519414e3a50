"""Sharding by jump consistent hashing (Lamping & Veach 2014): no ring table, an added shard takes only its share.

The published loop runs natively: a linear congruential step on the 64-bit key, held exactly in ``decimal`` because
Spark's long arithmetic refuses to wrap, and a jump ``j = floor((b + 1) * 2^31 / ((key >> 33) + 1))`` until the jump
leaves the shards.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import c

#: Fixed values of the published algorithm.
MULTIPLIER = 2862933555777941757
MODULUS = 1 << 64
#: Slot numbering splits each shard into this many pieces, so that no task sorts a whole shard.
PIECES = 256


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards``-1 of a 64-bit key (negative longs as their unsigned pattern; null counts as key 0).

    The jump position rises with every step, so ``shards`` steps always suffice; later ones leave the state alone."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    if shards > (1 << 31) - 1:
        raise ValueError("shard numbers must fit an int")

    def advance(k: Column) -> Column:
        return ((k * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)"))
                % F.lit(str(MODULUS)).cast("decimal(20,0)")).cast("decimal(20,0)")

    value = F.coalesce(key.cast("long"), F.lit(0)).cast("decimal(20,0)")
    unsigned = F.when(value < 0, value + F.lit(str(MODULUS)).cast("decimal(20,0)")).otherwise(value).cast("decimal(20,0)")
    start = F.struct(advance(unsigned).alias("k"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s: Column, _: Column) -> Column:
        top = F.floor(s["k"].cast("decimal(38,10)") / F.lit(1 << 33).cast("decimal(11,0)")).cast("double")
        jump = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (top + 1.0))).cast("long")
        return F.when(s["j"] >= shards, s).otherwise(
            F.struct(advance(s["k"]).alias("k"), s["j"].alias("b"), jump.alias("j")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def stable_key(*columns: Column) -> Column:
    """A 64-bit key for anything that is not already one integral column."""
    return F.xxhash64(*columns)


def assign_shards(df: DataFrame, key: Column, shards: int, shard_col: str = "shard") -> DataFrame:
    """``df`` with its shard; a column of that name is replaced."""
    return df.withColumn(shard_col, jump_hash(key, shards))


def number_slots(df: DataFrame, order: list[str], shards: int, pieces: int = PIECES) -> DataFrame:
    """``df`` (with a column ``shard``) and ``slot``: gapless numbers from 0 inside each shard.

    A shard is cut into ``pieces`` by a hash of its order columns; a piece is numbered by itself and starts where the
    pieces before it end. The table of starts has at most ``shards * pieces`` rows, hence its broadcast.
    Rows equal in all order columns take neighbouring slots in any order."""
    if shards * pieces > 1 << 20:
        raise ValueError("shards * pieces bounds a broadcast table and must stay within 2^20")
    pieced = df.withColumn("__piece", F.pmod(F.xxhash64(*[c(x) for x in order]), F.lit(pieces)).cast("int"))
    sizes = pieced.groupBy("shard", "__piece").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "__piece", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("shard", "__piece").orderBy(*[c(x) for x in order])
    return (pieced.join(F.broadcast(starts), ["shard", "__piece"])
            .withColumn("slot", (F.col("__start") + F.row_number().over(inside) - 1).cast("long"))
            .drop("__piece", "__start"))


def shard_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 length (null: 0) plus 1, ``text_crc32`` of a null text that of an empty one. The law
    is ``key``: id and shard count alone decide, whatever the text, so equal texts may lie in different shards and
    rows that repeat an id share its shard. A null id counts as key 0. ``grown_shard`` is the shard among one more."""
    text = F.coalesce(c(text_col).cast("string"), F.lit(""))
    rows = df.select(
        c(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"), jump_hash(c(id_col), shards).alias("shard"),
        jump_hash(c(id_col), shards + 1).alias("grown_shard"))
    return number_slots(rows, ["doc_id", "size", "text_crc32"], shards).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(df: DataFrame, path: str) -> None:
    """Write a sharded table (columns ``shard`` and ``slot``) as one folder per shard. Each shard is written by many
    tasks, one per range of slots, and rows inside a file are in slot order."""
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
