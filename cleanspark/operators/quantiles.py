"""Exact quantiles with linear interpolation, distributed.

Spark's exact ``percentile`` merges all distinct values of a column in one task. Here every wanted rank of every column
is narrowed by counting, all of them in the same job per pass, straight from the scan:

1. first pass: per column, values are counted by sign and binary exponent (at most about 4,200 groups a column, in
   order), with each group's smallest and largest value. Infinities and zero are groups of their own;
2. a rank lies in one group; while that group holds more than one value, a pass counts it in ``buckets`` equal steps
   between its smallest and largest value, and the rank moves on to one of them.

A group's bounds share sign and exponent, so widths never overflow, and its smallest and largest value always fall into
different steps, so every pass shrinks it: at most five more passes (53 bits, 12 a pass), one or two for columns of few
values. What moves is counts, never values. NaN counts as missing.

Result rows: ``(column, p, value)``; ``value`` is null for a column without values.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 4096
# Makes every binary exponent of a double (-1074 to 1023) positive; lies beyond the largest sum.
_EXPONENTS, _INFINITE = 1100, 3000


def long_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, v)`` for the non-null, non-NaN values of ``columns`` cast to double."""
    cols = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns]
    x = df.select(F.explode(F.array(*cols)).alias("x")).select("x.column", "x.v")
    return x.where(F.col("v").isNotNull() & ~F.isnan("v"))


def _pick(groups: Sequence[tuple[int, int, float, float]], rank: int) -> tuple[int, float, float]:
    """The group (``order, rows, lo, hi``) that holds ``rank``: ``(rank inside, lo, hi)``."""
    for _, rows, lo, hi in sorted(groups):
        if rank < rows:
            return rank, lo, hi
        rank -= rows
    raise ValueError("the rank lies beyond the counted rows; the input changed between passes")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], buckets: int = BUCKETS) -> DataFrame:
    spark = df.sparkSession
    columns, probs = list(columns), [float(p) for p in probs]
    if buckets < 2:
        raise ValueError("narrowing needs at least two buckets")
    v = F.col("v")
    exponent = F.when(F.abs(v) == float("inf"), F.lit(_INFINITE)).otherwise(
        F.floor(F.log2(F.abs(v))).cast("int") + F.lit(_EXPONENTS))
    order = F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("int") * exponent)
    values = long_numeric(df, columns)
    by_column: dict[str, list] = {}
    for r in values.groupBy("column", order.alias("o")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
        by_column.setdefault(r["column"], []).append((r["o"], r["n"], r["lo"], r["hi"]))

    wanted: dict[tuple[str, float], tuple[int, int, float]] = {}
    state: dict[tuple[str, int], tuple[int, float, float]] = {}
    for c, groups in by_column.items():
        total = sum(g[1] for g in groups)
        for p in probs:
            pos = (total - 1) * p
            low, high = int(math.floor(pos)), int(math.ceil(pos))
            wanted[(c, p)] = (low, high, pos - low)
            for rank in (low, high):
                state[(c, rank)] = _pick(groups, rank)

    while True:
        ranges = sorted({(c, lo, hi) for (c, _), (_, lo, hi) in state.items() if lo < hi})
        if not ranges:
            break
        targets = spark.createDataFrame([(i, *r) for i, r in enumerate(ranges)], "t int, column string, lo double, hi double")
        step = F.least(F.floor((v - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(buckets)).cast("int"), F.lit(buckets - 1))
        inside = values.join(F.broadcast(targets), "column").where((v >= F.col("lo")) & (v <= F.col("hi")))
        counted: dict[tuple, list] = {}
        for r in inside.groupBy("t", step.alias("o")).agg(
                F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
            counted.setdefault(ranges[r["t"]], []).append((r["o"], r["n"], r["lo"], r["hi"]))
        state = {(c, rank): _pick(counted[(c, lo, hi)], left) if lo < hi else (left, lo, hi)
                 for (c, rank), (left, lo, hi) in state.items()}

    rows = []
    for c in columns:
        for p in probs:
            if (c, p) not in wanted:
                rows.append((c, p, None))
                continue
            low, high, part = wanted[(c, p)]
            a, b = state[(c, low)][1], state[(c, high)][1]
            rows.append((c, p, a if part == 0 or a == b else a + (b - a) * part))
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("column", T.StringType()), T.StructField("p", T.DoubleType()), T.StructField("value", T.DoubleType())]))


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10000) -> DataFrame:
    """Sketch quantiles (GK sketch, ``percentile_approx``): one pass, bounded memory, rank error ~1/accuracy."""
    lv = long_numeric(df, columns)
    q = lv.groupBy("column").agg(F.percentile_approx("v", list(probs), accuracy).alias("qs"))
    return q.select("column", F.posexplode("qs").alias("i", "value")).select(
        "column", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1).alias("p"), "value")
