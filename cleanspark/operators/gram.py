"""Correlations of many columns from one block Gram matrix a task.

With missing cells every pair of columns has its own complete rows, so a pair needs a count, two means, two sums of
squares and a sum of products. For k columns these are six k x k matrices, and for a batch of rows X with a mask M they are
products of M, X and X squared: a task keeps them for its rows and merges batch after batch around their means, so large
offsets cost no digits. What leaves a task are the pairs' figures, k (k - 1) / 2 rows; Spark merges those of all tasks
by pair, again around the common mean. No expression grows with the number of columns, and the data are read once.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ship_package

#: Rows of a batch that are multiplied at once, and pairs of an output batch.
ROWS, PAIRS = 8_192, 65_536
_SCHEMA = "i int, j int, n bigint, mi double, mj double, qi double, qj double, c double"


class PairMoments:
    """Counts, means, centred squares and products of all pairs of ``k`` columns, each over the pair's complete rows. ``mean`` and
    ``square`` hold, at [i, j], those of column i where column j is not missing."""

    def __init__(self, k: int):
        self.n, self.mean, self.square, self.product = (np.zeros((k, k)) for _ in range(4))

    def add(self, x: np.ndarray) -> None:
        """Rows of ``x``, with NaN for missing cells."""
        held = ~np.isnan(x)
        mask = held.astype(np.float64)
        # shifted by a value of the column, so that a constant one gives exact zeros
        shift = np.where(held.any(axis=0), x[held.argmax(axis=0), np.arange(x.shape[1])], 0.0)
        d = np.where(held, x - shift, 0.0)
        n = mask.T @ mask
        some = np.maximum(n, 1)
        s, q, p = d.T @ mask, (d * d).T @ mask, d.T @ d
        self.merge(n, s / some + shift[:, None], q - s * s / some, p - s * s.T / some)

    def merge(self, n, mean, square, product) -> None:
        total = self.n + n
        some = np.maximum(total, 1)
        delta = np.where((self.n > 0) & (n > 0), mean - self.mean, 0.0)
        weight = self.n * n / some
        self.square += square + delta * delta * weight
        self.product += product + delta * delta.T * weight
        self.mean = np.where(self.n > 0, self.mean + delta * n / some, mean)
        self.n = total


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``i, j, n, mi, mj, qi, qj, c``: what each task has of the columns numbered i < j: complete rows, means, centred sums of
    squares and products."""
    ship_package(df.sparkSession)
    k = len(columns)

    def run(batches):
        moments = PairMoments(k)
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    moments.add(np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in part.columns]))
        i, j = np.triu_indices(k, 1)
        seen = moments.n[i, j] > 0
        i, j = i[seen], j[seen]
        for at in range(0, len(i), PAIRS):
            a, b = i[at:at + PAIRS], j[at:at + PAIRS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(moments.n[a, b].astype(np.int64)),
                 *(pa.array(x) for x in (moments.mean[a, b], moments.mean[b, a], moments.square[a, b], moments.square[b, a], moments.product[a, b]))],
                names=["i", "j", "n", "mi", "mj", "qi", "qj", "c"])

    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{x}") for x, c in enumerate(columns)])
    return values.mapInArrow(run, _SCHEMA)


def correlation_matrix(df: DataFrame, columns: Sequence[str], threshold: float | None = None) -> DataFrame:
    """``col1, col2, corr`` of every pair of ``columns``, in their order: Pearson's r over the rows where both have a value. Null where
    a column is constant there, or no row has both; ``threshold`` keeps |r| above it."""
    columns = list(columns)
    pair = Window.partitionBy("i", "j")

    def common(mean: str):  # around the least of the tasks' means, so that equal ones give exactly themselves
        least = F.min(mean).over(pair)
        return least + F.sum((F.col(mean) - F.col(f"{mean}_least")) * F.col("n")).over(pair) / F.sum("n").over(pair)

    parts = pair_moments(df, columns).select("*", F.min("mi").over(pair).alias("mi_least"), F.min("mj").over(pair).alias("mj_least"))
    parts = parts.select("*", common("mi").alias("ti"), common("mj").alias("tj"))
    di, dj = F.col("mi") - F.col("ti"), F.col("mj") - F.col("tj")
    found = parts.groupBy("i", "j").agg(F.sum(F.col("qi") + F.col("n") * di * di).alias("qi"), F.sum(F.col("qj") + F.col("n") * dj * dj).alias("qj"),
                                        F.sum(F.col("c") + F.col("n") * di * dj).alias("c"))
    r = F.when((F.col("qi") > 0) & (F.col("qj") > 0), F.col("c") / (F.sqrt("qi") * F.sqrt("qj")))
    k = len(columns)
    every = df.sparkSession.range(k).select(F.col("id").cast("int").alias("i")).select(
        "i", F.explode(F.sequence(F.col("i") + 1, F.lit(k))).alias("j")).where(F.col("j") < k)
    names = F.array(*[F.lit(c) for c in columns])
    out = every.join(found, ["i", "j"], "left").select(
        names[F.col("i")].alias("col1"), names[F.col("j")].alias("col2"), F.when(~F.isnan(r), r).alias("corr"))
    return out if threshold is None else out.where(F.abs("corr") > threshold)
