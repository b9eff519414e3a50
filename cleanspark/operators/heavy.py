"""The most common value of each column without a table of all values.

1. A sketch of the most frequent items of each column (``approx_top_k``, merged from all tasks) names candidates;
2. the candidates, ``CANDIDATES`` a column, are counted exactly;
3. a value that is no candidate has at most the sketch's error, or the least estimate among the candidates where
   there are more values than those. A best count above that is the answer, ties included. Columns where it is not
   (nearly unique ones, whose most common value occurs a few times) are counted in full, those alone.

What is shuffled for 1 and 2 is bounded by the sketches of the tasks, however many values a column has.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items that a column's sketch keeps, and candidates taken from it. An item's estimate is off by ERROR of all values at most
#: (the sketch's stated error is 3.5 over its size, which is above TRACKED).
TRACKED, CANDIDATES = 4_096, 64
ERROR = 3.5 / TRACKED


def common_values(long: DataFrame, candidates: int = CANDIDATES, tracked: int = TRACKED) -> tuple[DataFrame, dict[str, tuple]]:
    """Of ``long`` (column, value): the rows of columns that stay undecided, and ``{column: (value, count, rows)}`` of the others. A
    column without values has value None and count 0."""
    rows = {r["column"]: r for r in long.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("held"),
        F.expr(f"approx_top_k(value, {candidates}, {tracked}) FILTER (WHERE value IS NOT NULL)").alias("top")).collect()}
    named = [(c, x["item"]) for c, r in rows.items() for x in r["top"] or [] if x["item"] is not None]
    spark = long.sparkSession
    best: dict[str, tuple] = {}
    if named:
        listed = F.broadcast(spark.createDataFrame(named, "column string, value string"))  # CANDIDATES rows a column
        exact = long.join(listed, ["column", "value"]).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        top = exact.groupBy("column").agg(F.min_by(F.struct("value", "n"), F.struct(-F.col("n"), F.col("value"))).alias("x")).collect()
        best = {r["column"]: (r["x"]["value"], r["x"]["n"]) for r in top}
    decided = {}
    for column, r in rows.items():
        estimates = [x["count"] for x in r["top"] or []]
        everything = sum(estimates) == r["held"] and len(estimates) < candidates  # each value is a candidate, each count exact
        others = max(3.5 / tracked * r["held"], min(estimates) if len(estimates) >= candidates else 0)
        if not r["held"]:
            decided[column] = (None, 0, r["rows"])
        elif column in best and (everything or best[column][1] > others):
            decided[column] = (*best[column], r["rows"])
    return long.where(~F.col("column").isin(list(decided))) if decided else long, decided


def most_common(long: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """``column, value, n, rows`` of each of ``columns`` that ``long`` (column, value) holds: its most common value (of equally common
    ones the smallest), how often it occurs, and all rows."""
    rest, decided = common_values(long, **options)
    out = long.sparkSession.createDataFrame([(c, *x) for c, x in decided.items()], "column string, value string, n bigint, rows bigint")
    if len(decided) == len(columns):
        return out
    counts = rest.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct("value", "n"), F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("value"))))
    full = counts.groupBy("column").agg(F.sum("n").alias("rows"), best.alias("x"))
    return out.unionByName(full.select("column", "x.value", F.coalesce("x.n", F.lit(0)).alias("n"), "rows"))
