"""V9: before/after quality metrics of a cleaning run."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import coerce_number
from ..session import cut_lineage
from .quantiles import exact_quantiles

# The weights of the quality figure (percent points of missing cells, invalid cells, copies, outliers).
WEIGHTS = {"completeness": 40.0, "validity": 30.0, "uniqueness": 20.0, "inliers": 10.0}


def stage_metrics(df: DataFrame, stage: str, valid: dict | None = None, outliers_of: str | None = None,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """One row per stage: ``rows``, ``completeness`` (non-null cells / cells), ``exact_copies`` (rows - distinct rows),
    ``invalid_cells`` (non-null cells of the columns in ``valid`` whose condition does not hold), ``error_rate`` (invalid
    / non-null cells), ``outliers`` (values of ``outliers_of`` outside the quartile fences) and ``quality`` (0 to 100).

    One shuffle besides the quantiles: ``groupBy(all columns)`` gives copies per distinct row, all counts ride along."""
    cols = list(columns or df.columns)
    nn = sum((F.when(F.col(f"`{c}`").isNotNull(), 1).otherwise(0) for c in cols), F.lit(0))
    bad = sum((F.when(F.col(f"`{c}`").isNotNull() & ~F.coalesce(cond, F.lit(False)), 1).otherwise(0)
               for c, cond in (valid or {}).items()), F.lit(0))
    out = F.lit(0)
    if outliers_of:
        number = coerce_number(outliers_of)
        q = {r["p"]: r["value"] for r in exact_quantiles(df.select(number.alias("x")), ["x"], [0.25, 0.75]).collect()}
        if q[0.25] is not None:
            spread = 1.5 * (q[0.75] - q[0.25])
            out = F.when((number < q[0.25] - spread) | (number > q[0.75] + spread), 1).otherwise(0)
    g = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_n")).select(
        "_n", nn.alias("_nn"), bad.alias("_bad"), out.alias("_out"))
    m = g.agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(n) for n, x in (
        ("rows", F.col("_n")), ("_cells", F.col("_nn") * F.col("_n")), ("invalid_cells", F.col("_bad") * F.col("_n")),
        ("outliers", F.col("_out") * F.col("_n")))], F.count(F.lit(1)).alias("_distinct"))

    def share(a, b):
        return F.try_divide(F.col(a).cast("double") if isinstance(a, str) else a.cast("double"), b.cast("double"))

    m = m.withColumn("completeness", share("_cells", F.col("rows") * len(cols))) \
         .withColumn("exact_copies", (F.col("rows") - F.col("_distinct")).cast("bigint")) \
         .withColumn("error_rate", share("invalid_cells", F.col("_cells")))
    quality = (WEIGHTS["completeness"] * F.col("completeness") + WEIGHTS["validity"] * (1 - F.coalesce("error_rate", F.lit(0.0)))
               + WEIGHTS["uniqueness"] * share("_distinct", F.col("rows"))
               + WEIGHTS["inliers"] * (1 - share("outliers", F.col("rows"))))
    return m.select(F.lit(stage).alias("stage"), "rows", "completeness", "exact_copies", "invalid_cells", "error_rate",
                    "outliers", quality.alias("quality"))


def before_after(raw: DataFrame, clean: DataFrame, valid_raw: dict | None = None, valid_clean: dict | None = None,
                 outliers_of: str | None = None) -> DataFrame:
    """Two rows, ``before`` and ``after``, with ``improvement_pct``: the quality gained in percent of that before.

    ``clean`` is read twice and written for that; the two rows are written, as both the base and the gain are made of them."""
    clean = cut_lineage(clean)
    both = cut_lineage(stage_metrics(raw, "before", valid_raw, outliers_of).unionByName(stage_metrics(clean, "after", valid_clean, outliers_of)))
    before = F.max(F.when(F.col("stage") == "before", F.col("quality")))
    base = both.agg(before.alias("base")).collect()[0]["base"]  # one figure
    gain = F.when(F.col("stage") == "after", F.try_divide((F.col("quality") - F.lit(base)) * 100.0, F.lit(base)))
    return both.withColumn("improvement_pct", gain)
