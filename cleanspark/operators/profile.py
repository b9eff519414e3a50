"""Column profiling and the quality score.

Shape of the work: columns are unpivoted inside the scan (``explode`` of a struct array, no shuffle) and every
statistic is a ``groupBy(column)`` or ``groupBy(column, value)`` with map-side partial aggregation, so the shuffle
carries partial aggregates or distinct values, never whole columns. Quantiles use the distributed exact routine of
``quantiles.py``. Results are small long-format frames ``(column, ...)``; they are combined by joins on the column
name or by union + aggregate, never by cross joins.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import pct, quality_grade, traffic_light
from .gram import correlation_matrix
from .heavy import most_common
from .quantiles import approx_quantiles, exact_quantiles, long_numeric

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# The quality-score penalties (weight, cap) and thresholds.
NULL_WEIGHT, NULL_CAP = 0.5, 20.0
DUP_WEIGHT, DUP_CAP = 2.0, 15.0
OUTLIER_CAP = 15.0
NON_NORMAL_WEIGHT, NON_NORMAL_CAP = 2.0, 10.0
IQR_FACTOR = 1.5
NORMAL_P = 0.05
STRONG_CORRELATION = 0.7
# Columns up to which correlations are plain aggregate expressions.
NATIVE_COLUMNS = 8


def numeric_columns(df: DataFrame) -> list[str]:
    """numeric columns by type (booleans are categorical)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def categorical_columns(df: DataFrame) -> list[str]:
    num = set(numeric_columns(df))
    return [c for c in df.columns if c not in num]


def _as_text(df: DataFrame, name: str):
    """A value as text for counting distinct values: NaN is missing, -0.0 equals 0.0."""
    f = df.schema[name]
    c = F.col(f"`{name}`")
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        c = F.when(F.isnan(c), F.lit(None)).when(c == 0, F.lit(0.0)).otherwise(c)
    return c.cast("string")


def frequency(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, value, n)``: copies of every value (null included) of every column."""
    return _unpivoted(df, list(columns or df.columns)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _unpivoted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value)`` of every cell, within the scan."""
    pairs = [F.struct(F.lit(c).alias("column"), _as_text(df, c).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("x")).select("x.column", "x.value")


def profile_table(df: DataFrame) -> DataFrame:
    """A1: row count, column count, column names."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        F.lit(",".join(df.columns)).alias("column_names"))


def _type_frame(df: DataFrame, columns: Sequence[str]):
    num = set(numeric_columns(df))
    return F.create_map(*[x for c in columns for x in (F.lit(c), F.lit("numeric" if c in num else "categorical"))])


def profile_columns(df: DataFrame, exact: bool = True) -> DataFrame:
    """A2 + A3: per column non-null, null, null %, distinct (nulls excluded), duplicates = rows - distinct.

    ``exact=False`` uses HyperLogLog++ (``approx_count_distinct``) and skips the frequency table: one pass with
    no value shuffle, for very wide or very high-cardinality tables.
    """
    cols = list(df.columns)
    types = _type_frame(df, cols)
    if exact:
        freq = frequency(df, cols)
        per = freq.groupBy("column").agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null_count"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.count("value").alias("unique_count"))
    else:
        per = _unpivoted(df, cols).groupBy("column").agg(
            F.count(F.lit(1)).alias("rows"), F.count("value").alias("non_null_count"),
            F.count_if(F.col("value").isNull()).alias("null_count"),
            F.approx_count_distinct("value", 0.01).alias("unique_count"))
    return per.select(
        "column", types[F.col("column")].alias("type"),
        F.col("non_null_count").cast("bigint").alias("non_null_count"),
        F.col("null_count").cast("bigint").alias("null_count"),
        pct("null_count", "rows").alias("null_percentage"),
        F.col("unique_count").cast("bigint").alias("unique_count"),
        (F.col("rows") - F.col("unique_count")).cast("bigint").alias("duplicate_count"))


def quantile_map(df: DataFrame, columns: Sequence[str], probs: Sequence[float], exact: bool = True) -> dict:
    """``{(column, p): value}`` - a small driver-side map (columns x probabilities entries)."""
    q = exact_quantiles(df, columns, probs) if exact else approx_quantiles(df, columns, probs)
    return {(r["column"], float(r["p"])): r["value"] for r in q.collect()}


def _quantile_frame(df: DataFrame, columns: Sequence[str], exact: bool) -> DataFrame:
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75]) if exact else approx_quantiles(df, columns, [0.25, 0.5, 0.75])
    return q.groupBy("column").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q25"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q75"))


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """A4: mean, median, sample std, min, max, q25, q75 (linear interpolation) per numeric column."""
    columns = list(columns or numeric_columns(df))
    moments = long_numeric(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    return moments.join(_quantile_frame(df, columns, exact), "column").select(
        "column", "count", "mean", "median", "std", "min", "max", "q25", "q75")


def iqr_bounds(df: DataFrame, columns: Sequence[str] | None = None, factor: float = IQR_FACTOR,
               exact: bool = True) -> dict[str, tuple[float, float, float, float]]:
    """``{column: (q25, q75, lower, upper)}`` - J4's scalar statistics, one small entry per column."""
    columns = list(columns or numeric_columns(df))
    qm = quantile_map(df, columns, [0.25, 0.75], exact)
    out = {}
    for c in columns:
        q1, q3 = qm.get((c, 0.25)), qm.get((c, 0.75))
        if q1 is None or q3 is None:
            continue
        iqr = q3 - q1
        out[c] = (q1, q3, q1 - factor * iqr, q3 + factor * iqr)
    return out


def _outside(c: str, lower: float, upper: float):
    x = F.col(f"`{c}`").cast("double")
    return (x < F.lit(lower)) | (x > F.lit(upper))


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, factor: float = IQR_FACTOR,
                 exact: bool = True) -> DataFrame:
    """A5: values strictly outside ``[Q1 - 1.5 IQR, Q3 + 1.5 IQR]``: count, bounds, % of non-null values."""
    columns = list(columns or numeric_columns(df))
    bounds = iqr_bounds(df, columns, factor, exact)
    spark = df.sparkSession
    if not bounds:
        return spark.createDataFrame([], "column string, q25 double, q75 double, lower_bound double, "
                                         "upper_bound double, outliers_count bigint, outliers_percentage double")
    b = F.create_map(*[x for c, (_, _, lo, hi) in bounds.items() for x in (F.lit(c), F.array(F.lit(lo), F.lit(hi)))])
    lv = long_numeric(df, list(bounds)).withColumn("_b", b[F.col("column")])
    per = lv.groupBy("column").agg(
        F.count(F.lit(1)).alias("_nn"),
        F.count_if((F.col("v") < F.col("_b")[0]) | (F.col("v") > F.col("_b")[1])).alias("outliers_count"))
    qs = F.create_map(*[x for c, (q1, q3, lo, hi) in bounds.items()
                        for x in (F.lit(c), F.array(F.lit(q1), F.lit(q3), F.lit(lo), F.lit(hi)))])
    return per.select(
        "column", qs[F.col("column")][0].alias("q25"), qs[F.col("column")][1].alias("q75"),
        qs[F.col("column")][2].alias("lower_bound"), qs[F.col("column")][3].alias("upper_bound"),
        F.col("outliers_count").cast("bigint").alias("outliers_count"),
        pct("outliers_count", "_nn").alias("outliers_percentage"))


def iqr_flag(df: DataFrame, columns: Sequence[str] | None = None, factor: float = IQR_FACTOR,
             exact: bool = True, flag: str = "is_outlier") -> DataFrame:
    """Every row with ``is_outlier`` = outside the fences of *any* numeric column (a null never is)."""
    bounds = iqr_bounds(df, columns, factor, exact)
    cond = F.lit(False)
    for c, (_, _, lo, hi) in bounds.items():
        cond = cond | F.coalesce(_outside(c, lo, hi), F.lit(False))
    return df.withColumn(flag, cond)


def normality_jb(df: DataFrame, columns: Sequence[str] | None = None, alpha: float = NORMAL_P) -> DataFrame:
    """A7 (re-aimed): Jarque-Bera from population skewness and excess kurtosis; ``p = exp(-JB/2)``.

    Null when there are 3 values or fewer or the variance is zero. One pass, partial aggregation.
    """
    columns = list(columns or numeric_columns(df))
    m = long_numeric(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.skewness("v").alias("skewness"), F.kurtosis("v").alias("kurtosis"),
        F.var_pop("v").alias("_var"))
    ok = (F.col("n") > 3) & (F.col("_var") > 0)
    jb = F.col("n") / 6.0 * (F.pow(F.col("skewness"), 2) + F.pow(F.col("kurtosis"), 2) / 4.0)
    return m.select(
        "column", "n", F.when(ok, F.col("skewness")).alias("skewness"),
        F.when(ok, F.col("kurtosis")).alias("kurtosis"), F.when(ok, jb).alias("jb")
    ).withColumn("p_value", F.exp(-F.col("jb") / 2.0)).withColumn("is_normal", F.col("p_value") > alpha)


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Most common value, its count and % of all rows. Ties -> smallest value. Candidates come from a sketch and are
    counted exactly; only columns that this does not decide are counted in full (``heavy.py``)."""
    columns = list(columns or categorical_columns(df))
    found = most_common(_unpivoted(df, columns), columns)
    return found.select(
        "column", F.col("value").alias("most_common"), F.col("n").cast("bigint").alias("most_common_count"),
        F.coalesce(F.when(F.col("n") > 0, pct("n", "rows")), F.lit(0.0)).alias("most_common_percentage"))


def missing_values(df: DataFrame) -> DataFrame:
    """``(column, missing_count)`` for columns with at least one missing value, plus the table total."""
    cols = list(df.columns)
    pairs = [F.struct(F.lit(c).alias("column"), _as_text(df, c).isNull().alias("miss")) for c in cols]
    long = df.select(F.explode(F.array(*pairs)).alias("x")).select("x.column", "x.miss")
    per = long.groupBy("column").agg(F.count_if("miss").cast("bigint").alias("missing_count"))
    per = per.where(F.col("missing_count") > 0)
    total = per.agg(F.sum("missing_count").alias("total_missing"))
    return per.unionByName(total.select(F.lit("__total__").alias("column"),
                                        F.col("total_missing").cast("bigint").alias("missing_count")),
                           allowMissingColumns=False)


def _row_key(df: DataFrame, digest_columns: Sequence[str]):
    """Grouping columns; long text columns may be replaced by their SHA-256 digest (whole text hashed)."""
    keys = []
    for c in df.columns:
        if c in digest_columns:
            keys.append(F.sha2(F.col(f"`{c}`"), 256).alias(c))
        else:
            keys.append(F.col(f"`{c}`"))
    return keys


def exact_duplicates(df: DataFrame, digest_columns: Sequence[str] = ()) -> DataFrame:
    """A10: rows that have at least one identical copy, all copies counted; % of rows. Null equals null."""
    groups = df.groupBy(*_row_key(df, digest_columns)).agg(F.count(F.lit(1)).alias("_n"))
    out = groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
                     F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint")
                     .alias("exact_duplicates"))
    return out.withColumn("exact_duplicates_percentage", pct("exact_duplicates", "total_rows"))


def duplicate_rows(df: DataFrame, key: str, digest_columns: Sequence[str] = ()) -> DataFrame:
    """Rows (key included) whose other columns equal those of another row; a null-safe semi join on the content
    against the groups that have copies. ``key`` identifies rows and is not part of the comparison."""
    content = [c for c in df.columns if c != key]
    body = df.select(key, *_row_key(df.select(*content), digest_columns))
    dup_groups = body.groupBy(*content).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    cond = [body[c].eqNullSafe(dup_groups[c]) for c in content]
    return body.join(dup_groups, cond, "left_semi").select(key)


def duplicate_rows_top(df: DataFrame, key: str, n: int = 10, digest_columns: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` row keys of duplicated rows (a top-k report). ``key`` is not part of the comparison.

    Each content keeps its first keys only, cut before and after the shuffle (a limit by rank, at least two, which say that
    the content is held twice): no content is a task of all its rows, and nothing is joined back."""
    content = [c for c in df.columns if c != key]
    body = df.select(F.col(f"`{key}`").alias("_k"), *[x.alias(f"_c{i}") for i, x in enumerate(_row_key(df.select(*content), digest_columns))])
    same = Window.partitionBy(*[f"_c{i}" for i in range(len(content))])
    first = body.withColumn("_rank", F.row_number().over(same.orderBy("_k"))).where(F.col("_rank") <= max(n, 2))
    held = first.withColumn("_last", F.max("_rank").over(same)).where(F.col("_last") > 1)
    return held.orderBy("_k").limit(n).select(F.col("_k").alias(key))


def correlations(df: DataFrame, columns: Sequence[str] | None = None, threshold: float | None = None) -> DataFrame:
    """Pearson r of every numeric pair over pairwise-complete rows; ``|r| > threshold`` when given.

    More than ``NATIVE_COLUMNS`` columns go through one Gram matrix a task (``gram.py``); the expressions below grow with the pairs.
    Two passes of plain sums (the fastest aggregate Spark has): column means and missing counts, then centred
    sufficient statistics. Values are shifted by their column mean before products are summed, which keeps the
    one-pass formula numerically stable. Without missing values the per-column sums serve every pair and only
    ``sum(x'y')`` is per pair; otherwise count, sums and squares are taken per pair over its complete rows. A
    constant column gives a null r (no divide-by-zero error as ``corr`` raises under ANSI mode).
    """
    import math
    columns = list(columns or numeric_columns(df))
    spark = df.sparkSession
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    if not pairs:
        return spark.createDataFrame([], "col1 string, col2 string, corr double")
    if len(columns) > NATIVE_COLUMNS:
        return correlation_matrix(df, columns, threshold)
    xs = {c: F.col(f"`{c}`").cast("double") for c in columns}
    ok = {c: xs[c].isNotNull() & ~F.isnan(xs[c]) for c in columns}
    first = df.agg(F.count(F.lit(1)).alias("_rows"),
                   *[F.avg(F.when(ok[c], xs[c])).alias(f"m{i}") for i, c in enumerate(columns)],
                   *[F.count_if(ok[c]).alias(f"n{i}") for i, c in enumerate(columns)]).collect()[0]
    means = {c: (first[f"m{i}"] or 0.0) for i, c in enumerate(columns)}
    complete = all(first[f"n{i}"] == first["_rows"] for i in range(len(columns)))
    d = {c: xs[c] - F.lit(means[c]) for c in columns}
    aggs = [F.count(F.lit(1)).alias("_n")]
    if complete:
        for i, c in enumerate(columns):
            aggs += [F.sum(d[c]).alias(f"s{i}"), F.sum(d[c] * d[c]).alias(f"q{i}")]
        for k, (a, b) in enumerate(pairs):
            aggs.append(F.sum(d[a] * d[b]).alias(f"p{k}"))
    else:
        for k, (a, b) in enumerate(pairs):
            both = ok[a] & ok[b]
            da, db = F.when(both, d[a]), F.when(both, d[b])
            aggs += [F.count_if(both).alias(f"c{k}"), F.sum(da).alias(f"sa{k}"), F.sum(db).alias(f"sb{k}"),
                     F.sum(da * da).alias(f"qa{k}"), F.sum(db * db).alias(f"qb{k}"), F.sum(da * db).alias(f"p{k}")]
    r = df.agg(*aggs).collect()[0]
    rows = []
    for k, (a, b) in enumerate(pairs):
        if complete:
            ia, ib = columns.index(a), columns.index(b)
            n, sa, sb, qa, qb = r["_n"], r[f"s{ia}"], r[f"s{ib}"], r[f"q{ia}"], r[f"q{ib}"]
        else:
            n, sa, sb, qa, qb = r[f"c{k}"], r[f"sa{k}"], r[f"sb{k}"], r[f"qa{k}"], r[f"qb{k}"]
        sxy = r[f"p{k}"]
        val = None
        if n and n > 0 and sxy is not None:
            cov = sxy - sa * sb / n
            va, vb = qa - sa * sa / n, qb - sb * sb / n
            if va > 0 and vb > 0:
                val = cov / math.sqrt(va * vb)
        rows.append((a, b, val))
    out = spark.createDataFrame(rows, "col1 string, col2 string, corr double")
    if threshold is not None:
        out = out.where(F.abs("corr") > threshold)
    return out


def quality_score(df: DataFrame, exact: bool = True) -> DataFrame:
    """A13 + C11-C13: ``100 - min(avg null% x 0.5, 20) - min(dup% x 2, 15) - min(avg outlier%, 15)
    - min(2 x non-normal columns, 10)``, floor 0, 1 decimal; averages over all columns (categorical: 0 outliers)."""
    cols = profile_columns(df, exact).select("column", "null_percentage")
    num = numeric_columns(df)
    per = cols
    if num:
        out = iqr_outliers(df, num, exact=exact).select("column", "outliers_percentage")
        norm = normality_jb(df, num).select("column", "is_normal")
        per = cols.join(out, "column", "left").join(norm, "column", "left")
    else:
        per = per.withColumn("outliers_percentage", F.lit(None).cast("double")) \
                 .withColumn("is_normal", F.lit(None).cast("boolean"))
    per_rows = per.select(F.col("null_percentage"), F.coalesce("outliers_percentage", F.lit(0.0)).alias("outp"),
                          F.when(F.col("is_normal") == F.lit(False), 1).otherwise(0).alias("abn"),
                          F.lit(None).cast("double").alias("dup_pct"))
    dup = exact_duplicates(df).select(F.lit(None).cast("double").alias("null_percentage"),
                                      F.lit(None).cast("double").alias("outp"), F.lit(None).cast("int").alias("abn"),
                                      F.col("exact_duplicates_percentage").alias("dup_pct"))
    m = per_rows.unionByName(dup).agg(
        F.avg("null_percentage").alias("avg_null_percentage"), F.max("dup_pct").alias("duplicate_percentage"),
        F.avg(F.when(F.col("null_percentage").isNotNull(), F.col("outp"))).alias("avg_outlier_percentage"),
        F.sum("abn").cast("bigint").alias("non_normal_columns"))
    # a table without rows has no percentages and no score (least skips nulls, so it is said here)
    score = F.when(F.col("duplicate_percentage").isNotNull(), F.lit(100.0)
             - F.least(F.col("avg_null_percentage") * NULL_WEIGHT, F.lit(NULL_CAP))
             - F.least(F.col("duplicate_percentage") * DUP_WEIGHT, F.lit(DUP_CAP))
             - F.least(F.col("avg_outlier_percentage"), F.lit(OUTLIER_CAP))
             - F.least(F.col("non_normal_columns") * NON_NORMAL_WEIGHT, F.lit(NON_NORMAL_CAP)))
    known = F.col("quality_score").isNotNull()
    return m.withColumn("quality_score", F.when(score.isNotNull(), F.round(F.greatest(score, F.lit(0.0)), 1))) \
            .withColumn("quality_grade", F.when(known, quality_grade("quality_score"))) \
            .withColumn("traffic_light", F.when(known, traffic_light("quality_score")))


def column_summary(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column, numeric mean/min/max or categorical distinct count and most common value."""
    base = profile_columns(df, exact).select("column", "type", "unique_count")
    num = numeric_columns(df)
    cat = categorical_columns(df)
    if num:
        s = long_numeric(df, num).groupBy("column").agg(F.avg("v").alias("mean"), F.min("v").alias("min"),
                                                         F.max("v").alias("max"))
        base = base.join(s, "column", "left")
    else:
        base = base.select("*", *[F.lit(None).cast("double").alias(c) for c in ("mean", "min", "max")])
    if cat:
        base = base.join(categorical_profile(df, cat).select("column", "most_common"), "column", "left")
    else:
        base = base.withColumn("most_common", F.lit(None).cast("string"))
    return base.select("column", "type", "mean", "min", "max",
                       F.when(F.col("type") == "categorical", F.col("unique_count")).alias("unique_count"),
                       "most_common")
