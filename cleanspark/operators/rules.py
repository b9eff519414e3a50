"""Validation rules and documented corrections.

Rules produce a long violations table ``(row key..., rule, column, value)`` and a per-rule summary
``(rule, rows_checked, violations)``; all are filters and partial aggregates, no row leaves the executors.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_text, repair_email
from .profile import iqr_bounds

def _c(name: str):
    """The column of exactly this name (dots included)."""
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    condition: object          # Column that is TRUE for a violation
    applies: object = None     # Column; rows where the rule is checked (default: all)


def range_rule(column: str, lo: float | None = None, hi: float | None = None, name: str | None = None) -> Rule:
    """V2: violation when the value is outside ``[lo, hi]``; null passes."""
    x = _c(column)
    parts = ([x < F.lit(lo)] if lo is not None else []) + ([x > F.lit(hi)] if hi is not None else [])
    cond = parts[0] if parts else F.lit(False)
    for p in parts[1:]:
        cond = cond | p
    # a null comparison is not a violation; no coalesce, so the predicate stays pushable to the scan
    return Rule(name or f"range_{column}", column, cond)


def order_rule(earlier: str, later: str, name: str | None = None) -> Rule:
    """V3: violation when both dates are present and ``later < earlier``."""
    cond = _c(later) < _c(earlier)
    return Rule(name or f"order_{earlier}_{later}", later, cond)


def not_null_rule(column: str) -> Rule:
    return Rule(f"not_null_{column}", column, _c(column).isNull())


def violations(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """V8 long table: one row per (row, failed rule) with the offending value as text.

    The OR of the rule conditions filters first, so simple comparisons reach the Parquet scan as pushed filters
    (row groups whose statistics rule out every violation are skipped)."""
    any_violation = rules[0].condition
    for r in rules[1:]:
        any_violation = any_violation | r.condition
    df = df.where(any_violation)
    arr = F.array(*[F.when(r.condition, F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                                                 _c(r.column).cast("string").alias("value")))
                    for r in rules])
    ks = [_c(k) for k in keys]
    return df.select(*ks, F.explode(F.array_compact(arr)).alias("v")).select(*ks, "v.rule", "v.column", "v.value")


def rule_summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """V8 summary: ``(rule, rows_checked, violations, passed)`` in one pass."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, r in enumerate(rules):
        aggs.append(F.count_if(r.condition).alias(f"_v{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col("_rows").cast("bigint").alias("rows_checked"),
                              F.col(f"_v{i}").cast("bigint").alias("violations")) for i, r in enumerate(rules)])
    return wide.select(F.explode(rows).alias("x")).select("x.*").withColumn("passed", F.col("violations") == 0)


def validation_result(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """V8 overall: one row ``(rows_checked, invalid_rows, violations, is_valid)``; a row that breaks two rules is one
    invalid row and two violations. An empty table is valid."""
    broken = sum((F.when(r.condition, 1).otherwise(0) for r in rules), F.lit(0))
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows_checked"), F.count_if(broken > 0).cast("bigint").alias("invalid_rows"),
                  F.coalesce(F.sum(broken), F.lit(0)).cast("bigint").alias("violations")).withColumn(
        "is_valid", F.col("invalid_rows") == 0)


def duplicate_keys(df: DataFrame, key: str, suffix_pattern: str = "(?i)_bis$") -> DataFrame:
    """V4: identifiers that repeat once a copy suffix (``_BIS``) is removed: ``(base_key, rows)``."""
    base = F.regexp_replace(_c(key).cast("string"), suffix_pattern, "")
    return df.groupBy(base.alias("base_key")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def fold_categories(df: DataFrame, column: str, mapping: Mapping[str, str] | DataFrame | None = None,
                    out: str | None = None) -> DataFrame:
    """V7: case/space folding (C2), then an optional canonical-name lookup (broadcast only if small)."""
    out = out or f"{column}_folded"
    folded = df.withColumn(out, normalize_text(column))
    if mapping is None:
        return folded
    spark = df.sparkSession
    lk = mapping if isinstance(mapping, DataFrame) else spark.createDataFrame(
        list(mapping.items()), "folded_key string, canonical string")
    lk = lk.toDF("folded_key", f"{column}_canonical")
    return lookup_join(folded, lk, folded[out] == lk["folded_key"], how="left").drop("folded_key")


def lookup_join(df: DataFrame, lookup: DataFrame, on, how: str = "left") -> DataFrame:
    """A join to a dimension. The planner broadcasts it when its size in bytes, from file statistics or measured by
    adaptive execution, is below ``spark.sql.autoBroadcastJoinThreshold``, and shuffles both sides otherwise."""
    return df.join(lookup, on, how)


def email_repairs(df: DataFrame, column: str = "email") -> DataFrame:
    """V5: the repaired, valid e-mail (``nameATdomain.tld`` -> ``name@domain.tld``) or null."""
    return df.withColumn(f"{column}_repaired", repair_email(column))


def correction_log(df: DataFrame, cleaned_exprs: Mapping[str, object], key: str) -> DataFrame:
    """One row per changed cell ``(key, column, before, after)``, null-safe, from a single projection of
    raw and cleaned values (no join back to the raw rows)."""
    cells = [F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("before"),
                      F.when(e.isNotNull(), e.cast("string")).alias("after"))
             for c, e in cleaned_exprs.items()]
    long = df.select(_c(key), F.explode(F.array(*cells)).alias("x")).select(_c(key), "x.*")
    return long.where(~F.col("before").eqNullSafe(F.col("after")))


def correction_counts(log: DataFrame) -> DataFrame:
    """Per column the cells changed, and of those the ones set to null: ``(column, corrections, nulled)``."""
    return log.groupBy("column").agg(F.count(F.lit(1)).cast("bigint").alias("corrections"),
                                     F.count_if(F.col("after").isNull()).cast("bigint").alias("nulled"))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins from min to max (the maximum in the last bin); nulls counted apart as bin 0.

    Bounds come from one aggregate (two scalars on the driver); counting is a partial aggregate by bin."""
    b = df.agg(F.min(_c(column)).alias("mn"), F.max(_c(column)).alias("mx")).collect()[0]
    mn, mx = b["mn"], b["mx"]
    x = _c(column).cast("double")
    if mn is None:
        idx = F.lit(0)
    elif mx == mn:
        idx = F.when(x.isNull(), 0).otherwise(1)
    else:
        raw = F.floor((x - F.lit(float(mn))) / F.lit(float(mx) - float(mn)) * F.lit(bins)).cast("int") + 1
        idx = F.when(x.isNull(), 0).otherwise(F.least(raw, F.lit(bins)))
    counts = df.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (float(mx) - float(mn)) / bins if mn is not None and mx != mn else 0.0
    lo = F.when(F.col("bin") > 0, F.lit(float(mn or 0.0)) + (F.col("bin") - 1) * F.lit(width))
    hi = F.when(F.col("bin") > 0, F.when(F.col("bin") == bins, F.lit(float(mx or 0.0)))
                .otherwise(F.lit(float(mn or 0.0)) + F.col("bin") * F.lit(width)))
    return counts.select("bin", lo.alias("lower"), hi.alias("upper"), F.col("count").cast("bigint").alias("count"))


def clip_outliers(df: DataFrame, columns: Sequence[str], mode: str = "clip", exact: bool = True) -> DataFrame:
    """Values outside the IQR fences clipped to the fence (``mode="clip"``) or set null (``"null"``)."""
    bounds = iqr_bounds(df, columns, exact=exact)
    out = df
    for c, (_, _, lo, hi) in bounds.items():
        x = _c(c).cast("double")
        if mode == "clip":
            e = F.least(F.greatest(x, F.lit(lo)), F.lit(hi))
        elif mode == "null":
            e = F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), x)
        else:
            raise ValueError("mode must be 'clip' or 'null'")
        out = out.withColumn(f"{c}_corrected", e)
    return out


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric nulls -> the column mean of this frame (one aggregate, means as literals)."""
    row = df.agg(*[F.avg(_c(c)).alias(c) for c in columns]).collect()[0]
    return df.select(*[F.coalesce(_c(c), F.lit(row[c])).alias(c) if c in columns else _c(c)
                       for c in df.columns])


def binary_metrics(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """Precision, recall, F1 with zero division -> 0 (plus the confusion counts)."""
    t, p = F.col(y_true) == 1, F.col(y_pred) == 1
    m = df.agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"),
               F.count_if(~t & ~p).alias("tn"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double")), F.lit(0.0))
    m = m.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return m.withColumn("f1", f1).select(*[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")],
                                         "precision", "recall", "f1")


def anomaly_summary(df: DataFrame, flag: str = "is_anomaly", score: str = "anomaly_score") -> DataFrame:
    """Rows, flagged rows, mean score."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                  F.coalesce(F.sum(F.col(flag).cast("long")), F.lit(0)).cast("bigint").alias("anomalies_found"),
                  F.avg(score).alias("mean_score"))
