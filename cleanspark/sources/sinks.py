"""Sinks (S6-S10, V13): table writes, JSON reports, the typed load and its verification.

Writes are partitioned and parallel; nothing is funnelled through the driver. A relational database is reached
with Spark's JDBC writer (batched inserts, ``truncate`` keeps the table definition) when a user has one.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The typed load's column types (text lengths are enforced as a check, see ``length_violations``).
CUSTOMER_DDL = {
    "customer_id": "int", "name": "string", "email": "string", "phone": "string", "city": "string",
    "country": "string", "signup_date": "date", "amount": "decimal(10,2)", "is_anomaly": "int",
    "anomaly_score": "float",
}
TEXT_LENGTHS = {"name": 255, "email": 255, "phone": 20, "city": 100, "country": 100}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                mode: str = "overwrite", **options) -> None:
    """Write a table (Parquet by default; CSV with a header), optionally partitioned."""
    w = df.write.mode(mode).format(fmt).options(**options)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_report_json(report: DataFrame, path: str) -> None:
    """A (small) report frame as UTF-8 JSON lines in one file."""
    report.coalesce(1).write.mode("overwrite").option("encoding", "UTF-8").json(path)


def typed_load(df: DataFrame, ddl: Mapping[str, str] = CUSTOMER_DDL) -> DataFrame:
    """The typed frame a database load receives: guarded casts (``try_cast``: a bad value becomes null
    rather than failing the job), NaN -> null, columns in DDL order; absent columns are null."""
    out = []
    for c, t in ddl.items():
        if c in df.columns:
            x = F.col(f"`{c}`")
            if t in ("float", "double"):
                x = F.when(~F.isnan(x.cast("double")), x)
            out.append(x.try_cast(t).alias(c))
        else:
            out.append(F.lit(None).cast(t).alias(c))
    return df.select(*out)


def load_rejects(df: DataFrame, key: str, ddl: Mapping[str, str] = CUSTOMER_DDL) -> DataFrame:
    """The values that ``typed_load`` turns into null because they do not fit the column's type:
    ``(key, column, value)``, one row each."""
    cells = []
    for c, t in ddl.items():
        if c in df.columns:
            x = F.col(f"`{c}`")
            bad = x.isNotNull() & x.try_cast(t).isNull()
            if t in ("float", "double"):
                bad = bad & ~F.coalesce(F.isnan(x.try_cast("double")), F.lit(False))
            cells.append(F.when(bad, F.struct(F.lit(c).alias("column"), x.cast("string").alias("value"))))
    rejected = df.select(F.col(f"`{key}`").alias("key"), F.explode(F.array_compact(F.array(*cells))).alias("x"))
    return rejected.select("key", "x.column", "x.value")


def length_violations(df: DataFrame, lengths: Mapping[str, int] = TEXT_LENGTHS) -> DataFrame:
    """Text longer than the target column allows: ``(column, violations)``."""
    cols = [c for c in lengths if c in df.columns]
    arr = F.array(*[F.struct(F.lit(c).alias("column"),
                             F.count_if(F.length(c) > lengths[c]).cast("bigint").alias("violations")) for c in cols])
    return df.agg(arr.alias("x")).select(F.explode("x").alias("x")).select("x.*")


def save_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None) -> None:
    """Load into a catalog table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               batch_size: int = 10_000, truncate: bool = True) -> None:
    """Batched load into a relational table; ``truncate`` empties it and keeps its definition."""
    (df.write.mode("overwrite").option("truncate", str(truncate).lower()).option("batchsize", str(batch_size))
       .jdbc(url, table, properties=dict(properties or {})))


def verify_counts(tables: Mapping[str, DataFrame], flag: str = "is_anomaly") -> DataFrame:
    """``(table, rows, flagged)`` for each loaded table, one aggregate each."""
    parts = []
    for name, df in tables.items():
        fl = F.coalesce(F.sum(F.col(flag).cast("long")), F.lit(0)) if flag in df.columns else F.lit(None)
        parts.append(df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), fl.cast("bigint").alias("flagged"))
                     .select(F.lit(name).alias("table"), "rows", "flagged"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stamp(report: DataFrame, input_path: str | None = None) -> DataFrame:
    """Run timestamp and input path on a report (kept out of the oracle-checked queries)."""
    return report.select(F.current_timestamp().alias("generated_at"), F.lit(input_path).alias("input_path"), "*")
