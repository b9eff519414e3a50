"""P1 cleaning flow (S3, S4, C1-C8, F1, T1) and its report.

One narrow projection, one filter, one ``dropDuplicates``: a single shuffle, with partial aggregation on the map
side so a value repeated by a third of the rows collapses before it is exchanged.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date
from ..functions.text import clean_email, coerce_long, coerce_number, normalize_phone, normalize_text, strip_ws
from ..session import cut_lineage
from ..sources.readers import (CONTENT_COLUMNS, EXPECTED_COLUMNS, apply_null_tokens, complete_schema,
                               map_roles, normalize_headers)

TEXT_COLUMNS = ("name", "city", "country")


def _typed_id(df: DataFrame, name: str = "customer_id"):
    """An id stays what it is: whole numbers as bigint, anything else as stripped text. Text ids are not read as
    numbers, which would make one null of all that are none (see ``integral_ids`` for columns that are)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        s = strip_ws(F.col(name))
        return F.when(s != "", s).alias(name)
    if isinstance(dtype, T.IntegralType):
        return F.col(name).cast("bigint").alias(name)
    return F.col(name).cast("string").alias(name)


def integral_ids(df: DataFrame, name: str = "customer_id") -> DataFrame:
    """The id as bigint when every value is a whole number that fits, else unchanged: one aggregate decides."""
    if name not in df.columns or not isinstance(df.schema[name].dataType, T.StringType):
        return df
    lost = df.where(F.col(name).isNotNull() & coerce_long(name).isNull()).limit(1).count()
    return df if lost else df.withColumn(name, coerce_long(name))


def clean_columns(raw: DataFrame, year_first_order: str = "ymd", null_tokens: bool = True) -> DataFrame:
    """S3 + S4 + S5 + C2-C7 as one projection, no rows dropped. Headers that are synonyms of a role take its name;
    extra columns pass through unchanged."""
    df = map_roles(normalize_headers(raw))
    if null_tokens:
        df = apply_null_tokens(df)
    df = complete_schema(df)
    extra = [c for c in df.columns if c not in EXPECTED_COLUMNS]
    return df.select(
        _typed_id(df),
        normalize_text("name").alias("name"),
        clean_email("email").alias("email"),
        normalize_phone("phone").alias("phone"),
        normalize_text("city").alias("city"),
        normalize_text("country").alias("country"),
        parse_date("signup_date", year_first_order).alias("signup_date"),
        coerce_number("amount").alias("amount"),
        *[F.col(f"`{c}`") for c in extra],
    )


def drop_empty_rows(df: DataFrame, subset: Sequence[str] = CONTENT_COLUMNS) -> DataFrame:
    """drop rows whose content columns are all null (the id is not content)."""
    return df.dropna(how="all", subset=list(subset))


def drop_any_null(df: DataFrame) -> DataFrame:
    """drop rows with any null."""
    return df.dropna(how="any")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact distinct rows over every column (id and extra columns included)."""
    return df.dropDuplicates()


def clean_customers(raw: DataFrame, year_first_order: str = "ymd") -> DataFrame:
    """Cleaned, non-empty, exactly-distinct customer rows."""
    return distinct_rows(drop_empty_rows(clean_columns(raw, year_first_order)))


#: How many raw rows a distinct cleaned row stands for.
COPIES = "_copies"


def clean_groups(raw: DataFrame, year_first_order: str = "ymd") -> DataFrame:
    """The distinct cleaned rows, empty ones too, with their number of copies: what both the cleaned table and the counters are
    made of. Written once, so neither cleans the raw rows again (and, unlike metrics taken on the way, tasks that run twice
    are not counted twice)."""
    cleaned = clean_columns(raw, year_first_order)
    return cut_lineage(cleaned.groupBy(*[F.col(f"`{c}`") for c in cleaned.columns]).agg(F.count(F.lit(1)).alias(COPIES)))


def _content():
    return F.greatest(*[F.col(c).isNotNull() for c in CONTENT_COLUMNS])


def group_rows(groups: DataFrame) -> DataFrame:
    """P1 from ``clean_groups``: the cleaned, non-empty, exactly-distinct rows."""
    return groups.where(_content()).drop(COPIES)


def group_report(groups: DataFrame) -> DataFrame:
    """A14 from ``clean_groups``."""
    g = groups.withColumn("_keep", _content())

    def total_if(cond):
        return F.coalesce(F.sum(F.when(cond, F.col(COPIES))), F.lit(0)).cast("bigint")

    return g.agg(
        total_if(F.lit(True)).alias("rows_before"),
        total_if(F.col("_keep")).cast("bigint").alias("_rows_nonempty"),
        F.count_if(F.col("_keep")).cast("bigint").alias("rows_after"),
        total_if(F.col("email").isNull()).alias("invalid_emails"),
        total_if(F.col("signup_date").isNull()).alias("invalid_dates"),
        total_if(F.col("amount") < 0).alias("negative_amount_count"),
    ).select(
        "rows_before",
        (F.col("_rows_nonempty") - F.col("rows_after")).alias("exact_duplicates_removed"),
        "invalid_emails", "invalid_dates", "negative_amount_count", "rows_after",
        (F.col("rows_before") - F.col("_rows_nonempty")).alias("empty_rows_removed"),
    )


def clean_report(raw: DataFrame, year_first_order: str = "ymd") -> DataFrame:
    """One row of cleaning counters.

    Every counter is a function of the cleaned columns (an invalid e-mail or date is exactly a null after cleaning), so one
    ``groupBy`` over all cleaned columns gives copies per distinct row, and one global aggregate over the groups gives both the
    pre-drop counters and the distinct count: a single shuffle."""
    cleaned = clean_columns(raw, year_first_order)
    return group_report(cleaned.groupBy(*[F.col(f"`{c}`") for c in cleaned.columns]).agg(F.count(F.lit(1)).alias(COPIES)))
