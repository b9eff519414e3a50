"""Day-first date parsing over a fixed list of layouts, as one native expression.

Attempt order: year-first layouts (``yyyy-M-d``, ``yyyy/M/d``, ``yyyy.M.d``, ``yyyyMMdd``, ISO timestamp prefix);
day-first ``d/M/yyyy``, ``d-M-yyyy``, ``d.M.yyyy`` and two-digit-year ``d/M/yy``, falling back to month-first when the
day-first reading is not a real date; then ``d MMM yyyy`` and ``MMM d, yyyy``. Partial dates give null.

``year_first_order="ymd"`` reads ``2024-01-10`` as 10 January; ``"ydm"`` reads year-day-month first and falls back to
year-month-day, which is how a day-first free-form parser treats ISO text.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_ws

# The layouts recognised, as anchored regular expressions.
YEAR_FIRST = "^([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})([T ][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?)?$"
YEAR_FIRST_COMPACT = "^([0-9]{4})([0-9]{2})([0-9]{2})$"
DAY_FIRST = "^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4})$"
DAY_FIRST_SHORT_YEAR = "^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{2})$"
DAY_MONTH_NAME = "^([0-9]{1,2})[ -]([A-Za-z]+)[.]?,?[ -]([0-9]{4})$"
MONTH_NAME_DAY = "^([A-Za-z]+)[.]? ([0-9]{1,2}),? ([0-9]{4})$"
# English month names and abbreviations.
MONTH_NAME = "^(jan|january|feb|february|mar|march|apr|april|may|jun|june|jul|july|aug|august|sep|sept|september|oct|october|nov|november|dec|december)$"
MONTH_ABBREVIATIONS = "janfebmaraprmayjunjulaugsepoctnovdec"
# Two-digit years up to this value are read as 20yy, above it as 19yy.
TWO_DIGIT_YEAR_PIVOT = 75


def _ymd(y: Column, m: Column, d: Column) -> Column:
    """A real calendar date from text parts, else null (2024-02-30 -> null)."""
    text = F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.try_to_date(text, "yyyy-MM-dd")


def _month_number(word: Column) -> Column:
    w = F.lower(word)
    pos = F.instr(F.lit(MONTH_ABBREVIATIONS), F.substring(w, 1, 3))
    return F.when(w.rlike(MONTH_NAME), ((pos - 1) / 3 + 1).cast("int").cast("string"))


def parse_date(c, year_first_order: str = "ymd", two_digit_pivot: int = TWO_DIGIT_YEAR_PIVOT) -> Column:
    """Text -> DateType or null.

    The layout is chosen by anchored ``rlike`` tests; the parts come from one ``regexp_extract_all`` of digit and
    letter runs, so the expression stays small enough for whole-stage codegen.
    """
    if year_first_order not in ("ymd", "ydm"):
        raise ValueError("year_first_order must be 'ymd' or 'ydm'")
    s = strip_ws(F.col(c) if isinstance(c, str) else c).cast("string")
    tokens = F.regexp_extract_all(s, F.lit("([0-9]+|[A-Za-z]+)"), 1)
    t0, t1, t2 = (F.get(tokens, i) for i in range(3))

    def year_first(y: Column, a: Column, b: Column) -> Column:
        if year_first_order == "ymd":
            return _ymd(y, a, b)
        return F.coalesce(_ymd(y, b, a), _ymd(y, a, b))

    def day_first(d: Column, m: Column, y: Column) -> Column:
        return F.coalesce(_ymd(y, m, d), _ymd(y, d, m))

    yy = t2.cast("int")
    short_year = F.when(yy <= two_digit_pivot, yy + 2000).otherwise(yy + 1900).cast("string")
    return (
        F.when(s.rlike(YEAR_FIRST), year_first(t0, t1, t2))
        .when(s.rlike(YEAR_FIRST_COMPACT),
              year_first(F.substring(t0, 1, 4), F.substring(t0, 5, 2), F.substring(t0, 7, 2)))
        .when(s.rlike(DAY_FIRST), day_first(t0, t1, t2))
        .when(s.rlike(DAY_FIRST_SHORT_YEAR), day_first(t0, t1, short_year))
        .when(s.rlike(DAY_MONTH_NAME), _ymd(t2, _month_number(t1), t0))
        .when(s.rlike(MONTH_NAME_DAY), _ymd(t2, _month_number(t0), t1))
    )
