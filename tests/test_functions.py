"""Scalar cleaning expressions (C1-C7, C12, C13, V5) and date layouts (C6) on literal values."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from cleanspark.functions import text as X
from cleanspark.functions.dates import parse_date


def one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_strip_unicode_whitespace(spark):
    vals = ["\t a \n", " b　", "  ", None, "c"]
    assert one(spark, X.strip_ws, vals) == ["a", "b", "", None, "c"]


def test_normalize_text(spark):
    assert one(spark, X.normalize_text, ["  Alice  ", "ALICE", "   ", None, "\tTunis"]) == \
        ["alice", "alice", None, None, "tunis"]


def test_normalize_phone(spark):
    vals = [" +33 6 12 34 56 78 ", "+33-6-11-22-33-44", "0612345678", "not_a_phone", "+216 20 000 000", None, "1234567"]
    assert one(spark, X.normalize_phone, vals) == \
        ["33612345678", "33611223344", "0612345678", None, "21620000000", None, None]


def test_email_validity(spark):
    vals = ["Alice@example.com", "charlie#example.com", " bob@example.com ", "a@b", "a b@c.d", None, ""]
    assert one(spark, X.is_valid_email, vals) == [True, False, True, False, False, False, False]
    assert one(spark, X.clean_email, vals)[:3] == ["alice@example.com", None, "bob@example.com"]


def test_coerce_number(spark):
    vals = ["120.5", " -30 ", "5000", "abc", "1.0d", "NaN", "Infinity", "1e3", ".5", None]
    assert one(spark, X.coerce_number, vals) == [120.5, -30.0, 5000.0, None, None, None, None, 1000.0, 0.5, None]


def test_grade_and_light(spark):
    assert one(spark, X.quality_grade, [95.0, 90.0, 80.0, 60.0, 10.0], "double") == ["A", "A", "B", "C", "D"]
    assert one(spark, X.traffic_light, [92.6, 70.0, 59.9], "double") == ["green", "amber", "red"]


def test_repair_email(spark):
    vals = ["nameATdomain.tn", "good@x.tn", "aATbATc.tn", "nodomainAT", None]
    assert one(spark, X.repair_email, vals) == ["name@domain.tn", "good@x.tn", None, None, None]


D = dt.date


@pytest.mark.parametrize("text,ymd,ydm", [
    ("20/09/2024", D(2024, 9, 20), D(2024, 9, 20)),
    ("10-01-2024", D(2024, 1, 10), D(2024, 1, 10)),
    ("1/2/2024", D(2024, 2, 1), D(2024, 2, 1)),
    ("10.1.2024", D(2024, 1, 10), D(2024, 1, 10)),
    ("10/01/24", D(2024, 1, 10), D(2024, 1, 10)),
    ("01/13/2024", D(2024, 1, 13), D(2024, 1, 13)),
    ("Jan 10, 2024", D(2024, 1, 10), D(2024, 1, 10)),
    ("10 Jan 2024", D(2024, 1, 10), D(2024, 1, 10)),
    ("2024-02-30", None, None),
    ("31/02/2024", None, None),
    ("2024-01-10", D(2024, 1, 10), D(2024, 10, 1)),
    ("20240110", D(2024, 1, 10), D(2024, 10, 1)),
    ("2024-01-10T23:00:00", D(2024, 1, 10), D(2024, 10, 1)),
    ("2024-13-01", None, D(2024, 1, 13)),
    ("2024/02/03", D(2024, 2, 3), D(2024, 3, 2)),
    ("March", None, None),
    ("nan", None, None),
    (None, None, None),
])
def test_date_layouts(spark, text, ymd, ydm):
    df = spark.createDataFrame([(text,)], "v string")
    r = df.select(parse_date("v").alias("a"), parse_date("v", "ydm").alias("b")).collect()[0]
    assert (r["a"], r["b"]) == (ymd, ydm)
