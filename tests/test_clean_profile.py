"""Cleaning flow, report and profiling against golden values of the 7-row file; exact quantiles vs numpy."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cleanspark.operators import clean as C
from cleanspark.operators import profile as P
from cleanspark.operators.quantiles import exact_quantiles


def test_clean_golden(customers7):
    out = {r["customer_id"]: r for r in C.clean_customers(customers7).collect()}
    ids = [str(i) for i in range(11, 18)]
    assert sorted(out) == ids  # text ids stay text
    assert [str(out[i]["signup_date"]) if out[i]["signup_date"] else None for i in ids] == \
        ["2023-05-09", "2023-06-07", "2023-05-09", None, "2022-12-30", "2023-02-01", "2023-06-07"]
    assert [out[i]["phone"] for i in ids] == \
        ["21622334455", "21698765432", "22334455", None, "33144556677", None, "21698765432"]
    assert out["15"]["name"] is None and out["11"]["name"] == "olfa" and out["14"]["email"] is None


def test_ids_as_numbers_only_when_all_are(spark, customers7):
    assert dict(C.integral_ids(customers7).dtypes)["customer_id"] == "bigint"
    odd = customers7.union(customers7.limit(1).withColumn("customer_id", F.lit("PAT1_BIS")))
    assert dict(C.integral_ids(odd).dtypes)["customer_id"] == "string"
    out = C.clean_customers(spark.createDataFrame([(" PAT1", "ann"), ("PAT2", "ann"), ("", "bob")], "customer_id string, name string"))
    assert sorted((r["customer_id"] or "", r["name"]) for r in out.collect()) == [("", "bob"), ("PAT1", "ann"), ("PAT2", "ann")]


def test_cleaning_maps_roles(spark):
    df = spark.createDataFrame([("P1_BIS", " Zed ", "z@x.tn", "22 33 44 55", "Tunis", "2024-03-02", "7,5", "x")],
                               ["Patient_ID", "Nom", "mail", "Telephone", "Ville", "Date_Ordonnance", "prix_DT", "other.one"])
    r = C.clean_customers(df).collect()[0]
    assert (r["customer_id"], r["name"], r["phone"], r["city"], str(r["signup_date"]), r["other.one"]) == \
        ("P1_BIS", "zed", "22334455", "tunis", "2024-03-02", "x")


def test_clean_ydm_reproduces_reference_reading(customers7):
    out = {r["customer_id"]: r["signup_date"] for r in C.clean_customers(customers7, "ydm").collect()}
    assert str(out["11"]) == "2023-09-05" and str(out["14"]) == "2023-01-14" and str(out["12"]) == "2023-07-06"


def test_clean_report_golden(customers7):
    r = C.clean_report(customers7).collect()[0].asDict()
    assert r == {"rows_before": 7, "exact_duplicates_removed": 0, "invalid_emails": 1, "invalid_dates": 1,
                 "negative_amount_count": 1, "rows_after": 7, "empty_rows_removed": 0}


def test_clean_is_idempotent(customers7):
    once = C.clean_customers(customers7)
    as_text = once.select(*[F.col(c).cast("string").alias(c) for c in once.columns])
    twice = C.clean_customers(as_text)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_header_and_schema_completion(spark):
    df = spark.createDataFrame([("1", "x")], [" Customer_ID ", "NAME"])
    out = C.clean_columns(df)
    assert out.columns[:8] == ["customer_id", "name", "email", "phone", "city", "country", "signup_date", "amount"]
    with pytest.raises(ValueError):
        C.clean_columns(spark.createDataFrame([("1", "2")], ["a", "A "]))


def _typed7(customers7):
    return customers7.select(F.col("customer_id").cast("bigint").alias("customer_id"), "name", "email", "phone",
                             "city", "country", "signup_date", F.col("amount").cast("double").alias("amount"))


AMOUNTS = np.array([80.5, 45.25, 80.5, 2500, 60, -12, 45.25])
IDS = np.arange(11, 18)


def test_numeric_profile_golden(customers7):
    df = _typed7(customers7)
    r = {x["column"]: x for x in P.numeric_profile(df, ["amount"]).collect()}["amount"]
    assert (r["q25"], r["median"], r["q75"]) == pytest.approx((45.25, 60.0, 80.5))
    assert r["mean"] == pytest.approx(AMOUNTS.mean()) and r["std"] == pytest.approx(AMOUNTS.std(ddof=1))
    o = P.iqr_outliers(df, ["amount"]).collect()[0]
    assert (o["lower_bound"], o["upper_bound"], o["outliers_count"]) == pytest.approx((-7.625, 133.375, 2))


def _jarque_bera(x):
    z = (x - x.mean()) / x.std()
    return len(x) / 6 * ((z ** 3).mean() ** 2 + ((z ** 4).mean() - 3) ** 2 / 4)


def test_jarque_bera_golden(customers7):
    rows = {r["column"]: r for r in P.normality_jb(_typed7(customers7), ["amount", "customer_id"]).collect()}
    for name, x in (("amount", AMOUNTS), ("customer_id", IDS)):
        jb = _jarque_bera(x)
        assert rows[name]["jb"] == pytest.approx(jb) and rows[name]["p_value"] == pytest.approx(math.exp(-jb / 2))
    assert rows["amount"]["is_normal"] is False and rows["customer_id"]["is_normal"]


def test_quality_score_golden(spark, customers7):
    raw = _typed7(customers7)
    r = P.quality_score(raw).collect()[0]
    # 2 of 56 cells missing; no row twice; 2 of 7 amounts outlie, one of eight columns; one column is not normal
    assert r["quality_score"] == pytest.approx(round(100 - 0.5 * 100 * round(2 / 56, 6) - round(100 * 2 / 7, 2) / 8 - 2, 1), abs=0.11)
    assert r["quality_grade"] == "A"
    empty = P.quality_score(raw.limit(0)).collect()[0]
    assert (empty["quality_score"], empty["quality_grade"], empty["traffic_light"]) == (None, None, None)


def test_correlation_golden_and_constant_column(spark, customers7):
    df = _typed7(customers7).withColumn("k", F.lit(1.0))
    rows = {(r["col1"], r["col2"]): r["corr"] for r in P.correlations(df, ["customer_id", "amount", "k"]).collect()}
    assert rows[("customer_id", "amount")] == pytest.approx(np.corrcoef(IDS, AMOUNTS)[0, 1])
    assert rows[("customer_id", "k")] is None  # constant column: no error, no value
    assert P.correlations(df, ["customer_id", "amount"], threshold=0.7).count() == 0


def test_column_profile_distinct_and_nulls(customers7):
    rows = {r["column"]: r for r in P.profile_columns(customers7).collect()}
    assert [rows[c]["unique_count"] for c in ["customer_id", "name", "email", "phone", "city", "country",
                                              "signup_date", "amount"]] == [7, 5, 6, 5, 5, 2, 6, 5]
    assert rows["name"]["null_count"] == 1 and rows["phone"]["null_count"] == 1


def test_exact_duplicates_count_all_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    r = P.exact_duplicates(df).collect()[0]
    assert (r["exact_duplicates"], r["exact_duplicates_percentage"]) == (4, 80.0)


@pytest.mark.parametrize("buckets", [4096, 16, 2])
def test_exact_quantiles_match_numpy(spark, buckets):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(0, 1, 300), np.full(150, 2.5), rng.exponential(5, 50)])
    df = spark.createDataFrame([(float(v), float(v) * 2 if i % 3 else None) for i, v in enumerate(vals)],
                               "a double, b double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0] if buckets > 2 else [0.5]
    got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, ["a", "b"], probs, buckets=buckets).collect()}
    b = np.array([float(v) * 2 for i, v in enumerate(vals) if i % 3])
    for p in probs:
        assert got[("a", p)] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12, abs=1e-12)
        assert got[("b", p)] == pytest.approx(float(np.quantile(b, p)), rel=1e-12, abs=1e-12)


def test_quantiles_of_infinities_and_the_whole_range(spark):
    """Ranges that overflow a double, subnormals, both zeros and infinities end after a few passes."""
    inf = float("inf")
    vals = [inf, -inf, inf, 1e308, -1e308, 5e-324, -5e-324, 0.0, -0.0, 1.0, 1e-300, 1e200, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "`x.y` double")
    known = sorted(v for v in vals if v == v)
    got = {r["p"]: r["value"] for r in exact_quantiles(df, ["x.y"], [i / 11 for i in range(12)]).collect()}
    assert [got[i / 11] for i in range(12)] == pytest.approx(known)


def test_quantiles_of_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    r = exact_quantiles(df, ["a"], [0.5]).collect()[0]
    assert r["value"] is None and not math.isnan(0.0)


def test_classic_and_smart_flow_golden(customers7):
    from cleanspark.plans import flows as FL
    c = FL.classic_flow(customers7).collect()[0]
    # rows 15 and 16 lack a value; the negative amount is among them
    assert (c["rows_final"], c["duplicates_found"], c["anomalies_found"]) == (5, 2, 0)
    assert (c["exact_copies_removed"], c["null_rows_removed"]) == (0, 2)
    s = FL.smart_flow(customers7).collect()[0]
    assert (s["rows_final"], s["duplicates_found"], s["anomalies_found"]) == (7, 2, 2)
    cmp = FL.flow_comparison(FL.classic_flow(customers7), FL.smart_flow(customers7)).collect()[0]
    assert cmp["anomalies_difference"] == 2 and cmp["reasons"] == "smart flow finds 2 more anomalies"


def test_before_after_and_corrections(spark):
    from cleanspark.operators import quality as Q
    from cleanspark.operators import rules as V
    raw = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "x"), (None, None)], "t string, amount string")
    after = spark.createDataFrame([("a", 1.0), ("b", None)], "t string, amount double")
    valid = {"amount": F.col("amount").rlike("^[0-9]+$")}
    b, a = Q.before_after(raw, after, valid, None, "amount").collect()
    assert (b["rows"], b["exact_copies"], b["invalid_cells"], a["invalid_cells"], a["outliers"]) == (4, 1, 1, 0, 0)
    assert b["completeness"] == 0.75 and b["error_rate"] == pytest.approx(1 / 6)
    before = 40 * 0.75 + 30 * 5 / 6 + 20 * 0.75 + 10
    assert b["quality"] == pytest.approx(before) and a["quality"] == pytest.approx(90.0)
    assert a["improvement_pct"] == pytest.approx(100 * (90 - before) / before) and b["improvement_pct"] is None
    log = V.correction_log(raw.withColumn("id", F.lit(1)), {"amount": F.col("amount").try_cast("double")}, "id")
    assert {r["column"]: (r["corrections"], r["nulled"]) for r in V.correction_counts(log).collect()} == {"amount": (3, 1)}


def test_rules_on_dotted_names_and_overall_result(spark):
    from cleanspark.operators import rules as V
    from cleanspark.sources import readers as R
    df = spark.createDataFrame([(1, 5.0, "x"), (2, 50.0, "NA"), (3, None, "y")], "k int, `a.b` double, `t.u` string")
    rules = [V.range_rule("a.b", 0, 10), V.not_null_rule("a.b")]
    assert [(r["k"], r["rule"]) for r in V.violations(df, rules, ["k"]).orderBy("k").collect()] == [(2, "range_a.b"), (3, "not_null_a.b")]
    r = V.validation_result(df, rules).collect()[0]
    assert tuple(r) == (3, 2, 2, False)
    assert V.validation_result(df.limit(0), rules).collect()[0]["is_valid"] is True
    assert [x[2] for x in R.apply_null_tokens(df).orderBy("k").collect()] == ["x", None, "y"]
    assert V.impute_mean(df, ["a.b"]).where("k = 3").collect()[0]["a.b"] == 27.5
    assert V.histogram(df, "a.b", 2).count() == 3


def test_profile_and_before_after_read_written_tables(spark, customers7):
    """Cleaning stands in no plan of the report: the cleaned rows are written once, whatever the sections read."""
    from cleanspark.operators import quality as Q
    from cleanspark.plans import flows as FL
    cleaned = C.clean_customers(customers7)
    report = FL.profile_report(cleaned)
    assert "regexp_replace" not in report._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {r.section for r in report.collect()} >= {"general", "columns", "numeric", "categorical"}
    rows = Q.before_after(customers7, cleaned, None, None, "amount")
    assert "Aggregate" not in rows._jdf.queryExecution().optimizedPlan().toString() and rows.count() == 2
