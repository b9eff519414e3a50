"""The query catalogue: one Spark query per operator of the inventory, each with its oracle SQL where one exists.

Every query reads the driver tables (or rows Spark derives from them) in full.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.text import clean_email, coerce_number, is_valid_email, normalize_phone, normalize_text
from ..operators import clean as C
from ..session import cut_lineage
from ..sources import fixtures as FX
from ..sources import readers as R
from . import sqltext as S

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return FX.dirty_customers(spark, sf)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return FX.load(spark, sf, name)


# ---------------------------------------------------------------- sources and schema

@register("read_table", "SELECT * FROM customer")
def q_read_table(spark, sf):
    return R.read_table(spark, FX.table_path(sf, "customer"))


@register("null_tokens", S.with_clean("SELECT * FROM raw_nt"))
def q_null_tokens(spark, sf):
    return R.apply_null_tokens(raw(spark, sf))


@register("schema_completion", S.with_clean(
    "SELECT customer_id, name, email, phone, signup_date, amount, CAST(NULL AS VARCHAR) AS city, "
    "CAST(NULL AS VARCHAR) AS country FROM raw"))
def q_schema_completion(spark, sf):
    partial = raw(spark, sf).drop("city", "country")
    return R.complete_schema(partial)


_FRENCH = {"customer_id": "Patient_ID", "name": " Nom ", "email": "Email", "phone": "Telephone", "city": "Ville",
           "country": "PAYS", "signup_date": "Date_Ordonnance", "amount": "prix_DT"}


@register("role_mapping", "WITH raw AS (" + S.RAW + ") SELECT * FROM raw")
def q_role_mapping(spark, sf):
    renamed = raw(spark, sf).select(*[F.col(k).alias(v) for k, v in _FRENCH.items()])
    return R.map_roles(R.normalize_headers(renamed))


# ---------------------------------------------------------------- scalar cleaning

@register("normalize_text", S.with_clean(
    f"SELECT customer_id, name AS raw_name, {S.norm_text('name')} AS name, "
    f"city AS raw_city, {S.norm_text('city')} AS city, {S.norm_text('country')} AS country FROM raw"))
def q_normalize_text(spark, sf):
    r = raw(spark, sf)
    return r.select("customer_id", F.col("name").alias("raw_name"), normalize_text("name").alias("name"),
                    F.col("city").alias("raw_city"), normalize_text("city").alias("city"),
                    normalize_text("country").alias("country"))


@register("normalize_phone", S.with_clean(
    f"SELECT customer_id, phone AS raw_phone, {S.norm_phone('phone')} AS phone FROM raw"))
def q_normalize_phone(spark, sf):
    return raw(spark, sf).select("customer_id", F.col("phone").alias("raw_phone"),
                                 normalize_phone("phone").alias("phone"))


@register("validate_email", S.with_clean(
    f"SELECT customer_id, email AS raw_email, {S.valid_email(S.norm_text('email'))} AS is_valid, "
    f"{S.clean_email('email')} AS email FROM raw"))
def q_validate_email(spark, sf):
    return raw(spark, sf).select("customer_id", F.col("email").alias("raw_email"),
                                 is_valid_email(normalize_text("email")).alias("is_valid"),
                                 clean_email("email").alias("email"))


@register("parse_dates", S.with_clean(
    f"SELECT customer_id, signup_date AS raw_date, {S.parse_date('signup_date')} AS signup_date, "
    f"{S.parse_date('signup_date', 'ydm')} AS signup_date_ydm FROM raw"))
def q_parse_dates(spark, sf):
    return raw(spark, sf).select("customer_id", F.col("signup_date").alias("raw_date"),
                                 parse_date("signup_date").alias("signup_date"),
                                 parse_date("signup_date", "ydm").alias("signup_date_ydm"))


@register("coerce_amount", S.with_clean(
    f"SELECT customer_id, amount AS raw_amount, {S.number('amount')} AS amount FROM raw"))
def q_coerce_amount(spark, sf):
    return raw(spark, sf).select("customer_id", F.col("amount").alias("raw_amount"),
                                 coerce_number("amount").alias("amount"))


# ---------------------------------------------------------------- row cleaning

@register("drop_empty_rows", S.with_clean(
    "SELECT * FROM cleaned WHERE NOT (name IS NULL AND email IS NULL AND phone IS NULL AND city IS NULL "
    "AND country IS NULL AND signup_date IS NULL AND amount IS NULL)"))
def q_drop_empty_rows(spark, sf):
    return C.drop_empty_rows(C.clean_columns(raw(spark, sf)))


@register("distinct_rows", "WITH raw AS (" + S.RAW + ") SELECT DISTINCT * FROM raw")
def q_distinct_rows(spark, sf):
    return C.distinct_rows(raw(spark, sf))


@register("clean_customers", S.with_clean("SELECT * FROM clean"))
def q_clean_customers(spark, sf):
    return C.clean_customers(raw(spark, sf))


@register("clean_report", S.with_clean("""
SELECT CAST((SELECT count(*) FROM cleaned) AS BIGINT) AS rows_before,
       CAST((SELECT count(*) FROM cleaned WHERE NOT (name IS NULL AND email IS NULL AND phone IS NULL AND city IS NULL
             AND country IS NULL AND signup_date IS NULL AND amount IS NULL)) - (SELECT count(*) FROM clean) AS BIGINT)
         AS exact_duplicates_removed,
       CAST((SELECT count(*) FROM cleaned WHERE email IS NULL) AS BIGINT) AS invalid_emails,
       CAST((SELECT count(*) FROM cleaned WHERE signup_date IS NULL) AS BIGINT) AS invalid_dates,
       CAST((SELECT count(*) FROM cleaned WHERE amount < 0) AS BIGINT) AS negative_amount_count,
       CAST((SELECT count(*) FROM clean) AS BIGINT) AS rows_after,
       CAST((SELECT count(*) FROM cleaned WHERE name IS NULL AND email IS NULL AND phone IS NULL AND city IS NULL
             AND country IS NULL AND signup_date IS NULL AND amount IS NULL) AS BIGINT) AS empty_rows_removed
"""))
def q_clean_report(spark, sf):
    return C.clean_report(raw(spark, sf))


# ---------------------------------------------------------------- profiling
from ..operators import profile as P  # noqa: E402
from pyspark.sql import types as T  # noqa: E402


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for engine-independent comparison (summation order differs in the last bits)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


LINE_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax"]
LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUST_NUM = ["c_custkey", "c_nationkey", "c_acctbal"]


def _profile_columns_sql(tbl, cols, numeric):
    return S.union_all(
        f"SELECT '{c}' AS \"column\", '{'numeric' if c in numeric else 'categorical'}' AS type, "
        f"CAST(count({c}) AS BIGINT) AS non_null_count, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
        f"ROUND(100.0 * (count(*) - count({c})) / count(*), 2) AS null_percentage, "
        f"CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count, "
        f"CAST(count(*) - count(DISTINCT {c}) AS BIGINT) AS duplicate_count FROM {tbl}" for c in cols)


def _mode_sql(tbl, cols):
    return S.union_all(
        f"SELECT '{c}' AS \"column\", v AS most_common, CAST(n AS BIGINT) AS most_common_count, "
        f"ROUND(100.0 * n / (SELECT count(*) FROM {tbl}), 2) AS most_common_percentage FROM "
        f"(SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {tbl} WHERE {c} IS NOT NULL GROUP BY 1 "
        f"ORDER BY n DESC, v ASC LIMIT 1)" for c in cols)


@register("profile_table", "SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(5 AS BIGINT) AS total_columns, "
          "'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS column_names FROM customer")
def q_profile_table(spark, sf):
    return P.profile_table(table(spark, sf, "customer"))


@register("profile_columns", _profile_columns_sql("customer", CUST_COLS, CUST_NUM))
def q_profile_columns(spark, sf):
    return P.profile_columns(table(spark, sf, "customer"))


@register("profile_numeric", S.numeric_profile_sql("lineitem", LINE_NUM))
def q_profile_numeric(spark, sf):
    return rounded(P.numeric_profile(table(spark, sf, "lineitem"), LINE_NUM))


@register("iqr_outliers", S.iqr_outliers_sql("events", ["event_id", "user_id", "value"]))
def q_iqr_outliers(spark, sf):
    return rounded(P.iqr_outliers(table(spark, sf, "events"), ["event_id", "user_id", "value"]))


def _iqr_flag_sql(tbl, cols, keys):
    b = S.iqr_bounds_cte(tbl, cols)
    conds = " OR ".join(
        f"{c} < (SELECT q1 - 1.5 * (q3 - q1) FROM bounds WHERE \"column\" = '{c}') OR "
        f"{c} > (SELECT q3 + 1.5 * (q3 - q1) FROM bounds WHERE \"column\" = '{c}')" for c in cols)
    return f"WITH bounds AS ({b}) SELECT {', '.join(keys)} FROM {tbl} WHERE {conds}"


EVENT_NUM = ["event_id", "user_id", "value"]


@register("iqr_flag_rows", _iqr_flag_sql("events", EVENT_NUM, ["event_id", "value"]))
def q_iqr_flag_rows(spark, sf):
    ev = table(spark, sf, "events")
    return P.iqr_flag(ev, EVENT_NUM).where("is_outlier").select("event_id", "value")


@register("normality_jb", S.jb_sql("lineitem", LINE_NUM))
def q_normality_jb(spark, sf):
    return rounded(P.normality_jb(table(spark, sf, "lineitem"), LINE_NUM))


@register("profile_categorical", _mode_sql("part", ["p_name", "p_brand", "p_type"]))
def q_profile_categorical(spark, sf):
    return P.categorical_profile(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


@register("missing_values", S.with_clean(
    "SELECT \"column\", missing_count FROM (" + S.union_all(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS missing_count FROM raw_nt"
        for c in R.EXPECTED_COLUMNS) + ") t WHERE missing_count > 0 "
    "UNION ALL SELECT '__total__', CAST(sum(missing_count) AS BIGINT) FROM (" + S.union_all(
        f"SELECT count(*) - count({c}) AS missing_count FROM raw_nt" for c in R.EXPECTED_COLUMNS) + ") u"))
def q_missing_values(spark, sf):
    return P.missing_values(R.apply_null_tokens(raw(spark, sf)))


@register("exact_duplicates", """
SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS exact_duplicates,
       ROUND(100.0 * coalesce(sum(n) FILTER (WHERE n > 1), 0) / sum(n), 2) AS exact_duplicates_percentage
FROM (SELECT text, count(*) AS n FROM documents GROUP BY text) g""")
def q_exact_duplicates(spark, sf):
    return P.exact_duplicates(table(spark, sf, "documents").select("text"), digest_columns=["text"])


@register("duplicate_rows_top10", """
SELECT doc_id FROM documents d
WHERE EXISTS (SELECT 1 FROM documents e WHERE e.doc_id <> d.doc_id AND e.text IS NOT DISTINCT FROM d.text)
ORDER BY doc_id LIMIT 10""")
def q_duplicate_rows_top10(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return P.duplicate_rows_top(docs, "doc_id", 10, digest_columns=["text"])


@register("duplicate_rows_top10_whole", "WITH raw AS (" + S.RAW + """)
SELECT customer_id FROM (SELECT customer_id, count(*) OVER (PARTITION BY name, email, phone, city, country, signup_date, amount) AS n FROM raw)
WHERE n > 1 ORDER BY customer_id LIMIT 10""")
def q_duplicate_rows_top10_whole(spark, sf):
    """A11 over whole rows: all columns but the id are compared."""
    return P.duplicate_rows_top(raw(spark, sf), ID)


@register("correlations_all", S.corr_sql("lineitem", LINE_NUM))
def q_correlations_all(spark, sf):
    return rounded(P.correlations(table(spark, sf, "lineitem"), LINE_NUM))


_CHARGE = [*LINE_MEASURES, "charge"]


@register("correlations_strong", "WITH charged AS (SELECT * REPLACE (CASE WHEN l_linenumber <> 3 THEN l_tax END AS l_tax), "
          "l_extendedprice * (1 - l_discount) AS charge FROM lineitem)\n" + S.corr_sql("charged", _CHARGE, 0.7))
def q_correlations_strong(spark, sf):
    """A12 with a derived measure and missing values (pairs of columns that are not complete together)."""
    li = table(spark, sf, "lineitem").withColumn("charge", F.col("l_extendedprice") * (1 - F.col("l_discount"))) \
        .withColumn("l_tax", F.when(F.col("l_linenumber") != 3, F.col("l_tax")))
    return rounded(P.correlations(li, _CHARGE, threshold=0.7))


_WIDE = [(f"{c}_{k}", e.replace("x", c)) for c in LINE_NUM for k, e in (
    ("all", "x"), ("some", "CASE WHEN l_linenumber % 3 <> 0 THEN x END"), ("scaled", "x * (l_linenumber + 1000000)"))]
_WIDE_SELECT = "SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in _WIDE) + " FROM {lineitem}"


@register("correlations_wide", "WITH wide AS (" + _WIDE_SELECT.format(lineitem="lineitem") + ")\n" + S.corr_sql("wide", [n for n, _ in _WIDE]))
def q_correlations_wide(spark, sf):
    """A12 over three times the columns, a third of them with missing cells."""
    wide = spark.sql(_WIDE_SELECT, lineitem=table(spark, sf, "lineitem"))
    return rounded(P.correlations(wide, [n for n, _ in _WIDE]))


def _quality_sql(tbl, cols, numeric):
    pc = _profile_columns_sql(tbl, cols, numeric)
    io = S.iqr_outliers_sql(tbl, numeric).replace("WITH bounds AS", "bounds AS", 1)
    jb = S.jb_sql(tbl, numeric).replace("WITH m AS", "m AS", 1)
    return f"""
WITH pc AS ({pc}),
io AS (WITH {io}),
jbt AS (WITH {jb}),
g AS (SELECT count(*) AS n FROM {tbl} GROUP BY ALL_COLS_PLACEHOLDER),
dup AS (SELECT ROUND(100.0 * coalesce(sum(n) FILTER (WHERE n > 1), 0) / sum(n), 2) AS dp FROM g),
per AS (SELECT pc.\"column\", pc.null_percentage, coalesce(io.outliers_percentage, 0) AS op,
               CASE WHEN jbt.is_normal = false THEN 1 ELSE 0 END AS abn
        FROM pc LEFT JOIN io USING (\"column\") LEFT JOIN jbt USING (\"column\")),
m AS (SELECT avg(null_percentage) AS avg_null_percentage, (SELECT dp FROM dup) AS duplicate_percentage,
             avg(op) AS avg_outlier_percentage, CAST(sum(abn) AS BIGINT) AS non_normal_columns FROM per),
s AS (SELECT *, ROUND(greatest(100.0 - least(avg_null_percentage * 0.5, 20) - least(duplicate_percentage * 2, 15)
                 - least(avg_outlier_percentage, 15) - least(non_normal_columns * 2.0, 10), 0), 1) AS quality_score FROM m)
SELECT {S.r6('avg_null_percentage')} AS avg_null_percentage, duplicate_percentage,
       {S.r6('avg_outlier_percentage')} AS avg_outlier_percentage, non_normal_columns, quality_score,
       CASE WHEN quality_score >= 90 THEN 'A' WHEN quality_score >= 75 THEN 'B' WHEN quality_score >= 60 THEN 'C' ELSE 'D' END
         AS quality_grade,
       CASE WHEN quality_score >= 80 THEN 'green' WHEN quality_score >= 60 THEN 'amber' ELSE 'red' END AS traffic_light
FROM s""".replace("ALL_COLS_PLACEHOLDER", ", ".join(cols))


@register("quality_score", _quality_sql("customer", CUST_COLS, CUST_NUM))
def q_quality_score(spark, sf):
    return rounded(P.quality_score(table(spark, sf, "customer")))


_DIRTY_NUM = ["customer_id", "amount"]


@register("quality_score_dirty", S.with_clean("").rstrip() + ",\ndirty AS (SELECT * REPLACE (TRY_CAST(amount AS DOUBLE) AS amount) "
          "FROM raw_nt)," + _quality_sql("dirty", list(R.EXPECTED_COLUMNS), _DIRTY_NUM).replace("WITH pc AS", "pc AS", 1))
def q_quality_score_dirty(spark, sf):
    """A13 on rows with nulls, copies and outliers."""
    r = R.apply_null_tokens(raw(spark, sf))
    return rounded(P.quality_score(r.withColumn("amount", F.col("amount").try_cast("double"))))


@register("exact_duplicate_rows", "WITH raw AS (" + S.RAW + """)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS exact_duplicates,
       ROUND(100.0 * coalesce(sum(n) FILTER (WHERE n > 1), 0) / sum(n), 2) AS exact_duplicates_percentage
FROM (SELECT count(*) AS n FROM raw GROUP BY """ + ", ".join(R.EXPECTED_COLUMNS) + ") g")
def q_exact_duplicate_rows(spark, sf):
    """A11 on whole rows."""
    return P.exact_duplicates(raw(spark, sf))


@register("profile_report")
def q_profile_report(spark, sf):
    """Every section of the profile as one table."""
    return FL.profile_report(cleaned(spark, sf))


_CSV_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("read_csv", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ' "q", ' || chr(10) || 'line' AS c_name,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS c_nationkey, c_mktsegment FROM customer""")
def q_read_csv(spark, sf):
    """The customers written as CSV with quotes, commas and line breaks inside fields, half of them with another
    header order and one column less, read back as one table."""
    from ..streaming.stream import scratch_path
    c = table(spark, sf, "customer").withColumn("c_name", F.concat("c_name", F.lit(' "q", \nline'))).select(
        *[F.col(x).cast("string").alias(x) for x in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")])
    paths = [scratch_path(spark, "csv-a"), scratch_path(spark, "csv-b")]
    c.where(F.col("c_custkey").cast("long") % 2 == 0).write.option("header", True).option("escape", '"').csv(paths[0])
    c.where(F.col("c_custkey").cast("long") % 2 == 1).select("c_mktsegment", "c_name", "c_custkey").write.option(
        "header", True).option("escape", '"').csv(paths[1])
    return R.read_table(spark, paths, "csv").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@register("read_csv_split", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents")
def q_read_csv_split(spark, sf):
    """Documents, whose texts hold quotes, commas and line breaks, written as CSV and read back by splits."""
    from ..streaming.stream import scratch_path
    path = scratch_path(spark, "csv-split")
    table(spark, sf, "documents").select(F.col("doc_id").cast("string"), "text", "lang", "source").write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return R.read_csv(spark, [path], split=True)


def _column_summary_sql(tbl, cols, numeric):
    parts = []
    for c in cols:
        if c in numeric:
            parts.append(f"SELECT '{c}' AS \"column\", 'numeric' AS type, {S.r6(f'avg({c})')} AS mean, "
                         f"{S.r6(f'min({c})')} AS min, {S.r6(f'max({c})')} AS max, CAST(NULL AS BIGINT) AS unique_count, "
                         f"CAST(NULL AS VARCHAR) AS most_common FROM {tbl}")
        else:
            parts.append(f"SELECT '{c}', 'categorical', NULL, NULL, NULL, CAST(count(DISTINCT {c}) AS BIGINT), "
                         f"(SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {tbl} WHERE {c} IS NOT NULL "
                         f"GROUP BY 1 ORDER BY n DESC, v LIMIT 1)) FROM {tbl}")
    return S.union_all(parts)


@register("column_summary", _column_summary_sql("customer", CUST_COLS, CUST_NUM))
def q_column_summary(spark, sf):
    return rounded(P.column_summary(table(spark, sf, "customer")))


# ---------------------------------------------------------------- pairs, similarity, dedup
from ..operators import anomaly as AN  # noqa: E402
from ..operators import dedup as DD  # noqa: E402
from ..operators import pairs as PR  # noqa: E402
from ..operators import lossless as LL  # noqa: E402
from . import flows as FL  # noqa: E402


ID = "customer_id"


def clean(spark, sf):
    """Cleaned customers, written: pairing reads them several times (and a lineage cut keeps the optimiser from
    re-deriving constraints of the cleaning expressions through every self join)."""
    return cut_lineage(cleaned(spark, sf))


def cleaned(spark, sf):
    """Cleaned customers as a plan, for queries that read them once."""
    return C.clean_customers(raw(spark, sf))


def _tfeat(spark, sf):
    t = PR.triples(clean(spark, sf), ID)
    return PR.triple_pair_features(t, PR.candidate_pairs(t))


@register("pairs_blocked", S.with_pairs("SELECT row_i, row_j FROM listed WHERE first_i <> first_j"))
def q_pairs_blocked(spark, sf):
    t = PR.triples(clean(spark, sf), ID)
    return PR.candidate_pairs(t).select(F.col("tid_i").alias("row_i"), F.col("tid_j").alias("row_j"))


@register("sim_indel", S.with_pairs(
    "SELECT row_i, row_j, ROUND(email_sim, 6) AS email_sim, ROUND(phone_sim, 6) AS phone_sim FROM listed WHERE first_i <> first_j"))
def q_sim_indel(spark, sf):
    f = _tfeat(spark, sf)
    return rounded(f.select(F.col("tid_i").alias("row_i"), F.col("tid_j").alias("row_j"), "email_sim", "phone_sim"))


@register("sim_token_set", S.with_pairs(
    "SELECT row_i, row_j, ROUND(name_sim, 6) AS name_sim FROM listed WHERE first_i <> first_j"))
def q_sim_token_set(spark, sf):
    f = _tfeat(spark, sf)
    return rounded(f.select(F.col("tid_i").alias("row_i"), F.col("tid_j").alias("row_j"), "name_sim"))


@register("pair_features", S.with_pairs(
    "SELECT row_i, row_j, ROUND(name_sim, 6) AS name_sim, ROUND(email_sim, 6) AS email_sim, "
    "ROUND(phone_sim, 6) AS phone_sim, ROUND(avg_sim, 6) AS avg_sim FROM listed"))
def q_pair_features(spark, sf):
    return rounded(PR.pair_features(clean(spark, sf), ID))


@register("dup_pairs_rule", S.with_pairs(
    "SELECT row_i, row_j, ROUND(name_sim, 6) AS name_sim, ROUND(email_sim, 6) AS email_sim, "
    "ROUND(phone_sim, 6) AS phone_sim, ROUND(avg_sim, 6) AS avg_sim, 1 AS label FROM listed WHERE avg_sim > 0.7"))
def q_dup_pairs_rule(spark, sf):
    return rounded(DD.rule_pairs(clean(spark, sf), ID).withColumn("label", DD.rule_label()))


@register("dedup_drop_later", S.with_pairs("SELECT customer_id, reason FROM dropped"))
def q_dedup_drop_later(spark, sf):
    _, dropped, _ = DD.dedup_rule(clean(spark, sf), ID)
    return dropped


_SHARED_IDS = ("shared AS (SELECT DISTINCT CASE WHEN customer_id % 7 <> 0 THEN customer_id % 40 END AS customer_id, name, email, phone, "
               "city, country, signup_date, amount FROM clean),\nnumbered AS (SELECT *, row_number() OVER (ORDER BY " + ", ".join(
                   f"{c} NULLS FIRST" for c in R.EXPECTED_COLUMNS) + ") AS rid FROM shared)")


@register("dedup_repeated_ids", S.with_clean("").rstrip() + ",\n" + _SHARED_IDS + ",\n" + S.pair_ctes("numbered", "rid") +
          "\nSELECT " + ", ".join(R.EXPECTED_COLUMNS) + " FROM deduped")
def q_dedup_repeated_ids(spark, sf):
    """J3 where an id names many rows or none: rows are told apart by a number of their own."""
    few = F.when(F.col(ID) % 7 != 0, F.col(ID) % 40).alias(ID)
    shared = cleaned(spark, sf).select(few, *R.EXPECTED_COLUMNS[1:]).distinct()
    kept, _, _ = DD.dedup_rule(shared)
    return kept.select(*R.EXPECTED_COLUMNS)


@register("blocking_recall")
def q_blocking_recall(spark, sf):
    """What blocking misses: a stated query set compared with all rows, without blocks."""
    return PR.sampled_recall(cleaned(spark, sf), every=10)


def ratio_rounded(c: str):
    """A ratio of whole numbers below a million, in [0, 1], to six digits, half up. ``F.round`` goes through decimal text, which takes
    longer than all else on tables of pairs; no such ratio but an exact half is as near to a half as the margin here."""
    return (F.floor(F.col(c) * 1e6 + 0.5000001) / 1e6).alias(c)


def _lossless(t):
    found = LL.lossless_pairs(t)
    return found.select(F.col("tid_i").alias("row_i"), F.col("tid_j").alias("row_j"), *[ratio_rounded(c) for c in ("name_sim", "email_sim", "phone_sim")])


@register("pairs_lossless", S.all_pairs_sql("clean", S.CLEAN_CTES.strip()))
def q_pairs_lossless(spark, sf):
    """J2 without block keys: every pair that the rule calls a duplicate."""
    return _lossless(PR.triples(clean(spark, sf), ID))


@register("pairs_lossless_narrow", S.all_pairs_sql("narrow", "narrow AS (" + FX.oracle_sql_text(FX.NARROW_CUSTOMERS_SQL).strip() + ")"))
def q_pairs_lossless_narrow(spark, sf):
    """The same where names, mail domain and phones are alike, and block keys lose pairs."""
    return _lossless(PR.triples(FX.narrow_customers(spark, sf), ID))


_TEXT_ID = "'PAT' || CAST(customer_id % 1000 AS STRING) || CASE WHEN customer_id >= 1000 THEN '_BIS' ELSE '' END"


@register("clean_text_ids", S.with_clean(
    f"SELECT DISTINCT {_TEXT_ID} AS customer_id, name, email, phone, city, country, signup_date, amount FROM cleaned "
    "WHERE NOT (name IS NULL AND email IS NULL AND phone IS NULL AND city IS NULL AND country IS NULL AND "
    "signup_date IS NULL AND amount IS NULL)"))
def q_clean_text_ids(spark, sf):
    """P1 on ids that are no numbers: they survive as text."""
    return C.clean_customers(raw(spark, sf).withColumn(ID, F.expr(f"'  ' || {_TEXT_ID} || ' '")))

_FLAG = (", CAST((customer_id < (SELECT q1 - 1.5 * (q3 - q1) FROM qb WHERE k = 'customer_id') OR "
         "customer_id > (SELECT q3 + 1.5 * (q3 - q1) FROM qb WHERE k = 'customer_id') OR "
         "coalesce(amount < (SELECT q1 - 1.5 * (q3 - q1) FROM qb WHERE k = 'amount') OR "
         "amount > (SELECT q3 + 1.5 * (q3 - q1) FROM qb WHERE k = 'amount'), false)) AS INTEGER) AS is_anomaly")


def _qb(src):
    return (f"qb AS (SELECT 'customer_id' AS k, quantile_cont(customer_id, 0.25) AS q1, "
            f"quantile_cont(customer_id, 0.75) AS q3 FROM {src} UNION ALL SELECT 'amount', "
            f"quantile_cont(amount, 0.25), quantile_cont(amount, 0.75) FROM {src})")


@register("pipeline_rule", S.with_pairs(
    "").rstrip() + ",\n" + _qb("deduped") + "\nSELECT *" + _FLAG + " FROM deduped")
def q_pipeline_rule(spark, sf):
    return FL.run_rule(raw(spark, sf)).final


@register("run_report", S.with_pairs("").rstrip() + ",\n" + _qb("deduped") + ",\nfin AS (SELECT *" + _FLAG +
          " FROM deduped),\nnonempty AS (SELECT * FROM cleaned WHERE NOT (name IS NULL AND email IS NULL AND phone IS NULL AND "
          "city IS NULL AND country IS NULL AND signup_date IS NULL AND amount IS NULL))\n"
          "SELECT CAST((SELECT count(*) FROM raw) AS BIGINT) AS rows_read, "
          "CAST((SELECT count(*) FROM cleaned) - (SELECT count(*) FROM nonempty) AS BIGINT) AS empty_rows_removed, "
          "CAST((SELECT count(*) FROM nonempty) - (SELECT count(*) FROM clean) AS BIGINT) AS exact_duplicates_removed, "
          "CAST((SELECT count(*) FROM cleaned WHERE email IS NULL) AS BIGINT) AS invalid_emails, "
          "CAST((SELECT count(*) FROM cleaned WHERE signup_date IS NULL) AS BIGINT) AS invalid_dates, "
          "CAST((SELECT count(*) FROM cleaned WHERE amount < 0) AS BIGINT) AS negative_amounts, "
          "CAST((SELECT count(*) FROM clean) AS BIGINT) AS rows_clean, "
          "CAST((SELECT count(*) FROM dup) AS BIGINT) AS duplicate_pairs, "
          "CAST((SELECT count(*) FROM dropped) AS BIGINT) AS rows_dropped, "
          "CAST((SELECT count(*) FROM dropped WHERE reason = 'copy') AS BIGINT) AS dropped_copies, "
          "CAST((SELECT sum(is_anomaly) FROM fin) AS BIGINT) AS anomalies_found, "
          "CAST((SELECT count(*) FROM fin) AS BIGINT) AS final_rows, 'rule' AS dedup_variant, 'iqr' AS anomaly_variant, "
          "CAST(NULL AS VARCHAR) AS warning")
def q_run_report(spark, sf):
    return FL.run_rule(raw(spark, sf)).report


# ---------------------------------------------------------------- flows

_CLASSIC = ("raw_num AS (SELECT * REPLACE (CASE WHEN amount <> 'abc' THEN amount END AS amount) FROM raw_nt),\nclassic AS (SELECT 'classic' AS flow, CAST((SELECT count(*) FROM raw_nt) AS BIGINT) AS rows_processed, "
            "CAST(count(*) AS BIGINT) AS rows_final, "
            "CAST((SELECT count(*) FROM raw_nt) - count(*) AS BIGINT) AS duplicates_found, "
            "CAST(count(*) FILTER (WHERE customer_id < 0 OR CAST(amount AS DOUBLE) < 0) AS BIGINT) AS anomalies_found, "
            "CAST((SELECT count(*) FROM raw_nt) - count(*) AS BIGINT) AS rows_removed "
            "FROM (SELECT DISTINCT * FROM raw_num) d WHERE customer_id IS NOT NULL AND name IS NOT NULL AND "
            "email IS NOT NULL AND phone IS NOT NULL AND city IS NOT NULL AND country IS NOT NULL AND "
            "signup_date IS NOT NULL AND amount IS NOT NULL)")
_SMART = ("smart AS (SELECT 'smart' AS flow, CAST((SELECT count(*) FROM raw) AS BIGINT) AS rows_processed, "
          "CAST((SELECT count(*) FROM clean) AS BIGINT) AS rows_final, "
          "CAST((SELECT count(*) FROM dup) AS BIGINT) AS duplicates_found, "
          "CAST((SELECT count(*) FROM clean WHERE (customer_id < (SELECT q1 - 1.5 * (q3 - q1) FROM qb WHERE k = 'customer_id') OR "
          "customer_id > (SELECT q3 + 1.5 * (q3 - q1) FROM qb WHERE k = 'customer_id') OR "
          "coalesce(amount < (SELECT q1 - 1.5 * (q3 - q1) FROM qb WHERE k = 'amount') OR "
          "amount > (SELECT q3 + 1.5 * (q3 - q1) FROM qb WHERE k = 'amount'), false))) AS BIGINT) AS anomalies_found, "
          "CAST((SELECT count(*) FROM raw) - (SELECT count(*) FROM clean) AS BIGINT) AS rows_removed)")


@register("classic_flow", S.with_clean("").rstrip() + ",\n" + _CLASSIC + "\nSELECT *, "
          "CAST((SELECT count(*) FROM raw_nt) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_num)) AS BIGINT) "
          "AS exact_copies_removed, CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM raw_num)) - rows_final AS BIGINT) "
          "AS null_rows_removed FROM classic")
def q_classic_flow(spark, sf):
    return FL.classic_flow(_numeric_amounts(raw(spark, sf)))


def _numeric_amounts(r):
    """Raw rows whose amounts infer as numbers, as in a file without stray words in that column."""
    return r.withColumn("amount", F.when(F.col("amount") != "abc", F.col("amount")))


@register("smart_flow", S.with_pairs("").rstrip() + ",\n" + _qb("clean") + ",\n" + _SMART + "\nSELECT * FROM smart")
def q_smart_flow(spark, sf):
    return FL.smart_flow(raw(spark, sf))


@register("flow_comparison", S.with_pairs("").rstrip() + ",\n" + _qb("clean") + ",\n" + _CLASSIC + ",\n" + _SMART + """
SELECT c.rows_processed AS classic_rows_processed, c.rows_final AS classic_rows_final,
       c.duplicates_found AS classic_duplicates_found, c.anomalies_found AS classic_anomalies_found,
       c.rows_removed AS classic_rows_removed, s.rows_processed AS smart_rows_processed, s.rows_final AS smart_rows_final,
       s.duplicates_found AS smart_duplicates_found, s.anomalies_found AS smart_anomalies_found,
       s.rows_removed AS smart_rows_removed,
       s.duplicates_found - c.duplicates_found AS duplicates_difference,
       s.anomalies_found - c.anomalies_found AS anomalies_difference,
       concat_ws('; ', CASE WHEN s.duplicates_found > c.duplicates_found THEN 'smart flow finds ' ||
                            CAST(s.duplicates_found - c.duplicates_found AS VARCHAR) || ' more duplicates' END,
                       CASE WHEN s.anomalies_found > c.anomalies_found THEN 'smart flow finds ' ||
                            CAST(s.anomalies_found - c.anomalies_found AS VARCHAR) || ' more anomalies' END) AS reasons
FROM classic c, smart s""")
def q_flow_comparison(spark, sf):
    r = raw(spark, sf)
    return FL.flow_comparison(FL.classic_flow(_numeric_amounts(r)), FL.smart_flow(r))


# ---------------------------------------------------------------- models (D5-D7, M1-M3, P2, P3) - rows checks
from ..operators import rules as V  # noqa: E402
from ..sources import sinks as SK  # noqa: E402


@register("dup_model_train")
def q_dup_model_train(spark, sf):
    """Forest trained on the pair features; rows = feature importances. Rows have a number of their own, as an id may name several."""
    model = DD.train_dedup_model(cut_lineage(PR.pair_features(PR.with_row_id(clean(spark, sf), written=True))))
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(DD.FEATURES, imp)], "feature string, importance double")


@register("dup_pairs_model")
def q_dup_pairs_model(spark, sf):
    """D6 + F5: one decision per row by the forest at 0.75: dropped as a copy, dropped as a near match, or kept."""
    rows = PR.with_row_id(cleaned(spark, sf))
    t = PR.triples(rows)
    feats = cut_lineage(PR.triple_pair_features(t, PR.candidate_pairs(t)))
    model = DD.train_dedup_model(feats)
    dropped = DD.dropped_rows(rows, DD.predict_pairs(feats, model), PR.ROW_ID, DD.copies_predicted_duplicate(model), t)
    return rows.join(dropped, PR.ROW_ID, "left").select(ID, F.coalesce("reason", F.lit("kept")).alias("decision"))


@register("pair_model_properties", "SELECT true AS probabilities_in_range, true AS agrees_with_rule_away_from_it, "
          "true AS one_class_predicts_nothing, true AS same_after_repartition")
def q_pair_model_properties(spark, sf):
    """D5-D7 by property: probabilities lie in [0, 1]; the forest and the rule agree on pairs whose mean similarity is
    outside 0.65 to 0.80; a one-class forest predicts no pair; the input's partitioning changes no decision."""
    feats = cut_lineage(PR.pair_features(clean(spark, sf), ID))
    model = DD.train_dedup_model(feats, num_trees=20)
    scored = DD.predict_pairs(feats, model, 0.0)
    r = scored.agg(F.bool_and(F.col("proba").between(0, 1)).alias("p"),
                   F.bool_and(F.col("avg_sim").between(0.65, 0.80) | ((F.col("proba") >= DD.MODEL_THRESHOLD) == (F.col("avg_sim") > DD.RULE_THRESHOLD))).alias("a")).collect()[0]
    one = DD.train_dedup_model(feats.where(F.col("avg_sim") > 0.7), num_trees=3)
    again = DD.predict_pairs(feats.repartition(5), model).select("row_i", "row_j")
    same = DD.predict_pairs(feats, model).select("row_i", "row_j").exceptAll(again).isEmpty()
    return spark.createDataFrame([(bool(r["p"]), bool(r["a"]), DD.predict_pairs(feats, one).isEmpty(), bool(same))],
                                 "probabilities_in_range boolean, agrees_with_rule_away_from_it boolean, "
                                 "one_class_predicts_nothing boolean, same_after_repartition boolean")


@register("anomaly_properties", "SELECT true AS scores_in_range, true AS flagged_share_near_tenth, true AS same_after_repartition")
def q_anomaly_properties(spark, sf):
    """M1-M3 by property: scores in (0, 1], 8 to 12 % flagged, the same trees and scores after a repartition."""
    c = clean(spark, sf)
    model, again = AN.train(c, ID, n_trees=30), AN.train(c.repartition(5), ID, n_trees=30)
    r = AN.score(c, model).agg(F.bool_and((F.col("anomaly_score") > 0) & (F.col("anomaly_score") <= 1)).alias("s"),
                               F.avg(F.col("is_anomaly")).alias("f")).collect()[0]
    same = sorted(map(tuple, model.trees.round(4).values.tolist())) == sorted(map(tuple, again.trees.round(4).values.tolist()))
    return spark.createDataFrame([(bool(r["s"]), bool(abs(r["f"] - 0.1) <= 0.02), bool(same))],
                                 "scores_in_range boolean, flagged_share_near_tenth boolean, same_after_repartition boolean")


@register("anomaly_scores")
def q_anomaly_scores(spark, sf):
    """M1-M3: isolation forest on the cleaned customers' numeric columns; every row scored."""
    c = clean(spark, sf)
    model = AN.train(c, "customer_id")
    return AN.score(c, model).select("customer_id", "amount", "anomaly_score", "is_anomaly")


@register("pipeline_model")
def q_pipeline_model(spark, sf):
    """P2 + P3, model variant: train both models on the cleaned rows, then pairs -> drop later -> score."""
    r = raw(spark, sf)
    prepared = FL.prepare(r)
    trained = FL.train_models(r, num_trees=50, prepared=prepared)
    return FL.run_with(r, trained.dedup_model, trained.anomaly_model, prepared=prepared).final


# ---------------------------------------------------------------- load, verify, preview, group

@register("typed_load", S.with_pairs("").rstrip() + ",\n" + _qb("deduped") + ",\nfin AS (SELECT *" + _FLAG +
          " FROM deduped)\nSELECT TRY_CAST(customer_id AS INTEGER) AS customer_id, name, email, phone, city, country, "
          "signup_date, TRY_CAST(amount AS DECIMAL(10,2)) AS amount, is_anomaly, CAST(NULL AS FLOAT) AS anomaly_score "
          "FROM fin")
def q_typed_load(spark, sf):
    return SK.typed_load(FL.run_rule(raw(spark, sf)).final)


@register("verify_counts", S.with_pairs("").rstrip() + ",\n" + _qb("deduped") + ",\nfin AS (SELECT *" + _FLAG +
          " FROM deduped)\nSELECT 'clean' AS \"table\", CAST(count(*) AS BIGINT) AS rows, CAST(NULL AS BIGINT) AS flagged "
          "FROM clean UNION ALL SELECT 'final', CAST(count(*) AS BIGINT), CAST(sum(is_anomaly) AS BIGINT) FROM fin "
          "UNION ALL SELECT 'anomalies', CAST(count(*) FILTER (WHERE is_anomaly = 1) AS BIGINT), "
          "CAST(sum(is_anomaly) AS BIGINT) FROM fin")
def q_verify_counts(spark, sf):
    r = FL.run_rule(raw(spark, sf))
    return SK.verify_counts({"clean": r.clean, "final": r.final, "anomalies": r.final.where("is_anomaly = 1")})


def _run_files(spark, sf):
    from ..streaming.stream import scratch_path
    source, out = scratch_path(spark, "run-source"), scratch_path(spark, "run-out")
    raw(spark, sf).write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(source)
    return out, FL.run_files(spark, source, out)


@register("run_files_loaded", S.with_pairs("").rstrip() + ",\n" + _qb("deduped") + ",\nfin AS (SELECT *" + _FLAG +
          " FROM deduped)\nSELECT TRY_CAST(customer_id AS INTEGER) AS customer_id, name, email, phone, city, country, "
          "signup_date, TRY_CAST(amount AS DECIMAL(10,2)) AS amount, is_anomaly, CAST(NULL AS FLOAT) AS anomaly_score FROM fin")
def q_run_files_loaded(spark, sf):
    """P3 from CSV files to the typed load, read back from its path."""
    out, _ = _run_files(spark, sf)
    return spark.read.parquet(f"{out}/loaded")


@register("run_files_verified", S.with_pairs("").rstrip() + ",\n" + _qb("deduped") + ",\nfin AS (SELECT *" + _FLAG +
          " FROM deduped)\nSELECT 'clean' AS \"table\", CAST(count(*) AS BIGINT) AS rows, CAST(NULL AS BIGINT) AS flagged FROM clean "
          "UNION ALL SELECT 'final', CAST(count(*) AS BIGINT), CAST(sum(is_anomaly) AS BIGINT) FROM fin "
          "UNION ALL SELECT 'loaded', CAST(count(*) AS BIGINT), CAST(sum(is_anomaly) AS BIGINT) FROM fin")
def q_run_files_verified(spark, sf):
    """The run's report names the paths of its tables, whose rows were counted after writing."""
    _, report = _run_files(spark, sf)
    return spark.read.parquet(report.collect()[0]["verified_path"])


@register("preview_top5", S.with_clean("SELECT * FROM clean ORDER BY customer_id LIMIT 5"))
def q_preview_top5(spark, sf):
    return cleaned(spark, sf).orderBy("customer_id").limit(5)


@register("count_by_country", S.with_clean(
    "SELECT country, CAST(count(*) AS BIGINT) AS count FROM clean GROUP BY country"))
def q_count_by_country(spark, sf):
    return cleaned(spark, sf).groupBy("country").agg(F.count(F.lit(1)).alias("count"))


@register("impute_mean", S.with_clean(
    "SELECT customer_id, ROUND(coalesce(amount, (SELECT avg(amount) FROM clean)), 6) AS amount, "
    "ROUND(coalesce(CASE WHEN customer_id % 9 <> 0 THEN customer_id END, (SELECT avg(CASE WHEN customer_id % 9 <> 0 "
    "THEN customer_id END) FROM clean)), 6) AS number FROM clean"))
def q_impute_mean(spark, sf):
    numbers = cleaned(spark, sf).select("customer_id", "amount", F.when(F.col(ID) % 9 != 0, F.col(ID)).cast("double").alias("number"))
    return rounded(V.impute_mean(numbers, ["amount", "number"]))


@register("binary_metrics", """
WITH m AS (SELECT count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS tp, count(*) FILTER (WHERE toxic = 0 AND quality = 0) AS fp,
                  count(*) FILTER (WHERE toxic = 1 AND quality <> 0) AS fn, count(*) FILTER (WHERE toxic = 0 AND quality <> 0) AS tn
           FROM labels),
p AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall FROM m)
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
       ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall,
       ROUND(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0), 6) AS f1 FROM p""")
def q_binary_metrics(spark, sf):
    lab = table(spark, sf, "labels").withColumn("low_quality", (F.col("quality") == 0).cast("int"))
    return rounded(V.binary_metrics(lab, "toxic", "low_quality"))


@register("anomaly_summary", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS anomalies_found,
       ROUND(avg(abs(value - q2) / nullif(q3 - q1, 0)), 6) AS mean_score
FROM events, q""")
def q_anomaly_summary(spark, sf):
    ev = table(spark, sf, "events")
    qm = P.quantile_map(ev, ["value"], [0.25, 0.5, 0.75])
    q1, q2, q3 = qm[("value", 0.25)], qm[("value", 0.5)], qm[("value", 0.75)]
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    scored = ev.select(((F.col("value") < lo) | (F.col("value") > hi)).alias("is_anomaly"),
                       F.try_divide(F.abs(F.col("value") - F.lit(q2)), F.lit(q3 - q1)).alias("anomaly_score"))
    return rounded(V.anomaly_summary(scored))


# ---------------------------------------------------------------- validation rules and corrections

_RANGE_RULES = [("l_quantity", 1.0, 48.0), ("l_discount", 0.0, 0.09)]


@register("rule_range", S.union_all(
    f"SELECT l_orderkey, l_linenumber, 'range_{c}' AS rule, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value "
    f"FROM lineitem WHERE {c} < {lo} OR {c} > {hi}" for c, lo, hi in _RANGE_RULES))
def q_rule_range(spark, sf):
    li = table(spark, sf, "lineitem")
    return V.violations(li, [V.range_rule(c, lo, hi) for c, lo, hi in _RANGE_RULES], ["l_orderkey", "l_linenumber"])


@register("rule_date_order", """
SELECT l.l_orderkey, l.l_linenumber, CAST(o.o_orderdate AS DATE) AS order_date, CAST(l.l_shipdate AS DATE) AS ship_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate < o.o_orderdate""")
def q_rule_date_order(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date"),
                                            F.col("l_shipdate"))
    od = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = li.join(od, "l_orderkey")
    r = V.order_rule("o_orderdate", "l_shipdate", "ship_before_order")
    return j.where(r.condition).select("l_orderkey", "l_linenumber", F.col("o_orderdate").cast("date").alias("order_date"),
                                       "ship_date")


@register("rule_duplicate_key", "WITH raw AS (" + S.RAW + f") SELECT regexp_replace({_TEXT_ID}, "
          "'(?i)_bis$', '') AS base_key, CAST(count(*) AS BIGINT) AS rows FROM raw GROUP BY 1 HAVING count(*) > 1")
def q_rule_duplicate_key(spark, sf):
    keyed = raw(spark, sf).withColumn(ID, F.expr(_TEXT_ID))
    return V.duplicate_keys(keyed, ID).withColumn("rows", F.col("rows").cast("bigint"))


def _at_emails(df):
    """Derived input for V5: every 11th e-mail written with ``AT`` for ``@``."""
    return df.select("customer_id", F.when(F.col("customer_id") % 11 == 0, F.regexp_replace("email", "@", "AT"))
                     .otherwise(F.col("email")).alias("email"))


@register("repair_email", S.with_clean(
    f"""SELECT customer_id, email AS raw_email, coalesce({S.clean_email('email')},
       CASE WHEN NOT {S.valid_email('email')} AND length({S.strip('email')}) - length(replace({S.strip('email')}, 'AT', '')) = 2
                 AND regexp_matches({S.strip('email')}, '^[^@]+AT[^@]+\\.[^@]+$')
                 AND {S.valid_email(f"replace({S.strip('email')}, 'AT', '@')")}
            THEN lower(replace({S.strip('email')}, 'AT', '@')) END) AS email_repaired
FROM (SELECT customer_id, CASE WHEN customer_id % 11 = 0 THEN replace(email, '@', 'AT') ELSE email END AS email FROM raw)"""))
def q_repair_email(spark, sf):
    e = _at_emails(raw(spark, sf))
    return V.email_repairs(e).select("customer_id", F.col("email").alias("raw_email"), "email_repaired")


_COUNTRY_NAMES = {"tn": "Tunisia", "fr": "France"}


@register("fold_categories", S.with_clean(
    f"SELECT customer_id, country AS raw_country, {S.norm_text('country')} AS country_folded, "
    f"CASE {S.norm_text('country')} WHEN 'tn' THEN 'Tunisia' WHEN 'fr' THEN 'France' END AS country_canonical FROM raw"))
def q_fold_categories(spark, sf):
    r = raw(spark, sf).select("customer_id", F.col("country").alias("raw_country"))
    return V.fold_categories(r, "raw_country", _COUNTRY_NAMES, out="country_folded") \
            .withColumnRenamed("raw_country_canonical", "country_canonical")


def _line_rules():
    return [V.range_rule(c, lo, hi) for c, lo, hi in _RANGE_RULES] + [V.not_null_rule("l_shipdate"),
                                                                    V.range_rule("l_tax", 0.0, 0.08)]


@register("validate_rules", """
SELECT rule, CAST(rows_checked AS BIGINT) AS rows_checked, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM (
  SELECT 'range_l_quantity' AS rule, count(*) AS rows_checked, count(*) FILTER (WHERE l_quantity < 1.0 OR l_quantity > 48.0) AS violations FROM lineitem
  UNION ALL SELECT 'range_l_discount', count(*), count(*) FILTER (WHERE l_discount < 0.0 OR l_discount > 0.09) FROM lineitem
  UNION ALL SELECT 'not_null_l_shipdate', count(*), count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
  UNION ALL SELECT 'range_l_tax', count(*), count(*) FILTER (WHERE l_tax < 0.0 OR l_tax > 0.08) FROM lineitem) t""")
def q_validate_rules(spark, sf):
    return V.rule_summary(table(spark, sf, "lineitem"), _line_rules())


@register("validation_result", """
SELECT CAST(count(*) AS BIGINT) AS rows_checked, CAST(count(*) FILTER (WHERE n > 0) AS BIGINT) AS invalid_rows,
       CAST(sum(n) AS BIGINT) AS violations, count(*) FILTER (WHERE n > 0) = 0 AS is_valid
FROM (SELECT CAST(l_quantity < 1.0 OR l_quantity > 48.0 AS INT) + CAST(l_discount < 0.0 OR l_discount > 0.09 AS INT)
             + CAST(l_shipdate IS NULL AS INT) + CAST(l_tax < 0.0 OR l_tax > 0.08 AS INT) AS n FROM lineitem) t""")
def q_validation_result(spark, sf):
    return V.validation_result(table(spark, sf, "lineitem"), _line_rules())


@register("load_rejects", """
WITH wide AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 100 = 0 THEN c_custkey + 3000000000 ELSE c_custkey END AS customer_id,
                     CASE WHEN c_custkey % 50 = 0 THEN c_acctbal * 100000000 ELSE c_acctbal END AS amount FROM customer)
SELECT key, 'customer_id' AS "column", CAST(customer_id AS VARCHAR) AS value FROM wide WHERE TRY_CAST(customer_id AS INTEGER) IS NULL
UNION ALL SELECT key, 'amount', 'too large' FROM wide WHERE TRY_CAST(amount AS DECIMAL(10,2)) IS NULL""")
def q_load_rejects(spark, sf):
    c = table(spark, sf, "customer")
    wide = c.select(F.col("c_custkey").alias("key"),
                    F.when(F.col("c_custkey") % 100 == 0, F.col("c_custkey") + 3000000000).otherwise(F.col("c_custkey")).alias("customer_id"),
                    F.when(F.col("c_custkey") % 50 == 0, F.col("c_acctbal") * 100000000).otherwise(F.col("c_acctbal")).alias("amount"))
    text = F.when(F.col("column") == "amount", F.lit("too large")).otherwise(F.col("value"))  # engines spell doubles differently
    return SK.load_rejects(wide, "key").select("key", "column", text.alias("value"))

def _stage_sql(stage, src, valid):
    """V9 restated: ``valid`` maps a column to the condition its non-null cells must meet."""
    cols = R.EXPECTED_COLUMNS
    nn = " + ".join(f"count({c})" for c in cols)
    bad = " + ".join(f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT coalesce({v}, false))" for c, v in valid.items()) or "0"
    num = S.number("amount")
    return f"""SELECT '{stage}' AS stage, CAST(n AS BIGINT) AS rows, cells / (8.0 * n) AS completeness,
       CAST(n - d AS BIGINT) AS exact_copies, CAST(bad AS BIGINT) AS invalid_cells, bad / cells AS error_rate, CAST(o AS BIGINT) AS outliers,
       40.0 * cells / (8.0 * n) + 30.0 * (1 - bad / cells) + 20.0 * d / n + 10.0 * (1 - o / n) AS quality
FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST({nn} AS DOUBLE) AS cells, CAST({bad} AS DOUBLE) AS bad,
             (SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS d,
             CAST(count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS o
      FROM (SELECT *, {num} AS x FROM {src}) t,
           (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM (SELECT {num} AS x FROM {src})) q)"""


_VALID_SQL = {"email": S.valid_email("email"), "phone": f"{S.norm_phone('phone')} IS NOT NULL",
              "signup_date": f"{S.parse_date('signup_date')} IS NOT NULL", "amount": f"{S.number('amount')} IS NOT NULL"}


@register("before_after", S.with_clean("").rstrip() + ",\nb AS (" + _stage_sql("before", "raw_nt", _VALID_SQL) + "),\na AS (" +
          _stage_sql("after", "clean", {}) + "),\nu AS (SELECT * FROM b UNION ALL SELECT * FROM a)\n"
          "SELECT stage, rows, ROUND(completeness, 6) AS completeness, exact_copies, invalid_cells, ROUND(error_rate, 6) AS error_rate, "
          "outliers, ROUND(quality, 6) AS quality, ROUND(CASE WHEN stage = 'after' THEN (quality - (SELECT quality FROM b)) * 100.0 "
          "/ (SELECT quality FROM b) END, 6) AS improvement_pct FROM u")
def q_before_after(spark, sf):
    from ..operators import quality as Q
    r = raw(spark, sf)
    valid = {"email": is_valid_email("email"), "phone": normalize_phone("phone").isNotNull(),
             "signup_date": parse_date("signup_date").isNotNull(), "amount": coerce_number("amount").isNotNull()}
    return rounded(Q.before_after(R.apply_null_tokens(r), C.clean_customers(r), valid, None, "amount"))


def _cleaned_exprs():
    return {"name": normalize_text("name"), "email": clean_email("email"), "phone": normalize_phone("phone"),
            "city": normalize_text("city"), "country": normalize_text("country"),
            "signup_date": parse_date("signup_date").cast("string"), "amount": coerce_number("amount")}


@register("correction_log", S.with_clean(
    "SELECT customer_id, \"column\", before, after FROM (" + S.union_all(
        f"SELECT customer_id, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS before, CAST({e} AS VARCHAR) AS after FROM raw_nt"
        for c, e in [("name", S.norm_text("name")), ("email", S.clean_email("email")), ("phone", S.norm_phone("phone")),
                     ("city", S.norm_text("city")), ("country", S.norm_text("country")),
                     ("signup_date", S.parse_date("signup_date")), ("amount", S.number("amount"))]) +
    ") t WHERE before IS DISTINCT FROM after"))
def q_correction_log(spark, sf):
    r = R.apply_null_tokens(raw(spark, sf))
    return V.correction_log(r, _cleaned_exprs(), "customer_id")


@register("correction_counts", S.with_clean(
    "SELECT \"column\", CAST(count(*) AS BIGINT) AS corrections, CAST(count(*) FILTER (WHERE after IS NULL) AS BIGINT) AS nulled FROM (" +
    S.union_all(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS before, CAST({e} AS VARCHAR) AS after FROM raw_nt"
        for c, e in [("name", S.norm_text("name")), ("email", S.clean_email("email")), ("phone", S.norm_phone("phone")),
                     ("city", S.norm_text("city")), ("country", S.norm_text("country")),
                     ("signup_date", S.parse_date("signup_date")), ("amount", S.number("amount"))]) +
    ") t WHERE before IS DISTINCT FROM after GROUP BY 1"))
def q_correction_counts(spark, sf):
    return V.correction_counts(q_correction_log(spark, sf))


@register("dropped_by_reason", S.with_pairs("""
SELECT reason, CAST(count(*) AS BIGINT) AS rows FROM dropped GROUP BY reason
UNION ALL SELECT 'empty', CAST((SELECT count(*) FROM cleaned) - count(*) AS BIGINT) FROM cleaned WHERE NOT (name IS NULL AND
  email IS NULL AND phone IS NULL AND city IS NULL AND country IS NULL AND signup_date IS NULL AND amount IS NULL)
UNION ALL SELECT 'exact copy', CAST(count(*) - (SELECT count(*) FROM clean) AS BIGINT) FROM cleaned WHERE NOT (name IS NULL AND
  email IS NULL AND phone IS NULL AND city IS NULL AND country IS NULL AND signup_date IS NULL AND amount IS NULL)"""))
def q_dropped_by_reason(spark, sf):
    """The rows a run drops, by reason."""
    r = raw(spark, sf)
    counters = C.clean_report(r).select(F.explode(F.array(
        F.struct(F.lit("empty").alias("reason"), F.col("empty_rows_removed").alias("rows")),
        F.struct(F.lit("exact copy").alias("reason"), F.col("exact_duplicates_removed").alias("rows")))).alias("x")).select("x.*")
    _, dropped, _ = DD.dedup_rule(cut_lineage(C.clean_customers(r)), ID)
    return dropped.groupBy("reason").agg(F.count(F.lit(1)).alias("rows")).unionByName(counters)

@register("histogram", """
WITH b AS (SELECT min(l_extendedprice) AS mn, max(l_extendedprice) AS mx FROM lineitem),
x AS (SELECT CASE WHEN l_extendedprice IS NULL THEN 0
                  ELSE least(CAST(floor((l_extendedprice - mn) / (mx - mn) * 10) AS INTEGER) + 1, 10) END AS bin, mn, mx
      FROM lineitem, b)
SELECT bin, ROUND(CASE WHEN bin > 0 THEN mn + (bin - 1) * ((mx - mn) / 10) END, 6) AS lower,
       ROUND(CASE WHEN bin > 0 THEN CASE WHEN bin = 10 THEN mx ELSE mn + bin * ((mx - mn) / 10) END END, 6) AS upper,
       CAST(count(*) AS BIGINT) AS count
FROM x GROUP BY bin, mn, mx""")
def q_histogram(spark, sf):
    return rounded(V.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 10))


@register("clip_outliers", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, ROUND(value, 6) AS value,
       ROUND(least(greatest(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 6) AS value_corrected
FROM events, q""")
def q_clip_outliers(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    return rounded(V.clip_outliers(ev, ["value"]))


@register("enrich_lookup", """
SELECT c.c_custkey, n.n_name, r.r_name FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_enrich_lookup(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    nr = V.lookup_join(n, r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    return V.lookup_join(c, nr, c["c_nationkey"] == nr["n_nationkey"]).select("c_custkey", "n_name", "r_name")


# ---------------------------------------------------------------- streaming (ST-a, ST-d)
from ..streaming import stream as ST  # noqa: E402


@register("stream_clean", S.with_clean(
    "SELECT * FROM cleaned WHERE NOT (name IS NULL AND email IS NULL AND phone IS NULL AND city IS NULL "
    "AND country IS NULL AND signup_date IS NULL AND amount IS NULL)"))
def q_stream_clean(spark, sf):
    """ST-a: the raw rows replayed as a Parquet file stream, cleaned per micro-batch, written to files."""
    r = raw(spark, sf)
    src = ST.stage_as_files(spark, r, "raw-customers")
    out = ST.run_to_files(spark, ST.clean_stream(ST.read_stream(spark, src, r, max_files=2)), "clean-stream")
    return spark.read.parquet(out)


@register("stream_dedup", "SELECT DISTINCT CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value FROM events")
def q_stream_dedup(spark, sf):
    """ST-b: the events streamed twice, deduplicated within the watermark."""
    ev = table(spark, sf, "events").select(F.col("ts").cast("timestamp_ntz").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    src = ST.stage_as_files(spark, ev.unionByName(ev), "events-twice")
    out = ST.run_to_files(spark, ST.dedup_stream(ST.read_stream(spark, src, ev), "ts", "1 day", ev.columns), "dedup-stream")
    return spark.read.parquet(out).select(F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value")


@register("stream_score", "SELECT true AS all_rows_scored, true AS equal_to_batch")
def q_stream_score(spark, sf):
    """ST-c by property: the cleaned rows scored on a stream equal the same rows scored in a batch."""
    c = clean(spark, sf)
    model = AN.train(c, ID, n_trees=20)
    files = max(1, spark.sparkContext.defaultParallelism)  # of each of the two micro-batches: one file would be one task
    src = ST.stage_as_files(spark, c.repartition(2 * files), "to-score")
    out = spark.read.parquet(ST.run_to_files(spark, ST.score_stream(ST.read_stream(spark, src, c, max_files=files), model), "scored-stream"))
    both = AN.score(c, model).select(ID, F.round("anomaly_score", 9).alias("s")).exceptAll(out.select(ID, F.round("anomaly_score", 9).alias("s")))
    return spark.createDataFrame([(out.count() == c.count(), both.isEmpty())], "all_rows_scored boolean, equal_to_batch boolean")


@register("stream_quality_windows", """
SELECT CAST(date_trunc('day', ts) AS DATE) AS window_start, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS missing,
       CAST(count(*) FILTER (WHERE value < 0) AS BIGINT) AS negative, ROUND(sum(value), 6) AS value_sum
FROM events GROUP BY 1
HAVING date_trunc('day', min(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
def q_stream_quality_windows(spark, sf):
    """ST-d: daily tumbling-window counters over the events stream, each written once, when the watermark has passed its
    end (append mode: closed windows leave the state; days the watermark has not passed are still open). The staged files
    are one micro-batch: their order of writing says nothing about ``ts``, and a watermark between them would drop rows."""
    ev = table(spark, sf, "events").select("ts", "value")
    src = ST.stage_as_files(spark, ev, "events")
    agg = ST.quality_counters(ST.read_stream(spark, src, ev), "ts", "value")
    res = spark.read.parquet(ST.run_to_files(spark, agg, "event-windows"))
    return rounded(res.select(F.col("window_start").cast("date").alias("window_start"),
                              F.col("rows").cast("bigint").alias("rows"), F.col("missing").cast("bigint").alias("missing"),
                              F.col("negative").cast("bigint").alias("negative"), "value_sum"))


# ---------------------------------------------------------------- late rows (ST-b, ST-d)

_LATE_BATCHES = 10
# Every 50th event comes two weeks late (beyond the delay of one day), every other 50th half a day (inside it).
_LATE_SQL = f"""
WITH e AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, value, CAST(ts AS TIMESTAMP) + CASE WHEN event_id % 50 = 0 THEN INTERVAL 336 HOUR
                  WHEN event_id % 50 = 1 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS arrival FROM {{events}}),
m AS (SELECT min(arrival) AS a, max(arrival) AS z FROM e),
staged AS (SELECT event_id, ts, value, CAST(least({_LATE_BATCHES - 1}, floor({_LATE_BATCHES}.0 * (epoch(arrival) - epoch(a)) / greatest(1, epoch(z) - epoch(a)))) AS INT) AS batch
           FROM e, m)"""
_LATE_ORACLE = _LATE_SQL.format(events="events") + """,
w AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 1 DAY AS mark FROM staged GROUP BY batch),
f AS (SELECT s.*, coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= w.mark, false) AS late FROM staged s JOIN w USING (batch))"""


def _staged_late(spark, sf):
    """Events in the order in which they arrive, staged as micro-batches; the last one is of what is known by then."""
    ev = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    hours = F.when(F.col("event_id") % 50 == 0, 336).when(F.col("event_id") % 50 == 1, 12).otherwise(0)
    arrived = ev.withColumn("_at", F.col("ts").cast("double") + hours * 3600)
    a, z = arrived.agg(F.min("_at"), F.max("_at")).collect()[0]
    number = F.least(F.lit(_LATE_BATCHES - 1), F.floor(F.lit(float(_LATE_BATCHES)) * (F.col("_at") - a) / max(1.0, z - a))).cast("int")
    staged = cut_lineage(arrived.withColumn("batch", number).drop("_at"))
    return ST.stage_in_order(spark, staged, "batch", _LATE_BATCHES, "late-events"), ev


@register("stream_late_rows", _LATE_ORACLE + """
SELECT CAST(batch AS INT) AS batch, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (late) AS BIGINT) AS late FROM f GROUP BY batch""")
def q_stream_late_rows(spark, sf):
    """ST-b, ST-d: what the watermark drops, by micro-batch, from a side output."""
    path, ev = _staged_late(spark, sf)
    rows = ST.watermark_output(spark, ST.read_batches(spark, path, ev), "ts", "late-rows")
    return spark.read.parquet(rows).groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("late"))


@register("stream_late_windows", _LATE_ORACLE + """
SELECT CAST(date_trunc('day', ts) AS DATE) AS window_start, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS missing,
       CAST(count(*) FILTER (WHERE value < 0) AS BIGINT) AS negative, ROUND(sum(value), 6) AS value_sum
FROM f WHERE NOT late GROUP BY 1 HAVING date_trunc('day', min(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
def q_stream_late_windows(spark, sf):
    """ST-d over the same micro-batches: the windowed counters have exactly the rows that the side output does not call late."""
    path, ev = _staged_late(spark, sf)
    agg = ST.quality_counters(ST.read_batches(spark, path, ev), "ts", "value")
    res = spark.read.parquet(ST.run_to_files(spark, agg, "late-windows"))
    return rounded(res.select(F.col("window_start").cast("date").alias("window_start"), F.col("rows").cast("bigint").alias("rows"),
                              F.col("missing").cast("bigint").alias("missing"), F.col("negative").cast("bigint").alias("negative"), "value_sum"))
