"""Independent SQL text (DuckDB dialect) for the oracle side of each query.

Small generators keep the many oracle queries consistent; they restate the operator semantics in SQL and share
nothing with the Spark code path except the fixed value lists.
"""
from __future__ import annotations

from ..functions import dates as D
from ..functions.text import NUMBER_PATTERN, WHITESPACE_CHARS
from ..sources.fixtures import DIRTY_CUSTOMERS_SQL, oracle_sql_text
from ..sources.readers import NULL_TOKENS

WS = "||".join(f"chr({ord(c)})" for c in WHITESPACE_CHARS)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"trim(CAST({e} AS VARCHAR), {WS})"


def norm_text(e: str) -> str:
    return f"nullif(lower({strip(e)}), '')"


def norm_phone(e: str) -> str:
    d = f"regexp_replace({strip(e)}, '[^0-9]', '', 'g')"
    return f"CASE WHEN length({d}) >= 8 THEN {d} END"


def valid_email(e: str) -> str:
    return f"coalesce(regexp_matches(lower({strip(e)}), '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'), false)"


def clean_email(e: str) -> str:
    n = norm_text(e)
    return f"CASE WHEN {valid_email(n)} THEN {n} END"


def number(e: str) -> str:
    s = strip(e)
    return f"CASE WHEN regexp_matches({s}, {q(NUMBER_PATTERN)}) THEN TRY_CAST({s} AS DOUBLE) END"


def null_token(e: str) -> str:
    toks = ", ".join(q(t) for t in NULL_TOKENS)
    return f"CASE WHEN {e} IN ({toks}) THEN NULL ELSE {e} END"


def _ymd(y: str, m: str, d: str) -> str:
    return (f"CAST(try_strptime(lpad({y}, 4, '0') || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0'),"
            f" '%Y-%m-%d') AS DATE)")


def _month(word: str) -> str:
    w = f"lower({word})"
    return (f"CASE WHEN regexp_matches({w}, {q(D.MONTH_NAME)}) THEN "
            f"CAST(CAST((instr({q(D.MONTH_ABBREVIATIONS)}, substr({w}, 1, 3)) - 1) / 3 + 1 AS INTEGER) AS VARCHAR) END")


def parse_date(e: str, order: str = "ymd") -> str:
    s = strip(e)

    def g(p, i):
        return f"regexp_extract({s}, {q(p)}, {i})"

    def yf(p):
        y, a, b = g(p, 1), g(p, 2), g(p, 3)
        return _ymd(y, a, b) if order == "ymd" else f"coalesce({_ymd(y, b, a)}, {_ymd(y, a, b)})"

    def df_(p, short):
        d, m, y = g(p, 1), g(p, 2), g(p, 3)
        if short:
            y = (f"CAST(CASE WHEN CAST({y} AS INTEGER) <= {D.TWO_DIGIT_YEAR_PIVOT} THEN CAST({y} AS INTEGER) + 2000 "
                 f"ELSE CAST({y} AS INTEGER) + 1900 END AS VARCHAR)")
        return f"coalesce({_ymd(y, m, d)}, {_ymd(y, d, m)})"

    return (
        f"CASE WHEN regexp_matches({s}, {q(D.YEAR_FIRST)}) THEN {yf(D.YEAR_FIRST)} "
        f"WHEN regexp_matches({s}, {q(D.YEAR_FIRST_COMPACT)}) THEN {yf(D.YEAR_FIRST_COMPACT)} "
        f"WHEN regexp_matches({s}, {q(D.DAY_FIRST)}) THEN {df_(D.DAY_FIRST, False)} "
        f"WHEN regexp_matches({s}, {q(D.DAY_FIRST_SHORT_YEAR)}) THEN {df_(D.DAY_FIRST_SHORT_YEAR, True)} "
        f"WHEN regexp_matches({s}, {q(D.DAY_MONTH_NAME)}) THEN "
        f"{_ymd(g(D.DAY_MONTH_NAME, 3), _month(g(D.DAY_MONTH_NAME, 2)), g(D.DAY_MONTH_NAME, 1))} "
        f"WHEN regexp_matches({s}, {q(D.MONTH_NAME_DAY)}) THEN "
        f"{_ymd(g(D.MONTH_NAME_DAY, 3), _month(g(D.MONTH_NAME_DAY, 1)), g(D.MONTH_NAME_DAY, 2))} END"
    )


RAW = oracle_sql_text(DIRTY_CUSTOMERS_SQL).strip()

# raw_nt: raw rows with missing tokens as null; cleaned: every column cleaned; clean: non-empty distinct rows.
CLEAN_CTES = f"""
raw AS ({RAW}),
raw_nt AS (
  SELECT customer_id, {null_token('name')} AS name, {null_token('email')} AS email, {null_token('phone')} AS phone,
         {null_token('city')} AS city, {null_token('country')} AS country, {null_token('signup_date')} AS signup_date,
         {null_token('amount')} AS amount FROM raw),
cleaned AS (
  SELECT CAST(customer_id AS BIGINT) AS customer_id, {norm_text('name')} AS name, {clean_email('email')} AS email,
         {norm_phone('phone')} AS phone, {norm_text('city')} AS city, {norm_text('country')} AS country,
         {parse_date('signup_date')} AS signup_date, {number('amount')} AS amount FROM raw_nt),
clean AS (
  SELECT DISTINCT * FROM cleaned
  WHERE NOT (name IS NULL AND email IS NULL AND phone IS NULL AND city IS NULL AND country IS NULL
             AND signup_date IS NULL AND amount IS NULL))
"""


def with_clean(body: str) -> str:
    return f"WITH {CLEAN_CTES.strip()}\n{body}"


def r6(e: str) -> str:
    return f"ROUND(CAST({e} AS DOUBLE), 6)"


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def numeric_profile_sql(tbl: str, cols) -> str:
    return union_all(
        f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, {r6(f'avg({c})')} AS mean, "
        f"{r6(f'quantile_cont({c}, 0.5)')} AS median, {r6(f'stddev_samp({c})')} AS std, "
        f"{r6(f'min({c})')} AS min, {r6(f'max({c})')} AS max, {r6(f'quantile_cont({c}, 0.25)')} AS q25, "
        f"{r6(f'quantile_cont({c}, 0.75)')} AS q75 FROM {tbl}" for c in cols)


def iqr_bounds_cte(tbl: str, cols) -> str:
    return union_all(
        f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {tbl}"
        for c in cols)


def iqr_outliers_sql(tbl: str, cols) -> str:
    per = union_all(
        f"SELECT '{c}' AS \"column\", count({c}) AS nn, count(*) FILTER (WHERE {c} < b.q1 - 1.5 * (b.q3 - b.q1) "
        f"OR {c} > b.q3 + 1.5 * (b.q3 - b.q1)) AS oc FROM {tbl}, (SELECT * FROM bounds WHERE \"column\" = '{c}') b"
        for c in cols)
    return (f"WITH bounds AS ({iqr_bounds_cte(tbl, cols)}), per AS ({per})\n"
            f"SELECT p.\"column\", {r6('b.q1')} AS q25, {r6('b.q3')} AS q75, {r6('b.q1 - 1.5 * (b.q3 - b.q1)')} AS lower_bound, "
            f"{r6('b.q3 + 1.5 * (b.q3 - b.q1)')} AS upper_bound, CAST(p.oc AS BIGINT) AS outliers_count, "
            f"ROUND(100.0 * p.oc / p.nn, 2) AS outliers_percentage FROM per p JOIN bounds b USING (\"column\")")


def jb_sql(tbl: str, cols) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS n, "
            f"avg(power({c} - (SELECT avg({c}) FROM {tbl}), 2)) AS m2, "
            f"avg(power({c} - (SELECT avg({c}) FROM {tbl}), 3)) AS m3, "
            f"avg(power({c} - (SELECT avg({c}) FROM {tbl}), 4)) AS m4 FROM {tbl}")
    return (f"WITH m AS ({union_all(parts)}), s AS (SELECT \"column\", n, CASE WHEN n > 3 AND m2 > 0 THEN m3 / pow(m2, 1.5) END AS sk, "
            f"CASE WHEN n > 3 AND m2 > 0 THEN m4 / (m2 * m2) - 3 END AS ku FROM m), "
            f"j AS (SELECT \"column\", n, sk, ku, n / 6.0 * (sk * sk + ku * ku / 4.0) AS jb FROM s)\n"
            f"SELECT \"column\", CAST(n AS BIGINT) AS n, {r6('sk')} AS skewness, {r6('ku')} AS kurtosis, {r6('jb')} AS jb, "
            f"{r6('exp(-jb / 2.0)')} AS p_value, exp(-jb / 2.0) > 0.05 AS is_normal FROM j")


def corr_sql(tbl: str, cols, threshold=None) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            f = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            r = (f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) {f} * stddev_pop({b}) {f}, 0)")
            parts.append(f"SELECT '{a}' AS col1, '{b}' AS col2, {r} AS corr FROM {tbl}")
    body = f"SELECT col1, col2, {r6('corr')} AS corr FROM ({union_all(parts)}) t"
    if threshold is not None:
        body += f" WHERE abs(corr) > {threshold}"
    return body


def lcs(a: str, b: str) -> str:
    """LCS length by the textbook dynamic programme, one row per character of ``a`` (nested list_reduce)."""
    return (f"list_reduce(string_split({a}, ''), lambda prev, ca: list_reduce(range(1, length({b}) + 1), "
            f"lambda cur, j: list_append(cur, CASE WHEN ca = substr({b}, j::INTEGER, 1) THEN prev[j] + 1 "
            f"ELSE greatest(prev[j + 1], cur[j]) END), [0]), list_transform(range(length({b}) + 1), lambda k: 0))[-1]")


def indel(a: str, b: str) -> str:
    return (f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN 0.0 WHEN {a} = {b} THEN 1.0 "
            f"WHEN length({a}) + length({b}) = 0 THEN 1.0 "
            f"ELSE 2.0 * {lcs(a, b)} / (length({a}) + length({b})) END")


def tokens_sql(e: str) -> str:
    return f"list_filter(list_distinct(string_split_regex({e}, '\\s+')), lambda t: t <> '')"


PAIR_CTES = """
elig AS (SELECT * FROM PAIR_TABLE WHERE name IS NOT NULL AND email IS NOT NULL AND phone IS NOT NULL),
fst AS (SELECT *, min(PAIR_KEY) OVER (PARTITION BY name, email, phone) AS first_row FROM elig),
keys AS (
  SELECT PAIR_KEY AS id, 'email' AS kind, email AS key FROM elig
  UNION ALL SELECT PAIR_KEY, 'phone8', substr(phone, length(phone) - 7, 8) FROM elig
  UNION ALL SELECT PAIR_KEY, 'name_sorted', array_to_string(list_sort(TOKENS_NAME), ' ') FROM elig),
cand AS (SELECT DISTINCT a.id AS row_i, b.id AS row_j FROM keys a JOIN keys b ON a.kind = b.kind AND a.key = b.key
         WHERE a.id < b.id AND a.key IS NOT NULL AND a.key <> ''),
pv AS (SELECT c.row_i, c.row_j, a.first_row AS first_i, b.first_row AS first_j, a.name AS name_i, a.email AS email_i,
              a.phone AS phone_i, b.name AS name_j, b.email AS email_j, b.phone AS phone_j
       FROM cand c JOIN fst a ON a.PAIR_KEY = c.row_i JOIN fst b ON b.PAIR_KEY = c.row_j),
tk AS (SELECT *, TOKENS_I AS ta, TOKENS_J AS tb FROM pv),
ts AS (SELECT *, array_to_string(list_sort(list_intersect(ta, tb)), ' ') AS si,
              array_to_string(list_sort(list_filter(ta, lambda x: NOT list_contains(tb, x))), ' ') AS da,
              array_to_string(list_sort(list_filter(tb, lambda x: NOT list_contains(ta, x))), ' ') AS db FROM tk),
tl AS (SELECT *, length(si) AS li, length(da) AS lda, length(db) AS ldb,
              CASE WHEN length(si) > 0 THEN 1 ELSE 0 END AS sep,
              CASE WHEN da = db THEN length(da) ELSE LCS_DA_DB END AS lcs_d FROM ts),
sims AS (SELECT row_i, row_j, first_i, first_j, email_i, email_j, phone_i, phone_j,
   CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0
        WHEN li > 0 AND (lda = 0 OR ldb = 0) THEN 1.0
        WHEN li = 0 THEN CASE WHEN 2 * li + 2 * sep + lda + ldb = 0 THEN 1.0
                              ELSE 1.0 - (lda + ldb - 2 * lcs_d) / (2 * li + 2 * sep + lda + ldb) END
        ELSE greatest(1.0 - (lda + ldb - 2 * lcs_d) / (2 * li + 2 * sep + lda + ldb),
                      1.0 - (sep + lda) / (li + li + sep + lda), 1.0 - (sep + ldb) / (li + li + sep + ldb)) END
     AS name_sim,
   INDEL_EMAIL AS email_sim, INDEL_PHONE AS phone_sim FROM tl),
feat AS (SELECT row_i, row_j, first_i, first_j, name_sim, email_sim, phone_sim,
                (name_sim + email_sim + phone_sim) / 3.0 AS avg_sim FROM sims),
listed AS (SELECT * FROM feat WHERE row_i = first_i AND (row_j = first_j OR first_i = first_j)),
dup AS (SELECT * FROM feat WHERE avg_sim > 0.7),
dropped AS (SELECT row_j AS PAIR_KEY, CASE WHEN bool_or(first_i = first_j) THEN 'copy' ELSE 'fuzzy' END AS reason
            FROM dup GROUP BY row_j),
deduped AS (SELECT * FROM PAIR_TABLE WHERE PAIR_KEY NOT IN (SELECT PAIR_KEY FROM dropped))
"""
PAIR_CTES = (PAIR_CTES.replace("TOKENS_NAME", tokens_sql("name")).replace("TOKENS_I", tokens_sql("name_i"))
             .replace("TOKENS_J", tokens_sql("name_j")).replace("LCS_DA_DB", lcs("da", "db"))
             .replace("INDEL_EMAIL", indel("email_i", "email_j")).replace("INDEL_PHONE", indel("phone_i", "phone_j")))


def pair_ctes(table: str = "clean", key: str = "customer_id") -> str:
    """J2 and J3 over single rows of ``table``: every pair of rows that shares a block key is compared (rows with equal
    values too), and a row goes when an earlier row is its duplicate. ``listed`` are the pairs a report shows: between
    the first rows of equal values, and from a first row to its copies."""
    return PAIR_CTES.replace("PAIR_TABLE", table).replace("PAIR_KEY", key).strip()


def with_pairs(body: str) -> str:
    return f"WITH {CLEAN_CTES.strip()},\n{pair_ctes()}\n{body}"


def chars_sql(e: str) -> str:
    """The characters of a string with their occurrence; equal multisets give equal sets."""
    return (f"list_transform(string_split({e}, ''), lambda ch, i: ch || len(list_filter(string_split({e}, '')[1:i], lambda y: y = ch))::VARCHAR)")


def all_pairs_sql(source: str, prelude: str) -> str:
    """The rule on all pairs of the distinct triples of ``source``, with no block keys: what the characters that two values share
    rule out (an upper bound of each similarity) is left out first, and each pair of values is compared once."""
    bound = lambda f: f"2.0 * len(list_intersect(a.{f}_c, b.{f}_c)) / (len(a.{f}_c) + len(b.{f}_c))"
    name = (PAIR_CTES[PAIR_CTES.index("tk AS"):PAIR_CTES.index("feat AS")].rstrip().rstrip(",").replace("FROM pv", "FROM nv")
            .replace("row_i, row_j, first_i, first_j, email_i, email_j, phone_i, phone_j,", "name_i, name_j,"))
    name = name[:name.rindex("AS name_sim")] + "AS name_sim FROM tl)"
    return f"""WITH {prelude},
tr AS (SELECT min(customer_id) AS tid, name, email, phone FROM {source}
       WHERE name IS NOT NULL AND email IS NOT NULL AND phone IS NOT NULL GROUP BY name, email, phone),
tc AS (SELECT *, {tokens_sql("name")} AS tok, {chars_sql("array_to_string(list_sort(" + tokens_sql("name") + "), ' ')")} AS name_c, {chars_sql("email")} AS email_c, {chars_sql("phone")} AS phone_c FROM tr),
ub AS (SELECT a.tid AS row_i, b.tid AS row_j, a.name AS name_i, b.name AS name_j, a.email AS email_i, b.email AS email_j, a.phone AS phone_i, b.phone AS phone_j
       FROM tc a JOIN tc b ON a.tid < b.tid
       WHERE CASE WHEN list_has_any(a.tok, b.tok) THEN 1.0 ELSE {bound("name")} + 1e-9 END + {bound("email")} + {bound("phone")} > 2.1 - 1e-9),
nv AS (SELECT DISTINCT name_i, name_j FROM ub),
{name},
es AS (SELECT email_i, email_j, {indel("email_i", "email_j")} AS email_sim FROM (SELECT DISTINCT email_i, email_j FROM ub)),
ps AS (SELECT phone_i, phone_j, {indel("phone_i", "phone_j")} AS phone_sim FROM (SELECT DISTINCT phone_i, phone_j FROM ub))
SELECT row_i, row_j, ROUND(name_sim, 6) AS name_sim, ROUND(email_sim, 6) AS email_sim, ROUND(phone_sim, 6) AS phone_sim
FROM ub JOIN sims USING (name_i, name_j) JOIN es USING (email_i, email_j) JOIN ps USING (phone_i, phone_j)
WHERE (name_sim + email_sim + phone_sim) / 3.0 > 0.7"""
