"""Dirty customer records derived by Spark from the ``customer`` and ``nation`` tables.

The driver tables hold no e-mail, phone or date, so cleaning and deduplication run on this derived table. The same
SQL text runs in Spark and in DuckDB (the oracle), so both engines see identical raw rows. FIXTURES.md lists what is
planted. The work grows with ``customer``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import cut_lineage

DIRTY_CUSTOMERS_SQL = """
WITH base AS (
  SELECT c.c_custkey AS k, c.c_acctbal AS bal, n.n_name AS nat,
         split_part('olfa tarek sonia walid rania hatem bilel asma fares imen ghada nizar', ' ', CAST(c.c_custkey % 12 + 1 AS INT)) AS fn,
         translate(substr(md5(CAST(c.c_custkey AS STRING)), 1, 9), '0123456789abcdef', 'bdfgaeioulmnrstk') AS ln,
         translate(substr(md5(CAST(c.c_custkey AS STRING)), 20, 8), '0123456789abcdef', 'aeiounrstlmdkbzh') AS dom,
         lpad(CAST(c.c_custkey % 28 + 1 AS STRING), 2, '0') AS dd,
         lpad(CAST(c.c_custkey % 12 + 1 AS STRING), 2, '0') AS mm,
         CAST(2020 + c.c_custkey % 5 AS STRING) AS yy,
         translate(substr(md5(CAST(c.c_custkey AS STRING)), 10, 8), 'abcdef', '012345') AS ph
  FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
), one AS (
  SELECT k AS customer_id,
    CASE WHEN k % 71 = 0 THEN ' ' WHEN k % 37 = 0 THEN NULL WHEN k % 41 = 0 THEN '   ' WHEN k % 3 = 0 THEN '  ' || upper(fn) || ' ' || ln || ' '
         WHEN k % 5 = 0 THEN ln || ' ' || fn ELSE fn || ' ' || ln END AS name,
    CASE WHEN k % 71 = 0 THEN 'N/A' WHEN k % 43 = 0 THEN NULL WHEN k % 13 = 0 THEN ln || '#' || dom || '.tn'
         WHEN k % 3 = 0 THEN upper(ln) || '@' || dom || '.TN' ELSE ln || '@' || dom || '.tn' END AS email,
    CASE WHEN k % 71 = 0 OR k % 47 = 0 THEN NULL WHEN k % 19 = 0 THEN 'no number'
         WHEN k % 4 = 0 THEN '+216 ' || substr(ph,1,2) || ' ' || substr(ph,3,3) || ' ' || substr(ph,6,3) ELSE '+216-' || ph END AS phone,
    CASE WHEN k % 71 = 0 THEN '' WHEN k % 6 = 0 THEN ' ' || upper(nat) ELSE nat END AS city,
    CASE WHEN k % 71 = 0 THEN 'null' WHEN k % 2 = 0 THEN 'TN' ELSE 'tn ' END AS country,
    CASE WHEN k % 71 = 0 OR k % 53 = 0 THEN 'nan' WHEN k % 4 = 0 THEN yy || '-' || mm || '-' || dd WHEN k % 4 = 1 THEN yy || '/' || mm || '/' || dd
         WHEN k % 4 = 2 THEN dd || '-' || mm || '-' || yy ELSE dd || '/' || mm || '/' || yy END AS signup_date,
    CASE WHEN k % 71 = 0 OR k % 61 = 0 THEN NULL WHEN k % 59 = 0 THEN 'abc' ELSE CAST(bal AS STRING) END AS amount, fn, ln, dom
  FROM base
), parts AS (
  SELECT o.*, substr(o.email, 1, 2) || 'x' || substr(o.email, 4) AS email_typo,
         substr(o.phone, 1, length(o.phone) - 1) || translate(substr(o.phone, length(o.phone), 1), '0123456789', '1234567890') AS phone_typo
  FROM one o
)
SELECT customer_id, name, email, phone, city, country, signup_date, amount FROM one
UNION ALL SELECT customer_id, name, email, phone, city, country, signup_date, amount FROM one WHERE customer_id % 10 = 0
UNION ALL SELECT customer_id + 1000000, upper(ln) || ' ' || fn, email_typo, phone, city, country, signup_date, amount FROM parts WHERE customer_id % 21 = 0
UNION ALL SELECT customer_id + 1000000, fn || ' ' || reverse(ln), email, phone_typo, city, country, signup_date, amount FROM parts WHERE customer_id % 21 = 7
UNION ALL SELECT customer_id + 1000000, name, email_typo, phone_typo, city, country, signup_date, amount FROM parts WHERE customer_id % 21 = 14
UNION ALL SELECT customer_id + 2000000, name, email, phone, 'Elsewhere', country, signup_date, amount FROM parts WHERE customer_id % 30 = 0
UNION ALL SELECT customer_id + 3000000, upper(name), email, replace(replace(phone, ' ', ''), '-', ''), 'Nowhere', country, signup_date, amount FROM parts WHERE customer_id % 30 = 0
UNION ALL SELECT customer_id + 4000000, fn || ' ' || reverse(ln), substr(ln, 1, 4) || 'zz@' || dom || '.tn', phone, city, country, signup_date, amount FROM parts WHERE customer_id % 33 = 1
UNION ALL SELECT customer_id + 5000000, fn || ' ' || reverse(ln), substr(ln, 1, 4) || 'zz@' || dom || '.tn', '+216-' || translate(reverse(right(phone, 3)), ' -', '11') || '55' || substr(CAST(customer_id + 1000 AS STRING), 1, 3), city, country, signup_date, amount FROM parts WHERE customer_id % 33 = 1
UNION ALL SELECT customer_id + 6000000, reverse(ln), reverse(ln) || '@' || reverse(dom) || '.fr', phone, city, country, signup_date, amount FROM parts WHERE customer_id % 39 = 2
"""

# A hard case for blocking: few first names, one e-mail domain, phones that differ in few digits.
NARROW_CUSTOMERS_SQL = """
SELECT c.c_custkey AS customer_id,
       split_part('ali sami ines rim', ' ', CAST(c.c_custkey % 4 + 1 AS INT)) || ' '
         || split_part('ben salah trabelsi', ' ', CAST(c.c_custkey % 3 + 1 AS INT)) AS name,
       lower(split_part('ali sami ines rim', ' ', CAST(c.c_custkey % 4 + 1 AS INT))) || CAST(c.c_custkey % 50 AS STRING)
         || '@mail.tn' AS email,
       '2165' || lpad(CAST(c.c_custkey % 997 AS STRING), 7, '0') AS phone,
       n.n_name AS city, 'tn' AS country,
       '2024-01-' || lpad(CAST(c.c_custkey % 28 + 1 AS STRING), 2, '0') AS signup_date,
       CAST(c.c_acctbal AS STRING) AS amount
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw dirty customer rows: ``customer_id`` bigint, seven string columns.

    Written and read back (``cut_lineage``), every time: it stands in for a file source. Left as a plan, its CTEs would
    be re-analysed for every reference in a pairing plan and its CASE expressions inlined into the cleaning ones."""
    return cut_lineage(spark.sql(DIRTY_CUSTOMERS_SQL, customer=load(spark, sf_dir, "customer"), nation=load(spark, sf_dir, "nation")))


def narrow_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow-vocabulary variant (written like ``dirty_customers``)."""
    return cut_lineage(spark.sql(NARROW_CUSTOMERS_SQL, customer=load(spark, sf_dir, "customer"), nation=load(spark, sf_dir, "nation")))


def oracle_sql_text(template: str) -> str:
    """The same SQL against the oracle's pre-registered views."""
    return template.format(customer="customer", nation="nation")
