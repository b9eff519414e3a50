"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .base import table
from .decontaminate import contamination
from .exact_dedup import exact_groups
from .jaccard_join import similar_components
from .language_id import identify
from .line_dedup import line_dedup
from .main_text import extract_pages
from .near_dedup import near_classes
from .prefix_trie import prefix_trie
from .sharding import shard_documents
from .spelling import variants
from .token_counts import token_counts
from .url_filter import filter_urls


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.round_trip(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                        F.sha2("bytes", 256).alias("decoded_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("node")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_byte_bpe, op3_url_filter, op4_near_dedup, op5_sharding, op6_language_id, op7_line_dedup,
                                  op8_decontamination, op9_html_extraction, op10_token_counts, op11_prefix_trie, op12_spelling, op13_jaccard_join)}

#: CRC-32 in SQL: the table of the reflected polynomial, and a fold over the UTF-8 bytes of characters up to U+00FF.
CRC_TABLE = """crc AS (SELECT list(list_reduce(range(8), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS t
        FROM range(256) r(i))"""


def crc_sql(text: str) -> str:
    utf8 = (f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)] "
            "ELSE [192 + unicode(ch) // 64, 128 + unicode(ch) % 64] END))")
    return (f"xor(4294967295, list_reduce({utf8}, lambda c, b: xor(c // 256, crc.t[(xor(c % 256, b::BIGINT) + 1)::BIGINT]), 4294967295::BIGINT))")


ORACLE = {
    "op1_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d""",
    "op7_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
l AS (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS pos FROM d),
k AS (SELECT doc_id, line, pos,
             translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT k.doc_id, count(*) AS n_lines, count(g.key) FILTER (k.doc_id <> g.last_doc) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos)
                       FILTER (g.key IS NULL OR k.doc_id = g.last_doc), '')) AS kept_sha256
FROM k LEFT JOIN g ON k.key = g.key GROUP BY k.doc_id""",
    "op8_decontamination": r"""
WITH dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bm AS (SELECT item_id, w, least(len(w), 10) AS m FROM bw WHERE len(w) > 0),
bi AS (SELECT item_id, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM bm),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM bi),
di AS (SELECT doc_id, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM dw, (SELECT DISTINCT m FROM bm) WHERE len(w) >= m),
occ AS (SELECT doc_id, m, i, item_id FROM (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g FROM di)
        JOIN win USING (m, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM occ) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op11_prefix_trie": f"""
WITH {CRC_TABLE},
t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
             turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS x
      FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'x': x, 'w': len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))}} ORDER BY turn NULLS FIRST, x) AS a FROM t GROUP BY c),
h AS (SELECT c, a, {crc_sql("c::VARCHAR")} % 4 AS h FROM own, crc),
r AS (SELECT h.c, list_concat(coalesce(b.a, [])[1:h.h], h.a[h.h + 1:]) AS r FROM h LEFT JOIN own b ON b.c = h.c - h.c % 20),
p AS (SELECT c, d, array_to_string(list_transform(r[1:d], lambda s: s.x || '/'), '') AS p, CASE WHEN d > 0 THEN r[d].w ELSE 0 END AS w, d = len(r) AS over
      FROM (SELECT c, r, unnest(range(0, len(r) + 1)) AS d FROM r)),
n AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS saved,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (over), '')) AS ends_sha256 FROM p GROUP BY p, d),
k AS (SELECT substr(p, 1, (d - 1) * 65) AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
s AS (SELECT substr(p, 1, e * 65) AS p, sum(saved) AS saved, sum(leaf) AS leaves
      FROM (SELECT n.p, d, saved, (k.p IS NULL)::INT AS leaf, unnest(range(0, d + 1)) AS e FROM n LEFT JOIN k USING (p)) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n LEFT JOIN k USING (p) LEFT JOIN s USING (p) LEFT JOIN n up ON n.d > 0 AND up.p = substr(n.p, 1, (n.d - 1) * 65)""",
    "op12_spelling": rf"""
WITH RECURSIVE {CRC_TABLE},
o AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
      FROM documents),
x AS (SELECT run, {crc_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM (SELECT * FROM o WHERE length(run) >= 7), crc),
z AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM x),
w AS (SELECT word, count(*) AS n, translate(word, (SELECT string_agg(chr(i::INT), '' ORDER BY i) FROM range(192, 256) r(i)),
             '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&()*+,-./:;<=>?@[]^_{{|}}~') AS flat
      FROM z WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS (SELECT word, n, flat, substr(flat, 1, i - 1) || substr(flat, i + 1) AS key FROM (SELECT *, unnest(range(1, length(flat) + 2)) AS i FROM w)),
near AS (SELECT DISTINCT a.word AS a, b.word AS b, b.n FROM cut a JOIN cut b ON a.key = b.key WHERE a.word <> b.word AND levenshtein(a.flat, b.flat) = 1),
best AS (SELECT a, count(*) AS n_near, max(n) AS m, min(b) FILTER (n = top) AS b
         FROM (SELECT *, max(n) OVER (PARTITION BY a) AS top FROM near) GROUP BY a),
f AS (SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN b END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n
      FROM w LEFT JOIN best ON best.a = w.word),
r AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.next)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN r ON r.word = f.word AND r.next IS NULL""",
    "op13_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
s AS (SELECT doc_id, g, n FROM g JOIN n USING (doc_id)),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT DISTINCT a AS doc_id, a AS x FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.m, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(x) AS m FROM r GROUP BY doc_id) m USING (doc_id)""",
}
