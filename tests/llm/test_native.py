"""Exact dedup, sharding and line dedup: against brute force, DuckDB's SQL, and on odd inputs."""
import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cleanspark.llm import exact_dedup as ED
from cleanspark.llm import line_dedup as LD
from cleanspark.llm import sharding as SH

from . import brute

SCHEMA = "doc_id long, text string"
LONG = "word " * 50_000
ODD = [(1, "a  b"), (2, "a\t\nb"), (3, None), (4, ""), (5, "a b"), (6, LONG), (7, LONG), (8, "Ünïcode\x0b\x0cx"),
       (9, "Ünïcode x"), (5, "a b"), (None, "a b"), (None, None), (10, "a\xa0b")]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def groups(rows):
    by = defaultdict(list)
    for d, t in rows:
        by[norm(t)].append(d)
    return by


def test_exact_groups_odd_rows(spark):
    by = groups(ODD)
    got = ED.exact_groups(spark.createDataFrame(ODD, SCHEMA)).collect()
    assert len(got) == len(ODD)
    expected = []
    for d, t in ODD:
        ids = [x for x in by[norm(t)] if x is not None]
        first = min(ids) if ids else None
        expected.append((d, first, len(by[norm(t)]), d == first, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_exact_groups_compare_content_beside_the_digest(spark):
    """A digest of one character: contents under one digest stay apart."""
    rows = [(i, f"text {i % 7}") for i in range(60)]
    got = ED.exact_groups(spark.createDataFrame(rows, SCHEMA).repartition(5), digest=lambda t: F.lit("x")).collect()
    assert {(r.doc_id, r.keep_id) for r in got} == {(i, i % 7) for i in range(60)}


def test_exact_groups_hot_text_and_filter(spark):
    rows = [(i, "hot  text" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8).withColumn("keep_id", F.lit("mine")).withColumn("a.b", F.lit(1))
    kept = ED.exact_dedup(df)
    assert kept.columns == ["doc_id", "text", "keep_id", "a.b"]
    assert {r.doc_id for r in kept.collect()} == {0} | {i for i in range(3000) if i % 3}


def test_exact_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ED.exact_groups(empty).count() == 0 and ED.exact_dedup(empty).count() == 0


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 57, 1000])
def test_jump_hash_matches_the_published_loop(spark, shards):
    keys = [0, 1, 42, 256, -1, -5, 2 ** 63 - 1, -2 ** 63, 0xDEAD10CC, *range(10_000, 10_100)]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", SH.jump_hash(F.col("k"), shards).alias("s")).collect()
    assert {r.k: r.s for r in got} == {k: brute.jump(k, shards) for k in keys}


def test_published_vectors():
    assert (brute.jump(1, 1), brute.jump(42, 57), brute.jump(0xDEAD10CC, 666), brute.jump(256, 1024)) == (0, 43, 361, 520)


def test_shards_of_documents(spark):
    rows = [(i, None if i % 11 == 0 else "é" * (i % 5)) for i in range(2000)] + [(7, "again"), (None, "no id"), (3, LONG)]
    got = SH.shard_documents(spark.createDataFrame(rows, SCHEMA).repartition(6).withColumn("shard", F.lit("x"))).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        assert r.shard == brute.jump(r.doc_id or 0, 8) and r.grown_shard in (r.shard, 8)
        assert r.grown_shard == brute.jump(r.doc_id or 0, 9) and r.law == "key"
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = sorted((d or 0, len((t or "").encode()) + 1, brute.crc(t)) for d, t in rows)
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got) == sizes
    assert SH.shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_write_shards(spark, tmp_path):
    df = SH.shard_documents(spark.createDataFrame([(i, str(i)) for i in range(100)], SCHEMA), shards=3)
    SH.write_shards(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2}


def line_brute(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(brute.LOW)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders[key(x)]) >= min_docs and d != max(
            holders[key(x)], key=lambda v: (v is not None, v or 0)))]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines(spark):
    a, b = "A common line of text here", "  a COMMON line of text here \t"
    rows = [(1, f"{a}\nown line one\n{b}"), (2, f"x\n{b}\n{b}\ny"), (3, f"{a}"), (4, None), (5, ""), (6, "short\nshort"),
            (7, "short"), (8, "short"), (9, f"\n{a}\n\n"), (10, "ä" * 20 + "\nz"), (11, "ä" * 20), (12, "q\n" + "ä" * 20),
            (13, "ä" * 19), (14, "ä" * 19), (15, "ä" * 19), (16, (a + "\n") * 5000 + "tail"), (17, "twice in two documents\n" * 2),
            (18, "twice in two documents"), (None, a + "\nnull id")]
    got = LD.line_dedup(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, line_brute(rows)))


def test_lines_repeated_ids_hot_line_and_empty(spark):
    hot = "the licence line that every third document holds"
    rows = [(i, (hot + "\n" if i % 3 == 0 else "") + f"own line number {i}") for i in range(1500)] + [(1499, "x"), (0, hot), (0, hot)]
    got = LD.line_dedup(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, line_brute(rows)))
    assert LD.line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bitmaps_are_runs(spark):
    a = "a line that is long enough to count"
    rows = [(1, f"{a}\n{a}\nx\n{a}"), (2, a), (3, a)]
    got = LD.drop_bitmaps(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: [tuple(x) for x in r.drop_runs] for r in got} == {1: [(0, 1), (3, 3)], 2: [(0, 0)]}


@pytest.mark.parametrize("op", ["exact", "shard", "line"])
def test_native_plans_hold_no_python(spark, op):
    df = spark.createDataFrame([(1, "a")], SCHEMA).repartition(2)
    out = {"exact": ED.exact_groups, "shard": SH.shard_documents, "line": LD.line_dedup}[op](df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
