"""The prefix trie against a plain dictionary of prefixes."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from cleanspark.llm.prefix_trie import prefix_trie
from cleanspark.llm.queries import ORACLE, QUERIES

from ..conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """conv_id, depth, parent, members, children, leaves, saved, ends of every prefix of the rebuilt conversations."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()), (role, text)))
    own = {k: [x for _, x in sorted(v)] for k, v in own.items()}
    nodes = defaultdict(list)
    full = {}
    for k, turns in own.items():
        h = zlib.crc32(str(k).encode()) % 4
        full[k] = tuple(own.get(k - int(abs(k) % 20 * (1 if k > 0 else -1)), [])[:h] + turns[h:])
        for d in range(len(full[k]) + 1):
            nodes[full[k][:d]].append(k)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        mine = (len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[x] for x in kids[p]) or 1
        saved[p] = mine + sum(saved[x] for x in kids[p])
    ends = {p: ",".join(str(k) for k in sorted(m) if full[k] == p) for p, m in nodes.items()}
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in nodes.items())


def got(df, **options):
    return sorted((tuple(r) for r in prefix_trie(df, **options).drop("node").collect()), key=lambda r: (r[0], r[1], str(r)))


def same(rows, frame, **options):
    assert got(frame, **options) == sorted(brute(rows), key=lambda r: (r[0], r[1], str(r)))


def random_rows(seed, convs, longest, words=3):
    rng = random.Random(seed)
    rows = []
    for k in range(convs):
        conv = rng.choice([k, k, k * 7 - 50])
        n = rng.choice([0, 1, 2, 3, 5, 8, 9, longest])
        rows += [(conv, i if rng.random() > 0.05 else None, rng.choice(["user", "bot", None, ""]),
                  " ".join(rng.choice(["a", "b"]) for _ in range(rng.randrange(words))) if rng.random() > 0.1 else None) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, longest, options", [(1, 12, {}), (2, 40, {"columns": 3, "children": 2, "slice_ids": 7}), (3, 20, {"columns": 1, "slice_ids": 1})])
def test_random_conversations(spark, seed, longest, options):
    """Nulls, ties, repeated rows, negative ids, shared and long conversations over several blocks."""
    rows = random_rows(seed, 120, longest)
    rows += rows[:10] + [(None, 1, "user", "no id")] + [(900 + i, t, "user", f"turn {t}") for i in range(30) for t in range(longest)]
    same(rows, spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("depth", F.lit("clash")).withColumn("t1", F.lit(1)), **options)


def test_hot_nodes(spark):
    """One conversation repeated under many ids, and many first turns below the root: both in pieces, none lost."""
    rows = [(i, t, "user", f"same words {t}") for i in range(400) for t in range(3)] + [(1000 + i, 0, "user", f"first {i}") for i in range(300)]
    same(rows, spark.createDataFrame(rows, SCHEMA).repartition(8), children=20, slice_ids=16)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty).count() == 0
    one = [(5, None, None, None)]
    same(one, spark.createDataFrame(one, SCHEMA))
    long = [(1, i, "user", "w " * 30_000 if i == 2 else "x") for i in range(70)]
    same(long, spark.createDataFrame(long, SCHEMA))
    texts = spark.createDataFrame([("7", 0, "a", "b"), ("x", 0, "a", "b"), (None, 0, "a", "b")], "conv_id string, turn long, role string, text string")
    same([(7, 0, "a", "b")], texts)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF001}/conversations.parquet')")
    res = con.execute(ORACLE["op11_prefix_trie"])
    names = [d[0] for d in res.description]
    out = QUERIES["op11_prefix_trie"](spark, SF001)
    assert set(out.columns) == set(names)
    assert sorted(map(str, res.fetchall())) == sorted(str(tuple(r)) for r in out.select(*names).collect())
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
