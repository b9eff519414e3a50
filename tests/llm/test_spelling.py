"""Spelling variants against all pairs of words, and the bound of the gram index against every edit."""
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from cleanspark.llm import spelling as SP
from cleanspark.llm.queries import ORACLE, QUERIES

from ..conftest import SF001
from .brute import LOW

SCHEMA = "doc_id long, text string"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            count[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in count.items() if len(w) >= 7 and k >= 2}
    beside = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], len(beside[w]), n[form[w]] if form[w] else None) for w in n)


def got(df, **options):
    return sorted(tuple(r) for r in SP.variants(df, **options).collect())


def random_texts(seed, docs, letters="abé"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(7, 12))) for _ in range(40)]

    def word():
        w = base[min(int(rng.expovariate(0.2)), 39)]
        if rng.random() < 0.2:
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:]])
        return w.upper() if rng.random() < 0.05 and w.isascii() else w

    return [(i, rng.choice([" ", "-", "1"]).join(word() for _ in range(rng.randrange(60)))) for i in range(docs)]


@pytest.mark.parametrize("seed, letters, options", [(1, "abé", {"frequent": 3}), (2, "abcdefgh", {"frequent": 0, "part_words": 2}),
                                                    (3, "ab", {"part_words": 3}), (4, "aàÿz", {"frequent": 10 ** 9})])
def test_random_words(spark, seed, letters, options):
    rows = random_texts(seed, 60, letters)
    rows += rows[:5] + [(None, rows[0][1]), (7, None), (8, ""), (9, "aaaaaaa aaaaaaa baaaaaa baaaaaa"), (10, "ABCDEFG×÷Àabcdefg 1abcdefg")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    assert got(df, **options) == brute(rows)


def test_chains_and_odd_tables(spark):
    """Forms lead from form to form; a very long text, an empty table, a text without words."""
    words = {"abcdefgh": 20_000, "abcdefgi": 2_000, "abcdefji": 200, "abckefji": 20, "xbckefji": 2, "zzzzzzz": 3}
    rows = [(i, " ".join(w for w, k in words.items() for _ in range(k // 2))) for i in range(2)]
    out = got(spark.createDataFrame(rows, SCHEMA))
    assert out == brute(rows)
    assert any(form and root != form for _, form, root, *_ in out)
    assert got(spark.createDataFrame([], SCHEMA)) == [] == got(spark.createDataFrame([(1, None), (2, "a b 1 _")], SCHEMA))


def test_no_edit_takes_more_than_the_bound(spark):
    """Of every word over two letters and each of its edits: what the word's decomposition loses, and its bound."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(7, 11))) for _ in range(40)})
    edits = {w: {w[:i] + x + w[i + d:] for i in range(len(w) + 1) for d in (0, 1) for x in ("", "a", "b", "c")} - {w} for w in words}
    every = sorted({*words, *itertools.chain.from_iterable(edits.values())})
    df = spark.createDataFrame([(w,) for w in every], "word string")
    for frequent in (0, 60, 10 ** 9):
        rows = SP._bounded(SP._decomposed(df, SP.gram_dictionary(df, frequent))).collect()
        grams = {r.word: Counter(g.gram for g in r.grams) for r in rows}
        bound = {r.word: r.bound for r in rows}
        for w in words:
            assert bound[w] < sum(grams[w].values())
            assert all(sum((grams[w] - grams[x]).values()) <= bound[w] for x in edits[w]), (frequent, w)


def test_each_edit_leaves_a_common_list(spark):
    """A word and each of its edits share a list of their lengths; no word is in the lists of grams that no edit needs."""
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(7, 11))) for _ in range(25)})
    edits = {w: {w[:i] + x + w[i + d:] for i in range(len(w) + 1) for d in (0, 1) for x in ("", "a", "d")} - {w} for w in words}
    every = sorted({*words, *itertools.chain.from_iterable(edits.values())})
    df = spark.createDataFrame([(w,) for w in every], "word string")
    for frequent in (0, 60):
        bounded = SP._bounded(SP._decomposed(df, SP.gram_dictionary(df, frequent)))
        rows = SP._listed(bounded).collect()
        lists = {}
        for r in rows:
            lists.setdefault((r.word, r.half), set()).add(r.list)
        for w in words:
            for x in edits[w]:
                if len(x) >= 7:
                    halves = (0, 0) if len(w) == len(x) else (1, 2) if len(w) < len(x) else (2, 1)
                    assert lists[w, halves[0]] & lists[x, halves[1]], (frequent, w, x)
        # the bound + 1 rarest grams, at both sides and for all three kinds of edit
        assert len(rows) == len(set(rows)) < 0.75 * sum(6 * min(r.bound + 1, len(r.grams)) for r in bounded.collect())


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    res = con.execute(ORACLE["op12_spelling"])
    names = [d[0] for d in res.description]
    out = QUERIES["op12_spelling"](spark, SF001)
    assert set(out.columns) == set(names)
    assert sorted(map(str, res.fetchall())) == sorted(str(tuple(r)) for r in out.select(*names).collect())
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
