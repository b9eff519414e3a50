"""The exact Jaccard join against all pairs, and its index against pairs at the threshold."""
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cleanspark.llm import classes as CL
from cleanspark.llm import jaccard_join as JJ
from cleanspark.llm.queries import ORACLE, QUERIES

from ..conftest import SF001
from .brute import LOW

SCHEMA = "doc_id long, text string"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def brute(rows, percent=90):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(s), str(least.get(find(i)) if s else d)) for i, (d, s) in enumerate(sets))


def got(df, **options):
    out = JJ.similar_components(df, **options)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out.collect())


def varied(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        i = rng.randrange(len(w) + 1)
        w[i:i + rng.choice([0, 1])] = rng.choice([[], ["x"], ["the"], ["y", "z"]])
    return w


def random_rows(seed, docs, longest):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and"] * 20 + [f"w{i}" for i in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 11, 12, 15, 22, 40, 90, longest]))] for _ in range(docs // 6)]
    return [(i, rng.choice([" ", "\n", "\t "]).join(varied(rng, rng.choice(bases), rng.choice([0, 0, 1, 2, 3])) or ["a"])) for i in range(docs)]


@pytest.mark.parametrize("seed, percent", [(1, 90), (2, 80), (3, 95)])
def test_random_texts(spark, seed, percent):
    rows = random_rows(seed, 300, 400)
    rows += rows[:20] + [(None, rows[3][1]), (500, None), (501, ""), (502, " \n"), (503, "A b"), (504, "a B"), (505, "a b c"), (506, "a\0b c d"), (507, "é, x. É")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("n", F.lit("clash")).withColumn("row", F.lit(1))
    assert got(df, percent=percent) == brute(rows, percent)


def test_chain_and_large_group(spark, monkeypatch):
    """A chain of links, and a group of texts around the threshold that is cut into parts: one component, none lost."""
    monkeypatch.setattr(CL, "PART_ROWS", 7)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    chain = [(i, " ".join(base[:60] + [f"c{j}" for j in range(i)] + base[60 + i:])) for i in range(40)]
    group = [(100 + i, " ".join(varied(rng, base[::-1], rng.randrange(1, 4)))) for i in range(120)]
    copies = [(1000 + i, "the very same text again and again and once more") for i in range(200)]
    rows = chain + group + copies
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_odd_tables(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    long = " ".join(f"w{i % 50_000}" for i in range(120_000))
    rows = [(1, long), (2, long + " end"), (3, "w1 " + long), (4, None)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    texts = spark.createDataFrame([("b", "x y z"), ("a", "X  y z"), ("c", None)], "doc_id string, text string")
    assert got(texts) == [("a", 1, "a"), ("b", 1, "a"), ("c", 0, "c")]


@pytest.mark.parametrize("percent", [80, 90])
def test_pairs_at_the_threshold_share_a_key(percent):
    """Sets of every size with a partner just similar enough, under every choice of what is skipped."""
    rng = np.random.default_rng(percent)
    least, segments, partner = JJ.bands(percent)
    assert all(least[1:] - 1 >= least[:-1]) and all(100 * (least[i + 1] - 1) // percent < least[i + 2] for i in range(len(least) - 2))
    for skip in (0, 1, 2, 3):
        skips = np.where(segments > 1, skip, -1)
        for size in [*range(10, 60), 75, 120, 333, 900]:
            for _ in range(6):
                a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
                lost = int(rng.integers(0, size // 9 + 2))
                added = int(rng.integers(0, size // 9 + 2))
                b = np.concatenate([a[lost:], rng.integers(0, 1 << 63, added, dtype=np.uint64)])
                if 100 * (size - lost) < percent * (size + added):
                    continue
                found = []
                for x in (a, b):
                    band = int(np.searchsorted(least, len(x), "right")) - 1
                    found.append(set())
                    for at in (band, band - 1):
                        if segments[at] > 1 and (at == band or len(x) <= partner[at]):
                            keys, of = JJ.band_keys(x, np.array([0, len(x)]), np.array([at]), segments, skips)
                            assert not of.any()
                            found[-1] |= set(keys.tolist())
                assert found[0] & found[1], (skip, size, lost, added)


def test_allocation_follows_the_counts():
    few, many = JJ.skipped_sizes({60: 10, 61: 10}), JJ.skipped_sizes({60: 10 ** 9, 61: 10 ** 9})
    assert few[60] <= many[60] and many[60] > 0 and JJ.skipped_sizes({})[0] == -1


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    res = con.execute(ORACLE["op13_jaccard_join"])
    names = [d[0] for d in res.description]
    out = QUERIES["op13_jaccard_join"](spark, SF001)
    assert set(out.columns) == set(names)
    assert sorted(map(str, res.fetchall())) == sorted(str(tuple(r)) for r in out.select(*names).collect())
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
