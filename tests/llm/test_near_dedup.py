"""Near-dedup: signatures against the similarity they estimate, classes against comparing all pairs."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cleanspark.llm import classes as CL
from cleanspark.llm import near_dedup as ND
from cleanspark.llm import words as W

from . import brute

SCHEMA = "doc_id long, text string"


def classes(spark, rows, parts=4, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("class_id", F.lit("clash")).withColumn("row", F.lit(1))
    return ND.near_classes(df, **options).collect()


def prose(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10 ** 6)}"
    return out


@pytest.mark.parametrize("fractional", [False, True])
def test_signature_agreement_is_weighted_jaccard(fractional):
    rng = np.random.default_rng(0)
    hashed = lambda i: int(W.mix(np.array([i + 1000], np.uint64))[0])
    k, errors = 3000, []
    for _ in range(25):
        n = int(rng.integers(2, 300))
        weights = [1, 2, 3.5, 0.4] if fractional else [1, 1, 2, 5]
        a = {hashed(i): float(rng.choice(weights)) for i in range(n)}
        b = {x: float(rng.choice(weights)) if rng.random() < 0.1 else w for x, w in a.items() if rng.random() < 0.9}
        b |= {hashed(10 ** 6 + i): 1.0 for i in range(1 + n // 20)}
        both = set(a) | set(b)
        true = sum(min(a.get(x, 0), b.get(x, 0)) for x in both) / sum(max(a.get(x, 0), b.get(x, 0)) for x in both)
        s = ND.dart_signatures(np.array([*a, *b], np.uint64), np.array([*a.values(), *b.values()]), np.array([0, len(a), len(a) + len(b)]), k)
        errors.append((s[0] == s[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.008 and np.max(np.abs(errors)) < 0.05


def test_signature_of_nothing():
    assert not ND.dart_signatures(np.zeros(0, np.uint64), np.zeros(0), np.array([0, 0, 0]), 8).any()


def test_classes_equal_all_pairs(spark):
    rng = random.Random(7)
    rows = []
    for g in range(12):
        base = prose(rng, rng.choice([6, 20, 60, 300]))
        for _ in range(rng.randint(1, 6)):
            rows.append((len(rows) * 3 % 1009, " ".join(edited(rng, base, rng.choice([0, 0, 1, 1, 2])))))
    chain = prose(rng, 400)  # each near the next, the ends far apart
    for _ in range(12):
        rows.append((5000 - len(rows), " ".join(chain)))
        chain = edited(rng, chain, 5)
    rows += [(9000 + i, t) for i, t in enumerate(["one two", "One, TWO!", "one", "three four five six", "a b c d e", "a b c d e f"])]
    got = {r.doc_id: r.class_id for r in classes(spark, rows)}
    assert got == brute.near_classes(rows)


def test_large_groups_and_mixed_buckets(spark):
    """A group of copies, a group of near copies that also holds far relatives, and unrelated texts."""
    rng = random.Random(8)
    base = prose(rng, 120)
    rows = [(i, "the very same text of all these copies here") for i in range(0, 900, 3)]
    rows += [(1000 + i, " ".join(edited(rng, base, rng.choice([1, 2, 3, 5, 8, 12])))) for i in range(150)]
    rows += [(2000 + i, " ".join(prose(rng, 80))) for i in range(100)]
    got = classes(spark, rows, parts=7)
    assert {r.doc_id: r.class_id for r in got} == brute.near_classes(rows)
    sizes = {}
    for r in got:
        sizes[r.class_id] = sizes.get(r.class_id, 0) + 1
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "?!"), (4, None), (5, long), (6, long + " end"), (7, "same words here for all of us"),
            (7, "same words here for all of us"), (None, "Same words here, for all of us"), (8, "b " * 500), (9, "b " * 350)]
    got = classes(spark, rows, parts=2)
    assert len(got) == len(rows)
    alone = [r for r in got if r.doc_id in (1, 2, 3, 4)]
    assert all(r.class_id == r.doc_id and r.class_size == 1 and r.kept for r in alone)
    assert {r.class_id for r in got if r.doc_id in (5, 6)} == {5}
    seven = [r for r in got if r.class_id == 7]
    assert len(seven) == 3 and sum(r.kept for r in seven) == 1 and all(r.class_size == 3 for r in seven)
    assert {r.doc_id: r.class_id for r in got if r.doc_id in (8, 9)} == {8: 8, 9: 9}  # counts matter: 346 of 496 shared
    assert ND.near_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_filter_keeps_rows_and_columns(spark):
    rng = random.Random(9)
    base = " ".join(prose(rng, 100))
    df = spark.createDataFrame([(1, base), (2, base + " x"), (3, "else"), (None, base + " y"), (4, None)], SCHEMA).withColumn("kept", F.lit("mine"))
    out = ND.near_dedup(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {1, 3, 4}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 103), (101, 103), (102, 101)] + [(500, i) for i in range(501, 700)]
    got = {r.node: r.label for r in ND.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 104)}, **{i: 500 for i in range(500, 700)}}
    assert ND.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_scripts_without_spaces(spark):
    """One changed character of 100 leaves a copy similar; punctuation beyond ASCII parts words."""
    rng = random.Random(11)
    rows, pairs = [], []
    for first, last in ((0x4E00, 0x9FA5), (0x3041, 0x3096), (0x30A1, 0x30FA), (0xE01, 0xE2E), (0x1780, 0x17B3)):
        text = [chr(rng.randint(first, last)) for _ in range(100)]
        pairs.append((len(rows), len(rows) + 1))
        rows += [(len(rows), "".join(text)), (len(rows) + 1, "".join(text[:50]) + "x" + "".join(text[51:]))]
        rows.append((len(rows), "".join(chr(rng.randint(first, last)) for _ in range(100))))
    words = prose(rng, 60)
    pairs.append((len(rows), len(rows) + 1))
    rows += [(len(rows), "\u3002".join(words)), (len(rows) + 1, "\uff0c".join(words))]
    got = {r[0]: r.class_id for r in classes(spark, rows)}
    second = {b: a for a, b in pairs}
    assert got == {i: second.get(i, i) for i, _ in rows}


def test_only_compared_sets_are_moved(spark):
    """The sets of rows in no pair stay where they are read; similarities are those of all sets."""
    sets = spark.range(20_000).select(F.col("id").alias("row"), F.sequence(F.col("id"), F.col("id") + 9).alias("elements"))
    pairs = spark.createDataFrame([(i, i + 1 + i % 3) for i in range(0, 600, 3)] + [(5, 19_999), (5, 6)], "a bigint, b bigint")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    kept = CL.sets_of(sets, ends)
    assert ends.join(kept, "row", "left_anti").isEmpty()
    assert kept.count() < ends.count() + 1_000
    assert CL.sets_of(sets, ends.limit(0)).count() < 1_000
    overlap = lambda a, b: max(0, 10 - (b - a))
    out = {(r.a, r.b): r.sim for r in CL.similarities(pairs, sets).collect()}
    assert out == {(r.a, r.b): overlap(r.a, r.b) / (20 - overlap(r.a, r.b)) for r in pairs.collect()}
    plan = CL.similarities(pairs, sets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") >= 2  # both ends
