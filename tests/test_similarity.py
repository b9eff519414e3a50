"""D1 indel ratio and D2 token-set ratio: literal values, properties, and a plain-Python statement of the rule."""
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cleanspark.functions.similarity import indel_ratio, lcs_lengths, token_set_ratio


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def ratio(a, b):
    if a is None or b is None:
        return 0.0
    return 1.0 if len(a) + len(b) == 0 else 2.0 * lcs_dp(a, b) / (len(a) + len(b))


def token_set(a, b):
    """The token-set rule as stated in the survey (independent restatement)."""
    if a is None or b is None:
        return 0.0
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    inter, da, db = sorted(ta & tb), sorted(ta - tb), sorted(tb - ta)
    if inter and (not da or not db):
        return 1.0
    si, sa, sb = " ".join(inter), " ".join(da), " ".join(db)
    sep = 1 if si else 0
    ab, ba = len(si) + sep + len(sa), len(si) + sep + len(sb)
    dist = len(sa) + len(sb) - 2 * lcs_dp(sa, sb)
    base = 1.0 if ab + ba == 0 else 1.0 - dist / (ab + ba)
    if not si:
        return base
    return max(base, 1.0 - (sep + len(sa)) / (len(si) + ab), 1.0 - (sep + len(sb)) / (len(si) + ba))


def test_lcs_batch_matches_dp():
    rnd = random.Random(7)
    a = ["".join(rnd.choice("ab01é") for _ in range(rnd.randint(0, 80))) for _ in range(500)]
    b = ["".join(rnd.choice("ab01é") for _ in range(rnd.randint(0, 80))) for _ in range(500)]
    got = lcs_lengths(pd.Series(a), pd.Series(b)).tolist()
    assert got == [lcs_dp(x, y) for x, y in zip(a, b)]


def run(spark, fn, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    return [r[0] for r in df.select(fn("a", "b")).collect()]


def test_indel_literals(spark):
    pairs = [("33612345678", "0612345678"), ("alice@example.com", "alice@example.com"), ("abc", None), ("", "")]
    got = run(spark, indel_ratio, pairs)
    assert got[0] == pytest.approx(18 / 21)
    assert got[1:] == [1.0, 0.0, 1.0]


def test_token_set_literals(spark):
    pairs = [("alice", "alice"), ("bob", "bob"), ("mariem ben", "ben mariem"), ("ali ben salah", "ali ben"),
             ("karim x", "leila y"), ("nadia abc", "nadia abd"), (None, "x"), ("   ", "x")]
    got = run(spark, token_set_ratio, pairs)
    assert got == pytest.approx([token_set(a, b) for a, b in pairs])
    assert got[:4] == [1.0, 1.0, 1.0, 1.0]


words = st.lists(st.sampled_from(["ali", "ben", "salah", "sami", "rim", "ines", "a", "ab"]), min_size=0, max_size=4)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=20))
def test_token_set_matches_rule_and_is_symmetric(spark, pairs):
    rows = [(" ".join(x), " ".join(y)) for x, y in pairs]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(token_set_ratio("a", "b").alias("ab"), token_set_ratio("b", "a").alias("ba"),
                    indel_ratio("a", "b").alias("i")).collect()
    for (a, b), r in zip(rows, got):
        assert r["ab"] == pytest.approx(token_set(a, b))
        assert r["ab"] == pytest.approx(r["ba"])
        assert 0.0 <= r["ab"] <= 1.0
        assert r["i"] == pytest.approx(ratio(a, b))
