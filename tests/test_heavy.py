"""The most common values by sketch and recount against full counts."""
import random
from collections import Counter

import pytest

from cleanspark.operators import heavy as H
from cleanspark.operators import profile as P


def expected(rows, names):
    out = {}
    for i, name in enumerate(names):
        count = Counter(r[i] for r in rows if r[i] is not None)
        best = min(count, key=lambda v: (-count[v], v), default=None)
        out[name] = (best, count[best] if best is not None else 0)
    return out


def rows_of(n, seed):
    rng = random.Random(seed)
    return [(rng.choice("abc"), str(i), f"v{int(rng.expovariate(0.05))}", None, "twice" if i in (3, 77) else f"u{i}",
             rng.choice(["x", "y"]) if i % 2 else None, f"w{i % 50}") for i in range(n)]


NAMES = ["few", "unique", "skewed", "none", "nearly_unique", "halves", "ties"]


@pytest.mark.parametrize("options", [{}, {"candidates": 2, "tracked": 8}, {"candidates": 5, "tracked": 64}])
def test_equals_full_counts(spark, options):
    rows = rows_of(4000, 1)
    long = P._unpivoted(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES)).repartition(6), NAMES)
    got = {r["column"]: (r["value"], r["n"]) for r in H.most_common(long, NAMES, **options).collect()}
    assert got == expected(rows, NAMES)
    assert all(r["rows"] == 4000 for r in H.most_common(long, NAMES, **options).collect())


def test_only_undecided_columns_are_counted_in_full(spark):
    rows = rows_of(6000, 2)
    long = P._unpivoted(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES)).repartition(6), NAMES)
    rest, decided = H.common_values(long)
    assert {"few", "skewed", "none", "halves", "ties"} <= set(decided)
    assert {r["column"] for r in rest.select("column").distinct().collect()} == set(NAMES) - set(decided) == {"unique", "nearly_unique"}


def test_profile_of_odd_tables(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert P.categorical_profile(empty).count() == 0
    df = spark.createDataFrame([("z", True), ("z", None), (None, False), ("a", False)], "a string, b boolean")
    got = {r["column"]: (r["most_common"], r["most_common_count"], r["most_common_percentage"]) for r in P.categorical_profile(df).collect()}
    assert got == {"a": ("z", 2, 50.0), "b": ("false", 2, 50.0)}
