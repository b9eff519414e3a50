"""Correlations of many columns against numpy, pair by pair over complete rows."""
import numpy as np
import pytest

from cleanspark.operators import gram as G
from cleanspark.operators import profile as P


def expected(x):
    out = {}
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            constant = not len(a) or a.min() == a.max() or b.min() == b.max()
            out[f"c{i}", f"c{j}"] = None if constant else float(np.corrcoef(a, b)[0, 1])
    return out


def frame(spark, x, parts):
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    return spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(x.shape[1]))).repartition(parts)


def same(got, want):
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert (got[k] is None) == (v is None) and (v is None or got[k] == pytest.approx(v, abs=1e-7)), k


def test_two_hundred_columns_with_missing_cells(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)) @ rng.normal(size=(3, 200)) + rng.normal(size=(400, 200))
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7] = 0.1  # constant
    x[:, 8] = np.nan  # without values
    x[:, 9] += 1e9  # a large offset
    x[1:, 10] = np.nan  # one value
    df = frame(spark, x, 5)
    out = P.correlations(df)
    same({(r.col1, r.col2): r["corr"] for r in out.collect()}, expected(x))
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("MapInArrow") > 0 and len(plan) < 200_000


def test_batches_and_parts_do_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 12)) * 10.0 ** rng.integers(-3, 6, 12) + 10.0 ** rng.integers(0, 5, 12)
    x[rng.random(x.shape) < 0.5] = np.nan
    want = expected(x)
    moments = G.PairMoments(12)
    for part in np.array_split(x, [1, 2, 50, 290]):
        moments.add(part)
    for i in range(12):
        for j in range(i + 1, 12):
            r = moments.product[i, j] / np.sqrt(moments.square[i, j] * moments.square[j, i])
            assert r == pytest.approx(want[f"c{i}", f"c{j}"], abs=1e-9)
    for parts in (1, 7):
        same({(r.col1, r.col2): r["corr"] for r in G.correlation_matrix(frame(spark, x, parts), [f"c{i}" for i in range(12)]).collect()}, want)


def test_empty_and_threshold(spark):
    df = spark.createDataFrame([], "a double, b int, c float")
    assert [tuple(r) for r in G.correlation_matrix(df, ["a", "b", "c"]).collect()] and G.correlation_matrix(df, ["a", "b"], 0.5).count() == 0
    df = spark.range(50).selectExpr("id AS a", "id * 2 AS b", "id % 7 AS c")
    assert [(r.col1, r.col2) for r in G.correlation_matrix(df, ["a", "b", "c"], 0.9).collect()] == [("a", "b")]
