"""Pairs and dedup: golden pairs of the 7-row file, brute-force comparison on small fixtures, plan shape."""
import itertools

import pytest
from pyspark.sql import functions as F

from cleanspark.operators import clean as C
from cleanspark.operators import dedup as DD
from cleanspark.operators import pairs as PR
from cleanspark.sources import fixtures as FX

from .conftest import SF001
from .test_similarity import ratio, token_set


def brute_force(rows, threshold=0.7, key="customer_id"):
    """Exhaustive all-pairs scoring in plain Python (the J1 reference), in key order."""
    rows = sorted(rows, key=lambda r: r[key])
    pairs = {}
    for a, b in itertools.combinations(rows, 2):
        s = (token_set(a["name"], b["name"]) + ratio(a["email"], b["email"]) + ratio(a["phone"], b["phone"])) / 3
        if s > threshold:
            pairs[(a[key], b[key])] = s
    return pairs


def test_golden_pairs_and_kept_rows(customers7):
    clean = C.clean_customers(customers7)
    got = {(r["row_i"], r["row_j"]): r for r in DD.rule_pairs(clean, "customer_id").collect()}
    assert set(got) == {("11", "13"), ("12", "17")}
    r = got[("11", "13")]
    assert (r["name_sim"], r["email_sim"], r["phone_sim"]) == pytest.approx((1.0, 1.0, 16 / 19))
    assert got[("12", "17")]["avg_sim"] == 1.0
    kept, dropped, _ = DD.dedup_rule(clean, "customer_id")
    assert sorted(r["customer_id"] for r in kept.collect()) == ["11", "12", "14", "15", "16"]
    assert {r["customer_id"]: r["reason"] for r in dropped.collect()} == {"13": "fuzzy", "17": "copy"}


def test_next_best_pair_below_threshold(customers7):
    clean = C.clean_customers(customers7)
    feats = {(r["row_i"], r["row_j"]): r["avg_sim"] for r in PR.pair_features(
        clean, "customer_id", keys=("email", "phone8", "name_token")).collect()}
    assert all(v <= 0.7 for k, v in feats.items() if k not in {("11", "13"), ("12", "17")})


def test_repeated_missing_and_text_ids(spark):
    """An id that names several people, one person twice under an id, rows without id: only duplicates go."""
    rows = [("1", "ann lee", "ann@x.tn", "21622334455"), ("2", "ann lee", "ann@x.tn", "21622334455"), ("2", "bob ray", "bob@y.tn", "21698765432"),
            (None, "cid fox", "cid@z.tn", "21611112222"), (None, "cid fox", "cid@z.tn", "21611112222"), ("PAT1", "dee kay", "dee@w.tn", "21655556666")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "customer_id string, name string, email string, phone string, n int")
    kept, dropped, _ = DD.dedup_rule(df)
    assert sorted(r["n"] for r in kept.collect()) == [0, 2, 3, 5] and dropped.count() == 2
    with pytest.raises(ValueError, match="not a unique key"):
        DD.dedup_rule(df, "customer_id")
    no_id, _, _ = DD.dedup_rule(df.drop("customer_id"))
    assert no_id.count() == 4


@pytest.mark.parametrize("fixture", ["dirty", "narrow"])
def test_blocked_pairs_against_brute_force(spark, fixture):
    raw = FX.dirty_customers(spark, SF001) if fixture == "dirty" else FX.narrow_customers(spark, SF001)
    clean = C.clean_customers(raw).cache()
    elig = [r.asDict() for r in PR.eligible(clean).collect()]
    truth = brute_force(elig)
    keys = ("email", "phone8", "name_sorted", "name_token")
    kept, dropped, _ = DD.dedup_rule(clean, "customer_id", keys=keys)
    got_pairs = {(r["row_i"], r["row_j"]): r["avg_sim"] for r in DD.rule_pairs(clean, "customer_id", keys=keys).collect()}
    # every reported pair is a true pair (blocking never invents pairs), with its similarity
    assert all(truth[k] == pytest.approx(v) for k, v in got_pairs.items())
    # J3 semantics: a row goes when any earlier row pairs with it
    want_dropped = {j for (_, j) in truth}
    reasons = {r["customer_id"]: r["reason"] for r in dropped.collect()}
    assert set(reasons) == want_dropped  # with these keys nothing is missed on either fixture
    if fixture == "dirty":
        assert set(reasons.values()) == {"copy", "fuzzy"} and any(0.7 < v < 1 for v in got_pairs.values())
    t = PR.triples(clean, "customer_id")
    n = PR.row_pair_count(t, DD.rule_triple_pairs(t, keys)).collect()[0]["value"]
    assert n == len(truth) if fixture == "dirty" else 0.95 * len(truth) <= n <= len(truth)
    default = {r["customer_id"] for r in DD.dedup_rule(clean, "customer_id")[1].collect()}
    recall = len(default & want_dropped) / len(want_dropped)
    assert default <= want_dropped and recall >= (0.97 if fixture == "dirty" else 0.93)


def test_pair_counts_of_groups(spark):
    """Five copies are ten pairs; three copies next to two near ones six more."""
    rows = [(i, "ann lee", "ann@x.tn", "21622334455") for i in range(5)]
    rows += [(10 + i, "bob ray", "bob@y.tn", "21698765432") for i in range(3)] + [(20 + i, "bob ray", "bob@y.tn", "21698765433") for i in range(2)]
    df = spark.createDataFrame(rows, "customer_id long, name string, email string, phone string")
    t = PR.triples(df, "customer_id")
    assert PR.row_pair_count(t, DD.rule_triple_pairs(t)).collect()[0]["value"] == 10 + 3 + 1 + 6
    assert PR.row_pair_count(t, DD.rule_triple_pairs(t), False).collect()[0]["value"] == 6


def test_splitting_does_not_change_pairs(spark):
    clean = C.clean_customers(FX.narrow_customers(spark, SF001)).cache()
    t = PR.triples(clean, "customer_id").cache()
    a = sorted(tuple(r) for r in PR.candidate_pairs(t).collect())
    b = sorted(tuple(r) for r in PR.candidate_pairs(t, split_rows=3).collect())
    assert a == b and len(a) > 100 and len(set(a)) == len(a)


def test_hot_block_is_split_and_reported(spark):
    rows = [(i, f"sam{i % 3} x", "same@mail.tn", f"2165{i:07d}") for i in range(60)]
    df = spark.createDataFrame(rows, "customer_id long, name string, email string, phone string")
    t = PR.triples(df, "customer_id")
    rep = {(r["kind"], r["key"]): r["size"] for r in PR.block_report(t).collect()}
    assert rep[("email", "same@mail.tn")] == 60
    assert PR.candidate_pairs(t, split_rows=7).count() == 60 * 59 // 2


def test_sampled_recall(spark):
    clean = C.clean_customers(FX.dirty_customers(spark, SF001))
    r = PR.sampled_recall(clean, every=2).collect()[0]
    assert r["queries"] > 20 and r["pairs"] > 5 and r["recall"] >= 0.95
    assert PR.sampled_recall(clean, keys=("email",), every=2).collect()[0]["recall"] < r["recall"]


def test_blocked_plan_has_no_nested_loop_or_cartesian(spark):
    clean = C.clean_customers(FX.dirty_customers(spark, SF001))
    plan = DD.rule_pairs(clean, "customer_id")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert plan.count("ArrowEvalPython") == 1  # one evaluation of the similarities


def test_distinct_is_partial_and_final(spark, customers7):
    plan = C.distinct_rows(customers7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2


def test_lsh_keys_only_add_candidates(spark):
    clean = C.clean_customers(FX.narrow_customers(spark, SF001)).cache()
    t = PR.triples(clean, "customer_id")
    base = {tuple(r) for r in PR.candidate_pairs(t).collect()}
    more = {tuple(r) for r in PR.candidate_pairs(t, PR.DEFAULT_KEYS + ("email_lsh", "name_lsh")).collect()}
    assert base < more
    _, d0, _ = DD.dedup_rule(clean, "customer_id")
    _, d1, _ = DD.dedup_rule(clean, "customer_id", keys=PR.DEFAULT_KEYS + ("email_lsh", "name_lsh"))
    assert {r[0] for r in d0.collect()} <= {r[0] for r in d1.collect()}


def test_recall_compares_every_query(spark):
    """More queries than a block holds: none is left out, and the result is that of one block."""
    from cleanspark.operators import pairs as PR
    from cleanspark.sources import fixtures as FX
    raw = FX.narrow_customers(spark, "/root/testdata/sf0.001").limit(60).localCheckpoint()
    few, one = (PR.sampled_recall(raw, every=1, most=most).first() for most in (7, 2_000))
    assert few == one and one.queries > 7 and one.pairs > 0


def test_row_ids_without_a_sort(spark):
    """A whole-number key that names every row once is the row's number; else rows are ranked by key and content."""
    rows = [(3, "b"), (1, "a"), (2, None)]
    unique = PR.with_row_id(spark.createDataFrame(rows, "customer_id long, name string"))
    assert {(r.customer_id, r[PR.ROW_ID]) for r in unique.collect()} == {(1, 1), (2, 2), (3, 3)}
    assert "Sort" not in unique._jdf.queryExecution().optimizedPlan().toString()
    for more in ((3, "c"), (None, "n")):
        ranked = PR.with_row_id(spark.createDataFrame([*rows, more], "customer_id long, name string")).collect()
        by_rank = [(r.customer_id, r.name) for r in sorted(ranked, key=lambda r: r[PR.ROW_ID])]
        assert by_rank == sorted([*rows, more], key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    text = PR.with_row_id(spark.createDataFrame([("b", 1), ("a", 2)], "customer_id string, n int")).collect()
    assert [r.customer_id for r in sorted(text, key=lambda r: r[PR.ROW_ID])] == ["a", "b"]


def test_raw_rows_are_cleaned_once(spark):
    """Cleaned rows and counters come from one written table."""
    raw = FX.dirty_customers(spark, SF001)
    groups = C.clean_groups(raw)
    assert sorted(map(str, C.group_rows(groups).collect())) == sorted(map(str, C.clean_customers(raw).collect()))
    assert C.group_report(groups).collect() == C.clean_report(raw).collect()
    from cleanspark.plans import flows as FL
    report = FL.run_rule(raw).report._jdf.queryExecution().optimizedPlan().toString()
    assert "signup_date" not in report or "regexp" not in report.lower()


def test_recall_lists_no_pairs_for_the_similarities(spark, monkeypatch):
    """Queries meet all rows in cells, inside which bounds come first; no pair is joined to be compared by the column functions."""
    from cleanspark.operators import pairs as PR
    clean = C.clean_customers(FX.dirty_customers(spark, SF001))

    def refuse(*_):
        raise AssertionError("a listed pair")

    monkeypatch.setattr(PR, "token_set_ratio", refuse)
    assert PR.sampled_recall(clean, every=2).first()["pairs"] > 5
