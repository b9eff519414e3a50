"""The pipeline: stages against plain versions, on the smallest tables and on planted rows."""
import random

from pyspark.sql import functions as F

import corpus_pipeline as CP

from ..conftest import SF001
from . import brute
from .test_native import norm


def test_stages_by_contract():
    assert [n for n, _ in CP.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontaminate", "tokenize"]


def test_run_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {d: t for d, t in docs.items() if any(ch.isalpha() for ch in t or "")}
    first = {}
    for d in sorted(kept):
        first.setdefault(norm(kept[d]), d)
    kept = {d: kept[d] for d in first.values()}
    classes = brute.near_classes(list(kept.items()))
    kept = {d: t for d, t in kept.items() if classes[d] == d}
    kept = {d: t for d, t in kept.items() if not brute.hits(t, items)[0]}
    got = CP.run(spark, SF001).collect()
    assert {r.doc_id: r.text for r in got} == kept and len(got) == len(kept)
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_planted_rows(spark, tmp_path):
    """Copies, near copies, benchmark passages and noise go; clean rows and foreign columns stay."""
    rng = random.Random(11)
    en = "the of and to in is that for was with".split()
    de = "der die und das ist nicht ein mit auch sich".split()
    text = lambda lang: " ".join(rng.choice(lang) for _ in range(80))
    rows = [(i, text(en if i % 2 else de), "en" if i % 2 else "de", "s", None) for i in range(60)]
    base = rows[3][1]
    rows += [(100, base.replace(" ", "\n", 3), "en", "s", 1), (101, base + " end", "en", "s", 1), (102, "123 456 ... 789", "en", "s", 1),
             (103, None, "en", None, 1), (104, text(en) + " alpha beta gamma delta epsilon zeta eta theta iota kappa " + text(en), None, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("kept", F.lit("x"))
    spark.createDataFrame([(1, "Alpha beta gamma, delta epsilon zeta eta theta iota kappa!")], "item_id long, text string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = df.repartition(3)
    for name, stage in CP.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "tokenize":
            assert out.columns == df.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert {r.doc_id for r in docs.collect()} == set(range(60))
    empty = df.limit(0)
    for _, stage in CP.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
