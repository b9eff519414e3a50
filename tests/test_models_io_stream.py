"""Models (pair forest, isolation forest), sinks and streaming."""
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cleanspark.operators import anomaly as AN
from cleanspark.operators import clean as C
from cleanspark.operators import dedup as DD
from cleanspark.operators import pairs as PR
from cleanspark.plans import catalog
from cleanspark.sources import fixtures as FX
from cleanspark.sources import readers as R
from cleanspark.sources import sinks as SK
from cleanspark.streaming import stream as ST

from .conftest import SF001


@pytest.fixture(scope="module")
def dirty_clean(spark):
    return C.clean_customers(FX.dirty_customers(spark, SF001)).cache()


def test_isolation_forest_properties(spark, dirty_clean):
    model = AN.train(dirty_clean, "customer_id", n_trees=50)
    scored = AN.score(dirty_clean, model).cache()
    n = scored.count()
    flagged = scored.where("is_anomaly = 1").count()
    assert abs(flagged / n - 0.1) <= 0.02
    s = [r[0] for r in scored.select("anomaly_score").collect()]
    assert all(0.0 < v <= 1.0 for v in s)
    again = AN.score(dirty_clean, AN.train(dirty_clean, "customer_id", n_trees=50))
    assert sorted(r[0] for r in again.select("anomaly_score").collect()) == pytest.approx(sorted(s))
    # far outliers (the +1000000 ids) score higher on average than the rest
    hi = scored.where("customer_id > 1000000").agg(F.avg("anomaly_score")).collect()[0][0]
    lo = scored.where("customer_id < 1000000").agg(F.avg("anomaly_score")).collect()[0][0]
    assert hi > lo


def test_isolation_forest_save_load(spark, dirty_clean):
    model = AN.train(dirty_clean, "customer_id", n_trees=10)
    path = tempfile.mkdtemp(prefix="iforest-") + "/m"
    model.save(spark, path)
    back = AN.IsolationForestModel.load(spark, path)
    a = AN.score(dirty_clean, model).select("customer_id", "anomaly_score").collect()
    b = AN.score(dirty_clean, back).select("customer_id", "anomaly_score").collect()
    assert sorted(a) == sorted(b)
    assert AN.IsolationForestModel.load(spark, path + "-missing") is None


def test_no_numeric_column_gives_no_model(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert AN.train(df, "k") is None


def test_pair_forest_agrees_with_rule(spark):
    clean = C.clean_customers(FX.narrow_customers(spark, SF001)).cache()
    feats = PR.pair_features(clean, "customer_id", keys=(*PR.DEFAULT_KEYS, "name_token")).cache()
    model = DD.train_dedup_model(feats, num_trees=20)
    pred = DD.predict_pairs(feats, model).select("row_i", "row_j")
    rule = feats.where("avg_sim > 0.7").select("row_i", "row_j")
    outside = feats.where("avg_sim < 0.65 OR avg_sim > 0.8").select("row_i", "row_j")
    n = outside.count()
    agree = n - outside.join(pred, ["row_i", "row_j"], "left_semi").exceptAll(
        outside.join(rule, ["row_i", "row_j"], "left_semi")).count() - outside.join(rule, ["row_i", "row_j"],
                                                                                      "left_semi").exceptAll(
        outside.join(pred, ["row_i", "row_j"], "left_semi")).count()
    assert agree / n >= 0.99
    path = tempfile.mkdtemp(prefix="rf-") + "/m"
    DD.save_model(model, path)
    assert DD.load_model(spark, path) is not None and DD.load_model(spark, path + "x") is None


def test_one_class_model_predicts_nothing(spark):
    feats = spark.createDataFrame([(0.1, 0.2, 0.3, 0.2)] * 5, list(DD.FEATURES))
    model = DD.train_dedup_model(feats, num_trees=3)
    assert DD.model_classes(model) == 1 and DD.predict_pairs(feats, model).count() == 0
    only = spark.createDataFrame([(0.9, 0.9, 0.9, 0.9), (1.0, 1.0, 1.0, 1.0)] * 5, list(DD.FEATURES))
    assert DD.predict_pairs(only, DD.train_dedup_model(only, num_trees=3)).count() == 0
    assert DD.train_dedup_model(feats.limit(0)) is None


def test_sinks_round_trip(spark, dirty_clean):
    base = tempfile.mkdtemp(prefix="sinks-")
    SK.write_table(dirty_clean, f"{base}/pq", partition_by=["country"])
    SK.write_table(dirty_clean, f"{base}/csv", fmt="csv")
    back = spark.read.parquet(f"{base}/pq")
    assert back.count() == dirty_clean.count()
    text = R.read_table(spark, f"{base}/csv", fmt="csv")
    assert set(text.columns) == set(dirty_clean.columns)
    assert all(f.dataType.simpleString() == "string" for f in text.schema.fields)
    SK.write_report_json(C.clean_report(FX.dirty_customers(spark, SF001)), f"{base}/report")
    files = [f for f in os.listdir(f"{base}/report") if f.endswith(".json")]
    assert len(files) == 1 and "rows_before" in json.loads(open(f"{base}/report/{files[0]}").readline())
    typed = SK.typed_load(dirty_clean)
    assert dict(typed.dtypes)["amount"] == "decimal(10,2)" and dict(typed.dtypes)["customer_id"] == "int"
    assert {r["column"]: r["violations"] for r in SK.length_violations(dirty_clean).collect()}["phone"] == 0


def test_read_many_json_and_csv(spark):
    base = tempfile.mkdtemp(prefix="many-")
    with open(f"{base}/a.csv", "w") as f:
        f.write("Customer_ID,Name,phone\n1,Ann,0612345678\n2,,NA\n")
    with open(f"{base}/b.json", "w") as f:
        f.write('{"customer_id": "3", "name": "Bo", "email": "bo@x.tn"}\n')
    df = R.read_many(spark, [(f"{base}/a.csv", "csv"), (f"{base}/b.json", "json")])
    rows = {r["customer_id"]: r for r in R.apply_null_tokens(df).collect()}
    assert set(rows) == {"1", "2", "3"} and rows["2"]["phone"] is None and rows["3"]["email"] == "bo@x.tn"


def test_role_mapping(spark):
    df = spark.createDataFrame([("1", "x", "y")], ["Telephone", "Ville", "other"])
    out = R.map_roles(R.normalize_headers(df))
    assert out.columns == ["phone", "city", "other"]


def test_stream_clean_equals_batch(spark):
    raw = FX.dirty_customers(spark, SF001)
    src = ST.stage_as_files(spark, raw.repartition(3), "t-raw")
    out = ST.run_to_files(spark, ST.clean_stream(ST.read_stream(spark, src, raw, max_files=1)), "t-clean")
    batch = C.drop_empty_rows(C.clean_columns(raw))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, batch.collect()))


def test_stream_dedup_and_windows(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"),
                                                              "user_id", "event_type", "value")
    doubled = ev.unionByName(ev)
    src = ST.stage_as_files(spark, doubled, "t-ev")
    out = ST.run_to_files(spark, ST.dedup_stream(ST.read_stream(spark, src, doubled), "ts", "1 day"), "t-dedup")
    assert spark.read.parquet(out).count() == ev.distinct().count()
    ntz = spark.read.parquet(f"{SF001}/events.parquet").select("ts", "value")
    src2 = ST.stage_as_files(spark, ntz, "t-ev2")
    w = ST.run_to_files(spark, ST.quality_counters(ST.read_stream(spark, src2, ntz), "ts", "value"), "t-win",
                        output_mode="complete")
    assert spark.read.parquet(w).agg(F.sum("rows")).collect()[0][0] == ntz.count()
    closed = ST.run_to_files(spark, ST.quality_counters(ST.read_stream(spark, src2, ntz), "ts", "value"), "t-app")
    full = {r[0]: r[1] for r in spark.read.parquet(w).select("window_start", "rows").collect()}
    part = {r[0]: r[1] for r in spark.read.parquet(closed).select("window_start", "rows").collect()}
    assert part and part.items() <= full.items()  # append mode: every closed window once, open ones not yet


def test_window_query_over_many_files(spark):
    """The events as 24 files, the latest days in the first and largest ones: no row is late."""
    from cleanspark.plans import catalog
    base = tempfile.mkdtemp(prefix="many-files-")
    days = spark.range(24 * 400).selectExpr("cast(id % 24 as int) AS d", "cast(id as int) AS i")
    days = days.where("i <= 24 * (20 + 15 * d)").selectExpr(
        "d", "cast(timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, d, i % 20) as timestamp_ntz) AS ts",
        "cast(i as bigint) AS user_id", "'view' AS event_type", "if(i % 5 = 0, null, i - 100.5) AS value", "cast(i as bigint) AS event_id")
    for k in range(24):
        days.where(f"d = {23 - k}").drop("d").coalesce(1).write.mode("append").parquet(f"{base}/events.parquet")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = catalog.QUERIES["stream_quality_windows"](spark, base).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    want = days.where("d < 22").groupBy(F.to_date("ts")).agg(
        F.count(F.lit(1)), F.count_if(F.col("value").isNull()), F.count_if(F.col("value") < 0), F.round(F.sum("value"), 6)).collect()
    assert len(want) == 22 and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_train_then_run_with_stored_models(spark):
    from cleanspark.plans import flows as FL
    raw = FX.narrow_customers(spark, SF001)
    base = tempfile.mkdtemp(prefix="models-")
    tr = FL.train_models(raw, f"{base}/dedup", f"{base}/iforest", num_trees=10)
    rep = tr.report.collect()[0]
    assert rep["training_pairs"] > 0 and rep["dedup_model"] and rep["anomaly_model"]
    res = FL.run(raw, f"{base}/dedup", f"{base}/iforest")
    final = res.final
    assert {"anomaly_score", "is_anomaly"} <= set(final.columns)
    r = res.report.collect()[0]
    assert r["final_rows"] == r["rows_clean"] - r["rows_dropped"]
    # a missing model falls back to the rule and the IQR flag
    fb = FL.run(raw, f"{base}/none", f"{base}/none2").report.collect()[0]
    rule = FL.run_rule(raw).report.collect()[0]
    assert fb == rule and (fb["dedup_variant"], fb["anomaly_variant"], fb["warning"]) == ("rule", "iqr", None)
    assert (r["dedup_variant"], r["anomaly_variant"]) == ("model", "isolation forest")


def test_run_reports_a_one_class_model(spark):
    from cleanspark.plans import flows as FL
    model = DD.train_dedup_model(spark.createDataFrame([(0.1, 0.2, 0.3, 0.2)] * 5, list(DD.FEATURES)), num_trees=3)
    r = FL.run_with(FX.dirty_customers(spark, SF001), model, None).report.collect()[0]
    assert r["rows_dropped"] == 0 and "one class" in r["warning"]


def test_run_from_path_to_path(spark):
    """French headers, text ids, quotes and line breaks inside fields, a malformed record, two header orders."""
    from cleanspark.plans import flows as FL
    base = tempfile.mkdtemp(prefix="run-")
    with open(f"{base}/a.csv", "w") as f:
        f.write('Patient_ID,Nom,Email,Telephone,prix_DT\nP1,"Ann ""A"" Lee",ann@x.tn,22334455,10\nP1_BIS,"Ann ""A"" Lee",ann@x.tn,22334455,10\n'
                'P2,"Bob\nRay",bob@y.tn,98765432,20\nP9,too,many,fields,1,2,3\n')
    with open(f"{base}/b.csv", "w") as f:
        f.write("Email,Patient_ID,Nom\ncid@z.tn,P3,Cid\n,,\n")
    r = FL.run_files(spark, [f"{base}/a.csv", f"{base}/b.csv"], f"{base}/out").collect()[0]
    assert (r["rows_read"], r["empty_rows_removed"], r["rows_clean"], r["duplicate_pairs"], r["rows_dropped"], r["final_rows"]) == (5, 1, 4, 1, 1, 3)
    final = {x["customer_id"]: x for x in spark.read.parquet(r["final_path"]).collect()}
    assert set(final) == {"P1", "P2", "P3"} and final["P1"]["name"] == 'ann "a" lee' and final["P3"]["email"] == "cid@z.tn"
    assert final["P2"]["name"].split() == ["bob", "ray"] and spark.read.parquet(f"{base}/out/rejects").count() == 1
    assert r["input_path"].endswith("b.csv") and r["generated_at"]


def test_csv_errors_surface(spark):
    base = tempfile.mkdtemp(prefix="csv-")
    os.makedirs(f"{base}/d")
    for name, text in (("1.csv", "name,email\nann,a@x.tn\n"), ("2.csv", "email,name\nb@y.tn,bob\n")):
        with open(f"{base}/d/{name}", "w") as f:
            f.write(text)
    with pytest.raises(Exception):  # another header under one path is refused, not read by position
        R.read_table(spark, f"{base}/d", "csv").collect()
    both = R.read_table(spark, [f"{base}/d/1.csv", f"{base}/d/2.csv"], "csv").collect()
    assert {(r["name"], r["email"]) for r in both} == {("ann", "a@x.tn"), ("bob", "b@y.tn")}
    with open(f"{base}/bad.csv", "w") as f:
        f.write("name,email\nann\n")
    with pytest.raises(Exception):
        R.read_table(spark, f"{base}/bad.csv", "csv").collect()


def test_load_rejects_and_saved_tables(spark):
    df = spark.createDataFrame([(1, 3_000_000_000, 1.5), (2, 5, 123_456_789_012.0), (3, 6, float("nan"))], "k int, customer_id long, amount double")
    assert {(r["key"], r["column"]) for r in SK.load_rejects(df, "k").collect()} == {(1, "customer_id"), (2, "amount"), (3, "amount")}
    typed = SK.typed_load(df)
    SK.save_table(typed, "loaded_customers", partition_by=None)
    assert spark.table("loaded_customers").count() == 3 and spark.table("loaded_customers").where("customer_id IS NULL").count() == 1
    spark.sql("DROP TABLE loaded_customers")


def test_forest_without_a_usable_key(spark):
    df = spark.range(20_000).select(F.lit(None).cast("long").alias("key"), (F.col("id") % 977).cast("double").alias("x"))
    model = AN.train(df.withColumn("y", F.rand(1)), "key", features=["x", "y"], n_trees=5)
    assert model.trees["tree"].nunique() == 5 and 0 < model.threshold < 1
    with pytest.raises(ValueError, match="too many rows are equal"):
        AN.train(spark.range(200_000).select(F.lit(1).alias("key"), F.lit(2.0).alias("x")), "key", n_trees=100)


def test_scoring_uses_the_means_of_the_scored_frame(spark, dirty_clean):
    model = AN.train(dirty_clean, "customer_id", n_trees=10)
    part = dirty_clean.where("amount > 0 OR amount IS NULL")
    mean = part.agg(F.avg("amount")).collect()[0][0]
    a = {r["customer_id"]: r["anomaly_score"] for r in AN.score(part, model).collect()}
    b = {r["customer_id"]: r["anomaly_score"] for r in AN.score(part.fillna(mean, ["amount"]), model).collect()}
    assert a == pytest.approx(b)
    text = spark.createDataFrame([("a",)], "t string")
    assert tuple(AN.score(text, model).collect()[0]) == ("a", 0, 0.0)


def test_profiling_flow_and_stamp(spark, dirty_clean):
    from cleanspark.plans import flows as FL
    rep = FL.profiling(dirty_clean)
    assert {"general", "columns", "numeric", "outliers", "normality", "quality"} <= set(rep)
    stamped = SK.stamp(rep["quality"], "/data/customers.csv")
    assert stamped.columns[:2] == ["generated_at", "input_path"] and stamped.count() == 1


def test_stream_scoring_equals_batch(spark, dirty_clean):
    model = AN.train(dirty_clean, "customer_id", n_trees=10)
    src = ST.stage_as_files(spark, dirty_clean.repartition(2), "t-score")
    out = ST.run_to_files(spark, ST.score_stream(ST.read_stream(spark, src, dirty_clean, max_files=1), model),
                          "t-scored")
    streamed = {r["customer_id"]: r["anomaly_score"] for r in spark.read.parquet(out).collect()}
    batch = {r["customer_id"]: r["anomaly_score"] for r in AN.score(dirty_clean, model).collect()}
    assert streamed.keys() == batch.keys()
    assert all(abs(streamed[k] - batch[k]) < 1e-12 for k in batch)


def test_late_rows_are_counted_and_left_out(spark):
    """Rows inside and beyond the delay over several micro-batches: the side output and the counters agree row for row."""
    day = lambda d, h=0: f"2024-03-{d:02d} {h:02d}:00:00"
    arrivals = [[day(1), day(2)], [day(5), day(6, 12)], [day(5, 3), day(1, 5), day(9)], [day(2, 1), day(5, 1), day(9, 1), None], [day(1, 1), day(12)]]
    rows = [(t, float(i), b) for b, ts in enumerate(arrivals) for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "ts string, value double, b int").withColumn("ts", F.col("ts").cast("timestamp"))
    like = df.drop("b")
    path = ST.stage_in_order(spark, df, "b", len(arrivals), "late-test")
    out = spark.read.parquet(ST.watermark_output(spark, ST.read_batches(spark, path, like), "ts", "late-side"))
    late = {(r.batch, str(r.ts)) for r in out.where("late").collect()}
    # judged by the watermark of the batch before: batch 2 by day 1 (2 less a day), 3 by day 5.5, 4 by day 8
    assert late == {(3, "2024-03-02 01:00:00"), (4, "2024-03-01 01:00:00")} and out.count() == len(rows)
    counted = spark.read.parquet(ST.run_to_files(spark, ST.quality_counters(ST.read_batches(spark, path, like), "ts", "value"), "late-counted"))
    closed = out.where("NOT late AND ts < '2024-03-10'").groupBy(F.to_date("ts").alias("d")).count().collect()
    assert {r.d.isoformat(): r["count"] for r in closed} == {str(r.window_start)[:10]: r["rows"] for r in counted.collect()}


def test_training_and_run_share_what_is_prepared(spark, monkeypatch):
    """Cleaned rows, triples and pair features are made once for both."""
    from cleanspark.plans import flows as FL
    raw = FX.dirty_customers(spark, SF001)
    prepared = FL.prepare(raw)

    def refuse(*_):
        raise AssertionError("made again")

    monkeypatch.setattr(FL.C, "clean_groups", refuse)
    monkeypatch.setattr(FL.PR, "candidate_pairs", refuse)
    trained = FL.train_models(raw, num_trees=5, prepared=prepared)
    result = FL.run_with(raw, trained.dedup_model, trained.anomaly_model, prepared=prepared)
    assert result.report.first()["dedup_variant"] == "model" and result.final.count() > 0


def test_scored_stream_has_a_file_for_each_core(spark, monkeypatch):
    from cleanspark.plans import catalog
    seen = {}
    staged = catalog.ST.stage_as_files
    monkeypatch.setattr(catalog.ST, "stage_as_files", lambda s, df, name: seen.update(parts=df.rdd.getNumPartitions()) or staged(s, df, name))
    assert tuple(catalog.QUERIES["stream_score"](spark, SF001).first()) == (True, True)
    assert seen["parts"] == 2 * spark.sparkContext.defaultParallelism


def test_forest_is_trained_where_ids_repeat(spark, tmp_path):
    """Beyond a million customers the ids of planted copies are those of other customers."""
    keys = [*range(1, 150), *range(1_000_001, 1_000_150)]
    spark.createDataFrame([(k, f"c{k}", k % 3, float(k % 90)) for k in keys], "c_custkey long, c_name string, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(n, f"nation {n}") for n in range(3)], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    assert not PR.is_unique(catalog.clean(spark, str(tmp_path)), "customer_id")
    rows = catalog.q_dup_model_train(spark, str(tmp_path)).collect()
    assert [r.feature for r in rows] == list(DD.FEATURES) and sum(r.importance for r in rows) == pytest.approx(1.0)
