"""Composed flows (P2-P7): train, run, classic vs smart cleaning and their comparison.

Every flow returns DataFrames; one-row reports are built by union + conditional aggregate of small frames, so no
flow needs a cross join. Wall-clock timing of the flows belongs to ``bench.py``, not to the data.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import anomaly as AN
from ..operators import clean as C
from ..operators import dedup as DD
from ..operators import pairs as PR
from ..operators import profile as P
from ..session import cut_lineage
from ..sources import sinks as SK
from ..sources.readers import apply_null_tokens, map_roles, normalize_headers, read_csv, read_table, split_rejects

KEY = "customer_id"


def infer_types(df: DataFrame) -> DataFrame:
    """What a CSV reader's inference gives: a string column whose every non-null value is an integer becomes
    bigint, else every value a number -> double; otherwise it stays text. One aggregate pass."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strings:
        return df
    from ..functions.text import INTEGER_PATTERN, NUMBER_PATTERN
    aggs = []
    for c in strings:
        x = F.col(f"`{c}`")
        aggs += [F.bool_and(F.coalesce(x.rlike(INTEGER_PATTERN), F.lit(True))).alias(f"i_{c}"),
                 F.bool_and(F.coalesce(x.rlike(NUMBER_PATTERN), F.lit(True))).alias(f"n_{c}"),
                 F.count(x).alias(f"c_{c}")]
    r = df.agg(*aggs).collect()[0]
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in strings and r[f"c_{f.name}"] > 0 and r[f"i_{f.name}"]:
            out.append(c.try_cast("bigint").alias(f.name))
        elif f.name in strings and r[f"c_{f.name}"] > 0 and r[f"n_{f.name}"]:
            out.append(c.try_cast("double").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def negative_rows(df: DataFrame) -> DataFrame:
    """rows with a negative value in any numeric column (each row once)."""
    cond = F.lit(False)
    for c in P.numeric_columns(df):
        cond = cond | F.coalesce(F.col(f"`{c}`") < 0, F.lit(False))
    return df.where(cond)


def _one_row(parts: list[DataFrame], names: list[str]) -> DataFrame:
    """Union of ``(name, value)`` frames -> one row with a column per name."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.coalesce(F.max(F.when(F.col("name") == n, F.col("value"))), F.lit(0)).cast("bigint").alias(n)
                   for n in names])


def classic_flow(raw: DataFrame) -> DataFrame:
    """P5: exact distinct -> drop rows with any null -> rows with a negative numeric value.
    ``duplicates_found`` = rows removed by both steps (as the reference counts it).

    One ``groupBy`` over all columns holds every counter: copies per distinct row, and whether it is complete and
    negative."""
    typed = infer_types(apply_null_tokens(raw))
    names = [F.col(f"`{c}`") for c in typed.columns]
    complete, negative = F.lit(True), F.lit(False)
    for c in names:
        complete = complete & c.isNotNull()
    for c in P.numeric_columns(typed):
        negative = negative | F.coalesce(F.col(f"`{c}`") < 0, F.lit(False))
    groups = typed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).select("_n", complete.alias("_whole"), negative.alias("_minus"))
    row = groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_processed"),
                     F.count(F.lit(1)).cast("bigint").alias("_distinct"),
                     F.count_if(F.col("_whole")).cast("bigint").alias("rows_final"),
                     F.count_if(F.col("_whole") & F.col("_minus")).cast("bigint").alias("anomalies_found"))
    # The combined count (as the reference reports it) plus the two separate counters
    return row.select(
        F.lit("classic").alias("flow"), "rows_processed", "rows_final",
        (F.col("rows_processed") - F.col("rows_final")).alias("duplicates_found"), "anomalies_found",
        (F.col("rows_processed") - F.col("rows_final")).alias("rows_removed"),
        (F.col("rows_processed") - F.col("_distinct")).alias("exact_copies_removed"),
        (F.col("_distinct") - F.col("rows_final")).alias("null_rows_removed"))


@dataclass
class Duplicates:
    """Duplicate triples of a table with row ids: ``rows``, its ``triples``, the pairs of triples called duplicates
    (``tid_i``, ``tid_j``, ``copies_i``, ``copies_j``), and what decided."""
    rows: DataFrame
    triples: DataFrame
    pairs: DataFrame
    copies: bool
    variant: str
    warning: str | None

    def count(self) -> DataFrame:
        """All duplicate pairs of rows (one row, ``value``)."""
        return PR.row_pair_count(self.triples, self.pairs, self.copies)

    def dropped(self) -> DataFrame:
        return DD.dropped_rows(self.rows, self.pairs, PR.ROW_ID, self.copies, self.triples)


@dataclass
class Prepared:
    """What training and a run with the trained models both start from, written once: the cleaned ``groups``, their ``rows`` with row
    ids, the ``triples`` and the candidate pairs' ``features`` (with both sides' copies)."""
    groups: DataFrame
    rows: DataFrame
    triples: DataFrame
    features: DataFrame


def prepare(raw: DataFrame) -> Prepared:
    groups = C.clean_groups(raw)
    rows = PR.with_row_id(C.group_rows(groups), (KEY,), written=True)
    t = PR.triples(rows)
    return Prepared(groups, rows, t, cut_lineage(PR.similarities(PR.with_values(t, PR.candidate_pairs(t)))))


def find_duplicates(clean: DataFrame | Prepared, model: PipelineModel | None = None, threshold: float = DD.MODEL_THRESHOLD) -> Duplicates:
    """Number the rows, pair their triples and let the rule or the forest decide; similarities are computed once and the
    decided pairs written. A forest that saw one class predicts no pair (D7), which is a warning, not an error. ``clean`` is
    read several times: a written table, or what ``prepare`` made of it."""
    done = clean if isinstance(clean, Prepared) else None
    rows = done.rows if done else PR.with_row_id(clean, (KEY,), written=True)
    t = done.triples if done else PR.triples(rows)
    if model is None:
        return Duplicates(rows, t, cut_lineage(DD.rule_triple_pairs(t)), True, "rule", None)
    feats = done.features if done else PR.similarities(PR.with_values(t, PR.candidate_pairs(t)))
    pairs = cut_lineage(DD.predict_pairs(feats, model, threshold).select("tid_i", "tid_j", "copies_i", "copies_j"))
    one_class = DD.model_classes(model) < 2
    return Duplicates(rows, t, pairs, DD.copies_predicted_duplicate(model, threshold), "model",
                      "the pair model saw one class and predicts no duplicates" if one_class else None)


def smart_flow(raw: DataFrame, model: PipelineModel | None = None, threshold: float = DD.MODEL_THRESHOLD) -> DataFrame:
    """P1 cleaning -> duplicate pairs (the forest when given, else the rule; all row pairs counted) -> rows that are
    IQR outliers in any numeric column of the cleaned frame."""
    groups = C.clean_groups(raw)
    found = find_duplicates(C.group_rows(groups), model, threshold)
    clean = found.rows.drop(PR.ROW_ID)
    flagged = P.iqr_flag(clean).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_outlier")).alias("o"))
    both = F.array(F.struct(F.lit("rows_final").alias("name"), F.col("n").alias("value")),
                   F.struct(F.lit("anomalies_found").alias("name"), F.col("o").alias("value")))
    read = groups.agg(F.coalesce(F.sum(C.COPIES), F.lit(0)).cast("bigint").alias("value")).select(F.lit("rows_processed").alias("name"), "value")
    row = _one_row([read, flagged.select(F.explode(both).alias("x")).select("x.*"),
                    found.count().select(F.lit("duplicates_found").alias("name"), "value")],
                   ["rows_processed", "rows_final", "duplicates_found", "anomalies_found"])
    return row.select(F.lit("smart").alias("flow"), "*", (F.col("rows_processed") - F.col("rows_final")).alias("rows_removed"))


def flow_comparison(classic: DataFrame, smart: DataFrame) -> DataFrame:
    """Both flows side by side, differences, and the reasons that hold (durations excluded)."""
    cols = ["rows_processed", "rows_final", "duplicates_found", "anomalies_found", "rows_removed"]
    u = classic.select("flow", *cols).unionByName(smart.select("flow", *cols))
    wide = u.agg(*[F.max(F.when(F.col("flow") == f, F.col(c))).alias(f"{f}_{c}")
                   for f in ("classic", "smart") for c in cols])
    dd = F.col("smart_duplicates_found") - F.col("classic_duplicates_found")
    ad = F.col("smart_anomalies_found") - F.col("classic_anomalies_found")
    reasons = F.concat_ws("; ", F.array_compact(F.array(
        F.when(dd > 0, F.concat(F.lit("smart flow finds "), dd.cast("string"), F.lit(" more duplicates"))),
        F.when(ad > 0, F.concat(F.lit("smart flow finds "), ad.cast("string"), F.lit(" more anomalies"))))))
    return wide.select("*", dd.alias("duplicates_difference"), ad.alias("anomalies_difference"),
                       reasons.alias("reasons"))


@dataclass
class RunResult:
    clean: DataFrame
    dropped: DataFrame      # (_row_id, reason); ``clean`` without its ids keeps no trace of them
    final: DataFrame
    report: DataFrame
    duplicates: Duplicates


def run(raw: DataFrame, dedup_path: str | None = None, anomaly_path: str | None = None,
        threshold: float = DD.MODEL_THRESHOLD) -> RunResult:
    """Clean -> duplicate pairs (stored forest, or the rule when no model is stored) -> drop later members ->
    anomaly score (stored isolation forest, or the IQR flag when none) -> report. Only a missing model falls back, and
    the report says so; any other failure surfaces (X7)."""
    spark = raw.sparkSession
    return run_with(raw, DD.load_model(spark, dedup_path) if dedup_path else None,
                    AN.IsolationForestModel.load(spark, anomaly_path) if anomaly_path else None, threshold)


def run_rule(raw: DataFrame, score_model: AN.IsolationForestModel | None = None) -> RunResult:
    """P3, rule variant."""
    return run_with(raw, None, score_model)


def run_with(raw: DataFrame, dedup_model: PipelineModel | None, score_model: AN.IsolationForestModel | None,
             threshold: float = DD.MODEL_THRESHOLD, prepared: Prepared | None = None) -> RunResult:
    """P3 with models at hand. Written once each: the cleaned rows with their copies, the triples, the decided pairs, the dropped
    ids and the final table; every report figure is an aggregate over one of them, so the raw rows are read once, and not
    at all where they are ``prepared``."""
    groups = prepared.groups if prepared else C.clean_groups(raw)
    found = find_duplicates(prepared or C.group_rows(groups), dedup_model, threshold)
    dropped = cut_lineage(found.dropped())
    kept = cut_lineage(DD.drop_later_duplicates(found.rows, dropped).drop(PR.ROW_ID))
    if score_model is not None:
        final = cut_lineage(AN.score(kept, score_model))
    elif P.numeric_columns(kept):
        final = P.iqr_flag(kept, flag="_o").withColumn("is_anomaly", F.col("_o").cast("int")).drop("_o")
    else:
        final = AN.no_numeric_score(kept)
    anomaly = "isolation forest" if score_model is not None else "iqr" if P.numeric_columns(kept) else "none"
    return RunResult(found.rows.drop(PR.ROW_ID), dropped, final, run_report(groups, found, dropped, final, anomaly), found)


def run_report(groups: DataFrame, found: Duplicates, dropped: DataFrame, final: DataFrame, anomaly_variant: str) -> DataFrame:
    """One row - cleaning counters, all duplicate row pairs, rows dropped (copies / fuzzy), anomalies, final rows,
    and which variants ran. ``groups`` is what the cleaning wrote (``clean_groups``). The dropped ids stay a table, never a collected
    list."""
    drops = dropped.agg(F.count(F.lit(1)).alias("a"), F.count_if(F.col("reason") == "copy").alias("b"))
    ends = final.agg(F.coalesce(F.sum("is_anomaly"), F.lit(0)).cast("bigint").alias("a"), F.count(F.lit(1)).alias("b"))
    counters = {"rows_before": "rows_read", "empty_rows_removed": "empty_rows_removed",
                "exact_duplicates_removed": "exact_duplicates_removed", "invalid_emails": "invalid_emails",
                "invalid_dates": "invalid_dates", "negative_amount_count": "negative_amounts", "rows_after": "rows_clean"}

    def named(df: DataFrame, names: dict[str, str]) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("bigint").alias("value")) for c, n in names.items()])
        return df.select(F.explode(cells).alias("x")).select("x.*")

    parts = [named(C.group_report(groups), counters), found.count().select(F.lit("duplicate_pairs").alias("name"), "value"),
             named(drops, {"a": "rows_dropped", "b": "dropped_copies"}), named(ends, {"a": "anomalies_found", "b": "final_rows"})]
    return _one_row(parts, [*counters.values(), "duplicate_pairs", "rows_dropped", "dropped_copies", "anomalies_found", "final_rows"]).select(
        "*", F.lit(found.variant).alias("dedup_variant"), F.lit(anomaly_variant).alias("anomaly_variant"),
        F.lit(found.warning).cast("string").alias("warning"))


def run_files(spark: SparkSession, source: str | Sequence[str], out: str, fmt: str = "csv", dedup_path: str | None = None,
              anomaly_path: str | None = None, load_table: str | None = None) -> DataFrame:
    """P3 from path to path: read the source (large CSV files by many tasks), write ``clean``, ``final``, ``dropped`` and ``rejects``
    (malformed CSV records) under ``out``, then the typed load: ``loaded``, the final rows in the load's column types (S9; also as the
    catalog table ``load_table``), ``load_rejects``, the values that do not fit, and ``verified``, the row counts of all (S10). The
    stamped report with all output paths is written as JSON and returned."""
    if fmt == "csv":
        read = read_csv(spark, [source] if isinstance(source, str) else source, malformed="keep", split=True)
        good, rejects = split_rejects(cut_lineage(read))
        SK.write_table(rejects, f"{out}/rejects")
    else:
        good = read_table(spark, source, fmt)
    raw = C.integral_ids(apply_null_tokens(map_roles(normalize_headers(good))))
    result = run(raw, dedup_path, anomaly_path)
    for name, table in (("clean", result.clean), ("dropped", result.dropped), ("final", result.final)):
        SK.write_table(table, f"{out}/{name}")
    written = spark.read.parquet(f"{out}/final")
    SK.write_table(SK.typed_load(written), f"{out}/loaded")
    SK.write_table(SK.load_rejects(written, KEY), f"{out}/load_rejects")
    loaded = spark.read.parquet(f"{out}/loaded")
    if load_table:
        SK.save_table(loaded, load_table)
        loaded = spark.table(load_table)
    SK.write_table(SK.verify_counts({"clean": spark.read.parquet(f"{out}/clean"), "final": written, "loaded": loaded}), f"{out}/verified")
    names = ("clean", "dropped", "final", "loaded", "load_rejects", "verified")
    report = SK.stamp(result.report, source if isinstance(source, str) else ",".join(source)).select(
        "*", *[F.lit(f"{out}/{name}").alias(f"{name}_path") for name in names])
    SK.write_report_json(report, f"{out}/report")
    return spark.read.json(f"{out}/report")


# ---------------------------------------------------------------- P2 train, P4 profile

@dataclass
class TrainResult:
    dedup_model: PipelineModel | None
    anomaly_model: AN.IsolationForestModel | None
    report: DataFrame


def train_models(raw: DataFrame, dedup_path: str | None = None, anomaly_path: str | None = None,
                 num_trees: int = 100, seed: int = 42, prepared: Prepared | None = None) -> TrainResult:
    """Clean -> pair features -> pair forest (D5); clean -> isolation forest (M1); both saved when paths are
    given (S12). The cleaned frame is written once and feeds both fits (and a run after them, where it is ``prepared``)."""
    prepared = prepared or prepare(raw)
    rows, feats = prepared.rows, prepared.features
    dedup_model = DD.train_dedup_model(feats, num_trees=num_trees, seed=seed)
    anomaly_model = AN.train(rows.drop(PR.ROW_ID), KEY, seed=seed)
    if dedup_model is not None and dedup_path:
        DD.save_model(dedup_model, dedup_path)
    if anomaly_model is not None and anomaly_path:
        anomaly_model.save(raw.sparkSession, anomaly_path)
    report = feats.agg(F.count(F.lit(1)).cast("bigint").alias("training_pairs"),
                       F.count_if(F.col("avg_sim") > DD.RULE_THRESHOLD).cast("bigint").alias("positive_pairs")) \
        .select("*", F.lit(dedup_model is not None).alias("dedup_model"),
                F.lit(anomaly_model is not None).alias("anomaly_model"),
                F.lit(DD.model_classes(dedup_model) if dedup_model is not None else 0).alias("dedup_classes"))
    return TrainResult(dedup_model, anomaly_model, report)


def profiling(df: DataFrame, exact: bool = True) -> dict[str, DataFrame]:
    """The full profile of a table as named report frames."""
    num = P.numeric_columns(df)
    out = {"general": P.profile_table(df), "columns": P.profile_columns(df, exact),
           "missing_values": P.missing_values(df), "duplicates": P.exact_duplicates(df),
           "quality": P.quality_score(df, exact)}
    if num:
        out.update({"numeric": P.numeric_profile(df, num, exact), "outliers": P.iqr_outliers(df, num, exact=exact),
                    "normality": P.normality_jb(df, num), "correlations": P.correlations(df, num, 0.7)})
    cat = P.categorical_columns(df)
    if cat:
        out["categorical"] = P.categorical_profile(df, cat)
    return out


def profile_report(df: DataFrame, exact: bool = True) -> DataFrame:
    """P4 as one table: ``(section, column, metric, value)``, every figure of every section as text. Every section
    reads ``df``, so it is written once."""
    out = None
    for section, frame in profiling(cut_lineage(df), exact).items():
        keys = [c for c in ("column", "col1") if c in frame.columns]
        name = F.col(keys[0]).cast("string") if keys else F.lit(None).cast("string")
        cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("string").alias("value"))
                          for c in frame.columns if c not in keys])
        part = frame.select(F.lit(section).alias("section"), name.alias("column"), F.explode(cells).alias("x")).select(
            "section", "column", "x.metric", "x.value")
        out = part if out is None else out.unionByName(part)
    return out
