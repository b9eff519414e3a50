"""Fuzzy deduplication: rule labels, the pair forest, and dropping later members.

J3 keeps the reference semantics - every later member of a duplicate pair goes, with no transitive closure - but
works on triples: a row ``r`` of triple ``T`` is dropped when an earlier row shares its triple (copies are
duplicates: similarity 1.0) or when some triple ``P`` paired with ``T`` has a first row smaller than ``r``. That needs
one ``min`` per triple, never the row-by-row expansion of the pairs. "Earlier" is the order of the row key, which is
unique: by default the number that ``pairs.with_row_id`` gives each row.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import pairs as PR

# The rule's and the model's thresholds, and the forest's features.
RULE_THRESHOLD = 0.7
MODEL_THRESHOLD = 0.75
FEATURES = ("name_sim", "email_sim", "phone_sim", "avg_sim")


def rule_label(threshold: float = RULE_THRESHOLD):
    """Weak label ``avg_sim > threshold`` as 0/1."""
    return (F.col("avg_sim") > F.lit(threshold)).cast("int")


def rule_triple_pairs(t: DataFrame, keys: Sequence[str] = PR.DEFAULT_KEYS,
                      threshold: float = RULE_THRESHOLD, **kw) -> DataFrame:
    """Triple pairs whose mean similarity exceeds ``threshold``, with both sides' ``copies``.

    Values are joined once; what their lengths rule out (``indel <= 2 min / sum``, name at most 1: lossless) never
    reaches the one Python step."""
    valued = PR.with_values(t, PR.candidate_pairs(t, keys, **kw))
    bound = (F.lit(1.0) + PR._length_bound("email") + PR._length_bound("phone")) / 3.0
    return PR.similarities(valued.where(bound > F.lit(threshold))).where(F.col("avg_sim") > F.lit(threshold))


def rule_pairs(df: DataFrame, key: str = PR.ROW_ID, keys: Sequence[str] = PR.DEFAULT_KEYS,
               threshold: float = RULE_THRESHOLD, **kw) -> DataFrame:
    """Duplicate pairs by the rule, as ``(row_i, row_j, sims...)`` incl. copy edges. ``key`` must be unique."""
    PR.require_unique(df, key)
    t = PR.triples(df, key)
    tp = rule_triple_pairs(t, keys, threshold, **kw).drop("copies_i", "copies_j").withColumnRenamed("tid_i", "row_i") \
        .withColumnRenamed("tid_j", "row_j")
    return tp.unionByName(PR.copy_edges(df, t, key))


def dropped_rows(df: DataFrame, dup_triple_pairs: DataFrame, key: str = PR.ROW_ID,
                 copies_are_duplicates: bool = True, t: DataFrame | None = None) -> DataFrame:
    """``(key, reason)`` for every row J3 drops; reason ``copy`` (earlier row with the same triple) or ``fuzzy``.

    The smallest partner is joined to the triples, one row each; only triples that can drop a row are then looked up."""
    t = t if t is not None else PR.triples(df, key)
    both = dup_triple_pairs.select(F.col("tid_j").alias("tid"), F.col("tid_i").alias("partner")).unionByName(
        dup_triple_pairs.select(F.col("tid_i").alias("tid"), F.col("tid_j").alias("partner")))
    pm = both.groupBy("tid").agg(F.min("partner").alias("partner_min"))
    acting = t.join(pm, "tid", "left").where((F.lit(copies_are_duplicates) & (F.col("copies") > 1)) | F.col("partner_min").isNotNull())
    r = PR.look_up(df, acting, ["tid", "partner_min"], key)
    copy = F.lit(copies_are_duplicates) & (F.col(key) > F.col("tid"))
    fuzzy = F.coalesce(F.col(key) > F.col("partner_min"), F.lit(False))
    return r.where(copy | fuzzy).select(key, F.when(copy, F.lit("copy")).otherwise(F.lit("fuzzy")).alias("reason"))


def drop_later_duplicates(df: DataFrame, dropped: DataFrame, key: str = PR.ROW_ID) -> DataFrame:
    """The input without the dropped rows (anti join on the unique key)."""
    return df.join(dropped.select(key), key, "left_anti")


def dedup_rule(df: DataFrame, key: str | None = None, keys: Sequence[str] = PR.DEFAULT_KEYS,
               threshold: float = RULE_THRESHOLD, **kw) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rule variant of the run: ``(kept rows, dropped (key, reason), duplicate triple pairs)``.

    Without ``key`` rows are numbered (``with_row_id``), which any table allows; a key given must be unique."""
    if key is None:
        key = PR.ROW_ID
        df = df if key in df.columns else PR.with_row_id(df)
    else:
        PR.require_unique(df, key)
    t = PR.triples(df, key)
    tp = cut_lineage(rule_triple_pairs(t, keys, threshold, **kw))
    dropped = cut_lineage(dropped_rows(df, tp, key, True, t))
    return drop_later_duplicates(df, dropped, key), dropped, tp


# ---------------------------------------------------------------- the pair forest

def train_dedup_model(features: DataFrame, num_trees: int = 100, seed: int = 42,
                      negative_fraction: float | None = None) -> PipelineModel | None:
    """Random forest on the four similarities, labelled by the rule. No pairs -> None.

    ``negative_fraction`` samples the (dominant) negative class with a fixed seed; default keeps all rows.
    """
    data = features.select(*FEATURES).withColumn("label", rule_label())
    if negative_fraction is not None:
        data = data.sampleBy("label", {0: negative_fraction, 1: 1.0}, seed)
    if not data.take(1):
        return None
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees, seed=seed)
    return Pipeline(stages=[assembler, forest]).fit(data)


def model_classes(model: PipelineModel) -> int:
    """How many classes the forest learned to tell apart; 1 also when every tree is a single leaf, which is what a
    training set of duplicates only leaves behind."""
    forest = model.stages[-1]
    return 1 if forest.totalNumNodes == forest.getNumTrees else int(forest.numClasses)


def predict_pairs(features: DataFrame, model: PipelineModel | None,
                  threshold: float = MODEL_THRESHOLD) -> DataFrame:
    """D6 + F5: rows of ``features`` whose duplicate probability is at least ``threshold``.

    D7: a model that saw one class cannot give a duplicate probability; no pair is predicted (as the reference's
    caller ends up doing), and ``model_classes`` lets the caller report it.
    """
    if model is None or model_classes(model) < 2:
        return features.where(F.lit(False)).withColumn("proba", F.lit(None).cast("double"))
    scored = model.transform(features)
    proba = vector_to_array("probability")[1]
    return scored.withColumn("proba", proba).where(F.col("proba") >= F.lit(threshold)) \
                 .drop("features", "rawPrediction", "probability", "prediction")


def copies_predicted_duplicate(model: PipelineModel | None, threshold: float = MODEL_THRESHOLD) -> bool:
    """Whether the model calls two identical triples (all similarities 1.0) duplicates."""
    if model is None or model_classes(model) < 2:
        return False
    from pyspark.sql import SparkSession
    one = SparkSession.getActiveSession().createDataFrame([(1.0, 1.0, 1.0, 1.0)], list(FEATURES))
    return predict_pairs(one, model, threshold).count() > 0


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted model directory (overwrite)."""
    model.write().overwrite().save(path)


def path_exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_model(spark, path: str) -> PipelineModel | None:
    """A missing model is ``None``; any other failure surfaces."""
    if not path_exists(spark, path):
        return None
    return PipelineModel.load(path)
