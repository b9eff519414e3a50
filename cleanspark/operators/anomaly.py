"""Isolation forest (M1-M3), after Liu, Ting & Zhou (2008), on Spark.

Training never collects data. Each tree's sample is chosen by hashing: a row enters the candidate pool when
``h0(key) < p`` and tree ``t``'s sample when also ``h(key, t) < q`` (about twice the target size); a grouped Arrow
function per tree then keeps the ``max_samples`` rows with the smallest ``h(key, t)`` and grows the tree. Only
the pool (about ``2 x max_samples x trees`` rows, independent of the table size) is exploded per tree, and the result
does not depend on partitioning. The tree table (``trees x (2 x max_samples - 1)`` nodes at most) is the only
thing that reaches the driver; scoring broadcasts it to a vectorised pandas UDF.

Defaults follow the common library settings: 100 trees, ``max_samples = min(256, n)``, all features, contamination
0.1 -> rows scoring above the training 90th percentile are anomalies. ``anomaly_score`` is ``2^(-E[h(x)] / c(psi))``.
"""
from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .profile import numeric_columns
from .quantiles import exact_quantiles

EULER_GAMMA = 0.5772156649015329
TREE_SCHEMA = ("tree int, node int, feature int, split double, left int, right int, size long, depth int")


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful search in a binary search tree of ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """One isolation tree over ``x`` (rows x features): nodes ``(node, feature, split, left, right, size, depth)``."""
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, -1, False)]
    while stack:
        idx, depth, parent, is_right = stack.pop()
        node_id = len(nodes)
        nodes.append([node_id, -1, 0.0, -1, -1, len(idx), depth])
        if parent >= 0:
            nodes[parent][4 if is_right else 3] = node_id
        if len(idx) <= 1 or depth >= max_depth:
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        varying = np.nonzero(hi > lo)[0]
        if len(varying) == 0:
            continue
        f = int(varying[rng.integers(len(varying))])
        split = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < split
        nodes[node_id][1] = f
        nodes[node_id][2] = split
        stack.append((idx[~go_left], depth + 1, node_id, True))
        stack.append((idx[go_left], depth + 1, node_id, False))
    return [tuple(n) for n in nodes]


@dataclass
class IsolationForestModel:
    features: list[str]
    means: list[float]
    trees: pd.DataFrame            # TREE_SCHEMA columns
    psi: int
    threshold: float | None = None  # training score quantile at 1 - contamination
    contamination: float = 0.1

    def save(self, spark, path: str) -> None:
        """Tree table as Parquet plus a one-row metadata table."""
        spark.createDataFrame(self.trees, TREE_SCHEMA).write.mode("overwrite").parquet(f"{path}/trees")
        meta = json.dumps({"features": self.features, "means": self.means, "psi": self.psi,
                           "threshold": self.threshold, "contamination": self.contamination})
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @staticmethod
    def load(spark, path: str) -> IsolationForestModel | None:
        from .dedup import path_exists
        if not path_exists(spark, f"{path}/meta"):
            return None
        meta = json.loads(spark.read.json(f"{path}/meta").collect()[0]["meta"])
        trees = spark.read.parquet(f"{path}/trees").toPandas()
        return IsolationForestModel(meta["features"], meta["means"], trees, meta["psi"], meta["threshold"],
                                    meta["contamination"])


def _impute(df: DataFrame, features: Sequence[str], means: Sequence[float]):
    """Numeric nulls (and NaN) -> the given column means."""
    out = []
    for c, m in zip(features, means):
        x = F.col(f"`{c}`").cast("double")
        out.append(F.when(x.isNull() | F.isnan(x), F.lit(m)).otherwise(x).alias(c))
    return out


def column_means(df: DataFrame, features: Sequence[str], otherwise: Sequence[float] | None = None) -> list[float]:
    """The mean of each column; of a column without values its entry in ``otherwise``, else 0."""
    row = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(c) for c in features]).collect()[0]
    return [float(row[c]) if row[c] is not None else d for c, d in zip(features, otherwise or [0.0] * len(features))]


def train(df: DataFrame, key: str, features: Sequence[str] | None = None, n_trees: int = 100,
          max_samples: int = 256, contamination: float = 0.1, seed: int = 42,
          exclude: Sequence[str] = ()) -> IsolationForestModel | None:
    """M1 (+M3 threshold). ``features`` default: every numeric column (the key included, as the reference does),
    minus ``exclude``. No numeric column -> None.

    Rows are sampled by a hash of all their columns, so neither a missing nor a repeated key matters and the result does
    not depend on partitioning. A table of so many equal rows that trees stay without a sample raises an error."""
    features = [c for c in (features or numeric_columns(df)) if c not in exclude]
    if not features:
        return None
    ship_package(df.sparkSession)
    means = column_means(df, features)
    n = df.count()
    if n == 0:
        return None
    psi = min(max_samples, n)
    target = 2 * psi
    pool_share = min(1.0, target * n_trees / n)
    tree_share = min(1.0, target / (n * pool_share))
    scale = float(2 ** 63)
    identity = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed))
    pool = df.withColumn("_key", identity).withColumn("_h0", F.abs(F.xxhash64("_key")) / F.lit(scale)) \
        .where(F.col("_h0") < F.lit(pool_share)).select("_key", *_impute(df, features, means))
    # a row names the few trees it enters and is copied for those only
    def place(tree):
        return F.abs(F.xxhash64(F.col("_key"), tree, F.lit(seed + 1))) / F.lit(scale)

    entered = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda tree: place(tree) < F.lit(tree_share))
    sampled = pool.select("*", F.explode(entered).alias("tree")).withColumn("_h", place(F.col("tree")))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    feats = list(features)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_h", "_key"]).head(psi)
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        nodes = _grow(pdf[feats].to_numpy(dtype=float), rng, max_depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "size", "depth"])
        out.insert(0, "tree", tree)
        return out

    trees = sampled.groupBy("tree").applyInPandas(build, TREE_SCHEMA).toPandas()
    if trees["tree"].nunique() < n_trees:
        raise ValueError(f"only {trees['tree'].nunique()} of {n_trees} trees got a sample: too many rows are equal")
    model = IsolationForestModel(feats, means, trees, psi, None, contamination)
    # M3: the training frame's score quantile at 1 - contamination
    scored = score(df, model, with_flag=False).select("anomaly_score").persist()  # one scoring for all passes
    q = exact_quantiles(scored, ["anomaly_score"], [1.0 - contamination]).collect()[0]["value"]
    scored.unpersist()
    model.threshold = q
    return model


def _path_lengths(x: np.ndarray, trees: dict) -> np.ndarray:
    """Mean path lengths. A leaf is its own child on both sides, so all rows take as many steps as the tree is deep."""
    total = np.zeros(len(x))
    flat = x.ravel()
    start = np.arange(len(x)) * x.shape[1]
    for t in trees.values():
        leaf, own = t["feature"] < 0, np.arange(len(t["feature"]))
        feature = np.where(leaf, 0, t["feature"])
        children = np.column_stack([np.where(leaf, own, t["right"]), np.where(leaf, own, t["left"])]).ravel()
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(int(t["depth"].max())):
            node = children[2 * node + (flat[start + feature[node]] < t["split"][node])]
        total += (t["depth"] + t["cfac"])[node]
    return total / max(len(trees), 1)


def score(df: DataFrame, model: IsolationForestModel, with_flag: bool = True) -> DataFrame:
    """M2 (+M3): append ``anomaly_score`` (and ``is_anomaly``) to every row.

    Missing values become the means of the frame scored (C9); a stream, which has no mean of its own, takes the training
    means. A frame without the model's columns gets the constant fallback (F9)."""
    if not set(model.features) <= set(df.columns):
        return no_numeric_score(df)
    means = model.means if df.isStreaming else column_means(df, model.features, model.means)
    spark = df.sparkSession
    ship_package(spark)
    trees = {}
    for tid, g in model.trees.groupby("tree"):
        g = g.sort_values("node")
        trees[int(tid)] = {
            "feature": g["feature"].to_numpy(dtype=np.int64), "split": g["split"].to_numpy(dtype=float),
            "left": g["left"].to_numpy(dtype=np.int64), "right": g["right"].to_numpy(dtype=np.int64),
            "depth": g["depth"].to_numpy(dtype=float),
            "cfac": np.array([c_factor(s) for s in g["size"].to_numpy()]) * (g["feature"].to_numpy() < 0)}
    bc = spark.sparkContext.broadcast(trees)
    cpsi = c_factor(model.psi)

    @F.pandas_udf(T.DoubleType())
    def iforest_score(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        return pd.Series(np.power(2.0, -_path_lengths(x, bc.value) / cpsi))

    out = df.withColumn("anomaly_score", iforest_score(*_impute(df, model.features, means)))
    if with_flag:
        thr = model.threshold if model.threshold is not None else float("inf")
        out = out.withColumn("is_anomaly", (F.col("anomaly_score") > F.lit(thr)).cast("int"))
    return out


def no_numeric_score(df: DataFrame) -> DataFrame:
    """F9 fallback: no numeric column -> constant flag 0 and score 0.0."""
    return df.withColumn("is_anomaly", F.lit(0)).withColumn("anomaly_score", F.lit(0.0))
