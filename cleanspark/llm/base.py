"""Small helpers shared by the operators: column access that survives odd names, table reads, lineage cuts."""
from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space of the data contracts (blank, tab to carriage return).
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def c(name: str) -> Column:
    """The column of exactly this name, dots and back-quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under the names ``doc_id`` and ``text``: whatever else the input holds, also columns
    that are called like the operator's own, stays outside of the plan."""
    return df.select(c(id_col).alias("doc_id"), c(text_col).cast("string").alias("text"))


#: Most bytes of an Arrow batch between Spark and a Python worker; Spark's own bound is 64 MB.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``BATCH_BYTES``: a batch lies in the executor's buffers and in the worker at
    the same time. A smaller setting of the user's stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def frugal(run):
    """``run``, a function over batches, whose worker gives free memory back when a task ends: Python workers outlive their
    tasks, and those of an executor stand beside each other and its heap."""
    @functools.wraps(run)
    def out(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # a C library without it
                pass

    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``. Only where that is unset and the master
    is local (tests) a scratch folder is set; a cluster without the setting is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="llm-shared-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it survives lost executors and starts later plans from a leaf."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a key that meet one copy of what they look up, and keys that may have more, at most.
COPY_ROWS, HOT_KEYS = 10_000, 100_000


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], by: str, how: str = "inner", rows: int = COPY_ROWS) -> DataFrame:
    """``left`` joined with ``right``, whose ``keys`` are unique, so that no key is one task: where more than ``rows`` rows of
    ``left`` have a key, the row of ``right`` is repeated as often as their counted number asks for and they are dealt over
    the copies by the column ``by``. ``left`` is read twice and should be a written table. The list of such keys is
    broadcast; it has HOT_KEYS rows at most, as ``rows`` grows with the table."""
    limit = max(rows, left.count() // HOT_KEYS)
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies")).filter(F.col("__copies") > limit).select(
        *keys, F.ceil(F.col("__copies") / limit).cast("int").alias("__copies"))
    copies = F.coalesce("__copies", F.lit(1))
    dealt = left.join(F.broadcast(hot), keys, "left").withColumn("__copy", F.pmod(F.xxhash64(by, F.lit(7)), copies).cast("int")).drop("__copies")
    repeated = right.join(F.broadcast(hot), keys, "left").withColumn("__copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("__copies")
    return dealt.join(repeated, [*keys, "__copy"], how).drop("__copy")
