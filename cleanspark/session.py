"""Session helpers: a local session for tests and benches, lineage cuts that respect the cluster's settings."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cleanspark") -> SparkSession:
    """A local session for tests and the bench. On a cluster, pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CLEANSPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names (``spark.checkpoint.dir``), if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables. A cluster must name one in ``spark.checkpoint.dir``; only a local
    master without it (tests, a laptop: one machine) gets a scratch folder."""
    found = checkpoint_dir(spark)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cleanspark-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: later plans start from a leaf with known
    sizes, nothing is recomputed, and the table survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``cleanspark`` importable in the Python workers (Arrow UDFs, grouped functions pickle references to its
    functions): zip the package once per application and ``addPyFile`` it, as ``--py-files`` would."""
    import zipfile

    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import cleanspark
    root = os.path.dirname(os.path.abspath(cleanspark.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="cleanspark-pkg-"), "cleanspark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
