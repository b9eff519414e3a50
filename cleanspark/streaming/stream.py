"""The cleaning operators on Structured Streaming (ST-a to ST-d).

ST-a  cleaning is a projection + filter: ``clean_columns`` / ``drop_empty_rows`` run unchanged on a stream.
ST-b  exact dedup on a stream: a watermark bounds the state; ``dropDuplicatesWithinWatermark`` on a row digest.
ST-c  scoring a stream with a stored isolation forest (the Arrow UDF works per micro-batch).
ST-d  tumbling-window quality counters with a watermark.

Outputs go to files in the shared folder named by ``spark.checkpoint.dir`` (stream checkpoints too), never to a
machine-local folder on a cluster and never through the driver.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly as AN
from ..operators import clean as C
from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for stream output and checkpoints under the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def clean_stream(stream: DataFrame, year_first_order: str = "ymd") -> DataFrame:
    """ST-a: per-row cleaning and the empty-row filter (stateless)."""
    return C.drop_empty_rows(C.clean_columns(stream, year_first_order))


def row_digest(df: DataFrame, columns=None):
    cols = columns or df.columns
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols])), 256)


def dedup_stream(stream: DataFrame, event_time: str, delay: str = "1 hour", columns=None) -> DataFrame:
    """ST-b: drop exact copies that arrive within ``delay`` of each other (state bounded by the watermark)."""
    cols = columns or [c for c in stream.columns if c != event_time]
    return (stream.withColumn("_digest", row_digest(stream, cols)).withWatermark(event_time, delay)
            .dropDuplicatesWithinWatermark(["_digest"]).drop("_digest"))


def score_stream(stream: DataFrame, model: AN.IsolationForestModel) -> DataFrame:
    """ST-c: anomaly score and flag on every arriving row."""
    return AN.score(stream, model)


def quality_counters(stream: DataFrame, event_time: str, value: str, window: str = "1 day",
                     delay: str = "1 day") -> DataFrame:
    """ST-d: per tumbling window: rows, missing values, negative values, sum of values.

    A wall-clock (``TIMESTAMP_NTZ``) event time is read as UTC for the watermark, so windows align with its
    calendar; ``window_start`` is returned in the same wall-clock terms."""
    from pyspark.sql import types as T
    tz = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    ntz = isinstance(stream.schema[event_time].dataType, T.TimestampNTZType)
    et = F.to_utc_timestamp(F.col(event_time).cast("timestamp"), tz) if ntz else F.col(event_time)
    s = stream.withColumn("_et", et)
    w = F.window("_et", window)
    start = F.from_utc_timestamp(F.col("w.start"), tz).cast("timestamp_ntz") if ntz else F.col("w.start")
    return (s.withWatermark("_et", delay).groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(value).isNull()).alias("missing"),
                 F.count_if(F.col(value) < 0).alias("negative"), F.sum(value).alias("value_sum"))
            .select(start.alias("window_start"), "rows", "missing", "negative", "value_sum"))


def run_to_files(spark: SparkSession, stream: DataFrame, name: str, output_mode: str = "append",
                 fmt: str = "parquet") -> str:
    """Run ``stream`` over everything available (``availableNow``) into files; returns the output folder.
    Aggregations in complete mode are written per micro-batch with ``foreachBatch`` (overwrite)."""
    out = scratch_path(spark, name)
    ckpt = f"{out}/_checkpoint"
    data = f"{out}/data"
    if output_mode == "complete":
        def write(batch: DataFrame, _epoch: int) -> None:
            batch.write.mode("overwrite").format(fmt).save(data)
        q = (stream.writeStream.outputMode("complete").foreachBatch(write)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    else:
        q = (stream.writeStream.outputMode(output_mode).format(fmt).option("path", data)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return data


def stage_as_files(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write a batch frame as Parquet files (one per partition) in the shared folder so a file stream can
    replay it."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return path


def read_stream(spark: SparkSession, path: str, like: DataFrame, max_files: int | None = None) -> DataFrame:
    """A Parquet file stream with ``like``'s schema; ``max_files`` per micro-batch when given."""
    r = spark.readStream.schema(like.schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


# ---------------------------------------------------------------- late rows

def stage_in_order(spark: SparkSession, df: DataFrame, batch: str, batches: int, name: str) -> str:
    """Write ``df`` as one file set for each value 0 .. ``batches`` - 1 of the column ``batch``, one after the other, so that a file stream
    replays them as micro-batches in this order (``read_batches``)."""
    path = scratch_path(spark, name)
    for number in range(batches):
        df.where(F.col(batch) == number).drop(batch).coalesce(1).write.mode("append").parquet(path)
    return path


def read_batches(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stream of ``stage_in_order``: a micro-batch for each of its values."""
    return read_stream(spark, path, like, max_files=1)


def watermark_output(spark: SparkSession, stream: DataFrame, event_time: str, name: str, window: str = "1 day", delay: str = "1 day") -> str:
    """What a watermark drops, as a table: run ``stream`` (micro-batches as the windowed counters get them) and write every row with
    ``batch`` and ``late``, whether its window had closed when it came (null without an event time: such a row has no window).
    Returns the folder.

    Rows are late by the watermark that the micro-batch before had (that is how stateful operators judge them): the largest event
    time of the batches before that one less ``delay``. The event times are kept as a row a batch in the shared folder, so a run that is taken up again goes on with it, and a batch that is written twice replaces itself."""
    out = scratch_path(spark, name)
    marks, rows = f"{out}/marks", f"{out}/rows"

    def write(batch: DataFrame, epoch: int) -> None:
        known = [r for r in spark.read.json(marks).collect() if r["batch"] < epoch - 1] if epoch > 1 else []  # a row a batch
        seen = [r["most"] for r in known if r["most"] is not None]
        end = F.window(F.col(event_time), window)["end"]
        late = F.coalesce(end <= F.lit(max(seen)).cast("timestamp") - F.expr(f"INTERVAL {delay}"), F.lit(False)) if seen else F.lit(False)
        timed = batch.where(F.col(event_time).isNotNull()).select("*", F.lit(epoch).alias("batch"), late.alias("late"))
        untimed = batch.where(F.col(event_time).isNull()).select("*", F.lit(epoch).alias("batch"), F.lit(None).cast("boolean").alias("late"))
        timed.unionByName(untimed).write.mode("overwrite").parquet(f"{rows}/part={epoch}")
        batch.agg(F.max(event_time).cast("timestamp").cast("string").alias("most")).select(F.lit(epoch).alias("batch"), "most") \
            .coalesce(1).write.mode("overwrite").json(f"{marks}/part={epoch}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return rows
