"""Structured Streaming jobs (H1, H2, H3) and windowed counts.

Scoring is stateless: the same projections as the batch jobs run on every
micro-batch, so a stream and a batch over the same rows give the same
output. Sinks are files with a checkpoint (exactly-once); ``foreachBatch``
is used where each batch must re-read the current model tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dtree_compile import DTModel
from ..operators.dtree_score import score_dt
from ..operators.kmeans import KMModel, score_km
from ..session import scratch_path
from ..sources.fixtures import PACKETS_GRID_SQL


def read_table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A file source over a parquet table path (a directory, or one file)."""
    static = spark.read.parquet(path)
    r = spark.readStream.schema(static.schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if os.path.isfile(path) or path.endswith(".parquet"):
        parent = os.path.dirname(path.rstrip("/"))
        # a stream takes folders or globs: one that only this name matches
        exact = path.rstrip("/")
        return r.option("basePath", parent).parquet(f"{exact[:-1]}[{exact[-1]}]")
    return r.parquet(path)


def grid_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid packets as a stream over ``events`` (A1 for streams)."""
    ev = read_table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    return spark.sql(PACKETS_GRID_SQL, events=ev)


def score_dt_stream(stream: DataFrame, model: DTModel, model_id: str) -> DataFrame:
    """H1: tree scoring on a stream, no state."""
    return score_dt(stream, model, model_id=model_id, keep=["ts"])


def score_km_stream(stream: DataFrame, model: KMModel, model_id: str) -> DataFrame:
    """H2: k-means scoring on a stream, no state."""
    return score_km(stream, model, model_id=model_id, keep=["ts"])


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Run a stream to completion (availableNow) into a parquet table in the
    shared work folder, with its checkpoint beside it; return the table."""
    base = scratch_path(spark, name)
    w = stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/_checkpoint")
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start(f"{base}/data")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/data")


def run_updates_to_table(spark: SparkSession, counts: DataFrame, name: str) -> DataFrame:
    """Run ``windowed_counts`` of a stream to completion in update mode; return every window's last count.

    Each micro-batch writes the windows it changed to its own folder, which a
    retry overwrites, so windows still open when the data ends are in the
    result. Only rows that come after the watermark has passed their window
    are left out, as in append mode.
    """
    base = scratch_path(spark, name)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/data/epoch={epoch_id}")

    q = (
        counts.writeStream.outputMode("update").foreachBatch(per_batch)
        .option("checkpointLocation", f"{base}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    keys = [c for c in counts.columns if c != "n_packets"]
    return spark.read.parquet(f"{base}/data").groupBy(*keys).agg(F.max_by("n_packets", "epoch").alias("n_packets"))


def run_counting_late(spark: SparkSession, scored: DataFrame, name: str, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """X2 with late rows counted: (window_start, class_id, egress_port, n_packets, n_late) of a stream run to completion.

    A row is late if its window has ended by the watermark, which is the
    latest event time of the batches before its own less ``delay``. Windows on time
    are counted as they come, late rows go to the side table ``late`` and are
    counted per window and port; together they are all rows. A batch writes its
    counts, its late rows and its own latest time to folders of its number,
    which a retry replaces, so the watermark of a retried batch is the same.
    """
    base = scratch_path(spark, name)
    plain = scored.withColumn("ts", as_instant(scored, "ts"))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        mark = None
        if epoch_id:
            marks = spark.read.schema("latest timestamp, epoch long").parquet(f"{base}/marks")
            mark = marks.where(F.col("epoch") < epoch_id).agg(F.max("latest")).first()[0]
        placed = batch.withColumn("w", F.window("ts", size))
        gone = F.lit(False) if mark is None else F.col("w.end") <= F.lit(mark) - F.expr(f"INTERVAL {delay}")
        placed = placed.withColumn("late", gone)
        placed.where("late").drop("w", "late").write.mode("overwrite").parquet(f"{base}/late/epoch={epoch_id}")
        counts = placed.groupBy(F.unix_seconds(F.col("w.start")).alias("window_start"), "class_id", "egress_port").agg(
            F.count_if(~F.col("late")).alias("n_packets"), F.count_if(F.col("late")).alias("n_late")
        )
        counts.write.mode("overwrite").parquet(f"{base}/counts/epoch={epoch_id}")
        batch.agg(F.max("ts").alias("latest")).write.mode("overwrite").parquet(f"{base}/marks/epoch={epoch_id}")

    q = (
        plain.writeStream.foreachBatch(per_batch).option("checkpointLocation", f"{base}/_checkpoint")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    parts = spark.read.parquet(f"{base}/counts")
    return parts.groupBy("window_start", "class_id", "egress_port").agg(
        F.sum("n_packets").cast("long").alias("n_packets"), F.sum("n_late").cast("long").alias("n_late")
    )


def score_reloading(
    spark: SparkSession,
    stream: DataFrame,
    tables_path: str,
    model_id: str,
    out_path: str,
    checkpoint: str,
    on_batch=None,
) -> None:
    """H3: each micro-batch re-reads the compiled tables at ``tables_path``, so
    a recompiled model takes effect at the next batch without a restart.

    Output goes to ``out_path/epoch=<id>``; a retried batch overwrites its own
    folder, so the sink stays exactly-once. ``on_batch(epoch_id)`` runs after
    each batch (metrics, or a model swap in tests).
    """
    from ..sinks.tables import read_dt_tables

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        model = read_dt_tables(spark, tables_path)
        out = score_dt(batch, model, model_id=model_id)
        out.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")
        if on_batch is not None:
            on_batch(epoch_id)

    q = (
        stream.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def as_instant(df: DataFrame, col: str) -> F.Column:
    """A TIMESTAMP column from ``col``; TIMESTAMP_NTZ is taken as UTC wall time."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
        return F.timestamp_micros(micros)
    return F.col(col).cast("timestamp")


def windowed_counts(scored: DataFrame, size: str = "1 hour", delay: str | None = None) -> DataFrame:
    """Packets per event-time window, class and port.

    ``ts`` becomes a TIMESTAMP (watermarks need it). A TIMESTAMP_NTZ is
    read as UTC wall-clock time without going through the session time zone,
    so windows do not move with ``spark.sql.session.timeZone``. On a stream
    pass ``delay`` for the watermark; windows are emitted once it passes them.
    """
    df = scored.withColumn("ts", as_instant(scored, "ts"))
    if delay is not None:
        df = df.withWatermark("ts", delay)
    g = df.groupBy(F.window("ts", size).alias("w"), "class_id", "egress_port").agg(
        F.count(F.lit(1)).alias("n_packets")
    )
    return g.select(
        F.unix_seconds(F.col("w.start")).alias("window_start"), "class_id", "egress_port", "n_packets"
    )
