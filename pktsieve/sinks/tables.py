"""Compiled model tables on storage (A6, A7) and packet routing sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dtree_compile import DTModel
from ..operators.kmeans import KMModel, build_distance_table


def _write_by_model(df: DataFrame, path: str, mode: str, *more: str) -> None:
    """Partitioned by the model's id; the id stays a data column too, so reading back never infers its type."""
    df.withColumn("model", F.col("model_id")).write.mode(mode).partitionBy("model", *more).parquet(path)


def write_dt_tables(model: DTModel, path: str, mode: str = "overwrite") -> None:
    """dt_bin, dt_threshold and dt_rule as parquet, partitioned by model."""
    base = path.rstrip("/")
    _write_by_model(model.bins, f"{base}/dt_bin", mode)
    _write_by_model(model.thresholds(), f"{base}/dt_threshold", mode)
    _write_by_model(model.rules, f"{base}/dt_rule", mode)


def read_dt_tables(spark: SparkSession, path: str) -> DTModel:
    base = path.rstrip("/")
    bins = spark.read.parquet(f"{base}/dt_bin").select("model_id", "feature", "fpos", "fmax", "bin_id", "lo", "hi")
    rules = spark.read.parquet(f"{base}/dt_rule").select(
        "model_id", "rule_id", "line_no", "class", "id_start", "id_end"
    )
    return DTModel(bins=bins, rules=rules)


def write_km_tables(model: KMModel, path: str, mode: str = "overwrite", with_distances: bool = False) -> None:
    """km_center (and optionally the per-value km_distance table)."""
    base = path.rstrip("/")
    _write_by_model(model.centres, f"{base}/km_center", mode)
    if with_distances:
        _write_by_model(build_distance_table(model), f"{base}/km_distance", mode, "feature")


def read_km_tables(spark: SparkSession, path: str) -> KMModel:
    c = spark.read.parquet(f"{path.rstrip('/')}/km_center")
    return KMModel(c.select("model_id", "class_id", "frame_len", "src_port", "dst_port"))


def split_dropped(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sent, dropped). Dropped packets (no rule / no port) go to their own
    table; nothing is silently lost."""
    dropped = scored.filter(F.col("outcome") == "drop")
    sent = scored.filter(F.col("outcome") != "drop")
    return sent, dropped


def route(
    scored: DataFrame, path: str, files_per_port: int | None = None, mode: str | None = None, salt_col: str = "pkt_id",
    run_id: str | None = None, rows_per_file: int | None = None,
) -> None:
    """A8 + A9 in one pass: sent packets land under ``route=sent/egress_port=<p>``,
    dropped ones under ``route=dropped`` (their port is NULL); nothing is lost.

    With ``run_id`` a run writes its own folder ``run=<run_id>`` and replaces
    it when it is run again, so a retried job never doubles packets. Without
    it an existing ``path`` is an error unless ``mode`` says otherwise.

    With ``rows_per_file`` the packets per port are counted first, and a port gets
    as many writers as its packets need, so a port that carries most of the
    traffic is as many files of the common size. ``files_per_port`` gives every port
    the same number of writers instead, without counting. Writers are chosen by
    a hash of ``salt_col`` (deterministic, so a recomputed task routes the same rows
    to the same writer).
    """
    dest = F.when(F.col("outcome") == "drop", F.lit("dropped")).otherwise(F.lit("sent"))
    out = scored.withColumn("route", dest)
    salt = F.xxhash64(F.col(salt_col))
    if rows_per_file:
        per = out.groupBy("route", "egress_port").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per port
        first, chain = 0, None
        for r in sorted(per, key=lambda r: (r["route"], r["egress_port"] is None, r["egress_port"] or 0)):
            writers = -(-r["n"] // rows_per_file)
            here = (F.col("route") == r["route"]) & F.col("egress_port").eqNullSafe(F.lit(r["egress_port"]).cast("int"))
            writer = F.lit(first) + F.pmod(salt, F.lit(writers)).cast("int")
            chain = F.when(here, writer) if chain is None else chain.when(here, writer)
            first += writers
        if first:
            out = out.repartitionById(first, chain)
    elif files_per_port:
        out = out.repartition("route", "egress_port", F.pmod(salt, F.lit(files_per_port)))
    target = path.rstrip("/") if run_id is None else f"{path.rstrip('/')}/run={run_id}"
    mode = mode or ("errorifexists" if run_id is None else "overwrite")
    out.write.mode(mode).partitionBy("route", "egress_port").parquet(target)


def route_stream(scored: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """A8 + A9 for a stream: the same layout as ``route`` through a file sink
    with a checkpoint (exactly-once). Returns the started query."""
    dest = F.when(F.col("outcome") == "drop", F.lit("dropped")).otherwise(F.lit("sent"))
    w = (
        scored.withColumn("route", dest)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("route", "egress_port")
    )
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(path.rstrip("/"))
