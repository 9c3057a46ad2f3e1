"""Streams equal batch (H1, H2), reloading stream (H3), windowed counts."""

from conftest import SF001
from pyspark.sql import functions as F

from pktsieve.operators.dtree_score import score_dt
from pktsieve.operators.kmeans import score_km
from pktsieve.plans.models import DT_ID, KM_ID
from pktsieve.session import scratch_path
from pktsieve.sinks.tables import write_dt_tables
from pktsieve.sources.fixtures import PACKETS_GRID_SQL, grid_from
from pktsieve.streaming.score import (
    grid_stream,
    read_table_stream,
    run_to_table,
    run_updates_to_table,
    score_dt_stream,
    score_km_stream,
    score_reloading,
    windowed_counts,
)

DT = ["pkt_id", "rule_id", "class_id", "egress_port", "outcome"]
KM = ["pkt_id", "class_id", "egress_port", "outcome", "d1", "d2", "d3", "min_dist", "delta", "ipv4_identification"]


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dt_stream_equals_batch(spark, dt):
    s = run_to_table(spark, score_dt_stream(grid_stream(spark, SF001), dt, DT_ID), "t_dt").select(*DT)
    b = score_dt(grid_from(spark, SF001), dt, model_id=DT_ID).select(*DT)
    assert same(s, b)


def test_km_stream_equals_batch(spark, km):
    s = run_to_table(spark, score_km_stream(grid_stream(spark, SF001), km, KM_ID), "t_km").select(*KM)
    b = score_km(grid_from(spark, SF001), km, model_id=KM_ID).select(*KM)
    assert same(s, b)


def test_reloading_stream(spark, dt):
    base = scratch_path(spark, "t_reload")
    write_dt_tables(dt, f"{base}/tables")
    score_reloading(spark, grid_stream(spark, SF001), f"{base}/tables", DT_ID, f"{base}/out", f"{base}/ck")
    got = spark.read.parquet(f"{base}/out").select(*DT)
    assert same(got, score_dt(grid_from(spark, SF001), dt, model_id=DT_ID).select(*DT))


def test_windowed_stream_with_watermark(spark, dt):
    """Closed windows from the stream equal the same windows in batch."""
    s = score_dt_stream(grid_stream(spark, SF001), dt, DT_ID)
    got = run_to_table(spark, windowed_counts(s, "1 hour", "10 minutes"), "t_win")
    batch = windowed_counts(score_dt(grid_from(spark, SF001), dt, model_id=DT_ID, keep=["ts"]), "1 hour")
    assert got.count() > 0
    # every emitted window is complete and equal to batch
    assert got.exceptAll(batch).count() == 0


def test_windowed_stream_in_update_mode_is_complete(spark, dt):
    """Windows still open at the end are in the result, and equal batch."""
    s = score_dt_stream(grid_stream(spark, SF001), dt, DT_ID)
    got = run_updates_to_table(spark, windowed_counts(s, "1 hour", "10 minutes"), "t_win_upd")
    batch = windowed_counts(score_dt(grid_from(spark, SF001), dt, model_id=DT_ID, keep=["ts"]), "1 hour")
    assert same(got, batch)


def test_updates_over_several_batches_keep_the_last_count(spark, dt):
    """A window that several micro-batches change is counted once; a neighbour of the table isn't read."""
    base = scratch_path(spark, "t_win_many")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.repartition(3).write.parquet(f"{base}/events.parquet")
    ev.write.parquet(f"{base}/events.parquet.bak")
    packets = spark.sql(PACKETS_GRID_SQL, events=read_table_stream(spark, f"{base}/events.parquet", max_files=1))
    # a delay longer than the data, so that no row is late
    counts = windowed_counts(score_dt_stream(packets, dt, DT_ID), "1 hour", "3650 days")
    got = run_updates_to_table(spark, counts, "t_win_many_out")
    batch = windowed_counts(score_dt(grid_from(spark, SF001), dt, model_id=DT_ID, keep=["ts"]), "1 hour")
    assert same(got, batch)


def test_reload_takes_effect_next_batch(spark, dt):
    """Swapping the compiled tables between micro-batches changes the model used."""
    from pktsieve.plans.models import dt_without_rule

    base = scratch_path(spark, "t_reload2")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.repartitionByRange(2, "event_id").write.parquet(f"{base}/events")  # two files -> two batches
    write_dt_tables(dt, f"{base}/tables")
    alt = dt_without_rule(spark, 10)

    def swap(epoch_id):
        if epoch_id == 0:
            write_dt_tables(alt, f"{base}/tables")

    stream = read_table_stream(spark, f"{base}/events", max_files=1).transform(
        lambda e: spark.sql(PACKETS_GRID_SQL, events=e)
    )
    score_reloading(spark, stream, f"{base}/tables", DT_ID, f"{base}/out", f"{base}/ck", on_batch=swap)
    out = spark.read.parquet(f"{base}/out")
    epochs = sorted(r.epoch for r in out.select("epoch").distinct().collect())
    assert epochs == [0, 1]
    assert out.filter("epoch = 0 AND outcome = 'drop'").count() == 0  # full tree
    assert out.filter("epoch = 1 AND outcome = 'drop'").count() > 0  # tree without rule 10
    assert out.count() == ev.count()


def test_route_stream(spark):
    from pktsieve.plans.models import dt_without_rule
    from pktsieve.sinks.tables import route_stream

    base = scratch_path(spark, "t_route_stream")
    s = score_dt_stream(grid_stream(spark, SF001), dt_without_rule(spark, 10), DT_ID)
    route_stream(s.drop("ts"), f"{base}/out", f"{base}/ck").awaitTermination()
    w = spark.read.parquet(f"{base}/out")
    batch = score_dt(grid_from(spark, SF001), dt_without_rule(spark, 10), model_id=DT_ID)
    assert w.count() == batch.count()
    assert w.filter("route = 'dropped'").count() == batch.filter("outcome = 'drop'").count() > 0


def test_packet_table_stream(spark, dt):
    """A1 as a stream: a nested packet table read with readStream scores like batch."""
    from pktsieve.operators.frames import decode_frames, split_quarantine
    from pktsieve.sources.fixtures import frames_from
    from pktsieve.sources.packets import PACKET, read_packets

    ok, _ = split_quarantine(decode_frames(frames_from(spark, SF001)))
    base = scratch_path(spark, "t_pk_stream")
    ok.select(*[F.col(f.name).cast(f.dataType) if f.name != "ts" else F.lit(None).cast("timestamp").alias("ts")
                for f in PACKET.fields]).write.parquet(f"{base}/packets")
    s = score_dt(read_packets(spark, f"{base}/packets", stream=True), dt, model_id=DT_ID)
    got = run_to_table(spark, s, "t_pk_stream_out").select(*DT)
    want = score_dt(read_packets(spark, f"{base}/packets"), dt, model_id=DT_ID).select(*DT)
    assert same(got, want)
