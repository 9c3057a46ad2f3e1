"""Versioned models, late rows of a stream, and writers by port."""

import glob
import os
from statistics import median

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from pktsieve.operators.dtree_score import score_dt
from pktsieve.plans.models import DT_ID, dt_without_rule
from pktsieve.session import scratch_path
from pktsieve.sinks.store import ModelStore, score_from_store
from pktsieve.sinks.tables import route, write_dt_tables
from pktsieve.sources.fixtures import bulk_from, grid_from
from pktsieve.streaming.score import grid_stream, run_counting_late


def test_publish_names_whole_versions(spark, dt, km):
    store = ModelStore(spark, scratch_path(spark, "t_store"))
    assert store.current() is None
    assert store.publish(trees=dt) == 1
    assert store.load(1)[1] is None
    assert store.publish(centres=km) == 2  # the tree of version 1 stays
    trees, centres = store.load(2)
    assert trees.rules.count() == dt.rules.count() and centres.centres.count() == 3
    assert store.load(2)[0] is trees  # kept for the next batch
    # a publish that hasn't written its manifest row doesn't exist for readers
    write_dt_tables(dt_without_rule(spark, 10), f"{store.base}/versions/3")
    assert store.current() == 2
    with pytest.raises(ValueError, match="not published"):
        store.load(3)
    # and its folder is in the way of another writer of that version
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.publish(trees=dt)


def test_nothing_published_is_an_error(spark):
    store = ModelStore(spark, scratch_path(spark, "t_store_none"))
    base = scratch_path(spark, "t_store_none_out")
    with pytest.raises(Exception, match="no model published"):
        score_from_store(grid_stream(spark, SF001), store, lambda b, t, c: b, f"{base}/out", f"{base}/ck")


def test_one_batch_has_no_late_rows(spark, dt):
    out = run_counting_late(spark, score_dt(grid_stream(spark, SF001), dt, model_id=DT_ID, keep=["ts"]), "t_late_one")
    row = out.agg(F.sum("n_packets").alias("a"), F.sum("n_late").alias("b")).first()
    assert (row.a, row.b) == (1000, 0)


def test_files_of_all_ports_are_of_one_size(spark, dt):
    """The port that carries most packets is as many files of the common size."""
    scored = score_dt(bulk_from(spark, SF001), dt, model_id=DT_ID).select("pkt_id", "egress_port", "outcome")
    path = scratch_path(spark, "t_route_rows")
    route(scored, path, rows_per_file=200)
    files = [f for f in glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True)]
    per = {}
    for f in files:
        per.setdefault(os.path.dirname(f), []).append(spark.read.parquet(f).count())
    largest = max(per.values(), key=sum)
    assert sum(largest) > 0.4 * scored.count() and len(largest) > 5
    assert max(largest) <= 2 * median(largest) and max(max(x) for x in per.values()) <= 2 * 200
    back = spark.read.parquet(path).select("pkt_id", F.col("egress_port").cast("int").alias("egress_port"), "outcome")
    assert back.exceptAll(scored).count() == 0 and scored.exceptAll(back).count() == 0


def test_routing_an_empty_table(spark, dt):
    scored = score_dt(grid_from(spark, SF001).limit(0), dt, model_id=DT_ID).select("pkt_id", "egress_port", "outcome")
    path = scratch_path(spark, "t_route_none")
    route(scored, path, rows_per_file=10)
