"""Compiled tables on storage (A6, A7), routing."""

import pytest
from conftest import SF001
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pktsieve.operators.dtree_score import score_dt
from pktsieve.operators.kmeans import score_km
from pktsieve.plans.models import DT_ID, KM_ID, dt_without_rule
from pktsieve.session import scratch_path
from pktsieve.sinks.tables import read_dt_tables, read_km_tables, route, write_dt_tables, write_km_tables
from pktsieve.sources.fixtures import grid_from


def test_tables_round_trip(spark, dt, km):
    base = scratch_path(spark, "t_tables")
    write_dt_tables(dt, f"{base}/dt")
    write_km_tables(km, f"{base}/km")
    dt2, km2 = read_dt_tables(spark, f"{base}/dt"), read_km_tables(spark, f"{base}/km")
    g = grid_from(spark, SF001)
    a = score_dt(g, dt, model_id=DT_ID)
    b = score_dt(g, dt2, model_id=DT_ID)
    assert a.exceptAll(b).count() == 0
    assert score_km(g, km, model_id=KM_ID).exceptAll(score_km(g, km2, model_id=KM_ID)).count() == 0
    assert spark.read.parquet(f"{base}/dt/dt_threshold").count() == 34


def test_route_keeps_every_packet(spark):
    out = score_dt(grid_from(spark, SF001), dt_without_rule(spark, 10), model_id=DT_ID)
    path = scratch_path(spark, "t_route")
    route(out, path, files_per_port=3)
    w = spark.read.parquet(path)
    assert w.count() == out.count()
    assert w.filter("route = 'dropped'").count() == out.filter("outcome = 'drop'").count()
    per_port = {r.egress_port: r["count"] for r in w.filter("route = 'sent'").groupBy("egress_port").count().collect()}
    expect = {r.egress_port: r["count"] for r in out.filter("outcome != 'drop'").groupBy("egress_port").count().collect()}
    assert per_port == expect
    assert w.filter(F.col("route") == "sent").filter(F.col("egress_port").isNull()).count() == 0


def test_route_rerun_replaces_its_own_run(spark):
    out = score_dt(grid_from(spark, SF001), dt_without_rule(spark, 10), model_id=DT_ID)
    path = scratch_path(spark, "t_route_run")
    for run in ("a", "a", "b"):
        route(out, path, run_id=run)
    n = out.count()
    assert {r["run"]: r["count"] for r in spark.read.parquet(path).groupBy("run").count().collect()} == {"a": n, "b": n}
    with pytest.raises(AnalysisException):
        route(out, path)
