"""Beyond the broadcast limit the same joins run as shuffle joins: same results."""

from conftest import SF001, shuffles_over
from pyspark.sql import functions as F

from pktsieve.operators import dtree_compile, dtree_score, intervals, kmeans
from pktsieve.plans.models import DT_ID, KM_ID, two_kmeans, two_trees
from pktsieve.plans.models import KM_ALT_ID
from pktsieve.sources.fixtures import grid_from


def _multi(spark):
    return grid_from(spark, SF001).withColumn(
        "model_id", F.when(F.col("ingress_port") == 129, "dt_no_rule10").otherwise(DT_ID)
    )


def test_tree_same_with_and_without_broadcast(spark, monkeypatch):
    m = two_trees(spark)
    cols = ["pkt_id", "model_id", "rule_id", "class_id", "egress_port", "outcome"]
    a = sorted(tuple(r) for r in dtree_score.score_dt(_multi(spark), m, method="ranges", discretise_by="join",
                                                       keep=["model_id"]).select(*cols).collect())
    for mod in (dtree_compile, dtree_score, intervals):
        monkeypatch.setattr(mod, "MAX_BROADCAST_ROWS", -1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dtree_score.score_dt(_multi(spark), m, method="ranges", discretise_by="join", keep=["model_id"])
        assert shuffles_over(out, "events.parquet") > 0  # really the shuffle path
        b = sorted(tuple(r) for r in out.select(*cols).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a == b


def test_kmeans_same_without_broadcast(spark, monkeypatch):
    m = two_kmeans(spark)
    g = grid_from(spark, SF001).withColumn(
        "model_id", F.when(F.col("ingress_port") == 129, KM_ALT_ID).otherwise(KM_ID)
    )
    cols = ["pkt_id", "model_id", "class_id", "egress_port", "d1", "d2", "d3", "ipv4_identification"]
    a = sorted(tuple(r) for r in kmeans.score_km(g, m, keep=["model_id"]).select(*cols).collect())
    monkeypatch.setattr(kmeans, "MAX_BROADCAST_ROWS", -1)
    monkeypatch.setattr(dtree_score, "MAX_BROADCAST_ROWS", -1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sorted(tuple(r) for r in kmeans.score_km(g, m, keep=["model_id"]).select(*cols).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a == b
