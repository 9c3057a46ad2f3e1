"""The SURVEY-named API: every inventory name resolves, small composed operators work."""

import pytest
from conftest import SF001, compile_text
from pyspark.sql import functions as F

from pktsieve import api

NAMES = [
    "read_packets", "decode_frames", "read_dt_model", "read_km_model", "require_centres", "write_dt_tables",
    "write_km_tables", "route", "split_dropped", "rewrite_frames", "has", "features", "bypass", "int_edge", "clamp",
    "in_domain", "predicates", "sq", "cap", "distances", "nearest", "delta", "stamp", "ipv4_checksum", "discretise",
    "match_rules", "with_default", "assign_port", "lookup_distances", "bounds_to_ids", "complete",
    "build_distance_table", "build_cells", "known", "drop_empty_rules", "distinct_thresholds", "rule_bounds",
    "id_range", "valid_rules", "rule_rows", "model_counts", "last_definition", "nearest_long", "bins",
    "number_rules", "number_centers", "first_rule", "sorted_thresholds", "with_domain_max", "assert_covers",
    "score_dt_stream", "score_km_stream", "score_reloading", "compile_dt", "compile_km", "score_dt", "score_km",
    "rewrite_capture", "eval_rules", "class_counts", "windowed_counts", "audit_model", "label_crosstab",
]


@pytest.mark.parametrize("name", NAMES)
def test_name_exists(name):
    assert callable(getattr(api, name))


def test_assert_covers(spark, dt):
    api.assert_covers(dt.bins)
    with pytest.raises(ValueError):
        api.assert_covers(dt.bins.filter("NOT (feature = 'frame_len' AND bin_id = 3)"))


def test_with_domain_max_and_sorted(spark):
    vals = spark.createDataFrame([("m", "ip_proto", 3.5), ("m", "ip_proto", 3.2)], "model_id string, feature string, value double")
    edges = api.distinct_thresholds(vals)
    got = api.with_domain_max(spark, edges, vals.select("model_id").distinct())
    ip = sorted(r.upper for r in got.filter("feature = 'ip_proto'").collect())
    assert ip == [3, 255]
    assert api.sorted_thresholds(vals).collect()[0].uppers == [3]


def test_audit_model_and_class_counts(spark, dt):
    a = api.audit_model(dt).collect()[0]
    assert (a.n_cells, a.n_uncovered, a.n_overlap, a.n_rules_without_port) == (2880, 0, 0, 0)
    m = compile_text(spark, "when src_port<=5 then 9;\n")
    assert api.audit_model(m).collect()[0].n_rules_without_port == 1
    from pktsieve.plans.models import DT_ID
    from pktsieve.sources.fixtures import grid_from

    c = api.class_counts(api.score_dt(grid_from(spark, SF001), dt, model_id=DT_ID))
    assert c.agg(F.sum("n_packets")).collect()[0][0] == 1000


def test_bypass_stamp_delta(spark):
    df = spark.createDataFrame([(188, 0xABCD, 717701073, 49728010, 33299124)], "ingress_port int, ipv4_identification int, d1 long, d2 long, d3 long")
    r = api.stamp(api.delta(api.bypass(df)).withColumn("min_dist", F.least("d1", "d2", "d3"))).collect()[0]
    assert r.bypass is True and r.bypass_egress_port == 156 and r.ipv4_identification == 0xABA4
