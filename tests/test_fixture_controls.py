"""FIXTURES control values: F7 compile corpus (sf0.001, sf0.01), F3 / F6 counts at sf0.01."""

import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from pktsieve.operators import dtree_compile as dc
from pktsieve.operators.dtree_score import score_dt
from pktsieve.operators.kmeans import score_km
from pktsieve.plans.models import DT_ID, KM_ID
from pktsieve.sources.fixtures import bulk_from, grid_from, predicates_bulk, table

F7 = {
    SF001: (6000, 3629, 94325531, 332, 3908, 3297, 128653),
    SF01: (60000, 36593, 1806623682, 3334, 35090, 33259, 11644106),
}


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_f7_controls(spark, sf):
    n_pred, n_bounds, sum_b, n_empty, n_bins, n_ids, sum_ids = F7[sf]
    p = predicates_bulk(spark, table(spark, sf, "lineitem"))
    assert p.count() == n_pred
    keys = ["model_id", "rule_id"]
    b = dc.rule_bounds(spark, p, keys)
    r = b.agg(F.count(F.lit(1)), F.sum(F.col("lo") + F.col("hi")), F.sum(F.col("empty").cast("int"))).collect()[0]
    assert tuple(r) == (n_bounds, sum_b, n_empty)
    bins = dc.build_thresholds(spark, p.filter("is_threshold").select("model_id", "feature", "value"),
                               p.select("model_id").distinct())
    assert bins.count() == n_bins
    ids = dc.id_ranges(b, bins).filter(~F.col("empty"))
    r = ids.agg(F.count(F.lit(1)), F.sum(F.col("id_start") + F.col("id_end"))).collect()[0]
    assert tuple(r) == (n_ids, sum_ids)


def _counts(df):
    return {r[0]: r[1] for r in df.filter("outcome != 'bypass'").groupBy("class_id").count().collect()}


def test_f3_counts_sf001(spark, dt, km):
    g = grid_from(spark, SF01)
    d = score_dt(g, dt, model_id=DT_ID)
    assert _counts(d) == {0: 1701, 1: 165, 2: 449, 3: 623, 4: 6962}
    assert d.filter("outcome = 'bypass'").count() == 100
    assert _counts(score_km(g, km, model_id=KM_ID)) == {1: 6917, 2: 1914, 3: 1069}


def test_f6_counts_sf001(spark, dt, km):
    b = bulk_from(spark, SF01)
    assert _counts(score_dt(b, dt, model_id=DT_ID)) == {0: 1865, 1: 1773, 2: 27079, 3: 1419, 4: 27864}
    assert _counts(score_km(b, km, model_id=KM_ID)) == {1: 8261, 2: 25748, 3: 25991}
