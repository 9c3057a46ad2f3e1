"""Block equi-join point-in-interval lookup (operators/intervals.py)."""

import pytest
from pyspark.sql import functions as F

from pktsieve.operators.intervals import locate


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("block", [1, 7, 64, 4096])
def test_locate_matches_brute_force(spark, broadcast, block):
    import random

    rnd = random.Random(block)
    intervals, points = [], []
    for key in ("a", "b"):
        edges = sorted(rnd.sample(range(1, 65535), 40)) + [65535]
        lo = 0
        for i, hi in enumerate(edges):
            intervals.append((key, i, lo, hi))
            lo = hi + 1
        points += [(key, v) for v in rnd.sample(range(0, 65536), 200)] + [(key, -5), (key, 70000)]
    iv = spark.createDataFrame(intervals, "k string, bin_id int, lo int, hi int")
    pts = spark.createDataFrame(points, "k string, v int")
    got = {(r.k, r.v): r.bin for r in locate(pts, iv, ["k"], "v", {"bin_id": "bin"}, block=block, broadcast=broadcast).collect()}
    for k, v in points:
        want = next((b for kk, b, lo, hi in intervals if kk == k and lo <= v <= hi), None)
        assert got[(k, v)] == want, (k, v)
    assert len(got) == len(points)  # one output row per point
