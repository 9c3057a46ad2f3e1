"""Scoring: expected counts (F3, F6), single-row vectors (F5), control sums, paths agree."""

import pytest
from conftest import SF001, shuffles_over
from pyspark.sql import functions as F

from pktsieve.functions.arith import delta_u32, ipv4_checksum, sq, stamp_identification
from pktsieve.functions.features import features
from pktsieve.operators.dtree_score import InlineDT, eval_rules, rule_conditions, score_dt
from pktsieve.operators.kmeans import centres_of, delta3, distances_inline, nearest, score_km
from pktsieve.plans.models import DT_ID, KM_ID, dt_lines, dt_without_rule, two_trees
from pktsieve.sources.fixtures import bulk_from, grid_from


def counts(df, col="class_id"):
    return {r[0]: r[1] for r in df.filter(F.col("outcome") != "bypass").groupBy(col).count().collect()}


def test_grid_counts_sf0001(spark, dt, km):
    g = grid_from(spark, SF001)
    d = score_dt(g, dt, model_id=DT_ID)
    assert counts(d) == {0: 174, 1: 13, 2: 42, 3: 64, 4: 697}
    assert d.filter("outcome = 'bypass'").count() == 10
    k = score_km(g, km, model_id=KM_ID)
    assert counts(k) == {1: 690, 2: 193, 3: 107}


def test_bulk_counts_sf0001(spark, dt, km):
    b = bulk_from(spark, SF001)
    assert counts(score_dt(b, dt, model_id=DT_ID)) == {0: 177, 1: 192, 2: 2671, 3: 150, 4: 2810}
    assert counts(score_km(b, km, model_id=KM_ID)) == {1: 820, 2: 2581, 3: 2599}


@pytest.mark.parametrize("method,disc", [("cells", "expr"), ("ranges", "expr"), ("cells", "join"), ("ranges", "join")])
def test_tree_paths_agree(spark, dt, method, disc):
    g = grid_from(spark, SF001)
    base = score_dt(g, dt, model_id=DT_ID).select("pkt_id", "rule_id", "class_id", "egress_port", "outcome")
    if disc == "join":  # join path: packets carry their model
        other = score_dt(
            g.withColumn("model_id", F.lit(DT_ID)), dt, method=method, discretise_by=disc, keep=["model_id"]
        )
    else:
        other = score_dt(g, dt, model_id=DT_ID, method=method)
    other = other.select("pkt_id", "rule_id", "class_id", "egress_port", "outcome")
    assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0


def test_j3_equals_j6(spark, dt):
    f = features(grid_from(spark, SF001))
    conds = rule_conditions(spark, dt_lines(spark), DT_ID)
    direct = eval_rules(f, conds).select("pkt_id", "rule_id", "class_id")
    inl = InlineDT(dt, DT_ID)
    rule, klass = inl.match()
    compiled = f.select("pkt_id", *inl.ids()).select("pkt_id", rule.alias("rule_id"), klass.alias("class_id"))
    assert direct.exceptAll(compiled).count() == 0


def _leaf_and_mix(spark, dt, km, df):
    f = features(df)
    inl = InlineDT(dt, DT_ID)
    rule, _ = inl.match()
    d = distances_inline(f.select("*", *inl.ids()).select("*", (rule + 1).alias("leaf")), centres_of(km, KM_ID))
    return d


@pytest.mark.parametrize(
    "kind,distinct_leaf,sum_leaf,mix,capped",
    [("grid", 31, 10611, 8331740847971, 17), ("bulk", 21, 144958, 54549823719003, 697)],
)
def test_control_sums_sf0001(spark, dt, km, kind, distinct_leaf, sum_leaf, mix, capped):
    df = grid_from(spark, SF001) if kind == "grid" else bulk_from(spark, SF001)
    d = _leaf_and_mix(spark, dt, km, df)
    cents = centres_of(km, KM_ID)
    raw = [sum(sq(f, F.lit(c)) for f, c in zip(["frame_len", "src_port", "dst_port"], cen)) for cen in cents]
    d = d.select("*", *[r.alias(f"r{i + 1}") for i, r in enumerate(raw)])
    capped_cls = nearest(d, 3).select("*", F.col("class_id").alias("cc")).drop("min_dist", "class_id")
    unc = capped_cls.select(
        "*", *[F.col(f"r{i}").alias(f"d{i}x") for i in (1, 2, 3)]
    )
    unc_cls = F.when((F.col("r1") <= F.col("r2")) & (F.col("r1") <= F.col("r3")), 1).when(F.col("r2") <= F.col("r3"), 2).otherwise(3)
    r = unc.agg(
        F.countDistinct("leaf").alias("dl"),
        F.sum("leaf").alias("sl"),
        F.sum(F.col("d1") + 3 * F.col("d2") + 7 * F.col("d3")).alias("mix"),
        F.sum((unc_cls != F.col("cc")).cast("int")).alias("capped"),
    ).collect()[0]
    assert (r.dl, r.sl, r.mix, r.capped) == (distinct_leaf, sum_leaf, mix, capped)


KM_VECTORS = [
    ((0, 0, 0), (2123821, 770106348, 775011424, 2123821, 772887603, 1)),
    ((192, 1171, 846), (0, 758266344, 758325837, 0, 758325837, 1)),
    ((372, 49201, 7358), (758266344, 0, 1431679316, 0, 1431679316, 2)),
    ((218, 7690, 50028), (758325837, 1431679316, 0, 0, 3536641459, 3)),
    ((60, 40000, 40000), (1431673024, 800583545, 816413548, 800583545, 15830003, 2)),
    ((60, 65535, 65535), (1431673024, 982724700, 956319813, 956319813, 4268562409, 3)),
]


def test_km_vectors(spark, km):
    rows = [(i, a, b, c) for i, ((a, b, c), _) in enumerate(KM_VECTORS)]
    df = spark.createDataFrame(rows, "i int, frame_len int, src_port int, dst_port int")
    d = nearest(distances_inline(df, centres_of(km, KM_ID)), 3).select("*", delta3().alias("delta"))
    got = {r.i: (r.d1, r.d2, r.d3, r.min_dist, r.delta, r.class_id) for r in d.collect()}
    for i, (_, exp) in enumerate(KM_VECTORS):
        assert got[i] == exp


def test_cap_edge(spark):
    from pktsieve.functions.arith import cap

    df = spark.createDataFrame([(26754,), (26755,)], "x int")
    got = [r.v for r in df.select(cap(sq("x", F.lit(0))).alias("v")).orderBy("v").collect()]
    assert got == [715776516, 715827800]


def test_stamp_and_checksum_vectors(spark):
    df = spark.createDataFrame([(0xABCD, 717701073, 49728010, 33299124)], "ident int, d1 long, d2 long, d3 long")
    m = df.select("*", F.least("d1", "d2", "d3").alias("m"), delta_u32("d3", F.least("d1", "d2")).alias("dl"))
    assert m.select(stamp_identification("ident", "m", "dl")).collect()[0][0] == 0xABA4
    c = spark.range(1).select(
        ipv4_checksum(F.lit(4), F.lit(5), F.lit(0), F.lit(0x73), F.lit(0), F.lit(2), F.lit(0), F.lit(0x40), F.lit(0x11),
                      F.lit(0xC0A80001), F.lit(0xC0A800C7))
    )
    assert c.collect()[0][0] == 0xB861


def test_default_drop(spark):
    g = grid_from(spark, SF001)
    d = score_dt(g, dt_without_rule(spark, 10), model_id=DT_ID)
    dropped = d.filter("outcome = 'drop'")
    assert dropped.count() > 0
    assert dropped.filter("class_id IS NOT NULL OR egress_port IS NOT NULL").count() == 0


def test_many_models_by_model_id(spark):
    g = grid_from(spark, SF001).withColumn(
        "model_id", F.when(F.col("ingress_port") == 129, "dt_no_rule10").otherwise(DT_ID)
    )
    out = score_dt(g, two_trees(spark), keep=["model_id"])
    # the full tree never drops; only the copy without rule 10 can
    assert out.filter(f"model_id = '{DT_ID}' AND outcome = 'drop'").count() == 0
    assert out.filter("model_id = 'dt_no_rule10' AND outcome = 'drop'").count() > 0
    assert shuffles_over(out, "events.parquet") == 0  # no shuffle on the packet path


def test_bypass_never_stamped(spark, km):
    g = grid_from(spark, SF001)
    out = score_km(g, km, model_id=KM_ID).join(g.select("pkt_id", F.col("ipv4_identification").alias("orig")), "pkt_id")
    byp = out.filter("outcome = 'bypass'")
    assert byp.count() == 10
    assert byp.filter("NOT (ipv4_identification <=> orig)").count() == 0
    assert byp.filter("d1 IS NOT NULL OR class_id IS NOT NULL").count() == 0
    assert byp.filter("egress_port <> 156").count() == 0


def test_every_leaf_hit_sf001(spark, dt):
    """At sf0.01 the grid reaches all 32 leaves (31 at sf0.001)."""
    from conftest import SF01

    f = features(grid_from(spark, SF01))
    inl = InlineDT(dt, DT_ID)
    rule, _ = inl.match()
    leaves = f.select(*inl.ids()).select(rule.alias("r")).agg(F.countDistinct("r")).collect()[0][0]
    assert leaves == 32


def test_kmeans_any_k(spark):
    from pktsieve.operators.kmeans import compile_km_lines
    from pktsieve.sources.models import model_lines_from_text

    text = "".join(f"centre point : ( {a},{b},{c},);\n" for a, b, c in [(0, 0, 0), (100, 100, 100), (50, 60000, 60000), (9, 9, 9)])
    df = spark.createDataFrame([("k4", text)], "model_id string, text string")
    m = compile_km_lines(model_lines_from_text(df))
    pk = spark.createDataFrame(
        [(1, 130, 2048, 10, 6, 0, 8, 8, None, None), (2, 130, 2048, 100, 6, 0, 100, 100, None, None),
         (3, 130, 2048, 60, 6, 0, 60000, 59999, None, None)],
        "pkt_id long, ingress_port int, ether_type int, ipv4_total_len int, ipv4_protocol int, ipv4_identification int, "
        "tcp_src_port int, tcp_dst_port int, udp_src_port int, udp_dst_port int",
    )
    out = score_km(pk, m, model_id="k4", ports=None)
    # one schema for every number of centres but three: the array of distances, no delta
    assert "dist" in out.columns and "d1" not in out.columns
    assert out.filter("delta IS NOT NULL OR size(dist) <> 4").count() == 0
    got = {r.pkt_id: r.class_id for r in out.collect()}
    assert got == {1: 4, 2: 2, 3: 3}
    # classes beyond the shipped port map have no port: dropped, not stamped
    r = {r.pkt_id: (r.egress_port, r.outcome, r.ipv4_identification) for r in out.collect()}
    assert r[1] == (None, "drop", 0) and r[2] == (132, "forward", 0)


def test_class_without_port_is_an_error(spark):
    from conftest import compile_text

    m = compile_text(spark, "when src_port<=5 then 9;\n")
    with pytest.raises(ValueError, match="no egress port"):
        score_dt(grid_from(spark, SF001), m, model_id="m")
    g = grid_from(spark, SF001).withColumn("model_id", F.lit("m"))
    with pytest.raises(ValueError, match="no egress port"):
        score_dt(g, m, keep=["model_id"], discretise_by="join")


def test_wide_model_uses_join_path(spark):
    """More edges than the inlined form takes: same answers through the join path."""
    from conftest import compile_text
    from pyspark.sql.functions import lit

    from pktsieve.operators.dtree_score import inline_fits
    from pktsieve.sources.models import model_lines_from_text

    edges = ", ".join(f"np.float64({v}.5)" for v in range(0, 60000, 200))
    text = (
        f"src_port = [{edges}];\n"
        "dst_port = [np.float64(500.5)];\n"  # every predicate value is an edge (else compat snaps outward)
        "when src_port<=1000.5 and dst_port<=500.5 then 1;\n"
        "when src_port>1000.5 and src_port<=30000.5 then 2;\n"
        "when src_port>30000.5 then 3;\n"
        "when src_port<=1000.5 and dst_port>500.5 then 4;\n"
    )
    m = compile_text(spark, text)
    assert inline_fits(m, "m") == ()
    g = grid_from(spark, SF001)
    out = score_dt(g, m, model_id="m").select("pkt_id", "rule_id", "class_id")
    df = spark.createDataFrame([("m", text)], "model_id string, text string")
    conds = rule_conditions(spark, model_lines_from_text(df), "m")
    direct = eval_rules(features(g), conds).select("pkt_id", "rule_id", "class_id")
    byp = g.filter("ingress_port = 188").select("pkt_id")
    direct = direct.join(byp, "pkt_id", "left_anti").unionByName(
        byp.select("pkt_id", lit(None).cast("int").alias("rule_id"), lit(None).cast("int").alias("class_id"))
    )
    assert out.exceptAll(direct).count() == 0 and direct.exceptAll(out).count() == 0


def test_kmeans_many_centres_array_form(spark):
    """k = 40: array form (dist array, array_min) equals a brute-force nearest centre."""
    import random

    from pktsieve.operators.kmeans import compile_km_lines
    from pktsieve.sources.models import model_lines_from_text

    rnd = random.Random(7)
    cents = [(rnd.randrange(0, 1500), rnd.randrange(0, 65536), rnd.randrange(0, 65536)) for _ in range(40)]
    text = "".join(f"centre point : ( {a},{b},{c},);\n" for a, b, c in cents)
    df = spark.createDataFrame([("big", text)], "model_id string, text string")
    m = compile_km_lines(model_lines_from_text(df))
    g = grid_from(spark, SF001)
    out = score_km(g, m, model_id="big")
    assert "dist" in out.columns and "d1" not in out.columns
    feats = {r.pkt_id: (r.frame_len, r.src_port, r.dst_port, r.ingress_port) for r in features(g).collect()}
    cap_ = 715827800
    for r in out.collect():
        x = feats[r.pkt_id]
        if x[3] == 188:
            assert r.class_id is None and r.outcome == "bypass"
            continue
        d = [sum(min((a - b) * (a - b), cap_) for a, b in zip(x[:3], c)) for c in cents]
        best = min(range(40), key=lambda i: (d[i], i)) + 1
        assert (r.class_id, r.min_dist, list(r.dist)) == (best, d[best - 1], d)


def test_neighbour_models_leave_the_stamp_alone(spark):
    """A 3-centre model stamps its packets also beside models with more centres."""
    from pyspark.sql import functions as F

    from pktsieve.operators.kmeans import KMModel, score_km

    def centres(model_id, k):
        return [(model_id, c, 100 * c, 1000 * c, 1000 * c) for c in range(1, k + 1)]

    schema = "model_id string, class_id int, frame_len long, src_port long, dst_port long"
    fields = "model_id string, pkt_id long, ingress_port int, ether_type int, ipv4_total_len int, ipv4_protocol int, " \
        "ipv4_identification int, tcp_src_port int, tcp_dst_port int, udp_src_port int, udp_dst_port int"
    packets = [("a", i, 130, 2048, 60 * i, 6, 0xFFFF, 900 * i, 1100 * i, None, None) for i in range(1, 6)]
    pk = spark.createDataFrame(packets, fields)
    alone = KMModel(spark.createDataFrame(centres("a", 3), schema))
    want = {r.pkt_id: (r.class_id, r.min_dist, r.delta, r.ipv4_identification) for r in score_km(pk, alone, model_id="a").collect()}
    ports = spark.createDataFrame([("a", 1, 188), ("a", 2, 132), ("a", 3, 133)], "model_id string, class_id int, egress_port int")
    for k in (2, 4, 17, 300):
        both = KMModel(spark.createDataFrame(centres("a", 3) + centres("b", k), schema))
        forms = [score_km(pk, both), score_km(pk, both, model_id="a"), score_km(pk, both, model_id="a", ports=ports),
                 score_km(pk, both, model_id="a", distances_too=False), score_km(pk, both, distances_too=False)]
        if k < 300:
            forms += [score_km(pk, both, model_id="a", method="lookup"), score_km(pk, both, method="lookup")]
        for got in forms:
            got = {r.pkt_id: (r.class_id, r.min_dist, r.delta, r.ipv4_identification) for r in got.collect()}
            assert got == want, k


def test_blocks_give_the_nearest_of_any_number_of_centres(spark):
    """Blocks skipped by their bound lose nothing: ties, the cap, and centres far outside the packets."""
    import random

    from pktsieve.operators.kmeans import KMModel

    rnd = random.Random(11)
    rows, want = [], {}
    for k in (1, 2, 33, 700):
        for c in range(1, k + 1):
            at = (rnd.randrange(1500), rnd.choice([0, 65535, rnd.randrange(65536)]), rnd.choice([7, rnd.randrange(65536)]))
            rows.append((f"k{k}", c, *at))
    m = KMModel(spark.createDataFrame(rows, "model_id string, class_id int, frame_len long, src_port long, dst_port long"))
    packets = [(i, f"k{rnd.choice([1, 2, 33, 700])}", 130, 2048, rnd.randrange(1500), 6, 9, rnd.choice([0, 65535, rnd.randrange(65536)]),
                rnd.choice([7, rnd.randrange(65536)]), None, None) for i in range(400)]
    pk = spark.createDataFrame(packets, "pkt_id int, model_id string, ingress_port int, ether_type int, ipv4_total_len int, ipv4_protocol int, "
                               "ipv4_identification int, tcp_src_port int, tcp_dst_port int, udp_src_port int, udp_dst_port int")
    for p in packets:
        want[p[0]] = min((sum(min((a - b) ** 2, 715827800) for a, b in zip((p[4], p[7], p[8]), r[2:])), r[1]) for r in rows if r[0] == p[1])
    got = {r.pkt_id: (r.min_dist, r.class_id) for r in score_km(pk, m, distances_too=False).collect()}
    assert got == want
    assert {r.pkt_id: (r.min_dist, r.class_id) for r in score_km(pk, m).collect()} == want


def test_ranges_asked_for_but_too_large_to_inline_take_the_joins(spark, dt):
    from pktsieve.operators.dtree_compile import DTModel

    m = DTModel(dt.bins, dt.rules, {("inline_fits", DT_ID): ("cells",)})
    g = grid_from(spark, SF001)
    cols = ["pkt_id", "rule_id", "class_id", "egress_port", "outcome"]
    a = score_dt(g, dt, model_id=DT_ID).select(*cols)
    b = score_dt(g, m, model_id=DT_ID, method="ranges").select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
