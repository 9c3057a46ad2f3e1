"""Model compile: golden tables (FIXTURES F1) and hostile model text (F2)."""

from bisect import bisect_left

import pytest
from conftest import compile_text
from pyspark.sql import functions as F

from pktsieve.constants import DT_FEATURES, FEATURE_MAX
from pktsieve.models.tree import DT_EDGES, DT_LEAVES, leaf_bounds, tree_text

def golden_rule(leaf):
    """The id ranges of a leaf in feature order, and its class."""
    bounds = {f: (lo, hi) for f, lo, hi in leaf_bounds(leaf)}
    ids = []
    for f in DT_FEATURES:
        lo, hi = bounds.get(f, (0, FEATURE_MAX[f]))
        ids.append((bisect_left(DT_EDGES[f], lo), bisect_left(DT_EDGES[f], hi)))
    return ids, leaf[-1]


def edges(model, model_id):
    rows = model.bins.filter(F.col("model_id") == model_id).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.feature, r.bin_id)):
        out.setdefault(r.feature, []).append(r.hi)
    return out


def rules(model, model_id="m"):
    return {
        r.rule_id: (list(zip(r.id_start, r.id_end)), r["class"])
        for r in model.rules.filter(F.col("model_id") == model_id).collect()
    }


def test_golden_thresholds(dt):
    assert edges(dt, "decision_tree") == DT_EDGES


def test_golden_bins_tile_domain(dt):
    for r in dt.bins.groupBy("feature").agg(F.collect_list(F.struct("bin_id", "lo", "hi")).alias("b")).collect():
        b = sorted(r.b)
        assert b[0].lo == 0
        for prev, cur in zip(b, b[1:]):
            assert cur.lo == prev.hi + 1


def test_golden_rules(dt):
    assert rules(dt, "decision_tree") == {i: golden_rule(leaf) for i, leaf in enumerate(DT_LEAVES)}


def test_cells_complete_and_disjoint(dt):
    from pktsieve.operators.audit import cell_audit

    a = cell_audit(dt).collect()[0]
    assert (a.n_cells, a.n_uncovered, a.n_overlap) == (2880, 0, 0)
    assert dt.cell_pairs() == 2880
    assert dt.cells().count() == 2880


def test_model_counts(dt, km):
    from pktsieve.operators.dtree_compile import model_counts
    from pktsieve.operators.kmeans import model_counts as km_counts

    r = model_counts(dt).collect()[0]
    assert (r.n_rules, r.n_features, r.n_thresholds, r.n_classes) == (32, 5, 34, 5)
    assert km_counts(km).collect()[0].n_classes == 3


FEATS = "frame_len = [np.float64(100.5)];\n"


@pytest.mark.parametrize(
    "pred, expect",
    [
        ("frame_len>=5", (0, 65535)),  # not a predicate: ignored, rule widens
        ("frame_len<5", (0, 65535)),
        ("frame_len==5", (0, 65535)),
        ("frame_len<=1e5", (0, 65535)),
        ("frame_len<=1.5e3", (0, 1)),  # read as frame_len<=1
        ("frame_len<=2951.", (0, 2951)),
        ("ttl<=5", (0, 65535)),  # unknown feature: ignored
        ("frame_len<=-1.5", (0, 0)),  # clamped, still matches 0
        ("frame_len>70000", (65535, 65535)),
        ("frame_len<=50", (0, 100)),  # not a threshold: snaps outward to the bin
    ],
)
def test_hostile_predicates(spark, pred, expect):
    from pktsieve.operators.dtree_compile import predicates, rule_bounds, rule_lines
    from pktsieve.sources.models import model_lines_from_text, parse_dt_lines

    text = FEATS + f"when {pred} then 1;\n"
    df = spark.createDataFrame([("m", text)], "model_id string, text string")
    parsed = parse_dt_lines(model_lines_from_text(df))
    r = rule_lines(parsed)
    keys = ["model_id", "line_no", "class"]
    b = rule_bounds(spark, predicates(r, keys), keys, rules=r).filter("feature = 'frame_len'").collect()[0]
    if pred == "frame_len<=50":
        m = compile_text(spark, text)
        (fl, *_), _ = rules(m)[0]
        bins = {x.bin_id: (x.lo, x.hi) for x in m.bins.filter("feature = 'frame_len'").collect()}
        assert (bins[fl[0]][0], bins[fl[1]][1]) == expect
    else:
        assert (b.lo, b.hi) == expect


def test_patterns_run_once_per_line(spark):
    """Filters on the kind of a line and the parts of a predicate don't match the patterns again."""
    from pktsieve.operators.dtree_compile import predicates, rule_lines
    from pktsieve.sources.models import model_lines_from_text, parse_dt_lines

    white = [" ", "\t", "\x1c", "\xa0", "\u1680", "\u2009", "\u202f", "\u3000"]
    lines = [f"{w}{w}when a{v}<={v}-1.5{v}and b > .5 and c <= 7 then 3 ;{w}" for w in white for v in white if v != "\x1c"]
    lines += ["\u200bwhen a<=1 then 1;", "x = [np.float64(1.5)];", " when  then 1;", "when a then 256;", ""]
    df = spark.createDataFrame([("m", "\n".join(lines))], "model_id string, text string")
    rules_only = rule_lines(parse_dt_lines(model_lines_from_text(df)))
    found = predicates(rules_only, ["line_no"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("regexp_extract(") <= 4 and "RLIKE" not in plan
    n = len(white) * (len(white) - 1)
    rows = {}
    for r in found.collect():
        rows.setdefault(r.line_no, []).append((r.feature, r.op, r.value))
    # white space within text breaks lines where the grammar says so (U+001C does); the other lines hold three predicates
    assert rows and all(sorted(v) == [("a", "<=", -1.5), ("b", ">", 0.5), ("c", "<=", 7.0)] for v in rows.values())
    assert len(rows) == n


def test_contradiction_dropped(spark):
    m = compile_text(spark, "src_port = [];\nwhen src_port<=3.5 and src_port>5.5 then 1;\nwhen src_port<=9 then 2;\n")
    got = rules(m)
    assert list(got) == [0]
    assert got[0][1] == 2  # rule ids count after removal


def test_threshold_list_quirks(spark):
    text = (
        "frame_len = [np.float64(1e5), np.float64(94.), 94.0, np.float32(2.5), np.float64(10.5), np.float64(-3.5), "
        "np.float64(70000.5)];\nwhen frame_len<=10.5 then 0;\n"
    )
    assert edges(compile_text(spark, text), "m")["frame_len"] == [10, 65535]


def test_last_feature_line_wins_and_missing_feature(spark):
    text = "ip_proto = [np.float64(3.5)];\nip_proto = [np.float64(7.5)];\nwhen ip_proto<=7.5 then 1;\n"
    e = edges(compile_text(spark, text), "m")
    assert e["ip_proto"] == [7, 255]
    assert e["src_port"] == [65535]  # missing line: one bin 0..MAX


def test_other_lines_ignored(spark):
    text = "# comment\n\n  when src_port<=5 then 3;  \r\nrandom text\nwhen  then 4;\n"
    got = rules(compile_text(spark, text))
    # "when  then 4;" fits the grammar with an empty condition: a match-all rule
    assert got == {0: ([(0, 0)] * 5, 3), 1: ([(0, 0)] * 5, 4)}


def test_class_out_of_range(spark):
    with pytest.raises(ValueError, match="class label"):
        compile_text(spark, "when src_port<=5 then 300;\n")


def test_many_models_one_run(spark):
    from pktsieve.operators.dtree_compile import compile_from_lines
    from pktsieve.sources.models import model_lines_from_text

    df = spark.createDataFrame(
        [("a", "src_port = [np.float64(9.5)];\nwhen src_port<=9.5 then 1;\n"), ("b", "when dst_port>3 then 2;\n")],
        "model_id string, text string",
    )
    m = compile_from_lines(spark, model_lines_from_text(df))
    assert rules(m, "a") == {0: ([(0, 0), (0, 0), (0, 0), (0, 0), (0, 0)], 1)}
    assert rules(m, "b")[0][1] == 2
    assert edges(m, "b")["src_port"] == [65535]


def test_kmeans_parse(spark):
    from pktsieve.operators.kmeans import compile_km_lines
    from pktsieve.sources.models import model_lines_from_text

    text = (
        "CENTRE POINT : ( 1,2,3,);\n"
        "centre point : ( 1,2,);\n"
        "centre point : ( 1,2,3,4,);\n"
        "centre point : ( -1,2,3,);\n"
        "centre point : ( 1.5,2,3,);\n"
        "junk centre point:(7,8,9,); more\n"
    )
    df = spark.createDataFrame([("k", text)], "model_id string, text string")
    m = compile_km_lines(model_lines_from_text(df))
    got = [(r.class_id, r.frame_len, r.src_port, r.dst_port) for r in m.centres.orderBy("class_id").collect()]
    assert got == [(1, 1, 2, 3), (2, 7, 8, 9)]


def test_kmeans_no_centre_fails(spark):
    from pktsieve.operators.kmeans import compile_km_lines
    from pktsieve.sources.models import model_lines_from_text

    df = spark.createDataFrame([("k", "nothing here\n")], "model_id string, text string")
    with pytest.raises(ValueError, match="no centres"):
        compile_km_lines(model_lines_from_text(df))


def test_distance_table_golden(spark, km):
    from pktsieve.operators.kmeans import build_distance_table

    t = build_distance_table(km).filter("feature = 'dst_port'")
    r = t.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("dist")[0]).alias("s"),
        F.sum((F.col("dist")[0] == 715827800).cast("int")).alias("capped"),
    ).collect()[0]
    assert (r.n, r.s, r.capped) == (65536, 33538782645316, 37935)


def test_strict_mode(spark, tmp_path):
    from pktsieve.operators.dtree_compile import compile_dt, compile_from_lines
    from pktsieve.sources.models import model_lines_from_text

    path = tmp_path / "decision_tree.txt"
    path.write_text(tree_text())
    compile_dt(spark, str(path), mode="strict")  # the shipped model is clean
    for text, what in [
        ("when frame_len>=5 then 1;\n", "unread condition"),
        ("when ttl<=5 then 1;\n", "unknown feature"),
        ("when src_port>70000 then 1;\n", "outside the domain"),
        ("when src_port<=3.5 and src_port>5.5 then 1;\n", "empty range"),
        ("frame_len = [94.0];\nwhen frame_len<=5 then 1;\n", "unreadable threshold"),
    ]:
        df = spark.createDataFrame([("m", text)], "model_id string, text string")
        with pytest.raises(ValueError, match=what):
            compile_from_lines(spark, model_lines_from_text(df), mode="strict")


def test_audit_finds_planted_faults(spark):
    from pktsieve.operators.audit import cell_audit, classes_without_port, predicate_audit
    from pktsieve.operators.dtree_score import class_port_table

    text = (
        "src_port = [np.float64(9.5), np.float64(99.5)];\n"
        "when src_port<=9.5 then 1;\n"
        "when src_port<=99.5 then 2;\n"  # overlaps the first rule on bin 0
        "when ttl<=3 and src_port<=50 then 7;\n"  # unknown feature, off-threshold value, class 7 has no port
    )
    m = compile_text(spark, text)
    a = cell_audit(m).collect()[0]
    assert (a.n_cells, a.n_uncovered, a.n_overlap) == (3, 1, 2)
    assert [r["class"] for r in classes_without_port(m.rules, class_port_table(m.model_ids())).collect()] == [7]
    df = spark.createDataFrame(
        [("m", 1, "src_port", "<=", 9.5), ("m", 2, "src_port", "<=", 99.5), ("m", 3, "ttl", "<=", 3.0),
         ("m", 3, "src_port", "<=", 50.0), ("m", 4, "dst_port", ">", 70000.0)],
        "model_id string, rule_id int, feature string, op string, value double",
    )
    p = predicate_audit(spark, df, m.bins, ["model_id", "rule_id"]).collect()[0]
    assert (p.n_predicates, p.n_unknown_feature, p.n_out_of_domain, p.n_off_threshold) == (5, 1, 1, 1)


def test_number_in_order_across_blocks(spark):
    from pktsieve.operators.numbering import number_in_order

    df = spark.createDataFrame(
        [("a", p) for p in (0, 3, 7, 8, 15, 16, 40)] + [("b", p) for p in (5, 6, 33)], "k string, pos int"
    )
    got = {(r.k, r.pos): r.n for r in number_in_order(df, "k", "pos", "n", block=8).collect()}
    assert [got[("a", p)] for p in (0, 3, 7, 8, 15, 16, 40)] == list(range(7))
    assert [got[("b", p)] for p in (5, 6, 33)] == [0, 1, 2]
