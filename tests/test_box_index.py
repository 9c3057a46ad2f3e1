"""First-match index and cell audit against looking at every rule."""

import itertools
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from pktsieve.constants import DT_FEATURES, FEATURE_MAX
from pktsieve.operators import audit, box_index
from pktsieve.operators.dtree_compile import compile_from_lines
from pktsieve.operators.dtree_score import eval_rules, rule_conditions, rules_index, score_dt
from pktsieve.sources.models import model_lines_from_text

BOX = "model_id string, rule_id int, class int, lo array<int>, hi array<int>"


def random_boxes(rnd, n, narrow):
    out = []
    for r in range(n):
        lo, hi = [0] * 5, [FEATURE_MAX[f] for f in DT_FEATURES]
        for i in range(5):
            if rnd.random() < 0.6:
                a = rnd.randrange(hi[i] + 1)
                b = min(hi[i], a + rnd.randrange(1 + hi[i] // narrow))
                lo[i], hi[i] = (a, b) if rnd.random() < 0.7 else (0, b)
        out.append(("m%d" % (r % 2), r, r % 5, lo, hi))
    return out


def tree_leaves(rnd, lo, hi, depth):
    """The leaves of a random tree: boxes that tile the space."""
    if depth == 0:
        return [(lo, hi)]
    f = rnd.choice([i for i in range(5) if hi[i] > lo[i]])
    cut = rnd.randrange(lo[f], hi[f])
    top, bottom = list(hi), list(lo)
    top[f], bottom[f] = cut, cut + 1
    return tree_leaves(rnd, lo, top, depth - 1) + tree_leaves(rnd, bottom, hi, depth - 1)


@pytest.mark.parametrize("few, spread", [(2000, 16), (30, 16), (30, 0)])  # one group; level by level; no room to cut
def test_first_match_equals_every_rule(spark, monkeypatch, few, spread):
    monkeypatch.setattr(box_index, "FEW", few)
    monkeypatch.setattr(box_index, "SPREAD", spread)
    rnd = random.Random(few)
    rows = random_boxes(rnd, 90, 3)
    leaves = tree_leaves(rnd, [0] * 5, [FEATURE_MAX[f] for f in DT_FEATURES], 6)
    rnd.shuffle(leaves)
    rows += [("tree", i, i % 5, lo, hi) for i, (lo, hi) in enumerate(leaves)]
    rows += [("all", 0, 3, [0] * 5, [FEATURE_MAX[f] for f in DT_FEATURES])]
    models = spark.createDataFrame([("m0",), ("m1",), ("tree",), ("all",), ("none",)], "model_id string")
    index = box_index.build(spark.createDataFrame(rows, BOX), models)
    packets = []
    for i in range(1500):
        box = rnd.choice(rows)
        p = [rnd.choice([lo, hi, max(0, lo - 1), rnd.randint(lo, hi)]) for lo, hi in zip(box[3], box[4])]
        packets.append((i, rnd.choice(["m0", "m1", "tree", "all", "none", "unknown"]), *p))
    df = spark.createDataFrame(packets, "pkt_id int, model_id string, " + ", ".join(f"{f} int" for f in DT_FEATURES))
    got = {r["pkt_id"]: (r["rule_id"], r["class_id"]) for r in index.match(df).collect()}
    for i, m, *x in packets:
        hit = [(r, c) for mm, r, c, lo, hi in rows if mm == m and all(a <= v <= b for a, v, b in zip(lo, x, hi))]
        assert got[i] == (min(hit) if hit else (None, None))


def test_no_rows_per_rule_and_packet(spark):
    """The packets' plan has one join and no generator."""
    rows = random_boxes(random.Random(1), 300, 2)
    index = box_index.build(spark.createDataFrame(rows, BOX), spark.createDataFrame([("m0",), ("m1",)], "model_id string"))
    df = spark.createDataFrame([("m0", 1, 2, 3, 4, 5)], "model_id string, " + ", ".join(f"{f} int" for f in DT_FEATURES))
    plan = index.match(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Generate" not in plan


def test_rule_lists_on_raw_values_equal_one_case(spark):
    """J6 through the index: values out of the domain, off the thresholds, and rules without conditions."""
    text = "\n".join([
        "when frame_len<=-1.5 then 1;", "when src_port>70000 then 2;", "when ttl>3 and ip_proto>6.5 and ip_proto<=6.9 then 4;",
        "when ip_proto>254.5 then 3;", "when src_port>10.5 and src_port<=1e then 2;", "when dst_port<=80.0 and dst_port>79 then 0;",
        "when frame_len>100 and src_port<=2000.25 then 4;", "when ttl<=5 then 1;",
    ])
    lines = model_lines_from_text(spark.createDataFrame([("m", text)], "model_id string, text string"))
    conds = rule_conditions(spark, lines, "m")
    rnd = random.Random(3)
    rows = [(i, "m", rnd.choice([0, 50, 100, 101, 65535]), 0, rnd.choice([0, 6, 7, 255]), rnd.choice([0, 1, 11, 2000, 2001]), rnd.choice([79, 80, 81]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "pkt_id int, model_id string, " + ", ".join(f"{f} int" for f in DT_FEATURES))
    want = {r["pkt_id"]: (r["rule_id"], r["class_id"]) for r in eval_rules(df, conds).collect()}
    from pktsieve.operators.dtree_compile import predicates, rule_lines
    from pktsieve.sources.models import parse_dt_lines

    rules = rule_lines(parse_dt_lines(lines)).withColumn("rule_id", F.col("line_no"))
    preds = predicates(rules, ["model_id", "rule_id"])
    index = rules_index(spark, preds, rules.select("model_id", "rule_id", F.col("class").cast("int").alias("class")))
    assert {r["pkt_id"]: (r["rule_id"], r["class_id"]) for r in index.match(df).collect()} == want
    assert len({w[0] for w in want.values()}) > 3


def _model(spark, texts):
    return compile_from_lines(spark, model_lines_from_text(spark.createDataFrame(texts, "model_id string, text string")))


@pytest.mark.parametrize("few", [512, 16])
def test_cells_are_counted_without_listing(spark, monkeypatch, few):
    monkeypatch.setattr(audit, "FEW", few)
    rnd = random.Random(few)
    texts, want = [], {}
    for m in range(3):
        edges = {f: sorted(rnd.sample(range(0, 250), 4)) for f in DT_FEATURES}
        lines = [f"{f} = [" + ", ".join(f"np.float64({e}.5)" for e in es) + "];" for f, es in edges.items()]
        for r in range([3, 12, 40][m]):
            conds = []
            for f in rnd.sample(DT_FEATURES, rnd.choice([1, 2, 3])):
                a, b = sorted(rnd.sample(edges[f], 2))
                conds += [f"{f}>{a}.5"] if rnd.random() < 0.6 else []
                conds += [f"{f}<={b}.5"]
            lines.append(f"when {' and '.join(conds)} then {r % 5};")
        texts.append((f"m{m}", "\n".join(lines)))
    model = _model(spark, texts)
    bins = model.bins.groupBy("model_id", "fpos").count().collect()
    for m in range(3):
        dims = [next(r["count"] for r in bins if r["model_id"] == f"m{m}" and r["fpos"] == i) for i in range(5)]
        held = np.zeros(dims, dtype=int)
        for r in model.rules.where(F.col("model_id") == f"m{m}").collect():
            held[tuple(slice(a, b + 1) for a, b in zip(r["id_start"], r["id_end"]))] += 1
        want[f"m{m}"] = (held.size, int((held == 0).sum()), int((held > 1).sum()))
    got = {r["model_id"]: (r["n_cells"], r["n_uncovered"], r["n_overlap"]) for r in audit.cell_audit(model).collect()}
    assert got == {k: tuple(map(Decimal, v)) for k, v in want.items()}
    assert any(w[1] for w in want.values()) and any(w[2] for w in want.values())


def test_many_models_score_as_table_forms(spark):
    rnd = random.Random(9)
    texts = []
    for m in range(3):
        lines = []
        for f in DT_FEATURES:
            lines.append(f"{f} = [" + ", ".join(f"np.float64({e}.5)" for e in sorted(rnd.sample(range(250), 6))) + "];")
        for r in range(20):
            conds = [f"{f}{op}{rnd.randrange(250)}.5" for f, op in itertools.product(rnd.sample(DT_FEATURES, 2), rnd.sample(["<=", ">"], 1))]
            lines.append(f"when {' and '.join(conds)} then {r % 5};")
        texts.append((f"m{m}", "\n".join(lines)))
    model = _model(spark, texts)
    rows = [(i, f"m{i % 4}", rnd.choice([1, 188, None]), 5, rnd.randrange(300), rnd.randrange(256), rnd.randrange(300), rnd.randrange(300), rnd.randrange(300))
            for i in range(600)]
    df = spark.createDataFrame(rows, "pkt_id int, model_id string, ingress_port int, ipv4_identification int, ipv4_total_len int, ipv4_protocol int, "
                                     "ether_type int, tcp_src_port int, tcp_dst_port int")
    df = df.withColumn("udp_src_port", F.lit(None).cast("int")).withColumn("udp_dst_port", F.lit(None).cast("int"))
    forms = [sorted(map(tuple, score_dt(df, model, method=m, keep=["model_id"]).select("pkt_id", "rule_id", "class_id", "egress_port", "outcome").collect()))
             for m in ("index", "cells", "ranges")]
    assert [str(x) for x in forms[0]] == [str(x) for x in forms[1]] == [str(x) for x in forms[2]]
