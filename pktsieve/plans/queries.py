"""Registered queries: one per operator group, each (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (``events`` or ``lineitem``) through
the fixture builders, so its work grows with them, and runs the library's
own operators on the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BYPASS_INGRESS_PORT
from ..functions.features import features
from ..operators import dtree_compile as dc
from ..operators.dtree_score import class_port_table, eval_rules, inline_dt, rule_conditions, rules_index, score_dt
from ..operators.kmeans import KMModel, centres_of, compile_km_lines, distances_inline, nearest_long, score_km
from ..operators.frames import decode_frames, frame_checksum, split_quarantine
from ..sources.fixtures import bulk_from, frames_from, grid_from, predicates_bulk, table
from ..operators.audit import cell_audit, classes_without_port, predicate_audit
from ..operators.numbering import number_in_order
from ..session import checkpointed, scratch_path
from ..sinks.store import ModelStore, score_from_store
from ..sinks.tables import route, write_dt_tables
from ..sources.fixtures import PACKETS_GRID_SQL
from ..sources.packets import PACKET, read_packets
from ..sources.text_lines import read_model_lines_at_volume, render_tree_lines, write_model_text
from ..streaming.score import (
    grid_stream,
    read_table_stream,
    run_counting_late,
    run_to_table,
    run_updates_to_table,
    score_dt_stream,
    score_km_stream,
    score_reloading,
    windowed_counts,
)
from .capture import rewrite_capture
from . import oracle as O
from .models import ALT_ID, DT_ID, KM_ALT_ID, KM_ID, two_kmeans, dt_lines, dt_without_rule, shipped_dt, shipped_km, two_trees

Query = Callable[[SparkSession, str], DataFrame]

DT_COLS = ["pkt_id", "rule_id", "class_id", "egress_port", "outcome"]
MIXED_K = (3, 4, 40, 1000)  # centres of the models of km_score_mixed_k
KM_COLS = ["pkt_id", "class_id", "egress_port", "outcome", "d1", "d2", "d3", "min_dist", "delta", "ipv4_identification"]


# --------------------------------------------------------------------------- packet path


def q_features(spark: SparkSession, sf: str) -> DataFrame:
    """B1-B6 on the grid packets."""
    return features(grid_from(spark, sf))


def q_dt_rules_direct(spark: SparkSession, sf: str) -> DataFrame:
    """The model's rule text evaluated directly (one CASE) on raw features."""
    conds = rule_conditions(spark, dt_lines(spark), DT_ID)
    return eval_rules(features(grid_from(spark, sf)), conds).select("pkt_id", "rule_id", "class_id")


def q_dt_discretise(spark: SparkSession, sf: str) -> DataFrame:
    """C1 (expression form): the five bin ids of every grid packet."""
    inl = inline_dt(shipped_dt(spark), DT_ID)
    d = features(grid_from(spark, sf)).select("pkt_id", *inl.ids())
    return d.select(
        "pkt_id",
        *[F.col(f"id{i}").alias(f"{name}_id") for i, name in enumerate(["frame_len", "ether_type", "ip_proto", "src_port", "dst_port"])],
    )


def q_dt_score(spark: SparkSession, sf: str) -> DataFrame:
    """J3 on the grid: discretise, cell lookup, port, bypass/forward/drop."""
    return score_dt(grid_from(spark, sf), shipped_dt(spark), model_id=DT_ID).select(*DT_COLS)


def q_dt_score_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """J3 on the volume packets (the bench query)."""
    return score_dt(bulk_from(spark, sf), shipped_dt(spark), model_id=DT_ID).select(*DT_COLS)


def q_dt_match(spark: SparkSession, sf: str) -> DataFrame:
    """Rule-range match (bit-vector form), the second path of J3, on volume packets."""
    return score_dt(bulk_from(spark, sf), shipped_dt(spark), model_id=DT_ID, method="ranges").select(*DT_COLS)


def q_dt_score_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Many models at once: the arrival port picks the model (port 129 gets the
    tree without rule 10); the first-match index joins on model_id (C2, E5)."""
    m = two_trees(spark)
    g = grid_from(spark, sf).withColumn(
        "model_id", F.when(F.col("ingress_port") == 129, F.lit(ALT_ID)).otherwise(F.lit(DT_ID))
    )
    out = score_dt(g, m, keep=["model_id"])
    return out.select("pkt_id", "model_id", "class_id", "egress_port", "outcome")


def q_dt_match_multi(spark: SparkSession, sf: str) -> DataFrame:
    """The table forms for many models: bins by the block join (C1 join form),
    rules by the bit-vector match (C2), both joined on model_id."""
    m = two_trees(spark)
    g = grid_from(spark, sf).withColumn(
        "model_id", F.when(F.col("ingress_port") == 129, F.lit(ALT_ID)).otherwise(F.lit(DT_ID))
    )
    out = score_dt(g, m, method="ranges", discretise_by="join", keep=["model_id"])
    return out.select("pkt_id", "model_id", "class_id", "egress_port", "outcome")


def q_dt_default_drop(spark: SparkSession, sf: str) -> DataFrame:
    """A copy of the tree without rule 10 drops the packets only it matched."""
    out = score_dt(grid_from(spark, sf), dt_without_rule(spark, 10), model_id=DT_ID)
    return out.select("pkt_id", "class_id", "egress_port", "outcome")


def q_dt_route_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A8/A9 summary: packets per egress port and outcome (grid)."""
    out = score_dt(grid_from(spark, sf), shipped_dt(spark), model_id=DT_ID)
    return out.groupBy("egress_port", "outcome").agg(F.count(F.lit(1)).alias("n_packets"))


def q_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Packets per class and port for both models, from one scan of the
    volume packets (both scorers run in the same pass, one aggregation)."""
    b = bulk_from(spark, sf)
    flat = [c for c in b.columns if c != "ts"]
    dt = score_dt(b, shipped_dt(spark), model_id=DT_ID, keep=flat)
    dt = dt.select(*flat, F.col("class_id").alias("dt_class"), F.col("egress_port").alias("dt_port"))
    km = score_km(dt, shipped_km(spark), model_id=KM_ID, keep=["dt_class", "dt_port"])
    both = km.select(
        F.inline(
            F.array(
                F.struct(F.lit("dt").alias("model"), F.col("dt_class").alias("class_id"), F.col("dt_port").alias("egress_port")),
                F.struct(F.lit("km").alias("model"), F.col("class_id").alias("class_id"), F.col("egress_port").alias("egress_port")),
            )
        )
    )
    return both.groupBy("model", "class_id", "egress_port").agg(F.count(F.lit(1)).alias("n_packets"))


def q_km_distances(spark: SparkSession, sf: str) -> DataFrame:
    """Capped distances to the three centres, every grid packet."""
    f = features(grid_from(spark, sf))
    return distances_inline(f, centres_of(shipped_km(spark), KM_ID)).select("pkt_id", "d1", "d2", "d3")


def q_km_score_multi(spark: SparkSession, sf: str) -> DataFrame:
    """J4 for two models at once through the model_id join (the many-model
    path): port 129 packets use the centres in reverse order."""
    b = bulk_from(spark, sf).withColumn(
        "model_id", F.when(F.col("ingress_port") == 129, F.lit(KM_ALT_ID)).otherwise(F.lit(KM_ID))
    )
    return score_km(b, two_kmeans(spark), keep=["model_id"]).select("model_id", *KM_COLS)


def centre_text(spark: SparkSession, sf: str) -> DataFrame:
    """Centre text of four models, (model_id, line_no, line): 3, 4, 40 and 1,000 centres, a line per part."""
    p = table(spark, sf, "part").select(
        "p_partkey", (20 + F.col("p_partkey") * 37 % 1481).alias("a"), (F.col("p_partkey") * 40503 % 65536).alias("b"),
        (F.col("p_partkey") * 52711 % 65536).alias("c"),
    )
    sizes = F.array(*[F.struct(F.lit(m).cast("string").alias("model_id"), F.lit(k).alias("k")) for m, k in enumerate(MIXED_K)])
    lines = p.select("*", F.inline(sizes)).where(F.col("p_partkey") < F.col("k"))
    return lines.select("model_id", F.col("p_partkey").alias("line_no"), F.format_string("Centre point : ( %d,%d,%d,);", "a", "b", "c").alias("line"))


def q_km_score_mixed_k(spark: SparkSession, sf: str) -> DataFrame:
    """J4 with models of 3, 4, 40 and 1,000 centres in one pass (A4, A5, E4, B12-B17):
    pkt_id mod 4 picks the model; blocks of far centres are skipped; packets of
    the model of three centres are stamped."""
    model = compile_km_lines(centre_text(spark, sf))
    model = KMModel(model.centres.transform(checkpointed))
    g = grid_from(spark, sf).withColumn("model_id", (F.col("pkt_id") % 4).cast("string"))
    out = score_km(g, model, keep=["model_id"], distances_too=False)
    return out.select("pkt_id", "model_id", "class_id", "egress_port", "outcome", "min_dist", "delta", "ipv4_identification")


def q_km_score(spark: SparkSession, sf: str) -> DataFrame:
    """J4 on the grid: nearest centre, port, stamp."""
    return score_km(grid_from(spark, sf), shipped_km(spark), model_id=KM_ID).select(*KM_COLS)


def q_km_score_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """J4 on the volume packets (the bench query)."""
    return score_km(bulk_from(spark, sf), shipped_km(spark), model_id=KM_ID).select(*KM_COLS)


def q_km_score_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """C8 + C5: J4 with distances from the per-value table (3 x 65,536 entries)."""
    return score_km(bulk_from(spark, sf), shipped_km(spark), model_id=KM_ID, method="lookup").select(*KM_COLS)


def q_km_nearest_long(spark: SparkSession, sf: str) -> DataFrame:
    """Arg-min over (packet, class) rows in long form (grid, unique pkt_id)."""
    f = features(grid_from(spark, sf))
    d = distances_inline(f, centres_of(shipped_km(spark), KM_ID))
    long = d.select(
        "pkt_id",
        F.inline(F.array(*[F.struct(F.lit(c).alias("class_id"), F.col(f"d{c}").alias("dist")) for c in (1, 2, 3)])),
    )
    return nearest_long(long, ["pkt_id"])


def q_label_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    """Tree class vs k-means class, one pass over the volume packets."""
    b = bulk_from(spark, sf)
    flat = [c for c in b.columns if c != "ts"]
    dt = score_dt(b, shipped_dt(spark), model_id=DT_ID, keep=flat)
    dt = dt.select(*flat, F.col("class_id").alias("dt_class"))
    km = score_km(dt, shipped_km(spark), model_id=KM_ID, keep=["dt_class"])
    return km.groupBy("dt_class", F.col("class_id").alias("km_class")).agg(F.count(F.lit(1)).alias("n_packets"))


def q_dt_route(spark: SparkSession, sf: str) -> DataFrame:
    """A8 + A9: route the tree-without-rule-10 output to per-port folders (writers
    by the packets of each port) and a dropped table, then read the written tables back."""
    out = score_dt(grid_from(spark, sf), dt_without_rule(spark, 10), model_id=DT_ID)
    path = scratch_path(spark, "route")
    route(out.select("pkt_id", "egress_port", "outcome"), path, rows_per_file=1_000_000)
    written = spark.read.parquet(path)
    return written.select("pkt_id", F.col("egress_port").cast("int").alias("egress_port"), "outcome")


def q_class_counts_windowed(spark: SparkSession, sf: str) -> DataFrame:
    """Packets per hour of event time, class and port (grid, tree)."""
    out = score_dt(grid_from(spark, sf), shipped_dt(spark), model_id=DT_ID, keep=["ts"])
    return windowed_counts(out, "1 hour")


# --------------------------------------------------------------------------- streams


def q_stream_dt_score(spark: SparkSession, sf: str) -> DataFrame:
    """H1: the grid as a stream over events, scored by the tree, file sink."""
    s = score_dt_stream(grid_stream(spark, sf), shipped_dt(spark), DT_ID)
    return run_to_table(spark, s, "stream_dt").select(*DT_COLS)


def q_stream_km_score(spark: SparkSession, sf: str) -> DataFrame:
    """H2: the grid as a stream, scored by k-means, file sink."""
    s = score_km_stream(grid_stream(spark, sf), shipped_km(spark), KM_ID)
    return run_to_table(spark, s, "stream_km").select(*KM_COLS)


def q_stream_windowed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """X2 on a stream: hourly counts per class and port with a 10-minute
    watermark, update mode, so windows still open at the end are included."""
    s = score_dt_stream(grid_stream(spark, sf), shipped_dt(spark), DT_ID)
    return run_updates_to_table(spark, windowed_counts(s, "1 hour", "10 minutes"), "stream_windows")


def q_stream_reloading(spark: SparkSession, sf: str) -> DataFrame:
    """H3 (+ A6): compiled tables written to storage; every micro-batch re-reads them."""
    base = scratch_path(spark, "reload")
    write_dt_tables(shipped_dt(spark), f"{base}/tables")
    score_reloading(
        spark, read_table_stream(spark, f"{sf.rstrip('/')}/events.parquet", max_files=1).transform(
            lambda ev: spark.sql(PACKETS_GRID_SQL, events=ev)
        ),
        f"{base}/tables", DT_ID, f"{base}/out", f"{base}/_checkpoint",
    )
    return spark.read.parquet(f"{base}/out").select(*DT_COLS)


def _halves(spark: SparkSession, sf: str, files: int = 4) -> DataFrame:
    """The grid as a stream of two batches: events of even ids in ``files`` files, then those of odd ids."""
    base = scratch_path(spark, "halves")
    events = table(spark, sf, "events")
    for odd in (0, 1):  # the source takes files in the order of their times
        events.where(F.col("event_id") % 2 == odd).repartition(files).write.mode("append").parquet(base)
    return spark.sql(PACKETS_GRID_SQL, events=read_table_stream(spark, base, max_files=files))


def q_stream_dt_score_multi(spark: SparkSession, sf: str) -> DataFrame:
    """H1 with many models in one stream: the arrival port picks the tree, the index joins the stream by model_id."""
    g = grid_stream(spark, sf).withColumn(
        "model_id", F.when(F.col("ingress_port") == 129, F.lit(ALT_ID)).otherwise(F.lit(DT_ID))
    )
    out = run_to_table(spark, score_dt(g, two_trees(spark), keep=["model_id"]), "stream_dt_multi")
    return out.select("pkt_id", "model_id", "class_id", "egress_port", "outcome")


def q_stream_model_swap(spark: SparkSession, sf: str) -> DataFrame:
    """H3 (+ A6, A7) for both kinds: after the first of two batches a new version is
    published (the tree without rule 10, the centres in reverse order); each
    batch is scored by one version."""
    store = ModelStore(spark, scratch_path(spark, "store"))
    store.publish(shipped_dt(spark), shipped_km(spark))
    turned = shipped_km(spark).centres.withColumn("class_id", (4 - F.col("class_id")).cast("int"))

    def swap(epoch_id: int) -> None:
        if epoch_id == 0:
            store.publish(dt_without_rule(spark, 10), KMModel(turned))

    def score(batch: DataFrame, trees, centres) -> DataFrame:
        flat = [c for c in batch.columns if c != "ts"]
        dt = score_dt(batch, trees, model_id=DT_ID, keep=flat)
        dt = dt.select(*flat, F.col("class_id").alias("dt_class"), F.col("egress_port").alias("dt_port"))
        km = score_km(dt, centres, model_id=KM_ID, keep=["dt_class", "dt_port"])
        return km.select("pkt_id", "dt_class", "dt_port", F.col("class_id").alias("km_class"), F.col("egress_port").alias("km_port"))

    base = scratch_path(spark, "swap")
    score_from_store(_halves(spark, sf), store, score, f"{base}/out", f"{base}/_checkpoint", on_batch=swap)
    return spark.read.parquet(f"{base}/out").select("pkt_id", "model_version", "dt_class", "dt_port", "km_class", "km_port")


def q_stream_late_counts(spark: SparkSession, sf: str) -> DataFrame:
    """X2 with late rows: the events of odd ids come a batch after all those of even
    ids, so most are behind the watermark; on time and late together are all rows."""
    return run_counting_late(spark, score_dt_stream(_halves(spark, sf), shipped_dt(spark), DT_ID), "stream_late")


# --------------------------------------------------------------------------- captures


def q_frame_decode(spark: SparkSession, sf: str) -> DataFrame:
    """A2: decode raw frames (every 13th cut short) into headers; reasons for the quarantine."""
    d = decode_frames(frames_from(spark, sf))
    return d.select(
        "pkt_id",
        F.col("ethernet.ether_type").alias("ether_type"),
        F.col("ipv4.total_len").alias("ipv4_total_len"),
        F.col("ipv4.protocol").alias("ipv4_protocol"),
        F.col("ipv4.identification").alias("ipv4_identification"),
        F.col("ipv4.ttl").alias("ipv4_ttl"),
        F.col("ipv4.src_ip").alias("ipv4_src_ip"),
        F.col("ipv4.dst_ip").alias("ipv4_dst_ip"),
        F.col("tcp.src_port").alias("tcp_src_port"),
        F.col("tcp.dst_port").alias("tcp_dst_port"),
        F.col("udp.src_port").alias("udp_src_port"),
        F.col("udp.dst_port").alias("udp_dst_port"),
        "decode_error",
    )


def q_ipv4_checksum(spark: SparkSession, sf: str) -> DataFrame:
    """Header checksum of every decodable IPv4 frame (as captured)."""
    d = decode_frames(frames_from(spark, sf)).filter(F.col("ipv4").isNotNull())
    return d.select("pkt_id", frame_checksum("frame").alias("checksum"))


def q_frame_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """K-means stamp + new checksum written back into the frames."""
    out, _ = rewrite_capture(frames_from(spark, sf), shipped_km(spark), KM_ID)
    return out.select("pkt_id", "outcome", F.hex("frame_out").alias("frame_hex"))


# --------------------------------------------------------------------------- compile at scale


def _preds(spark: SparkSession, sf: str) -> DataFrame:
    return predicates_bulk(spark, table(spark, sf, "lineitem"))


def q_bounds_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """C10 + B8/B9 + D2: per (model, rule, mentioned known feature) integer bounds."""
    b = dc.rule_bounds(spark, _preds(spark, sf), ["model_id", "rule_id"])
    return b.select("model_id", "rule_id", "feature", "lo", "hi")


def _bins_bulk(spark: SparkSession, sf: str) -> DataFrame:
    p = _preds(spark, sf)
    vals = p.filter("is_threshold").select("model_id", "feature", "value")
    return dc.build_thresholds(spark, vals, p.select("model_id").distinct())


def q_bins_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """Bins of 20 generated models."""
    return _bins_bulk(spark, sf).select("model_id", "feature", "bin_id", "lo", "hi")


def q_id_ranges_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """C6 + D3: bounds to bin-id ranges by block equi-joins (non-empty only)."""
    b = dc.rule_bounds(spark, _preds(spark, sf), ["model_id", "rule_id"])
    r = dc.id_ranges(b, _bins_bulk(spark, sf))
    return r.filter(~F.col("empty")).select("model_id", "rule_id", "feature", "id_start", "id_end")


def q_rule_ids_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """E3 at scale: valid rules of each generated model numbered from 0 in rule
    order (two-level numbering, no model in one task)."""
    # the block counts and the numbering both read the rows: computed once
    rows = q_rules_bulk(spark, sf).select("model_id", "rule_id").transform(checkpointed)
    return number_in_order(rows, "model_id", "rule_id", "rule_no")


def corpus_model(spark: SparkSession, sf: str, n_classes: int = 5) -> dc.DTModel:
    """The 20 generated corpus models compiled to tree tables (no text step):
    every rule completed to 5 features, empty rules dropped, rules numbered per
    model in rule order; a rule's class is its id mod 5 (the corpus has none)."""
    p = _preds(spark, sf)
    keys = ["model_id", "rule_id"]
    bins = _bins_bulk(spark, sf).transform(checkpointed)
    rows = dc.rule_rows(dc.id_ranges(dc.rule_bounds(spark, p, keys, rules=p.select(*keys).distinct()), bins), keys)
    numbered = number_in_order(rows.transform(checkpointed), "model_id", "rule_id", "rule_no")
    rules = numbered.select(
        "model_id", F.col("rule_no").alias("rule_id"), F.col("rule_id").alias("line_no"),
        (F.col("rule_id") % n_classes).cast("int").alias("class"), "id_start", "id_end",
    )
    return dc.DTModel(bins=bins, rules=rules.transform(checkpointed))


def corpus_text(spark: SparkSession, sf: str) -> DataFrame:
    """The generated corpus as model text, (model_id, line_no, line), as awkward as the
    grammar allows: every feature line comes twice (the first with one wrong
    value), every rule's conditions are repeated, values end in ``.5``."""
    p = _preds(spark, sf)
    vals = p.filter("is_threshold").select("model_id", "feature", "value")
    rules = p.select("model_id", "rule_id").distinct().withColumn("class", (F.col("rule_id") % 5).cast("int"))
    lines = render_tree_lines(vals, p, rules, times=2)
    wrong = vals.select("model_id", "feature").distinct().select(
        "model_id", F.lit(-(1 << 40)).cast("long").alias("line_no"), F.concat("feature", F.lit(" = [np.float64(7.5)];")).alias("line")
    )
    return lines.unionByName(wrong)


def q_dt_compile_corpus_text(spark: SparkSession, sf: str) -> DataFrame:
    """J1 at volume (A3, B11, C7, C11, D2, D5, D7, E3): the corpus as text files, read
    in splits, parsed and compiled; the rules with their numbers, classes and id ranges."""
    path = scratch_path(spark, "corpus_text")
    write_model_text(corpus_text(spark, sf), path)
    model = dc.compile_from_lines(spark, read_model_lines_at_volume(spark, path))
    return model.rules.select(
        F.col("model_id").cast("int").alias("model_id"), F.col("rule_id").alias("rule_no"), "class",
        *[F.col("id_start")[i].alias(f"s{i}") for i in range(5)],
        *[F.col("id_end")[i].alias(f"e{i}") for i in range(5)],
    )


def q_dt_score_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Many large models at once: grid packets, each scored by corpus model
    pkt_id mod 20, through the first-match index and the port map."""
    g = grid_from(spark, sf).withColumn("model_id", (F.col("pkt_id") % 20).cast("int"))
    out = score_dt(g, corpus_model(spark, sf), keep=["model_id"])
    return out.select("pkt_id", "model_id", "rule_id", "class_id", "egress_port", "outcome")


def q_dt_rules_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """J6 for many large rule lists: the corpus rules' own conditions on raw
    values (no bins, no clamping), first true rule by rule id, class id mod 5."""
    p = _preds(spark, sf)
    rules = p.select("model_id", "rule_id").distinct().withColumn("class", (F.col("rule_id") % 5).cast("int"))
    g = features(grid_from(spark, sf)).withColumn("model_id", (F.col("pkt_id") % 20).cast("int"))
    return rules_index(spark, p, rules).match(g).select("pkt_id", "model_id", "rule_id", "class_id")


def q_model_audit(spark: SparkSession, sf: str) -> DataFrame:
    """X3 on the generated corpus, per model: ignored, clamped and off-threshold
    predicates, rules with an empty range; cells without a rule and with several;
    rules whose class has no port (a rule's class is its id mod 7 here, so some have none)."""
    p = _preds(spark, sf)
    model = corpus_model(spark, sf, n_classes=7)
    found = predicate_audit(spark, p, model.bins, ["model_id", "rule_id"])
    lost = classes_without_port(model.rules, class_port_table(model.model_ids()))
    lost = lost.groupBy("model_id").agg(F.count(F.lit(1)).alias("n_rules_without_port"))
    out = found.join(cell_audit(model), "model_id").join(lost, "model_id", "left")
    return out.fillna(0, ["n_rules_without_port"])


def q_model_counts(spark: SparkSession, sf: str) -> DataFrame:
    """D6 (+ G2): rules kept, classes, features and thresholds of every corpus model, whose bins must cover the domains."""
    from ..api import assert_covers

    model = corpus_model(spark, sf)
    assert_covers(model.bins)
    return dc.model_counts(model).select("model_id", "n_rules", "n_classes", "n_features", "n_thresholds")


def q_packet_table_score(spark: SparkSession, sf: str) -> DataFrame:
    """A1: the decoded capture written as a table of nested headers, read back with the fixed schema, scored by the tree."""
    whole, _ = split_quarantine(decode_frames(frames_from(spark, sf)))
    path = scratch_path(spark, "packets")
    columns = [F.lit(None).cast("timestamp").alias("ts") if f.name == "ts" else F.col(f.name).cast(f.dataType) for f in PACKET.fields]
    whole.select(*columns).write.parquet(path)
    return score_dt(read_packets(spark, path), shipped_dt(spark), model_id=DT_ID).select(*DT_COLS)


def q_rules_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """C7 + C11 + D4 + D5: complete every rule to 5 features, keep valid rules."""
    p = _preds(spark, sf)
    keys = ["model_id", "rule_id"]
    rules = p.select(*keys).distinct()
    b = dc.rule_bounds(spark, p, keys, rules=rules)
    r = dc.id_ranges(b, _bins_bulk(spark, sf))
    rows = dc.rule_rows(r, keys)
    return rows.select(
        *keys,
        *[F.col("id_start")[i].alias(f"s{i}") for i in range(5)],
        *[F.col("id_end")[i].alias(f"e{i}") for i in range(5)],
    )


REGISTRY: dict[str, Query] = {
    "features": q_features,
    "dt_rules_direct": q_dt_rules_direct,
    "dt_discretise": q_dt_discretise,
    "dt_score": q_dt_score,
    "dt_score_bulk": q_dt_score_bulk,
    "dt_match": q_dt_match,
    "dt_score_multi": q_dt_score_multi,
    "dt_match_multi": q_dt_match_multi,
    "dt_rules_corpus": q_dt_rules_corpus,
    "dt_default_drop": q_dt_default_drop,
    "dt_route_counts": q_dt_route_counts,
    "class_counts": q_class_counts,
    "class_counts_windowed": q_class_counts_windowed,
    "dt_route": q_dt_route,
    "stream_dt_score": q_stream_dt_score,
    "stream_km_score": q_stream_km_score,
    "stream_reloading": q_stream_reloading,
    "stream_windowed_counts": q_stream_windowed_counts,
    "stream_dt_score_multi": q_stream_dt_score_multi,
    "stream_model_swap": q_stream_model_swap,
    "stream_late_counts": q_stream_late_counts,
    "km_distances": q_km_distances,
    "km_score": q_km_score,
    "km_score_bulk": q_km_score_bulk,
    "km_score_lookup": q_km_score_lookup,
    "km_score_multi": q_km_score_multi,
    "km_score_mixed_k": q_km_score_mixed_k,
    "km_nearest_long": q_km_nearest_long,
    "label_crosstab": q_label_crosstab,
    "frame_decode": q_frame_decode,
    "ipv4_checksum": q_ipv4_checksum,
    "frame_rewrite": q_frame_rewrite,
    "bounds_bulk": q_bounds_bulk,
    "bins_bulk": q_bins_bulk,
    "id_ranges_bulk": q_id_ranges_bulk,
    "rules_bulk": q_rules_bulk,
    "model_audit": q_model_audit,
    "rule_ids_bulk": q_rule_ids_bulk,
    "model_counts": q_model_counts,
    "packet_table_score": q_packet_table_score,
    "dt_score_corpus": q_dt_score_corpus,
    "dt_compile_corpus_text": q_dt_compile_corpus_text,
}


# --------------------------------------------------------------------------- oracle SQL


def _bounds_sql() -> str:
    return (
        "k AS (SELECT p.model_id, p.rule_id, p.feature, f.fmax, p.op, "
        "GREATEST(-1.0, LEAST(p.value, f.fmax + 1.0)) AS v FROM preds p JOIN feats5 f ON p.feature = f.feature), "
        "b0 AS (SELECT model_id, rule_id, feature, fmax, "
        "MAX(CASE WHEN op = '>' THEN CAST(FLOOR(v) AS BIGINT) + 1 END) AS lo_c, "
        "MIN(CASE WHEN op = '<=' THEN CAST(FLOOR(v) AS BIGINT) END) AS hi_c FROM k GROUP BY model_id, rule_id, feature, fmax), "
        "bounds AS (SELECT model_id, rule_id, feature, "
        "CAST(GREATEST(0, LEAST(COALESCE(lo_c, 0), fmax)) AS INT) AS lo, "
        "CAST(GREATEST(0, LEAST(COALESCE(hi_c, fmax), fmax)) AS INT) AS hi FROM b0)"
    )


def _bins_sql() -> str:
    return (
        "edges AS (SELECT DISTINCT p.model_id, p.feature, CAST(FLOOR(p.value) AS INT) AS upper "
        "FROM preds p JOIN feats5 f ON p.feature = f.feature "
        "WHERE p.is_threshold AND p.value >= 0 AND p.value < f.fmax + 1 "
        "UNION SELECT m.model_id, f.feature, f.fmax FROM (SELECT DISTINCT model_id FROM preds) m CROSS JOIN feats5 f), "
        "bins AS (SELECT model_id, feature, "
        "CAST(ROW_NUMBER() OVER (PARTITION BY model_id, feature ORDER BY upper) - 1 AS INT) AS bin_id, "
        "CAST(COALESCE(LAG(upper) OVER (PARTITION BY model_id, feature ORDER BY upper) + 1, 0) AS INT) AS lo, "
        "upper AS hi FROM edges)"
    )


def _ids_sql(src: str = "bounds") -> str:
    return (
        "SELECT b.model_id, b.rule_id, b.feature, s.bin_id AS id_start, e.bin_id AS id_end "
        f"FROM {src} b JOIN bins s ON s.model_id = b.model_id AND s.feature = b.feature AND b.lo BETWEEN s.lo AND s.hi "
        "JOIN bins e ON e.model_id = b.model_id AND e.feature = b.feature AND b.hi BETWEEN e.lo AND e.hi "
        "WHERE b.lo <= b.hi"
    )


def _coverage_sql() -> str:
    """``cov`` (model_id, n_cells, once, twice) over ``valid`` and ``bins``: boxes of id ranges cut in two until one rule
    at most reaches in, or two cover all. The cut is the median of the lower edges inside, of the feature with the most."""
    five = range(5)
    inside = [f"CASE WHEN r.s{i} > b.l{i} THEN r.s{i} WHEN r.e{i} < b.h{i} THEN r.e{i} + 1 END" for i in five]
    meets = " AND ".join(f"r.s{i} <= b.h{i} AND r.e{i} >= b.l{i}" for i in five)
    whole = " AND ".join(f"r.s{i} <= b.l{i} AND r.e{i} >= b.h{i}" for i in five)
    box = ", ".join(f"b.l{i}, b.h{i}" for i in five)
    size = lambda lo, hi: " * ".join(f"CAST({hi.format(i=i)} - {lo.format(i=i)} + 1 AS HUGEINT)" for i in five)
    part = size("GREATEST(r.s{i}, b.l{i})", "LEAST(r.e{i}, b.h{i})")
    stats = (
        f"SELECT b.model_id, {box}, COUNT(*) AS n, COUNT(*) FILTER ({whole}) AS full_n, MIN({part}) AS part, "
        + ", ".join(f"COUNT({e}) AS c{i}, quantile_disc({e}, 0.5) AS m{i}" for i, e in enumerate(inside))
        + f" FROM {{}} b JOIN valid r ON r.model_id = b.model_id AND {meets} GROUP BY b.model_id, {box}"
    )
    most = "GREATEST(c0, c1, c2, c3, c4)"
    pick = "CASE " + " ".join(f"WHEN c{i} = {most} THEN {i}" for i in five) + " END"
    cut = "CASE " + " ".join(f"WHEN c{i} = {most} THEN m{i}" for i in five) + " END"
    low = ", ".join(f"l{i}, CASE WHEN side = 0 AND f = {i} THEN cut - 1 ELSE h{i} END AS h{i}" for i in five)
    both = ", ".join(f"CASE WHEN side = 1 AND f = {i} THEN cut ELSE l{i} END AS l{i}, x.h{i}" for i in five)
    dims = ", ".join(f"0 AS l{i}, MAX(CASE WHEN f.fpos = {i} THEN b.bin_id END) AS h{i}" for i in five)
    return (
        f"dims AS (SELECT b.model_id, {dims} FROM bins b JOIN feats5 f ON f.feature = b.feature GROUP BY b.model_id), "
        f"boxes AS (SELECT * FROM dims UNION ALL SELECT x.model_id, {both} FROM ("
        f"SELECT model_id, {low}, side, f, cut FROM (SELECT *, {pick} AS f, {cut} AS cut FROM ({stats.format('boxes')}) "
        f"WHERE full_n < 2 AND n >= 2) CROSS JOIN (VALUES (0), (1)) t(side)) x), "
        f"ended AS ({stats.format('boxes')}), "
        f"sums AS (SELECT model_id, SUM(CASE WHEN full_n >= 1 THEN {size('l{i}', 'h{i}')} ELSE part END) AS once, "
        f"SUM(CASE WHEN full_n >= 2 THEN {size('l{i}', 'h{i}')} ELSE 0 END) AS twice FROM ended "
        f"WHERE full_n >= 2 OR n = 1 GROUP BY model_id), "
        f"cov AS (SELECT d.model_id, {size('l{i}', 'h{i}')} AS n_cells, COALESCE(s.once, 0) AS once, COALESCE(s.twice, 0) AS twice "
        "FROM dims d LEFT JOIN sums s ON s.model_id = d.model_id)"
    )


def oracle_sql() -> dict[str, str]:
    feat_cols = "pkt_id, ingress_port, ipv4_identification, frame_len, ether_type, ip_proto, src_port, dst_port"
    grid_km = O.km_scored("grid")
    bulk_km = O.km_scored("bulk")
    f7 = f"WITH {O.predicates_cte()}, {O.FEATURE_VALUES}"
    complete = (
        "full5 AS (SELECT r.model_id, r.rule_id, f.feature, f.fpos, COALESCE(b.lo, 0) AS lo, COALESCE(b.hi, f.fmax) AS hi "
        "FROM (SELECT DISTINCT model_id, rule_id FROM preds) r CROSS JOIN feats5 f "
        "LEFT JOIN bounds b ON b.model_id = r.model_id AND b.rule_id = r.rule_id AND b.feature = f.feature), "
        "ids5 AS (SELECT b.model_id, b.rule_id, b.fpos, s.bin_id AS id_start, e.bin_id AS id_end "
        "FROM full5 b JOIN bins s ON s.model_id = b.model_id AND s.feature = b.feature AND b.lo BETWEEN s.lo AND s.hi "
        "JOIN bins e ON e.model_id = b.model_id AND e.feature = b.feature AND b.hi BETWEEN e.lo AND e.hi "
        "WHERE b.lo <= b.hi) "
    )
    rules_out = (
        "SELECT model_id, rule_id, "
        + ", ".join(f"MAX(CASE WHEN fpos = {i} THEN id_start END) AS s{i}" for i in range(5))
        + ", "
        + ", ".join(f"MAX(CASE WHEN fpos = {i} THEN id_end END) AS e{i}" for i in range(5))
        + " FROM ids5 GROUP BY model_id, rule_id HAVING COUNT(*) = 5"
    )
    return {
        "features": f"WITH {O.with_packets('grid')} SELECT {feat_cols} FROM feats",
        "dt_rules_direct": (
            f"WITH {O.with_packets('grid')} SELECT pkt_id, {O.rule_case('rule')} AS rule_id, "
            f"{O.rule_case('class')} AS class_id FROM feats"
        ),
        "dt_discretise": (
            f"WITH {O.with_packets('grid')} SELECT pkt_id, "
            + ", ".join(f"CAST({O.edges_sum(f)} AS INT) AS {f}_id" for f in O.DT_EDGES)
            + " FROM feats"
        ),
        "dt_score": f"{O.dt_scored('grid')} {O.DT_OUT}",
        "dt_score_bulk": f"{O.dt_scored('bulk')} {O.DT_OUT}",
        "dt_match": f"{O.dt_scored('bulk')} {O.DT_OUT}",
        "dt_score_multi": (
            f"WITH {O.with_packets('grid')}, {O.dt_multi_ctes(129, 'dt_no_rule10', {10})} "
            "SELECT pkt_id, model_id, class_id, egress_port, outcome FROM dt"
        ),
        "dt_match_multi": (
            f"WITH {O.with_packets('grid')}, {O.dt_multi_ctes(129, 'dt_no_rule10', {10})} "
            "SELECT pkt_id, model_id, class_id, egress_port, outcome FROM dt"
        ),
        "stream_dt_score_multi": (
            f"WITH {O.with_packets('grid')}, {O.dt_multi_ctes(129, 'dt_no_rule10', {10})} "
            "SELECT pkt_id, model_id, class_id, egress_port, outcome FROM dt"
        ),
        "stream_model_swap": (
            f"WITH {O.with_packets('grid')}, r AS (SELECT pkt_id, ingress_port = {BYPASS_INGRESS_PORT} AS byp, pkt_id % 2 AS odd, "
            f"CASE WHEN pkt_id % 2 = 1 THEN {O.rule_case('class', {10})} ELSE {O.rule_case('class')} END AS dtc, "
            f"{O.km_dist_sql()} FROM feats), "
            # reversed centres: class 1 is the third centre
            "n AS (SELECT *, CASE WHEN odd = 1 THEN CASE WHEN d3 <= d2 AND d3 <= d1 THEN 1 WHEN d2 <= d1 THEN 2 ELSE 3 END "
            "ELSE CASE WHEN d1 <= d2 AND d1 <= d3 THEN 1 WHEN d2 <= d3 THEN 2 ELSE 3 END END AS kmc FROM r) "
            "SELECT pkt_id, CAST(odd + 1 AS BIGINT) AS model_version, CASE WHEN NOT byp THEN dtc END AS dt_class, "
            f"CAST(CASE WHEN byp THEN 156 ELSE {O.port_case('dtc', O.DT_CLASS_PORTS)} END AS INT) AS dt_port, "
            "CAST(CASE WHEN NOT byp THEN kmc END AS INT) AS km_class, "
            f"CAST(CASE WHEN byp THEN 156 ELSE {O.port_case('kmc', O.KM_CLASS_PORTS)} END AS INT) AS km_port FROM n"
        ),
        "stream_late_counts": (
            f"{O.dt_scored('grid')}, mark AS (SELECT max(ts) FILTER (pkt_id % 2 = 0) - INTERVAL 10 MINUTE AS w FROM dt), "
            "late AS (SELECT *, pkt_id % 2 = 1 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= w AS is_late FROM dt, mark) "
            "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, class_id, egress_port, "
            "COUNT(*) FILTER (NOT is_late) AS n_packets, COUNT(*) FILTER (is_late) AS n_late FROM late GROUP BY 1, 2, 3"
        ),
        "dt_rules_corpus": (
            f"{f7}, raw AS (SELECT p.model_id, p.rule_id, "
            + ", ".join(
                f"MAX(CASE WHEN p.feature = '{f}' AND p.op = '>' THEN p.value END) AS a{i}, "
                f"MIN(CASE WHEN p.feature = '{f}' AND p.op = '<=' THEN p.value END) AS b{i}"
                for i, f in enumerate(O.DT_EDGES)
            )
            + f" FROM preds p GROUP BY p.model_id, p.rule_id), {O.with_packets('grid')}, "
            "pm AS (SELECT *, CAST(pkt_id % 20 AS INT) AS model_id FROM feats), "
            "hit AS (SELECT pm.pkt_id, pm.model_id, MIN(raw.rule_id) AS rule_id FROM pm LEFT JOIN raw ON raw.model_id = pm.model_id "
            + " ".join(f"AND pm.{f} > COALESCE(a{i}, -1) AND pm.{f} <= COALESCE(b{i}, 65535)" for i, f in enumerate(O.DT_EDGES))
            + " GROUP BY pm.pkt_id, pm.model_id) "
            "SELECT pkt_id, model_id, rule_id, CAST(rule_id % 5 AS INT) AS class_id FROM hit"
        ),
        "dt_default_drop": f"{O.dt_scored('grid', skip={10})} SELECT pkt_id, class_id, egress_port, outcome FROM dt",
        "dt_route_counts": (
            f"{O.dt_scored('grid')} SELECT egress_port, outcome, COUNT(*) AS n_packets FROM dt GROUP BY egress_port, outcome"
        ),
        "class_counts": (
            f"WITH {O.with_packets('bulk')}, {O.dt_ctes()}, {O.km_ctes()} "
            "SELECT 'dt' AS model, class_id, egress_port, COUNT(*) AS n_packets FROM dt GROUP BY class_id, egress_port "
            "UNION ALL SELECT 'km' AS model, class_id, egress_port, COUNT(*) AS n_packets FROM km GROUP BY class_id, egress_port"
        ),
        "class_counts_windowed": (
            f"{O.dt_scored('grid')} SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, "
            "class_id, egress_port, COUNT(*) AS n_packets FROM dt GROUP BY 1, 2, 3"
        ),
        "dt_route": f"{O.dt_scored('grid', skip={10})} SELECT pkt_id, egress_port, outcome FROM dt",
        "stream_dt_score": f"{O.dt_scored('grid')} {O.DT_OUT}",
        "stream_km_score": f"{grid_km} {O.KM_OUT}",
        "stream_reloading": f"{O.dt_scored('grid')} {O.DT_OUT}",
        "stream_windowed_counts": (
            f"{O.dt_scored('grid')} SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, "
            "class_id, egress_port, COUNT(*) AS n_packets FROM dt GROUP BY 1, 2, 3"
        ),
        "km_distances": (
            f"WITH {O.with_packets('grid')} SELECT pkt_id, {O.km_dist_sql()} FROM feats"
        ),
        "km_score": f"{grid_km} {O.KM_OUT}",
        "km_score_bulk": f"{bulk_km} {O.KM_OUT}",
        "km_score_lookup": f"{bulk_km} {O.KM_OUT}",
        "km_score_multi": (
            f"WITH {O.with_packets('bulk')}, {O.km_ctes(None, 'ingress_port <> 129', 'a')}, "
            f"{O.km_ctes(O.KM_CENTRES[::-1], 'ingress_port = 129', 'b')} "
            f"SELECT 'kmeans' AS model_id, {', '.join(KM_COLS)} FROM kma UNION ALL "
            f"SELECT '{KM_ALT_ID}' AS model_id, {', '.join(KM_COLS)} FROM kmb"
        ),
        "km_score_mixed_k": (
            f"WITH {O.with_packets('grid')}, cent AS (SELECT CAST(m AS VARCHAR) AS model_id, p_partkey + 1 AS cls, k, "
            "20 + p_partkey * 37 % 1481 AS a, p_partkey * 40503 % 65536 AS b, p_partkey * 52711 % 65536 AS c FROM part, "
            f"(VALUES {', '.join(f'({m}, {k})' for m, k in enumerate(MIXED_K))}) t(m, k) WHERE p_partkey < k), "
            "pm AS (SELECT *, CAST(pkt_id % 4 AS VARCHAR) AS model_id FROM feats), "
            "d AS (SELECT pm.pkt_id, pm.model_id, k, cls, "
            + " + ".join(
                f"LEAST((CAST(pm.{f} AS BIGINT) - {v}) * (CAST(pm.{f} AS BIGINT) - {v}), {O.KM_DIST_CAP})"
                for f, v in (("frame_len", "a"), ("src_port", "b"), ("dst_port", "c"))
            )
            + " AS dist FROM pm JOIN cent ON cent.model_id = pm.model_id), "
            "best AS (SELECT pkt_id, model_id, k, MIN(dist) AS md, MIN(dist) FILTER (cls <= 2) AS m2, MIN(dist) FILTER (cls = 3) AS d3 "
            "FROM d GROUP BY pkt_id, model_id, k), "
            "near AS (SELECT b.*, (SELECT MIN(cls) FROM d WHERE d.pkt_id = b.pkt_id AND d.dist = b.md) AS cls, "
            "CASE WHEN k = 3 THEN ((d3 - m2) % 4294967296 + 4294967296) % 4294967296 END AS dl FROM best b), "
            f"j AS (SELECT near.*, ipv4_identification AS ident, ingress_port = {BYPASS_INGRESS_PORT} AS byp, "
            f"{O.port_case('cls', O.KM_CLASS_PORTS)} AS port FROM near JOIN feats ON feats.pkt_id = near.pkt_id) "
            "SELECT pkt_id, model_id, CAST(CASE WHEN NOT byp THEN cls END AS INT) AS class_id, "
            "CAST(CASE WHEN byp THEN 156 ELSE port END AS INT) AS egress_port, "
            "CASE WHEN byp THEN 'bypass' WHEN port IS NULL THEN 'drop' ELSE 'forward' END AS outcome, "
            "CASE WHEN NOT byp THEN md END AS min_dist, CASE WHEN NOT byp THEN dl END AS delta, "
            "CAST(CASE WHEN ident IS NOT NULL AND NOT byp AND dl IS NOT NULL "
            "THEN (CAST(ident AS BIGINT) & 65280) | ((dl & 15) * 16) | (md & 15) ELSE ident END AS INT) AS ipv4_identification FROM j"
        ),
        "km_nearest_long": (
            f"WITH {O.with_packets('grid')}, dist AS (SELECT pkt_id, {O.km_dist_sql()} FROM feats) "
            "SELECT pkt_id, LEAST(d1, d2, d3) AS min_dist, "
            "CAST(CASE WHEN d1 <= d2 AND d1 <= d3 THEN 1 WHEN d2 <= d3 THEN 2 ELSE 3 END AS INT) AS class_id FROM dist"
        ),
        "label_crosstab": (
            f"WITH {O.with_packets('bulk')}, dist AS (SELECT ingress_port, {O.rule_case('class')} AS dtc, "
            f"{O.km_dist_sql()} FROM feats) "
            f"SELECT CASE WHEN ingress_port = {BYPASS_INGRESS_PORT} THEN NULL ELSE dtc END AS dt_class, "
            f"CAST(CASE WHEN ingress_port = {BYPASS_INGRESS_PORT} THEN NULL "
            "WHEN d1 <= d2 AND d1 <= d3 THEN 1 WHEN d2 <= d3 THEN 2 ELSE 3 END AS INT) AS km_class, "
            "COUNT(*) AS n_packets FROM dist GROUP BY 1, 2"
        ),
        "frame_decode": (
            f"WITH {O.frames_ctes()} SELECT pkt_id, "
            "CASE WHEN err IS NULL THEN ether_type END AS ether_type, "
            + ", ".join(
                f"CASE WHEN err IS NULL THEN {src} END AS {dst}"
                for src, dst in (
                    ("ipv4_total_len", "ipv4_total_len"), ("ipv4_protocol", "ipv4_protocol"),
                    ("ipv4_identification", "ipv4_identification"),
                    ("CASE WHEN ipv4_total_len IS NOT NULL THEN ttl END", "ipv4_ttl"),
                    ("CASE WHEN ipv4_total_len IS NOT NULL THEN src_ip END", "ipv4_src_ip"),
                    ("CASE WHEN ipv4_total_len IS NOT NULL THEN dst_ip END", "ipv4_dst_ip"),
                    ("tcp_src_port", "tcp_src_port"), ("tcp_dst_port", "tcp_dst_port"),
                    ("udp_src_port", "udp_src_port"), ("udp_dst_port", "udp_dst_port"),
                )
            )
            + ", err AS decode_error FROM fe"
        ),
        "ipv4_checksum": (
            f"WITH {O.frames_ctes()} SELECT pkt_id, {O.checksum_sql('ipv4_identification')} AS checksum "
            "FROM fe WHERE err IS NULL AND ipv4_total_len IS NOT NULL"
        ),
        "frame_rewrite": f"WITH {O.frames_ctes()}, {O.rewrite_ctes()} SELECT pkt_id, outcome, frame_hex FROM rw",
        "bounds_bulk": f"{f7}, {_bounds_sql()} SELECT model_id, rule_id, feature, lo, hi FROM bounds",
        "bins_bulk": f"{f7}, {_bins_sql()} SELECT model_id, feature, bin_id, lo, hi FROM bins",
        "id_ranges_bulk": f"{f7}, {_bounds_sql()}, {_bins_sql()} {_ids_sql()}",
        "rule_ids_bulk": (
            f"{f7}, {_bounds_sql()}, {_bins_sql()}, {complete}, valid AS ({rules_out}) "
            "SELECT model_id, rule_id, CAST(ROW_NUMBER() OVER (PARTITION BY model_id ORDER BY rule_id) - 1 AS INT) "
            "AS rule_no FROM valid"
        ),
        "model_counts": (
            f"{f7}, {_bounds_sql()}, {_bins_sql()}, {complete}, valid AS ({rules_out}), "
            "b AS (SELECT model_id, COUNT(DISTINCT feature) AS n_features, COUNT(*) AS n_thresholds FROM bins GROUP BY model_id), "
            "r AS (SELECT model_id, COUNT(*) AS n_rules, COUNT(DISTINCT rule_id % 5) AS n_classes FROM valid GROUP BY model_id) "
            "SELECT b.model_id, COALESCE(n_rules, 0) AS n_rules, COALESCE(n_classes, 0) AS n_classes, n_features, n_thresholds "
            "FROM b LEFT JOIN r ON r.model_id = b.model_id"
        ),
        "packet_table_score": (
            f"WITH {O.frames_ctes()}, feats AS ({O.FEATURES_SELECT}, NULL AS ts FROM fe WHERE err IS NULL), {O.dt_ctes()} {O.DT_OUT}"
        ),
        "dt_compile_corpus_text": (
            f"{f7}, {_bounds_sql()}, {_bins_sql()}, {complete}, valid AS ({rules_out}) "
            "SELECT model_id, CAST(ROW_NUMBER() OVER (PARTITION BY model_id ORDER BY rule_id) - 1 AS INT) AS rule_no, "
            "CAST(rule_id % 5 AS INT) AS class, " + ", ".join(f"s{i}, e{i}" for i in range(5)) + " FROM valid"
        ),
        "dt_score_corpus": (
            f"{f7}, {_bounds_sql()}, {_bins_sql()}, {complete}, valid AS ({rules_out}), "
            "vr AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY model_id ORDER BY rule_id) - 1 AS INT) AS rule_no, "
            "CAST(rule_id % 5 AS INT) AS cls FROM valid), "
            f"{O.with_packets('grid')}, "
            "pm AS (SELECT pkt_id, ingress_port, frame_len, ether_type, ip_proto, src_port, dst_port, "
            "CAST(pkt_id % 20 AS INT) AS model_id FROM feats), "
            "pid AS (SELECT pm.pkt_id, pm.ingress_port, pm.model_id, b0.bin_id AS i0, b1.bin_id AS i1, b2.bin_id AS i2, "
            "b3.bin_id AS i3, b4.bin_id AS i4 FROM pm "
            + " ".join(
                f"ASOF JOIN (SELECT * FROM bins WHERE feature = '{f}') b{i} "
                f"ON b{i}.model_id = pm.model_id AND pm.{f} >= b{i}.lo"
                for i, f in enumerate(["frame_len", "ether_type", "ip_proto", "src_port", "dst_port"])
            )
            + "), hit AS (SELECT pid.pkt_id, pid.model_id, pid.ingress_port, MIN(vr.rule_no) AS rno FROM pid "
            "LEFT JOIN vr ON vr.model_id = pid.model_id "
            + " ".join(f"AND pid.i{i} BETWEEN vr.s{i} AND vr.e{i}" for i in range(5))
            + " GROUP BY pid.pkt_id, pid.model_id, pid.ingress_port), "
            "lab AS (SELECT hit.*, vr.cls FROM hit LEFT JOIN vr ON vr.model_id = hit.model_id AND vr.rule_no = hit.rno) "
            f"SELECT pkt_id, model_id, CASE WHEN ingress_port = {BYPASS_INGRESS_PORT} THEN NULL ELSE rno END AS rule_id, "
            f"CASE WHEN ingress_port = {BYPASS_INGRESS_PORT} THEN NULL ELSE cls END AS class_id, "
            f"CAST(CASE WHEN ingress_port = {BYPASS_INGRESS_PORT} THEN 156 ELSE {O.port_case('cls', O.DT_CLASS_PORTS)} END AS INT) "
            "AS egress_port, "
            f"CASE WHEN ingress_port = {BYPASS_INGRESS_PORT} THEN 'bypass' WHEN cls IS NULL THEN 'drop' ELSE 'forward' END AS outcome "
            "FROM lab"
        ),
        "model_audit": (
            f"WITH RECURSIVE {O.predicates_cte()}, {O.FEATURE_VALUES}, {_bounds_sql()}, {_bins_sql()}, "
            "pa AS (SELECT p.model_id, p.rule_id, f.fmax, f.feature AS kf, "
            "CAST(FLOOR(GREATEST(-2.0, LEAST(p.value, COALESCE(f.fmax, 0) + 2.0))) AS BIGINT) AS edge, p.feature "
            "FROM preds p LEFT JOIN feats5 f ON p.feature = f.feature), "
            "per AS (SELECT model_id, COUNT(*) AS n_predicates, "
            "CAST(SUM(CASE WHEN kf IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unknown_feature, "
            "CAST(SUM(CASE WHEN kf IS NOT NULL AND (edge < 0 OR edge > fmax) THEN 1 ELSE 0 END) AS BIGINT) AS n_out_of_domain, "
            "CAST(SUM(CASE WHEN kf IS NOT NULL AND edge BETWEEN 0 AND fmax AND NOT EXISTS (SELECT 1 FROM bins b "
            "WHERE b.model_id = pa.model_id AND b.feature = pa.feature AND b.hi = pa.edge) THEN 1 ELSE 0 END) AS BIGINT) "
            "AS n_off_threshold FROM pa GROUP BY model_id), "
            "emp AS (SELECT model_id, COUNT(*) AS n_rules_constrained, CAST(SUM(e) AS BIGINT) AS n_rules_empty FROM "
            "(SELECT model_id, rule_id, MAX(CASE WHEN lo > hi THEN 1 ELSE 0 END) AS e FROM bounds GROUP BY model_id, rule_id) "
            "GROUP BY model_id), "
            f"{complete}, valid AS ({rules_out}), {_coverage_sql()}, "
            "noport AS (SELECT model_id, COUNT(*) AS n FROM valid WHERE rule_id % 7 > 4 GROUP BY model_id) "
            "SELECT per.model_id, n_predicates, n_unknown_feature, n_out_of_domain, n_off_threshold, "
            "COALESCE(n_rules_constrained, 0) AS n_rules_constrained, COALESCE(n_rules_empty, 0) AS n_rules_empty, "
            "CAST(cov.n_cells AS DECIMAL(38,0)) AS n_cells, CAST(cov.n_cells - cov.once AS DECIMAL(38,0)) AS n_uncovered, "
            "CAST(cov.twice AS DECIMAL(38,0)) AS n_overlap, COALESCE(noport.n, 0) AS n_rules_without_port "
            "FROM per LEFT JOIN emp ON per.model_id = emp.model_id JOIN cov ON cov.model_id = per.model_id "
            "LEFT JOIN noport ON noport.model_id = per.model_id"
        ),
        "rules_bulk": f"{f7}, {_bounds_sql()}, {_bins_sql()}, {complete}{rules_out}",
    }
