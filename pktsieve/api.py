"""The operator inventory under its SURVEY section 2 names.

Each name is the library function that does the work, or a small DataFrame
function composed from them. Everything takes and returns DataFrames (or
Columns for scalar expressions) unless noted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import DT_CLASS_PORTS
from .functions.arith import cap, clamp, delta_u32, ipv4_checksum, sq, stamp_identification  # noqa: F401
from .functions.arith import int_edge_gt, int_edge_le
from .functions.features import bypass_port, features, has, is_bypass  # noqa: F401
from .operators.audit import cell_audit, classes_without_port, predicate_audit
from .operators.dtree_compile import (  # noqa: F401
    DTModel,
    build_thresholds,
    compile_dt,
    compile_from_lines,
    feature_lines as last_definition,
    feature_table,
    id_ranges as bounds_to_ids,
    known_predicates as known,
    model_counts,
    number_rules,
    predicates,
    rule_bounds,
    rule_rows,
)
from .operators.dtree_score import (  # noqa: F401
    assign_port,
    class_port_table,
    discretise,
    discretise_join,
    eval_rules,
    match_cells,
    match_rules,
    rules_index,
    score_dt,
)
from .operators.frames import decode_frames, rewrite_frames, split_quarantine  # noqa: F401
from .operators.kmeans import (  # noqa: F401
    build_distance_table,
    compile_km,
    distances,
    lookup_distances,
    nearest,
    nearest_array,
    nearest_in_blocks,
    nearest_long,
    number_centres as number_centers,
    score_km,
)
from .plans.capture import rewrite_capture  # noqa: F401
from .sinks.store import ModelStore, score_from_store  # noqa: F401
from .sinks.tables import read_dt_tables, read_km_tables, route, route_stream, split_dropped  # noqa: F401
from .sinks.tables import write_dt_tables, write_km_tables  # noqa: F401
from .sources.models import read_dt_model, read_km_model, require_centres  # noqa: F401
from .sources.packets import read_packets  # noqa: F401
from .sources.text_lines import read_model_lines_at_volume, write_model_text  # noqa: F401
from .streaming.score import run_counting_late, score_dt_stream, score_km_stream, score_reloading, windowed_counts  # noqa: F401


# --------------------------------------------------------------------------- B


def bypass(df: DataFrame) -> DataFrame:
    """Mark bypassed packets (ingress 188 -> egress 156, no model)."""
    return df.withColumn("bypass", is_bypass()).withColumn(
        "bypass_egress_port", F.when(is_bypass(), bypass_port())
    )


def int_edge(v, op: str):
    """Integer edge of ``x <= v`` (op '<=') or of ``x > v`` (op '>')."""
    return int_edge_le(v) if op == "<=" else int_edge_gt(v)


def in_domain(df: DataFrame, value: str = "value", fmax: str = "fmax") -> DataFrame:
    """Keep values whose integer edge lies in 0..fmax."""
    return df.filter((F.col(value) >= 0) & (F.col(value) < F.col(fmax) + 1))


def delta(df: DataFrame) -> DataFrame:
    """delta = d3 - min(d1, d2) mod 2^32."""
    return df.withColumn("delta", delta_u32("d3", F.least("d1", "d2")))


def stamp(df: DataFrame) -> DataFrame:
    """Stamp IPv4 identification from min_dist and delta (IPv4 rows only)."""
    return df.withColumn(
        "ipv4_identification",
        F.when(
            F.col("ipv4_identification").isNotNull(),
            stamp_identification("ipv4_identification", "min_dist", "delta"),
        ),
    )


# --------------------------------------------------------------------------- C, D, E, F, G


def with_default(df: DataFrame) -> DataFrame:
    """No rule / no class -> drop (egress_port NULL, outcome 'drop')."""
    return df.withColumn("outcome", F.when(F.col("egress_port").isNull(), F.lit("drop")).otherwise(F.lit("forward")))


def complete(spark: SparkSession, preds: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """Every rule gets every feature (full range where unmentioned)."""
    return rule_bounds(spark, preds, keys, rules=rules)


def build_cells(model: DTModel) -> DataFrame:
    """C9 + E5: flat (model_id, cell, rule_id, class) table."""
    return model.cells()


def drop_empty_rules(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """C11 + D4: rules whose five ranges are all non-empty, as rule rows."""
    return rule_rows(ranges, keys)


valid_rules = drop_empty_rules


def distinct_thresholds(values: DataFrame) -> DataFrame:
    """Distinct integer edges per (model, feature)."""
    return values.select("model_id", "feature", F.floor("value").cast("int").alias("upper")).distinct()


def sorted_thresholds(values: DataFrame) -> DataFrame:
    """edges per (model, feature) as a sorted array (bounded by the domain)."""
    return distinct_thresholds(values).groupBy("model_id", "feature").agg(
        F.sort_array(F.collect_list("upper")).alias("uppers")
    )


def with_domain_max(spark: SparkSession, edges: DataFrame, models: DataFrame) -> DataFrame:
    """G1: append the domain maximum of every feature to every model's edges."""
    from .operators.dtree_compile import feature_rows

    tops = models.select("model_id", feature_rows()).select("model_id", "feature", F.col("fmax").alias("upper"))
    return edges.select("model_id", "feature", "upper").unionByName(tops).distinct()


def assert_covers(bins: DataFrame) -> None:
    """Bins must tile 0..fmax per (model, feature); raises otherwise."""
    from pyspark.sql import Window

    w = Window.partitionBy("model_id", "feature").orderBy("bin_id")
    gaps = bins.select(
        "*", F.lag("hi").over(w).alias("prev_hi"), F.max("hi").over(Window.partitionBy("model_id", "feature")).alias("top")
    ).filter(
        ((F.col("prev_hi").isNull()) & (F.col("lo") != 0))
        | (F.col("prev_hi").isNotNull() & (F.col("lo") != F.col("prev_hi") + 1))
        | (F.col("top") != F.col("fmax"))
    )
    bad = gaps.limit(1).collect()
    if bad:
        r = bad[0]
        raise ValueError(f"model {r.model_id} feature {r.feature}: bins do not cover the domain")


def first_rule(model: DTModel) -> DataFrame:
    """E5: one rule per cell where rules overlap - the lowest rule_id."""
    return model.cells()


def bins(spark: SparkSession, values: DataFrame, models: DataFrame) -> DataFrame:
    """E1 + E2: bin lo/hi/id from the edges."""
    return build_thresholds(spark, values, models)


def id_range(bounds: DataFrame, bin_table: DataFrame) -> DataFrame:
    """D3: first and last overlapping bin id."""
    return bounds_to_ids(bounds, bin_table)


# --------------------------------------------------------------------------- X


def class_counts(scored: DataFrame) -> DataFrame:
    """Packets per class and port."""
    return scored.groupBy("class_id", "egress_port").agg(F.count(F.lit(1)).alias("n_packets"))


def label_crosstab(scored: DataFrame, a: str = "dt_class", b: str = "km_class") -> DataFrame:
    """Counts per (label a, label b) from one scored pass carrying both labels."""
    return scored.groupBy(a, b).agg(F.count(F.lit(1)).alias("n_packets"))


def audit_model(model: DTModel, ports: DataFrame | None = None) -> DataFrame:
    """X3 on compiled tables: cells with no / several rules, rules with no port."""
    ports = class_port_table(model.model_ids(), DT_CLASS_PORTS) if ports is None else ports
    no_port = classes_without_port(model.rules, ports).groupBy("model_id").agg(
        F.count(F.lit(1)).alias("n_rules_without_port")
    )
    return cell_audit(model).join(no_port, "model_id", "left").fillna(0, ["n_rules_without_port"])


__all__ = [n for n in dir() if not n.startswith("_")] + ["predicate_audit"]
