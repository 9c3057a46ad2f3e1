"""DuckDB oracle SQL for the registered queries.

The oracle never goes through compiled tables: the tree is the rule list as
integer conditions on raw features (one CASE), the k-means model is plain
arithmetic on the centre values. So a compile error in the Spark path shows
up as a mismatch.
"""

from __future__ import annotations

from ..constants import (
    BYPASS_EGRESS_PORT,
    BYPASS_INGRESS_PORT,
    DT_CLASS_PORTS,
    FEATURE_MAX,
    KM_CLASS_PORTS,
    KM_DIST_CAP,
)
from ..models.centres import KM_CENTRES
from ..models.tree import DT_EDGES, DT_LEAVES, leaf_bounds
from ..sources.fixtures import oracle_bulk, oracle_frames, oracle_grid, oracle_predicates


def _leaf_sql(leaf: tuple) -> str:
    return " AND ".join(f"{f} BETWEEN {lo} AND {hi}" for f, lo, hi in leaf_bounds(leaf))


# the shipped decision tree as integer conditions on raw features, rule_id from 0, with the class of each leaf
DT_RULES = [(i, _leaf_sql(leaf), leaf[-1]) for i, leaf in enumerate(DT_LEAVES)]

FEATURES_SELECT = (
    "SELECT pkt_id, ingress_port, ipv4_identification, "
    "COALESCE(ipv4_total_len, 0) AS frame_len, ether_type, "
    "COALESCE(ipv4_protocol, 0) AS ip_proto, "
    "COALESCE(tcp_src_port, udp_src_port, 0) AS src_port, "
    "COALESCE(tcp_dst_port, udp_dst_port, 0) AS dst_port"
)


def with_packets(kind: str) -> str:
    src = oracle_grid() if kind == "grid" else oracle_bulk()
    return f"packets AS ({src}), feats AS ({FEATURES_SELECT}, ts FROM packets)"


def rule_case(value: str, skip: set[int] | None = None, renumber: bool = False) -> str:
    skip = skip or set()
    parts = []
    n = 0
    for rid, cond, klass in DT_RULES:
        if rid in skip:
            continue
        v = (n if renumber else rid) if value == "rule" else klass
        parts.append(f"WHEN {cond} THEN {v}")
        n += 1
    return "CAST(CASE " + " ".join(parts) + " END AS INT)"


def port_case(col: str, mapping: dict[int, int]) -> str:
    parts = " ".join(f"WHEN {c} THEN {p}" for c, p in sorted(mapping.items()))
    return f"CASE {col} {parts} END"


def dt_ctes(skip: set[int] | None = None) -> str:
    """CTEs over ``feats`` ending in ``dt`` (pkt_id, ingress_port, rule_id, class_id, egress_port, outcome)."""
    byp = f"ingress_port = {BYPASS_INGRESS_PORT}"
    port = port_case("class_id", DT_CLASS_PORTS)
    return (
        f"raw AS (SELECT pkt_id, ingress_port, ts, {rule_case('rule', skip, True)} AS rule_id, "
        f"{rule_case('class', skip)} AS class_id FROM feats), "
        f"dt AS (SELECT pkt_id, ingress_port, ts, "
        f"CASE WHEN {byp} THEN NULL ELSE rule_id END AS rule_id, "
        f"CASE WHEN {byp} THEN NULL ELSE class_id END AS class_id, "
        f"CAST(CASE WHEN {byp} THEN {BYPASS_EGRESS_PORT} ELSE {port} END AS INT) AS egress_port, "
        f"CASE WHEN {byp} THEN 'bypass' WHEN ({port}) IS NOT NULL THEN 'forward' ELSE 'drop' END AS outcome "
        f"FROM raw)"
    )


def dt_multi_ctes(port: int, alt_id: str, skip: set[int]) -> str:
    """Two trees: packets arriving on ``port`` use the tree without ``skip``."""
    byp = f"ingress_port = {BYPASS_INGRESS_PORT}"
    port_c = port_case("class_id", DT_CLASS_PORTS)
    return (
        f"raw AS (SELECT pkt_id, ingress_port, "
        f"CASE WHEN ingress_port = {port} THEN '{alt_id}' ELSE 'decision_tree' END AS model_id, "
        f"CASE WHEN ingress_port = {port} THEN {rule_case('class', skip)} ELSE {rule_case('class')} END AS class_id "
        f"FROM feats), "
        f"dt AS (SELECT pkt_id, model_id, "
        f"CASE WHEN {byp} THEN NULL ELSE class_id END AS class_id, "
        f"CAST(CASE WHEN {byp} THEN {BYPASS_EGRESS_PORT} ELSE {port_c} END AS INT) AS egress_port, "
        f"CASE WHEN {byp} THEN 'bypass' WHEN ({port_c}) IS NOT NULL THEN 'forward' ELSE 'drop' END AS outcome "
        f"FROM raw)"
    )


def dt_scored(kind: str, skip: set[int] | None = None) -> str:
    return f"WITH {with_packets(kind)}, {dt_ctes(skip)}"


def km_dist_sql(centres: list[tuple[int, int, int]] | None = None) -> str:
    out = []
    for i, (a, b, c) in enumerate(centres or KM_CENTRES, start=1):
        terms = [
            f"LEAST((CAST({f} AS BIGINT) - {v}) * (CAST({f} AS BIGINT) - {v}), {KM_DIST_CAP})"
            for f, v in (("frame_len", a), ("src_port", b), ("dst_port", c))
        ]
        out.append(" + ".join(terms) + f" AS d{i}")
    return ", ".join(out)


def km_ctes(centres: list[tuple[int, int, int]] | None = None, where: str = "TRUE", sfx: str = "") -> str:
    """CTEs over ``feats`` ending in ``km{sfx}`` with the J4 output columns."""
    byp = f"ingress_port = {BYPASS_INGRESS_PORT}"
    port = port_case("cls", KM_CLASS_PORTS)
    return (
        f"dist{sfx} AS (SELECT pkt_id, ingress_port, ipv4_identification, ts, {km_dist_sql(centres)} "
        f"FROM feats WHERE {where}), "
        f"near{sfx} AS (SELECT *, CASE WHEN d1 <= d2 AND d1 <= d3 THEN 1 WHEN d2 <= d3 THEN 2 ELSE 3 END AS cls, "
        f"LEAST(d1, d2, d3) AS md, ((d3 - LEAST(d1, d2)) % 4294967296 + 4294967296) % 4294967296 AS dl FROM dist{sfx}), "
        f"km{sfx} AS (SELECT pkt_id, ts, "
        f"CAST(CASE WHEN {byp} THEN NULL ELSE cls END AS INT) AS class_id, "
        f"CAST(CASE WHEN {byp} THEN {BYPASS_EGRESS_PORT} ELSE {port} END AS INT) AS egress_port, "
        f"CASE WHEN {byp} THEN 'bypass' ELSE 'forward' END AS outcome, "
        f"CASE WHEN {byp} THEN NULL ELSE d1 END AS d1, CASE WHEN {byp} THEN NULL ELSE d2 END AS d2, "
        f"CASE WHEN {byp} THEN NULL ELSE d3 END AS d3, CASE WHEN {byp} THEN NULL ELSE md END AS min_dist, "
        f"CASE WHEN {byp} THEN NULL ELSE dl END AS delta, "
        f"CAST(CASE WHEN ipv4_identification IS NOT NULL AND NOT ({byp}) "
        f"THEN (CAST(ipv4_identification AS BIGINT) & 65280) | ((dl & 15) * 16) | (md & 15) "
        f"ELSE ipv4_identification END AS INT) AS ipv4_identification "
        f"FROM near{sfx})"
    )


def km_scored(kind: str) -> str:
    return f"WITH {with_packets(kind)}, {km_ctes()}"


DT_OUT = "SELECT pkt_id, rule_id, class_id, egress_port, outcome FROM dt"
KM_OUT = (
    "SELECT pkt_id, class_id, egress_port, outcome, d1, d2, d3, min_dist, delta, ipv4_identification FROM km"
)


def edges_sum(feature: str) -> str:
    return " + ".join(f"CAST({feature} > {t} AS INT)" for t in DT_EDGES[feature] if t < FEATURE_MAX[feature]) or "0"


def predicates_cte() -> str:
    return f"preds AS ({oracle_predicates()})"


FEATURE_VALUES = (
    "feats5 AS (SELECT * FROM (VALUES ('frame_len', 0, 65535), ('ether_type', 1, 65535), "
    "('ip_proto', 2, 255), ('src_port', 3, 65535), ('dst_port', 4, 65535)) AS t(feature, fpos, fmax))"
)


def frames_ctes() -> str:
    """``fr``: the frames; ``fe``: with the expected quarantine reason ``err``."""
    cut = "CASE WHEN pkt_id % 13 = 0 THEN LEAST(CAST(pkt_id % 60 AS INT), full_len) ELSE full_len END"
    l4 = "CASE WHEN ether_type = 2048 THEN 34 ELSE 54 END"
    err = (
        f"CASE WHEN n < 14 THEN 'truncated:ethernet' "
        f"WHEN ether_type = 2048 AND n < 34 THEN 'truncated:ipv4' "
        f"WHEN ether_type = 34525 AND n < 54 THEN 'truncated:ipv6' "
        f"WHEN ether_type = 2054 AND n < 42 THEN 'truncated:arp' "
        f"WHEN tcp_src_port IS NOT NULL AND n < {l4} + 20 THEN 'truncated:tcp' "
        f"WHEN udp_src_port IS NOT NULL AND n < {l4} + 8 THEN 'truncated:udp' "
        f"WHEN ipv4_protocol = 1 AND n < 42 THEN 'truncated:icmp' END"
    )
    return f"fr AS ({oracle_frames()}), fn AS (SELECT *, {cut} AS n FROM fr), fe AS (SELECT *, {err} AS err FROM fn)"


def checksum_sql(ident: str) -> str:
    words = [
        "(4 * 4096 + 5 * 256 + diffserv)", "ipv4_total_len", ident, "(flags * 8192)",
        "(ttl * 256 + ipv4_protocol)", "(src_ip >> 16)", "(src_ip & 65535)", "(dst_ip >> 16)", "(dst_ip & 65535)",
    ]
    s = "(" + " + ".join(f"CAST({w} AS BIGINT)" for w in words) + ")"
    s1 = f"(({s} & 65535) + ({s} >> 16))"
    s2 = f"(({s1} & 65535) + ({s1} >> 16))"
    return f"CAST(65535 - {s2} AS INT)"


def rewrite_ctes() -> str:
    byp = f"ingress_port = {BYPASS_INGRESS_PORT}"
    return (
        f"feats AS ({FEATURES_SELECT}, NULL AS ts, ttl, diffserv, flags, src_ip, dst_ip, ipv4_total_len, "
        f"ipv4_protocol, frame_hex FROM fe WHERE err IS NULL), "
        f"d AS (SELECT *, {km_dist_sql()} FROM feats), "
        f"n AS (SELECT *, LEAST(d1, d2, d3) AS md, ((d3 - LEAST(d1, d2)) % 4294967296 + 4294967296) % 4294967296 AS dl FROM d), "
        f"s AS (SELECT *, CASE WHEN {byp} THEN ipv4_identification ELSE "
        f"CAST((CAST(ipv4_identification AS BIGINT) & 65280) | ((dl & 15) * 16) | (md & 15) AS INT) END AS ident2 FROM n), "
        f"rw AS (SELECT pkt_id, CASE WHEN {byp} THEN 'bypass' ELSE 'forward' END AS outcome, "
        f"CASE WHEN ipv4_total_len IS NULL THEN frame_hex ELSE "
        f"substr(frame_hex, 1, 36) || lpad(hex(ident2), 4, '0') || substr(frame_hex, 41, 8) || "
        f"lpad(hex({checksum_sql('ident2')}), 4, '0') || substr(frame_hex, 53) END AS frame_hex FROM s)"
    )
