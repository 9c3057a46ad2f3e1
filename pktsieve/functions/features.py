"""Header-derived packet features (B1-B7) as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BYPASS_EGRESS_PORT, BYPASS_INGRESS_PORT

# Flat packet columns: one nullable column per header field; a NULL field means
# the header is not valid on that packet.
FLAT_COLUMNS = [
    "pkt_id", "ingress_port", "ether_type",
    "ipv4_total_len", "ipv4_protocol", "ipv4_identification",
    "tcp_src_port", "tcp_dst_port", "udp_src_port", "udp_dst_port",
]


FEATURE_NAMES = ["frame_len", "ether_type", "ip_proto", "src_port", "dst_port"]


def has(col: str | Column) -> Column:
    """B1: header-valid predicate (the header struct / field is present)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull()


def frame_len() -> Column:
    """B2: IPv4 total length when IPv4 is valid, else 0."""
    return F.coalesce(F.col("ipv4_total_len"), F.lit(0)).cast("int")


def ip_proto() -> Column:
    """IPv4 protocol when IPv4 is valid, else 0 (decision tree only)."""
    return F.coalesce(F.col("ipv4_protocol"), F.lit(0)).cast("int")


def l4_port(side: str) -> Column:
    """TCP port, else UDP port, else 0. ``side`` is ``src`` or ``dst``."""
    return F.coalesce(F.col(f"tcp_{side}_port"), F.col(f"udp_{side}_port"), F.lit(0)).cast("int")


def is_bypass() -> Column:
    """B7 predicate: packets from the bypass ingress port skip the model."""
    return F.col("ingress_port") == F.lit(BYPASS_INGRESS_PORT)


def bypass_port() -> Column:
    return F.lit(BYPASS_EGRESS_PORT).cast("int")


def features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Add the model features to a flat packet table.

    Output keeps ``pkt_id``, ``ingress_port``, ``ipv4_identification`` (plus
    any ``keep`` columns) and adds frame_len, ether_type, ip_proto,
    src_port, dst_port. Everything is a projection: no shuffle.
    """
    produced = {"pkt_id", "ingress_port", "ipv4_identification", *FEATURE_NAMES}
    extra = [c for c in dict.fromkeys(keep or []) if c in df.columns and c not in produced]
    return df.select(
        "pkt_id", "ingress_port", "ipv4_identification",
        frame_len().alias("frame_len"),
        F.col("ether_type").cast("int").alias("ether_type"),
        ip_proto().alias("ip_proto"),
        l4_port("src").alias("src_port"),
        l4_port("dst").alias("dst_port"),
        *extra,
    )


def flatten_headers(df: DataFrame) -> DataFrame:
    """Map the nested packet shape (one struct per header) to flat columns."""
    out = df.select(
        "*",
        F.col("ethernet.ether_type").alias("ether_type"),
        F.col("ipv4.total_len").alias("ipv4_total_len"),
        F.col("ipv4.protocol").alias("ipv4_protocol"),
        F.col("ipv4.identification").alias("ipv4_identification"),
        F.col("tcp.src_port").alias("tcp_src_port"),
        F.col("tcp.dst_port").alias("tcp_dst_port"),
        F.col("udp.src_port").alias("udp_src_port"),
        F.col("udp.dst_port").alias("udp_dst_port"),
    )
    return out
