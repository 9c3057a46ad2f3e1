"""Rewrite a capture - decode, score with k-means (stamp), new checksum, write back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.frames import decode_frames, flat_packets, frame_checksum, rewrite_frames, split_quarantine
from ..operators.kmeans import KMModel, score_km


def rewrite_capture(frames: DataFrame, model: KMModel, model_id: str, frame_col: str = "frame") -> tuple[DataFrame, DataFrame]:
    """Returns (rewritten, quarantine).

    ``rewritten`` has pkt_id, ingress_port, class_id, egress_port, outcome and
    ``frame_out``: IPv4 frames carry the stamped identification (not on
    bypass) and a recomputed header checksum (on every IPv4 frame, bypass
    included, as it is done at egress); other frames are unchanged.
    ``quarantine`` holds frames too short for a header they announce.
    """
    ok, bad = split_quarantine(decode_frames(frames, frame_col))
    flat = flat_packets(ok, keep=["pkt_id", "ingress_port", frame_col]).withColumn(
        "ipv4", F.col("ipv4_total_len").isNotNull()
    )
    scored = score_km(flat, model, model_id=model_id, keep=["ingress_port", frame_col, "ipv4"])
    ident = F.col("ipv4_identification")
    out = scored.select(
        "pkt_id", "ingress_port", "class_id", "egress_port", "outcome",
        F.when(
            F.col("ipv4"),
            rewrite_frames(scored, frame_col, ident, frame_checksum(frame_col, ident)),
        ).otherwise(F.col(frame_col)).alias("frame_out"),
    )
    return out, bad.select("pkt_id", frame_col, "decode_error")
