"""Frame decode (A2), quarantine, checksum (B18) and rewrite."""

from conftest import SF001
from pyspark.sql import functions as F

from pktsieve.operators.frames import decode_frames, frame_checksum, split_quarantine
from pktsieve.plans.capture import rewrite_capture
from pktsieve.plans.models import KM_ID
from pktsieve.session import scratch_path
from pktsieve.sources.fixtures import frames_from, grid_from

VECTOR = (
    "0000000000010000000000020800" "4500007300004000401100" "00c0a80001c0a800c7" "d903003500000000"
)


def test_decode_vector(spark):
    df = spark.createDataFrame([(VECTOR,)], "h string").select(F.unhex("h").alias("frame"))
    r = decode_frames(df).collect()[0]
    assert r.decode_error is None
    assert r.ethernet.ether_type == 2048
    assert (r.ipv4.total_len, r.ipv4.protocol, r.ipv4.src_ip, r.ipv4.dst_ip) == (115, 17, 3232235521, 3232235719)
    assert (r.udp.src_port, r.udp.dst_port) == (55555, 53)
    assert r.tcp is None and r.ipv6 is None and r.arp is None
    assert (r.ipv4.flags, r.ipv4.frag_offset, r.ipv4.ttl) == (2, 0, 64)
    assert r.ipv4_has_options is False and r.ipv4_is_fragment is False


def test_checksum_from_frame(spark):
    from pktsieve.operators.frames import header_checksum

    df = spark.createDataFrame([(VECTOR,)], "h string").select(F.unhex("h").alias("frame"))
    assert df.select(frame_checksum("frame")).collect()[0][0] == 0xB861
    assert decode_frames(df).select(header_checksum("ipv4")).collect()[0][0] == 0xB861


def test_truncated_never_partial(spark):
    rows = [(n, VECTOR[: 2 * n]) for n in range(0, 43)]
    df = spark.createDataFrame(rows, "n int, h string").select("n", F.unhex("h").alias("frame"))
    out = {r.n: r for r in decode_frames(df).collect()}
    for n in range(0, 42):
        assert out[n].decode_error is not None, n
        assert out[n].ipv4 is None and out[n].udp is None and out[n].ethernet is None
    assert out[42].decode_error is None
    assert out[13].decode_error == "truncated:ethernet"
    assert out[20].decode_error == "truncated:ipv4"
    assert out[41].decode_error == "truncated:udp"


def test_round_trip_grid(spark):
    """Frames built from the grid packets decode back to the same columns."""
    fr = frames_from(spark, SF001)
    ok, bad = split_quarantine(decode_frames(fr))
    assert bad.count() + ok.count() == fr.count()
    assert bad.filter(F.length("frame") >= F.col("full_len")).count() == 0  # only cut frames fail
    cols = ["ipv4_total_len", "ipv4_protocol", "ipv4_identification", "tcp_src_port", "tcp_dst_port",
            "udp_src_port", "udp_dst_port"]
    got = ok.select(
        "pkt_id", F.col("ethernet.ether_type").alias("ether_type"),
        F.col("ipv4.total_len").alias("ipv4_total_len"), F.col("ipv4.protocol").alias("ipv4_protocol"),
        F.col("ipv4.identification").alias("ipv4_identification"),
        F.col("tcp.src_port").alias("tcp_src_port"), F.col("tcp.dst_port").alias("tcp_dst_port"),
        F.col("udp.src_port").alias("udp_src_port"), F.col("udp.dst_port").alias("udp_dst_port"),
    )
    src = grid_from(spark, SF001).select("pkt_id", "ether_type", *cols).join(ok.select("pkt_id"), "pkt_id")
    assert got.exceptAll(src).count() == 0 and src.exceptAll(got).count() == 0


def test_rewrite_changes_only_two_fields(spark, km):
    fr = frames_from(spark, SF001)
    out, quarantine = rewrite_capture(fr, km, KM_ID)
    j = out.join(fr.select("pkt_id", "frame"), "pkt_id")
    rows = j.select("pkt_id", "outcome", F.hex("frame").alias("a"), F.hex("frame_out").alias("b")).collect()
    assert quarantine.count() + len(rows) == fr.count()
    for r in rows:
        assert len(r.a) == len(r.b)
        diff = [i for i in range(0, len(r.a), 2) if r.a[i:i + 2] != r.b[i:i + 2]]
        assert all(18 <= i // 2 <= 19 or 24 <= i // 2 <= 25 for i in diff), r.pkt_id
    # the rewritten capture, as written to storage, decodes and its header checksum verifies
    path = scratch_path(spark, "t_rewritten")
    out.select("pkt_id", F.col("frame_out").alias("frame")).write.parquet(path)
    d = decode_frames(spark.read.parquet(path)).filter(F.col("ipv4").isNotNull())
    assert d.filter(F.col("ipv4.checksum") != frame_checksum("frame")).count() == 0


def test_packet_table_round_trip(spark, dt):
    """Decoded headers stored as a packet table (A1) score like the source packets."""
    from pktsieve.operators.dtree_score import score_dt
    from pktsieve.plans.models import DT_ID
    from pktsieve.sources.packets import PACKET, read_packets

    ok, _ = split_quarantine(decode_frames(frames_from(spark, SF001)))
    path = scratch_path(spark, "t_packets")
    ok.select(*[F.col(f.name).cast(f.dataType) if f.name != "ts" else F.lit(None).cast("timestamp").alias("ts")
                for f in PACKET.fields]).write.parquet(path)
    pk = read_packets(spark, path)
    a = score_dt(pk, dt, model_id=DT_ID)
    b = score_dt(grid_from(spark, SF001).join(ok.select("pkt_id"), "pkt_id"), dt, model_id=DT_ID)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert read_packets(spark, path, flat=False).schema == PACKET


def test_ipv4_options_not_followed(spark):
    """ihl = 6: 20 header bytes are still taken, ports come from the option word."""
    opt = "0000000000010000000000020800" "4600007800004000400600" "00c0a80001c0a800c7" "AABBCCDD" + "0050" * 10
    df = spark.createDataFrame([(opt,)], "h string").select(F.unhex("h").alias("frame"))
    r = decode_frames(df).collect()[0]
    assert r.ipv4.ihl == 6 and r.ipv4_has_options is True
    assert (r.tcp.src_port, r.tcp.dst_port) == (0xAABB, 0xCCDD)


def test_fragment_flagged(spark):
    frag = "0000000000010000000000020800" "4500007300002001401100" "00c0a80001c0a800c7" "d903003500000000"
    df = spark.createDataFrame([(frag,)], "h string").select(F.unhex("h").alias("frame"))
    r = decode_frames(df).collect()[0]
    assert r.ipv4_is_fragment is True and r.udp.src_port == 55555
