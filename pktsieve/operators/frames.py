"""Raw frame decode (A2), IPv4 checksum (B18), stamp and rewrite.

Frames are BINARY columns. Decoding reads fixed byte offsets of the first
74 bytes with built-in functions (``substring`` / ``hex`` / ``conv``): one
projection per row, no Python. The parser follows Ethernet -> (IPv4 | IPv6 |
ARP) -> (TCP | UDP | ICMP) by ether type and protocol, takes 20 bytes of
IPv4 header always (options and fragments are flagged, not followed), and
never reads a header that the frame does not fully hold: such rows get a
``decode_error`` and belong in the quarantine table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    ARP_LEN,
    ETH_LEN,
    ETHERTYPE_ARP,
    ETHERTYPE_IPV4,
    ETHERTYPE_IPV6,
    ICMP_LEN,
    IP_PROTO_ICMP,
    IP_PROTO_TCP,
    IP_PROTO_UDP,
    IPV4_LEN,
    IPV6_LEN,
    TCP_LEN,
    UDP_LEN,
)
from ..functions.arith import ipv4_checksum

HEAD = 74  # the deepest header end: Ethernet + IPv6 + TCP


CHUNK = 7  # bytes per conv call: 56 bits always fit a positive BIGINT


def _chunks(spark_cols: list, hexcol: Column, nbytes: int, prefix: str) -> list[str]:
    """Add columns holding ``nbytes`` of a hex string as 7-byte integers (zero padded)."""
    n = -(-nbytes // CHUNK)
    padded = F.rpad(hexcol, n * CHUNK * 2, "0")
    names = []
    for k in range(n):
        name = f"{prefix}{k}"
        spark_cols.append(F.conv(F.substring(padded, k * CHUNK * 2 + 1, CHUNK * 2), 16, 10).cast("bigint").alias(name))
        names.append(name)
    return names


def _reader(names: list[str]):
    """Field reader over chunk columns: get(offset, nbytes) -> unsigned BIGINT."""

    def get(o: int, nb: int) -> Column:
        c0, c1 = o // CHUNK, (o + nb - 1) // CHUNK
        if c0 == c1:
            shift = 8 * (CHUNK - (o % CHUNK) - nb)
            return F.shiftright(F.col(names[c0]), shift).bitwiseAND(F.lit((1 << (8 * nb)) - 1))
        head = CHUNK - (o % CHUNK)  # bytes taken from the first chunk
        tail = nb - head
        hi = F.col(names[c0]).bitwiseAND(F.lit((1 << (8 * head)) - 1))
        lo = F.shiftright(F.col(names[c1]), 8 * (CHUNK - tail))
        return F.shiftleft(hi, 8 * tail).bitwiseOR(lo)

    return get


def decode_frames(df: DataFrame, frame_col: str = "frame") -> DataFrame:
    """A2: add one struct column per header (NULL when not valid) and ``decode_error``.

    Output columns added: ethernet, ipv4, ipv6, arp, tcp, udp, icmp,
    decode_error, ipv4_has_options, ipv4_is_fragment.
    Each header region is read as 7-byte integers (one ``conv`` per 56 bits)
    and fields are cut out with shifts and masks; the transport region starts
    where the network header ends (34 or 54). ``frame_col`` should be a
    stored column (a capture table): every field read refers to it, so a
    frame computed earlier in the same plan would be inlined into each of
    them; write such frames out first.
    """
    n, h = F.col("__n"), F.col("__h")
    s1 = df.select(
        "*",
        F.length(F.col(frame_col)).alias("__n"),
        F.hex(F.substring(F.col(frame_col), 1, HEAD)).alias("__h"),
    )
    cols: list = []
    eth = _reader(_chunks(cols, F.substring(h, 1, ETH_LEN * 2), ETH_LEN, "__e"))
    net = _reader(_chunks(cols, F.substring(h, ETH_LEN * 2 + 1, IPV6_LEN * 2), IPV6_LEN, "__w"))
    s2 = s1.select("*", *cols)
    s3 = s2.select("*", F.when(n >= ETH_LEN, eth(12, 2)).alias("__et"))
    et = F.col("__et")
    is4, is6 = et == ETHERTYPE_IPV4, et == ETHERTYPE_IPV6
    l4p = F.when(is4, net(9, 1)).when(is6, net(6, 1))
    l4o = F.when(is4, F.lit(ETH_LEN + IPV4_LEN)).when(is6, F.lit(ETH_LEN + IPV6_LEN))
    s4 = s3.select(
        "*",
        is4.alias("__is4"), is6.alias("__is6"), (et == ETHERTYPE_ARP).alias("__arp"),
        l4p.alias("__l4p"), l4o.alias("__l4o"),
    )
    is4, is6, isarp = F.col("__is4"), F.col("__is6"), F.col("__arp")
    l4p, l4o = F.col("__l4p"), F.col("__l4o")
    is_tcp = l4p == IP_PROTO_TCP
    is_udp = l4p == IP_PROTO_UDP
    is_icmp = is4 & (l4p == IP_PROTO_ICMP)
    err = (
        F.when(n.isNull(), F.lit("missing:frame"))
        .when(n < ETH_LEN, F.lit("truncated:ethernet"))
        .when(is4 & (n < ETH_LEN + IPV4_LEN), F.lit("truncated:ipv4"))
        .when(is6 & (n < ETH_LEN + IPV6_LEN), F.lit("truncated:ipv6"))
        .when(isarp & (n < ETH_LEN + ARP_LEN), F.lit("truncated:arp"))
        .when(is_tcp & (n < l4o + TCP_LEN), F.lit("truncated:tcp"))
        .when(is_udp & (n < l4o + UDP_LEN), F.lit("truncated:udp"))
        .when(is_icmp & (n < l4o + ICMP_LEN), F.lit("truncated:icmp"))
    )
    tcols: list = []
    tr = _reader(_chunks(tcols, F.substring(h, l4o * 2 + 1, TCP_LEN * 2), TCP_LEN, "__t"))
    s5 = s4.select(
        "*",
        err.alias("decode_error"),
        is_tcp.alias("__tcp"), is_udp.alias("__udp"), is_icmp.alias("__icmp"),
        *tcols,
    )
    ok = F.col("decode_error").isNull()
    b0, b1 = net(0, 1), net(1, 1)
    ethernet = F.struct(eth(0, 6).alias("dst_mac"), eth(6, 6).alias("src_mac"), et.cast("int").alias("ether_type"))
    ipv4 = F.struct(
        F.shiftright(b0, 4).cast("int").alias("version"),
        b0.bitwiseAND(F.lit(15)).cast("int").alias("ihl"),
        b1.cast("int").alias("diffserv"),
        net(2, 2).cast("int").alias("total_len"),
        net(4, 2).cast("int").alias("identification"),
        F.shiftright(net(6, 1), 5).cast("int").alias("flags"),
        net(6, 2).bitwiseAND(F.lit(0x1FFF)).cast("int").alias("frag_offset"),
        net(8, 1).cast("int").alias("ttl"),
        net(9, 1).cast("int").alias("protocol"),
        net(10, 2).cast("int").alias("checksum"),
        net(12, 4).alias("src_ip"),
        net(16, 4).alias("dst_ip"),
    )
    ipv6 = F.struct(
        F.shiftright(b0, 4).cast("int").alias("version"),
        (b0.bitwiseAND(F.lit(15)) * 16 + F.shiftright(b1, 4)).cast("int").alias("traffic_class"),
        (b1.bitwiseAND(F.lit(15)) * 65536 + net(2, 2)).cast("int").alias("flow_label"),
        net(4, 2).cast("int").alias("payload_len"),
        net(6, 1).cast("int").alias("next_hdr"),
        net(7, 1).cast("int").alias("hop_limit"),
        F.substring(F.col(frame_col), ETH_LEN + 9, 16).alias("src_ip"),
        F.substring(F.col(frame_col), ETH_LEN + 25, 16).alias("dst_ip"),
    )
    arp = F.struct(
        net(0, 2).cast("int").alias("hw_type"),
        net(2, 2).cast("int").alias("proto_type"),
        net(4, 1).cast("int").alias("hw_addr_len"),
        net(5, 1).cast("int").alias("proto_addr_len"),
        net(6, 2).cast("int").alias("opcode"),
        net(8, 6).alias("sender_mac"),
        net(14, 4).alias("sender_ip"),
        net(18, 6).alias("target_mac"),
        net(24, 4).alias("target_ip"),
    )
    tcp = F.struct(
        tr(0, 2).cast("int").alias("src_port"),
        tr(2, 2).cast("int").alias("dst_port"),
        tr(4, 4).alias("seq_no"),
        tr(8, 4).alias("ack_no"),
        F.shiftright(tr(12, 1), 4).cast("int").alias("data_offset"),
        tr(12, 1).bitwiseAND(F.lit(15)).cast("int").alias("res"),
        tr(13, 1).cast("int").alias("flags"),
        tr(14, 2).cast("int").alias("window"),
        tr(16, 2).cast("int").alias("checksum"),
        tr(18, 2).cast("int").alias("urgent_ptr"),
    )
    udp = F.struct(
        tr(0, 2).cast("int").alias("src_port"),
        tr(2, 2).cast("int").alias("dst_port"),
        tr(4, 2).cast("int").alias("hdr_length"),
        tr(6, 2).cast("int").alias("checksum"),
    )
    icmp = F.struct(
        tr(0, 1).cast("int").alias("type"),
        tr(1, 1).cast("int").alias("code"),
        tr(2, 2).cast("int").alias("checksum"),
        tr(4, 2).cast("int").alias("id"),
        tr(6, 2).cast("int").alias("seq_no"),
    )
    out = s5.select(
        *df.columns,
        F.when(ok, ethernet).alias("ethernet"),
        F.when(ok & is4, ipv4).alias("ipv4"),
        F.when(ok & is6, ipv6).alias("ipv6"),
        F.when(ok & isarp, arp).alias("arp"),
        F.when(ok & F.col("__tcp"), tcp).alias("tcp"),
        F.when(ok & F.col("__udp"), udp).alias("udp"),
        F.when(ok & F.col("__icmp"), icmp).alias("icmp"),
        "decode_error",
    )
    return out.select(
        "*",
        (F.col("ipv4.ihl") > 5).alias("ipv4_has_options"),
        ((F.col("ipv4.frag_offset") > 0) | (F.col("ipv4.flags").bitwiseAND(F.lit(1)) == 1)).alias("ipv4_is_fragment"),
    )


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that decoded vs rows for the quarantine table (with their reason)."""
    ok = decoded.filter(F.col("decode_error").isNull())
    bad = decoded.filter(F.col("decode_error").isNotNull())
    return ok, bad


def flat_packets(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Decoded header structs -> the flat packet columns the scorers read."""
    return decoded.select(
        *(keep or []),
        F.col("ethernet.ether_type").alias("ether_type"),
        F.col("ipv4.total_len").alias("ipv4_total_len"),
        F.col("ipv4.protocol").alias("ipv4_protocol"),
        F.col("ipv4.identification").alias("ipv4_identification"),
        F.col("tcp.src_port").alias("tcp_src_port"),
        F.col("tcp.dst_port").alias("tcp_dst_port"),
        F.col("udp.src_port").alias("udp_src_port"),
        F.col("udp.dst_port").alias("udp_dst_port"),
    )


def header_checksum(ipv4: str = "ipv4", identification: Column | None = None) -> Column:
    """B18 over a decoded ipv4 struct, optionally with a new identification."""
    c = lambda f: F.col(f"{ipv4}.{f}")
    return ipv4_checksum(
        c("version"), c("ihl"), c("diffserv"), c("total_len"),
        c("identification") if identification is None else identification,
        c("flags"), c("frag_offset"), c("ttl"), c("protocol"), c("src_ip"), c("dst_ip"),
    )


def frame_checksum(frame_col: str = "frame", identification: Column | None = None) -> Column:
    """B18 read straight from the frame: the one's-complement sum of the
    IPv4 header's 16-bit words, the checksum word left out; optionally with
    a new identification word."""
    nh = F.hex(F.substring(F.col(frame_col), ETH_LEN + 1, IPV4_LEN))
    s = None
    for k in range(IPV4_LEN // 2):
        if k == 5:  # the checksum field itself
            continue
        word = F.conv(F.substring(nh, 4 * k + 1, 4), 16, 10).cast("bigint")
        w = identification.cast("bigint") if (k == 2 and identification is not None) else word
        s = w if s is None else s + w
    for _ in range(2):
        s = s.bitwiseAND(F.lit(0xFFFF)) + F.shiftright(s, 16)
    return (F.lit(0xFFFF) - s).cast("int")


def u16_bytes(x: Column) -> Column:
    """Two big-endian bytes of a 16-bit value."""
    return F.unhex(F.lpad(F.hex(x.cast("bigint")), 4, "0"))


def rewrite_frames(df: DataFrame, frame_col: str, identification: Column, checksum: Column) -> Column:
    """A10: the frame with IPv4 identification (bytes 19-20) and checksum
    (bytes 25-26, 1-based) replaced; every other byte unchanged."""
    f = F.col(frame_col)
    with_id = F.overlay(f, u16_bytes(identification), F.lit(ETH_LEN + 5), F.lit(2))
    return F.overlay(with_id, u16_bytes(checksum), F.lit(ETH_LEN + 11), F.lit(2))
