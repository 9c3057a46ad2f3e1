"""Packet tables (A1): the parsed header shape, batch or stream.

A packet is one row with one nullable struct per header; a NULL struct is a
header that is not valid on that packet. Unsigned fields use the next wider
signed type (Spark has no unsigned types); IPv6 addresses are 16-byte BINARY.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.features import flatten_headers

I, L, B = T.IntegerType(), T.LongType(), T.BinaryType()


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ETHERNET = _s(("dst_mac", L), ("src_mac", L), ("ether_type", I))
IPV4 = _s(
    ("version", I), ("ihl", I), ("diffserv", I), ("total_len", I), ("identification", I), ("flags", I),
    ("frag_offset", I), ("ttl", I), ("protocol", I), ("checksum", I), ("src_ip", L), ("dst_ip", L),
)
IPV6 = _s(
    ("version", I), ("traffic_class", I), ("flow_label", I), ("payload_len", I), ("next_hdr", I),
    ("hop_limit", I), ("src_ip", B), ("dst_ip", B),
)
ARP = _s(
    ("hw_type", I), ("proto_type", I), ("hw_addr_len", I), ("proto_addr_len", I), ("opcode", I),
    ("sender_mac", L), ("sender_ip", L), ("target_mac", L), ("target_ip", L),
)
TCP = _s(
    ("src_port", I), ("dst_port", I), ("seq_no", L), ("ack_no", L), ("data_offset", I), ("res", I),
    ("flags", I), ("window", I), ("checksum", I), ("urgent_ptr", I),
)
UDP = _s(("src_port", I), ("dst_port", I), ("hdr_length", I), ("checksum", I))
ICMP = _s(("type", I), ("code", I), ("checksum", I), ("id", I), ("seq_no", I))

PACKET = T.StructType(
    [
        T.StructField("pkt_id", L, True),
        T.StructField("ts", T.TimestampType(), True),
        T.StructField("ingress_port", I, True),
        T.StructField("ethernet", ETHERNET, True),
        T.StructField("ipv4", IPV4, True),
        T.StructField("ipv6", IPV6, True),
        T.StructField("arp", ARP, True),
        T.StructField("tcp", TCP, True),
        T.StructField("udp", UDP, True),
        T.StructField("icmp", ICMP, True),
    ]
)


def read_packets(spark: SparkSession, path: str, stream: bool = False, flat: bool = True) -> DataFrame:
    """A1: scan a packet table with the fixed header schema (no inference).

    ``flat=True`` adds the flat feature columns the scorers read; only the
    fields a query uses are read from parquet (column pruning).
    """
    reader = spark.readStream if stream else spark.read
    df = reader.schema(PACKET).parquet(path)
    return flatten_headers(df) if flat else df
