"""Stand-in packet tables derived from the driver's test tables.

The reference ships no packet data, so packets are derived from ``events``
and ``lineitem`` by plain integer SQL. The same SQL text runs in Spark (over a
DataFrame argument) and in DuckDB (over the registered views), so the oracle
sees exactly the rows the Spark job scores. These builders only produce rows
in the packet schema; they do none of the scoring work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Boundary values (both sides of every model threshold) cycled by the grid.
GRID_LENGTHS = "20,44,45,51,52,61,62,64,65,94,95,139,140,176,177,208,209,312,313,335,336,366,367,1500,65535"
GRID_SPORTS = "0,95,96,2951,2952,4500,4501,4999,5000,8899,8900,27655,27656,61000,61001,65535"
GRID_DPORTS = "0,66,67,68,435,436,1907,1908,3071,3072,3392,3393,4999,5000,8946,8947,49159,49160,65535"

PACKETS_GRID_SQL = f"""
SELECT pkt_id, ts, ingress_port, ether_type,
       CASE WHEN is_v4 THEN len END AS ipv4_total_len,
       CASE WHEN is_v4 THEN proto END AS ipv4_protocol,
       CASE WHEN is_v4 THEN CAST(pkt_id % 65536 AS INT) END AS ipv4_identification,
       CASE WHEN is_tcp THEN sport END AS tcp_src_port,
       CASE WHEN is_tcp THEN dport END AS tcp_dst_port,
       CASE WHEN is_udp THEN sport END AS udp_src_port,
       CASE WHEN is_udp THEN dport END AS udp_dst_port
FROM (
  SELECT event_id AS pkt_id, ts,
    CAST(CASE WHEN event_id % 101 = 0 THEN 188 ELSE 128 + event_id % 4 END AS INT) AS ingress_port,
    CAST(CASE WHEN event_id % 7 <= 4 THEN 2048 WHEN event_id % 7 = 5 THEN 34525
              WHEN event_id % 3 = 0 THEN 2054 WHEN event_id % 3 = 1 THEN 2048
              ELSE 33024 END AS INT) AS ether_type,
    (event_id % 7 <= 4 OR (event_id % 7 = 6 AND event_id % 3 = 1)) AS is_v4,
    (event_id % 7 <= 1 OR (event_id % 7 = 5 AND event_id % 2 = 0)) AS is_tcp,
    (event_id % 7 IN (2, 3) OR (event_id % 7 = 5 AND event_id % 2 = 1)) AS is_udp,
    CAST(CASE WHEN event_id % 7 <= 1 THEN 6 WHEN event_id % 7 <= 3 THEN 17
              WHEN event_id % 7 = 4 THEN 1 ELSE 47 END AS INT) AS proto,
    CAST(split_part('{GRID_LENGTHS}', ',', CAST(event_id % 25 AS INT) + 1) AS INT) AS len,
    CAST(split_part('{GRID_SPORTS}', ',', CAST(event_id % 16 AS INT) + 1) AS INT) AS sport,
    CAST(split_part('{GRID_DPORTS}', ',', CAST(event_id % 19 AS INT) + 1) AS INT) AS dport
  FROM {{events}}) g
"""

PACKETS_BULK_SQL = """
SELECT l_orderkey * 8 + l_linenumber AS pkt_id, l_shipdate AS ts,
  CAST(128 + l_suppkey % 4 AS INT) AS ingress_port, CAST(2048 AS INT) AS ether_type,
  CAST(20 + (l_orderkey * 31 + l_linenumber * 97 + l_partkey) % 1481 AS INT) AS ipv4_total_len,
  CAST(CASE WHEN l_linenumber % 2 = 0 THEN 6 ELSE 17 END AS INT) AS ipv4_protocol,
  CAST((l_orderkey * 13 + l_linenumber) % 65536 AS INT) AS ipv4_identification,
  CAST(CASE WHEN l_linenumber % 2 = 0 THEN (l_orderkey * 40503 + l_partkey * 7919 + l_linenumber) % 65536 END AS INT) AS tcp_src_port,
  CAST(CASE WHEN l_linenumber % 2 = 0 THEN (l_partkey * 52711 + l_orderkey * 17 + l_linenumber) % 65536 END AS INT) AS tcp_dst_port,
  CAST(CASE WHEN l_linenumber % 2 = 1 THEN (l_orderkey * 40503 + l_partkey * 7919 + l_linenumber) % 65536 END AS INT) AS udp_src_port,
  CAST(CASE WHEN l_linenumber % 2 = 1 THEN (l_partkey * 52711 + l_orderkey * 17 + l_linenumber) % 65536 END AS INT) AS udp_dst_port
FROM {lineitem}
"""

# A large generated rule corpus, already in predicate form (model, rule,
# feature, op, value): 20 models, one rule per order, one predicate per line.
PREDICATES_BULK_SQL = """
SELECT CAST(l_orderkey % 20 AS INT) AS model_id, l_orderkey AS rule_id, feature, op,
  CASE WHEN feature = 'ip_proto' THEN CAST(l_partkey % 270 AS DOUBLE) + 0.5
       ELSE CAST((l_partkey * 37 + l_suppkey * 11) % 66000 AS DOUBLE) + 0.5 END AS value,
  l_partkey % 5 <> 0 AS is_threshold
FROM (SELECT l_orderkey, l_partkey, l_suppkey,
        split_part('frame_len,ether_type,ip_proto,src_port,dst_port,ttl', ',', CAST((l_partkey + l_linenumber) % 6 AS INT) + 1) AS feature,
        CASE WHEN l_suppkey % 2 = 0 THEN '<=' ELSE '>' END AS op
      FROM {lineitem}) t
"""


def _h(expr: str, width: int) -> str:
    return f"lpad(hex({expr}), {width}, '0')"


# Raw Ethernet frames (as hex text) built from the grid packets, with the
# extra header fields a capture carries derived from pkt_id. Every 13th frame
# is cut short (0..59 bytes) to exercise the quarantine. Same SQL text in
# Spark and DuckDB; the decode job only ever sees ``frame_hex``.
FRAMES_SQL = f"""
SELECT pkt_id, ingress_port, ether_type, ipv4_total_len, ipv4_protocol, ipv4_identification,
  tcp_src_port, tcp_dst_port, udp_src_port, udp_dst_port,
  ttl, diffserv, flags, src_ip, dst_ip, full_len,
  CASE WHEN pkt_id % 13 = 0 THEN substr(full_hex, 1, 2 * CAST(pkt_id % 60 AS INT)) ELSE full_hex END AS frame_hex
FROM (
  SELECT *, CAST(length(full_hex) / 2 AS INT) AS full_len FROM (
    SELECT *,
      {_h('dst_mac', 12)} || {_h('src_mac', 12)} || {_h('ether_type', 4)} ||
      CASE
        WHEN ipv4_total_len IS NOT NULL THEN
          '45' || {_h('diffserv', 2)} || {_h('ipv4_total_len', 4)} || {_h('ipv4_identification', 4)} ||
          {_h('flags * 8192', 4)} || {_h('ttl', 2)} || {_h('ipv4_protocol', 2)} || '0000' ||
          {_h('src_ip', 8)} || {_h('dst_ip', 8)}
        WHEN ether_type = 34525 THEN
          '6' || {_h('diffserv', 2)} || '00000' ||
          CASE WHEN tcp_src_port IS NOT NULL THEN '001406' ELSE '000811' END || {_h('ttl', 2)} ||
          '20010DB8000000000000' || {_h('src_ip', 12)} || 'FE800000000000000000' || {_h('dst_ip', 12)}
        WHEN ether_type = 2054 THEN
          '0001080006040001' || {_h('src_mac', 12)} || {_h('src_ip', 8)} || {_h('dst_mac', 12)} || {_h('dst_ip', 8)}
        ELSE '8100CAFE'
      END ||
      CASE
        WHEN tcp_src_port IS NOT NULL THEN
          {_h('tcp_src_port', 4)} || {_h('tcp_dst_port', 4)} || {_h('pkt_id % 4294967296', 8)} || '00000000' ||
          '5010FFFF00000000'
        WHEN udp_src_port IS NOT NULL THEN {_h('udp_src_port', 4)} || {_h('udp_dst_port', 4)} || '00080000'
        WHEN ipv4_protocol = 1 THEN '08000000' || {_h('pkt_id % 65536', 4)} || '0001'
        WHEN ipv4_total_len IS NOT NULL THEN 'DEADBEEF'
        ELSE ''
      END AS full_hex
    FROM (
      SELECT p.*,
        CAST(p.pkt_id % 281474976710656 AS BIGINT) AS dst_mac,
        CAST(2199023255552 + p.pkt_id % 1048576 AS BIGINT) AS src_mac,
        CAST(64 - p.pkt_id % 32 AS INT) AS ttl,
        CAST(p.pkt_id % 4 AS INT) AS diffserv,
        CAST(CASE WHEN p.pkt_id % 3 = 0 THEN 2 ELSE 0 END AS INT) AS flags,
        CAST(3232235520 + p.pkt_id % 65536 AS BIGINT) AS src_ip,
        CAST(167772160 + (p.pkt_id * 7) % 16777216 AS BIGINT) AS dst_ip
      FROM ({{packets}}) p) w) f) x
"""


def packets_grid(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Boundary-grid packets from ``events`` (FIXTURES F3)."""
    return spark.sql(PACKETS_GRID_SQL, events=events)


def packets_bulk(spark: SparkSession, lineitem: DataFrame) -> DataFrame:
    """Volume packets from ``lineitem`` (FIXTURES F4)."""
    return spark.sql(PACKETS_BULK_SQL, lineitem=lineitem)


def predicates_bulk(spark: SparkSession, lineitem: DataFrame) -> DataFrame:
    """Generated rule corpus in predicate form (FIXTURES F7)."""
    return spark.sql(PREDICATES_BULK_SQL, lineitem=lineitem)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def grid_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_grid(spark, table(spark, sf_dir, "events"))


def bulk_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_bulk(spark, table(spark, sf_dir, "lineitem"))


def oracle_grid() -> str:
    """The grid SQL for DuckDB, reading the ``events`` view."""
    return PACKETS_GRID_SQL.replace("{events}", "events")


def oracle_bulk() -> str:
    return PACKETS_BULK_SQL.replace("{lineitem}", "lineitem")


_captures: dict = {}


def frames_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid packets as a stored capture: (pkt_id, ingress_port, frame BINARY, ...source columns).

    The capture is written once per session as a parquet table in the shared
    work folder and read back, as a real capture table would be read.
    """
    from ..session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _captures:
        src = spark.sql(FRAMES_SQL, packets=grid_from(spark, sf_dir)).withColumn("frame", F.unhex("frame_hex"))
        path = scratch_path(spark, "capture")
        # a capture is many files; spread the stand-in over the cluster's slots
        files = max(1, spark.sparkContext.defaultParallelism)
        src.repartitionByRange(files, "pkt_id").write.mode("overwrite").parquet(path)
        _captures[key] = path
    return spark.read.parquet(_captures[key])


def oracle_frames() -> str:
    return FRAMES_SQL.replace("{packets}", oracle_grid())


def oracle_predicates() -> str:
    return PREDICATES_BULK_SQL.replace("{lineitem}", "lineitem")
