"""Fixed values of the packet-classification semantics.

Everything in this module is a value that must equal the reference for
results to match (feature order, domains, the distance cap, port maps,
protocol numbers, and the text patterns that define the model grammar).
They are stated once here, in natural order, and imported everywhere else.
"""

from __future__ import annotations

# --- fixed values: decision-tree features, in compiled-rule order, with domain maxima
DT_FEATURES = ["frame_len", "ether_type", "ip_proto", "src_port", "dst_port"]
FEATURE_MAX = {
    "frame_len": 65535,
    "ether_type": 65535,
    "ip_proto": 255,
    "src_port": 65535,
    "dst_port": 65535,
}

# --- fixed values: k-means features (order of the three centre coordinates)
KM_FEATURES = ["frame_len", "src_port", "dst_port"]
# per-feature squared distance saturates here; 3 x cap < 2**31
KM_DIST_CAP = 715827800
# distance tables cover every 16-bit feature value
KM_VALUE_DOMAIN = 65536

# --- fixed values: bypass and class -> egress port maps
BYPASS_INGRESS_PORT = 188
BYPASS_EGRESS_PORT = 156
DT_CLASS_PORTS = {0: 188, 1: 132, 2: 133, 3: 134, 4: 135}
KM_CLASS_PORTS = {1: 188, 2: 132, 3: 133}
MAX_CLASS_LABEL = 255

# --- fixed values: protocol numbers used by the frame parser
ETHERTYPE_IPV4 = 0x0800
ETHERTYPE_IPV6 = 0x86DD
ETHERTYPE_ARP = 0x0806
IP_PROTO_ICMP = 1
IP_PROTO_TCP = 6
IP_PROTO_UDP = 17

# --- fixed values: header sizes in bytes
ETH_LEN = 14
IPV4_LEN = 20
IPV6_LEN = 40
ARP_LEN = 28
TCP_LEN = 20
UDP_LEN = 8
ICMP_LEN = 8

# --- fixed values: model text grammar (Java regex syntax, same meaning as the
# patterns the model files are written against)
DT_FEATURE_LINE = r"^\s*([a-zA-Z_][a-zA-Z0-9_]*)\s*=\s*(\[.*\])\s*;\s*$"
DT_RULE_LINE = r"^\s*when\s+(.*?)\s+then\s+(\d+)\s*;\s*$"
DT_THRESHOLD_ITEM = r"np\.float64\(([-+]?\d*\.?\d+)\)"
DT_PREDICATE = r"\b([a-zA-Z_][a-zA-Z0-9_]*)\s*(<=|>)\s*([-+]?\d*\.?\d+)\b"
KM_CENTRE_LINE = (
    r"(?iu)centre\s+point\s*:\s*\(\s*"
    r"(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*,\s*\)\s*;\s*"
)
# line terminators recognised when splitting model text into lines
LINE_BREAK = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x85\u2028\u2029]"
