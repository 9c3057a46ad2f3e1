"""The shipped tree as one table of fixed values, and the model text rendered from it."""

from __future__ import annotations

from ..constants import DT_FEATURES, FEATURE_MAX

# --- fixed values: upper edges per feature (domain max last)
DT_EDGES = {
    "frame_len": [44, 51, 61, 64, 94, 139, 176, 208, 312, 335, 366, 65535],
    "ether_type": [65535],
    "ip_proto": [3, 11, 255],
    "src_port": [95, 2951, 4500, 4999, 8899, 27655, 61000, 65535],
    "dst_port": [66, 67, 435, 1907, 3071, 3392, 4999, 8946, 49159, 65535],
}

# --- fixed values: the leaves in rule order, each with its inclusive integer
# bounds on the features of LEAF_FEATURES, and its class
LEAF_FEATURES = ("frame_len", "ip_proto", "src_port", "dst_port")
DT_LEAVES = [
    ((0, 94), (0, 255), (0, 2951), (0, 66), 4),
    ((95, 65535), (0, 255), (0, 2951), (0, 66), 4),
    ((0, 335), (0, 255), (0, 2951), (67, 67), 3),
    ((336, 65535), (0, 255), (0, 2951), (67, 67), 1),
    ((0, 65535), (0, 3), (0, 95), (68, 65535), 3),
    ((0, 65535), (0, 3), (96, 2951), (68, 65535), 4),
    ((0, 366), (4, 255), (0, 2951), (68, 65535), 4),
    ((367, 65535), (4, 255), (0, 2951), (68, 65535), 4),
    ((0, 44), (0, 255), (2952, 4500), (0, 65535), 4),
    ((0, 44), (0, 255), (4501, 4999), (0, 65535), 0),
    ((45, 65535), (0, 255), (2952, 4999), (0, 49159), 0),
    ((45, 65535), (0, 255), (2952, 4999), (49160, 65535), 4),
    ((0, 64), (0, 255), (5000, 27655), (0, 66), 1),
    ((65, 65535), (0, 255), (5000, 27655), (0, 66), 3),
    ((0, 65535), (0, 255), (5000, 8899), (67, 65535), 4),
    ((0, 65535), (0, 255), (8900, 27655), (67, 65535), 4),
    ((0, 44), (0, 255), (27656, 65535), (0, 435), 4),
    ((45, 51), (0, 255), (27656, 65535), (0, 435), 4),
    ((52, 61), (0, 255), (27656, 65535), (0, 435), 2),
    ((62, 65535), (0, 255), (27656, 65535), (0, 435), 2),
    ((0, 139), (0, 255), (27656, 61000), (436, 1907), 3),
    ((140, 65535), (0, 255), (27656, 61000), (436, 1907), 3),
    ((0, 312), (0, 255), (61001, 65535), (436, 1907), 0),
    ((313, 65535), (0, 255), (61001, 65535), (436, 1907), 2),
    ((0, 65535), (0, 11), (27656, 65535), (1908, 3071), 4),
    ((0, 65535), (0, 11), (27656, 65535), (3072, 4999), 0),
    ((0, 65535), (12, 255), (27656, 65535), (1908, 3392), 4),
    ((0, 65535), (12, 255), (27656, 65535), (3393, 4999), 3),
    ((0, 208), (0, 255), (27656, 65535), (5000, 8946), 3),
    ((209, 65535), (0, 255), (27656, 65535), (5000, 8946), 1),
    ((0, 176), (0, 255), (27656, 65535), (8947, 65535), 4),
    ((177, 65535), (0, 255), (27656, 65535), (8947, 65535), 2),
]


def leaf_bounds(leaf: tuple) -> list[tuple[str, int, int]]:
    """The features that a leaf constrains, with bounds."""
    every = zip(LEAF_FEATURES, leaf)
    return [(f, lo, hi) for f, (lo, hi) in every if (lo, hi) != (0, FEATURE_MAX[f])]


def tree_text() -> str:
    """The tree in the model text grammar: five threshold lists, then a rule per leaf."""
    lines = []
    for f in DT_FEATURES:
        items = ", ".join(f"np.float64({float(e)})" for e in DT_EDGES[f] if e < FEATURE_MAX[f])
        lines.append(f"{f} = [{items}];")
    for leaf in DT_LEAVES:
        conds = []
        for f, lo, hi in leaf_bounds(leaf):
            conds += [f"{f}>{float(lo - 1)}"] if lo > 0 else []
            conds += [f"{f}<={float(hi)}"] if hi < FEATURE_MAX[f] else []
        lines.append(f"when {' and '.join(conds)} then {leaf[-1]};")
    return "\n".join(lines) + "\n"
