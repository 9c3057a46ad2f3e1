"""The shipped centres as a table of fixed values, and the model text rendered from it."""

from __future__ import annotations

# --- fixed values: the shipped k-means centres (frame_len, src_port, dst_port), class from 1
KM_CENTRES = [(192, 1171, 846), (372, 49201, 7358), (218, 7690, 50028)]


def centre_text() -> str:
    """The centres in the model text grammar, a line each."""
    return "".join(f"centre point : ( {a},{b},{c},);\n" for a, b, c in KM_CENTRES)
