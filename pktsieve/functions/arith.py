"""Integer column helpers.

All of them are built-in expressions on BIGINT, so they stay inside
whole-stage codegen. Spark's ANSI mode raises on overflow, so every product is
taken on BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import KM_DIST_CAP

U32 = 4294967296


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_edge_le(v: str | Column) -> Column:
    """``x <= v`` on integers is ``x <= floor(v)``."""
    return F.floor(_c(v)).cast("bigint")


def int_edge_gt(v: str | Column) -> Column:
    """``x > v`` on integers starts at ``floor(v) + 1``."""
    return (F.floor(_c(v)) + F.lit(1)).cast("bigint")


def clamp(x: str | Column, hi: str | Column | int) -> Column:
    """Clamp into the feature domain ``0..hi``."""
    h = hi if isinstance(hi, Column) else (F.col(hi) if isinstance(hi, str) else F.lit(hi))
    return F.greatest(F.lit(0), F.least(_c(x), h))


def safe_double(v: str | Column, hi: str | Column | int) -> Column:
    """Bound a parsed number to [-1, hi + 1] before flooring.

    Integer edges are clamped into the domain afterwards, so this keeps every
    result equal while keeping ``floor`` inside BIGINT for absurd inputs.
    """
    h = hi if isinstance(hi, Column) else (F.col(hi) if isinstance(hi, str) else F.lit(hi))
    return F.greatest(F.lit(-1.0), F.least(_c(v), h.cast("double") + F.lit(1.0)))


def sq(x: str | Column, c: str | Column | int) -> Column:
    """Squared difference on BIGINT."""
    cc = c if isinstance(c, Column) else (F.col(c) if isinstance(c, str) else F.lit(c))
    d = _c(x).cast("bigint") - cc.cast("bigint")
    return d * d


def cap(x: str | Column) -> Column:
    """Saturate a per-feature distance at the fixed cap."""
    return F.least(_c(x), F.lit(KM_DIST_CAP).cast("bigint"))


def delta_u32(a: str | Column, b: str | Column) -> Column:
    """``a - b`` as an unsigned 32-bit value."""
    return F.pmod(_c(a).cast("bigint") - _c(b).cast("bigint"), F.lit(U32))


def stamp_identification(ident: str | Column, min_dist: str | Column, delta: str | Column) -> Column:
    """Bits 3:0 from min_dist, bits 7:4 from delta, the rest kept."""
    keep = _c(ident).cast("bigint").bitwiseAND(F.lit(0xFF00))
    low = _c(min_dist).cast("bigint").bitwiseAND(F.lit(0xF))
    mid = _c(delta).cast("bigint").bitwiseAND(F.lit(0xF)) * F.lit(16)
    return (keep.bitwiseOR(mid).bitwiseOR(low)).cast("int")


def ipv4_checksum(
    version: str | Column, ihl: str | Column, diffserv: str | Column,
    total_len: str | Column, identification: str | Column,
    flags: str | Column, frag_offset: str | Column,
    ttl: str | Column, protocol: str | Column,
    src_ip: str | Column, dst_ip: str | Column,
) -> Column:
    """one's-complement sum over the IPv4 header words, checksum left out."""
    b = lambda x: _c(x).cast("bigint")
    words = [
        b(version) * 4096 + b(ihl) * 256 + b(diffserv),
        b(total_len),
        b(identification),
        b(flags) * 8192 + b(frag_offset),
        b(ttl) * 256 + b(protocol),
        F.shiftright(b(src_ip), 16),
        b(src_ip).bitwiseAND(F.lit(0xFFFF)),
        F.shiftright(b(dst_ip), 16),
        b(dst_ip).bitwiseAND(F.lit(0xFFFF)),
    ]
    s = words[0]
    for w in words[1:]:
        s = s + w
    for _ in range(2):
        s = s.bitwiseAND(F.lit(0xFFFF)) + F.shiftright(s, 16)
    return (F.lit(0xFFFF) - s).cast("int")
