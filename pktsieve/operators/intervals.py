"""Point-in-interval lookup as an equi-join on coarse value blocks.

A bare ``lo <= x AND x <= hi`` join is a nested-loop join. Here the value
domain is cut into blocks of ``block`` values; every interval is listed once
per block it touches, and a point joins on ``(keys, block)`` and then keeps the
interval holding it. Intervals within one key must not overlap (bins do not),
so each point gets at most one partner and the candidates per point are at
most ``block``. The expanded interval table grows with the number of intervals
plus ``domain / block`` per key, never with the points.

The interval side is broadcast only after its row count is checked; larger
tables go through a shuffle join (AQE splits a hot block on the point side).
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS

DEFAULT_BLOCK = 64
_TAGS = itertools.count()


def expand_blocks(
    intervals: DataFrame, keys: list[str], lo: str, hi: str, carry: list[str], block: int = DEFAULT_BLOCK
) -> DataFrame:
    """One row per (interval, block it overlaps); ``carry`` columns ride along."""
    return intervals.select(
        *[F.col(k).alias(f"__ik_{k}") for k in keys],
        F.col(lo).alias("__ilo"),
        F.col(hi).alias("__ihi"),
        *[F.col(c).alias(f"__c_{c}") for c in carry],
        F.explode(
            F.sequence(F.floor(F.col(lo) / block).cast("bigint"), F.floor(F.col(hi) / block).cast("bigint"))
        ).alias("__iblk"),
    )


def locate(
    points: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    value: str | F.Column,
    carry: dict[str, str],
    lo: str = "lo",
    hi: str = "hi",
    block: int = DEFAULT_BLOCK,
    expanded: DataFrame | None = None,
    broadcast: bool | None = None,
) -> DataFrame:
    """Left join each point to the interval (same ``keys``) that holds ``value``.

    ``carry`` maps interval columns to the output names added to the points.
    Points with no holding interval keep NULLs (left outer join).
    """
    iv = expanded if expanded is not None else expand_blocks(intervals, keys, lo, hi, list(carry), block)
    if broadcast is None:
        broadcast = iv.count() <= MAX_BROADCAST_ROWS
    v = F.col(value) if isinstance(value, str) else value
    tag = next(_TAGS)
    pa, ia = f"__p{tag}", f"__i{tag}"
    pts = points.withColumn("__pv", v.cast("bigint")).withColumn("__pblk", F.floor(F.col("__pv") / block).cast("bigint"))
    right = (F.broadcast(iv) if broadcast else iv).alias(ia)
    left = pts.alias(pa)
    p = lambda c: F.col(f"{pa}.{c}")
    i = lambda c: F.col(f"{ia}.{c}")
    cond = [p(k) == i(f"__ik_{k}") for k in keys] + [
        p("__pblk") == i("__iblk"),
        i("__ilo") <= p("__pv"),
        p("__pv") <= i("__ihi"),
    ]
    joined = left.join(right, cond, "left")
    return joined.select(*[p(c) for c in points.columns], *[i(f"__c_{src}").alias(dst) for src, dst in carry.items()])
