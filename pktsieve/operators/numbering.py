"""Consecutive numbering per key in file order, with bounded groups.

``row_number() over (partition by key order by pos)`` puts a whole key in
one task. Here rows are first numbered inside blocks of ``block`` positions
(a group holds at most ``block`` rows), then each block adds the number of
rows in the earlier blocks of its key (a small table: one row per block).
Exact and deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS

BLOCK = 1 << 20


def number_in_order(df: DataFrame, key: str, pos: str, out: str, start: int = 0, block: int = BLOCK) -> DataFrame:
    """Add ``out`` = start + rank of ``pos`` within ``key`` (positions distinct per key)."""
    b = df.withColumn("__blk", F.floor(F.col(pos) / block).cast("bigint"))
    local = b.withColumn("__i", F.row_number().over(Window.partitionBy(key, "__blk").orderBy(pos)) - 1)
    counts = b.groupBy(key, "__blk").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(key).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "__blk", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    n_blocks = offsets.count()
    right = F.broadcast(offsets) if n_blocks <= MAX_BROADCAST_ROWS else offsets
    j = local.join(right, [key, "__blk"])
    return j.withColumn(out, (F.col("__off") + F.col("__i") + F.lit(start)).cast("int")).drop("__blk", "__i", "__off")
