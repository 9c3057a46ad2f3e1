"""Shared helpers of the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed

__all__ = ["checkpointed", "connected_components", "give_back", "giving_back", "groups_for", "small", "table", "text_or_empty"]

# Broadcast limit in bytes of a hashed relation, as estimated from counted rows and their 8-byte words.
MAX_BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    """The text, with null read as the empty string."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def give_back() -> None:
    """Return a task's freed buffers to the system: its Python worker lives on beside the next tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory until it is told
    if trim is not None:
        trim(0)


def giving_back(task: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``task`` over a partition's batches, followed by :func:`give_back` once its own last batch is freed too."""

    @functools.wraps(task)
    def run(batches):
        yield from task(batches)  # at its end the task's variables are gone
        give_back()

    return run


def groups_for(rows: int, per_group: int) -> int:
    """How many hash groups give about ``per_group`` rows each."""
    return max(1, math.ceil(rows / per_group))


def small(df: DataFrame, rows: int, words: int) -> DataFrame:
    """``df`` to be broadcast if its counted rows of about ``words`` 8-byte values fit the limit, else as it is."""
    return F.broadcast(df) if rows * 8 * (words + 4) <= MAX_BROADCAST_BYTES else df


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph of longs.

    ``edges`` has columns ``a, b``. Returns ``(id, component)`` for every id in
    an edge, ``component`` being the smallest id reachable.

    Alternating large-star / small-star: a node sends its smallest neighbour to
    its larger (then its smaller) neighbours, so edges become stars around the
    smallest ids in a logarithmic number of rounds. Minima are taken by
    aggregation and joined back, so no node's neighbours are ever gathered in
    one group. Each round is checkpointed in the shared folder. Rounds join by
    sorting, so no round's minima are gathered in the driver for a broadcast.
    """
    both = edges.where("a is not null and b is not null and a <> b")
    cur = checkpointed(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        # large star: every neighbour larger than u is linked to u's minimum
        sym = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = (
            sym.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        # small star: u's smaller neighbours and u are linked to u's minimum
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        linked = big.join(low.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = checkpointed(linked.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        state = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        before = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        cur = nxt
        if tuple(state) == tuple(before):
            break
    else:
        raise RuntimeError("connected components did not settle")
    roots = cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
