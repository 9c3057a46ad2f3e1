"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow. Its documents are shuffled (by a hash of the row), and
a document's virtual finish time is the source's cumulative words up to its
end, divided by the source's target. All flows start at virtual time 0, so the
budget (the sum of the targets) is used up at virtual time ``budget / sum of
targets`` for every flow at once: sorting all documents by finish time and
truncating at the total budget is a cut at that time. The document in service
at the cut is served up to the cut (``cut_last=True``: its first words), or
taken whole if at least half of it was served (``cut_last=False``).

A source whose target exceeds its size is served again from its start, up to
``cap`` times in all.

Defined results: null text has 0 words; a null source is a source of its own,
sorted last; rows that are equal in every used column are interchangeable; an
empty table gives no rows; a source without words has target 0. Extra columns
are never looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, groups_for, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BLOCK = 20_000


def word_count(text="text"):
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, cap: float = 3.0, weights=(1, 2, 3)) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``(source, source_size)``.

    Weights repeat over the sources in code point order, null last. Targets
    share the total by weight and stop at ``cap`` times the source's size; what
    is cut is shared anew among the others until none is above. The level
    (target per unit of weight) is found by repeating one small aggregate; only
    scalars reach the driver.
    """
    blocks = sizes.withColumn("_null", F.col("source").isNull())
    order = Window.orderBy("_null", "source")  # one row per source
    ranked = blocks.withColumn("_rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = checkpointed(ranked.select("source", "source_size", weight.alias("weight")))
    limit = F.col("source_size") * F.lit(float(cap))
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        capped = limit <= F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.sum(capped.cast("int")).alias("n"),
            F.sum(F.when(capped, limit).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("w"),
        ).first()
        if row["n"] is None or row["n"] == full or not row["w"]:
            break
        full, level = row["n"], (total - row["fixed"]) / row["w"]
    return ranked.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)))


def mix(docs: DataFrame, keys: list[str], size, source: str = "source", cap: float = 3.0, seed: int = 4,
        cut_last: bool = True) -> DataFrame:
    """Decide how many words of every document the mix takes.

    ``keys`` are the columns that identify a row (used for the shuffle order
    and returned), ``size`` the column expression of its words. Returns
    ``keys, source, size, source_size, target, copies, finish, taken``:
    ``copies`` whole passes (the document in service counts if it is taken
    whole), ``finish`` the first virtual finish time, ``taken`` the words taken.
    """
    order = F.xxhash64(F.lit(seed), *keys, source)
    rows = checkpointed(
        docs.select(*keys, F.col(source).alias("source"), size.alias("size"), order.alias("_u"))
    )
    n = rows.count()
    blocks = groups_for(n, ROWS_PER_BLOCK)
    block = F.floor((F.col("_u") / F.lit(2.0**64) + 0.5) * F.lit(float(blocks))).cast("long")
    rows = rows.withColumn("_b", block)
    per_block = rows.groupBy("source", "_b").agg(F.sum("size").alias("_sum"))
    sizes = per_block.groupBy("source").agg(F.sum("_sum").alias("source_size"))
    targets = checkpointed(source_targets(sizes, cap))
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        "source", "_b", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off")
    ).join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    inside = Window.partitionBy("source", "_b").orderBy("_u", *keys, "size").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    o = offsets.withColumnRenamed("source", "_s").withColumnRenamed("_b", "_ob")
    j = local.join(o, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_ob")))
    start = F.col("_off") + F.col("_in")
    limit = F.round("target").cast("long")  # words of the source that are served at the cut
    safe = F.when(F.col("source_size") > 0, F.col("source_size")).otherwise(F.lit(1))
    passes = F.floor(limit / safe).cast("long")
    rest = limit - passes * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    finish = F.when(F.col("target") > 0, (start + F.col("size")) / F.col("target"))
    if cut_last:
        copies, taken = passes, passes * F.col("size") + part
    else:
        whole = (2 * (rest - start) >= F.col("size")) & (rest > 0)
        copies = passes + F.when(whole, 1).otherwise(0)
        taken = copies * F.col("size")
    return j.select(
        *keys, "source", "size", "source_size", "target", copies.cast("long").alias("copies"),
        finish.alias("finish"), taken.cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The mixed corpus: every document repeated as often as the mix takes it
    (whole documents), range-sorted by virtual finish time, in the input's columns.

    A pass ``e`` of a source ends ``e * source_size / target`` later. A source
    without any words is kept as it is, since it costs nothing.
    """
    packed = docs.select(
        F.struct(*docs.columns).alias("row"), F.xxhash64(*docs.columns).alias("k1"),
        F.md5(F.to_json(F.struct(*docs.columns))).alias("k2"), F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    plan = mix(packed, ["k1", "k2"], F.col("size"), cut_last=False)
    # equal rows are interchangeable: their copies are added up and dealt to one of them
    per_key = plan.groupBy("k1", "k2").agg(
        F.sum(F.when(F.col("source_size") == 0, 1).otherwise(F.col("copies"))).alias("n"),
        F.min("finish").alias("finish"), F.first(F.col("source_size") / F.col("target")).alias("lap"),
    )
    one = packed.join(per_key.where("n > 0"), ["k1", "k2"])
    # each of the equal rows emits its share of the copies
    same = Window.partitionBy("k1", "k2")
    one = one.withColumn("i", F.row_number().over(same.orderBy(F.lit(1)))).withColumn("c", F.count(F.lit(1)).over(same))
    share = F.floor(F.col("n") / F.col("c")) + F.when(F.col("i") <= F.col("n") % F.col("c"), 1).otherwise(0)
    out = one.where(share > 0).withColumn("e", F.explode(F.sequence(F.lit(0), (share - 1).cast("int"))))
    return out.orderBy(F.col("finish") + F.col("e") * F.col("lap"), "k1", "k2", "e").select("row.*")
