"""Document fingerprints by winnowing, with DataFrame functions only.

A text's words (``[^\\x20\\x09-\\x0D]+``) are hashed; the hash of a k-gram of words is a
rolling (cyclic polynomial) hash of theirs; of every ``window`` consecutive
k-grams the one with the smallest hash is selected, the rightmost of ties, with
its position. So two texts that share ``window + k - 1`` words in a row share a
selected hash. A text with fewer k-grams has one window, one with fewer words
than k one gram.

Defined results: a null or empty text has no grams and the empty fingerprint;
two empty fingerprints are alike (1), an empty and another one aren't (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS
from .common import checkpointed, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
LOW = (1 << 32) - 1


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _rotated(x: Column, bits: int) -> Column:
    return x if not bits else F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits))


def selected(text: Column, k: int = 4, window: int = 8) -> Column:
    """Selected grams in order: a long each, the hash in the upper 31 bits, 2^32 - 1 - position below.

    ``window`` is a power of two: minima of windows of 2, 4, ... come from two
    minima of half the width.
    """
    none = F.expr("cast(array() as array<bigint>)")

    def gram(h: Column, i: Column) -> Column:
        out = _rotated(h[i], k - 1)
        for j in range(1, k):
            out = out.bitwiseXOR(_rotated(h[i + j], k - 1 - j))
        return out

    def grams(h: Column) -> Column:
        whole = F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, x: _rotated(a, 1).bitwiseXOR(x)))
        each = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: gram(h, i))
        return F.when(F.size(h) == 0, none).when(F.size(h) < k, whole).otherwise(each)

    def ranks(g: Column) -> Column:
        return F.transform(
            g, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 33), 32).bitwiseOR(F.lit(LOW).cast("long") - i)
        )

    def minima(r: Column, width: int) -> Column:
        if width == window:
            return F.array_distinct(F.slice(r, F.lit(1), F.size(r) - (window - 1)))
        pair = F.transform(r, lambda x, i: F.when(i + width < F.size(r), F.least(x, r[i + width])).otherwise(x))
        return _let(pair, lambda m: minima(m, 2 * width))

    def choose(r: Column) -> Column:
        return F.when(F.size(r) == 0, none).when(F.size(r) <= window, F.array(F.array_min(r))).otherwise(minima(r, 1))

    hashes = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    return _let(hashes, lambda h: _let(grams(h), lambda g: _let(ranks(g), choose)))


def hashes_of(sel: Column) -> Column:
    return F.transform(sel, lambda x: F.shiftright(x, 32).cast("int"))


def positions_of(sel: Column) -> Column:
    return F.transform(sel, lambda x: (F.lit(LOW).cast("long") - x.bitwiseAND(F.lit(LOW).cast("long"))).cast("int"))


def fingerprint_text(sel: Column) -> Column:
    """``hash@position`` of every selected gram, in order."""
    one = lambda x: F.concat(
        F.hex(F.shiftright(x, 32)), F.lit("@"), (F.lit(LOW).cast("long") - x.bitwiseAND(F.lit(LOW).cast("long"))).cast("string")
    )
    return F.array_join(F.transform(sel, one), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all of two fingerprints (0 to 1)."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def _row_id(key: str) -> Column:
    """The key as a string; a null key is one of its own."""
    return F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id")


def next_documents(docs: DataFrame, key: str, n_chars: Column, text_hash: Column, ranges: int) -> DataFrame:
    """``(id, th, n, next_id, next_th)``: each row's next one in descending key; the last one's is the first.

    Rows are range-partitioned by key, so the order is found range by range;
    only the first row of every range is looked at across ranges. A null key
    comes last; rows that share a key go by their text's hash, and rows equal in
    both are one. ``id`` is the key as a string.
    """
    rows = docs.select(F.col(key).cast("long").alias("k"), _row_id(key), text_hash.alias("th"), n_chars.cast("long").alias("n"))
    order = [F.desc_nulls_last("k"), F.asc("th")]
    ranged = checkpointed(
        rows.distinct().repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id())
    )
    inside = Window.partitionBy("part").orderBy(*order)
    pair = F.struct(F.col("id").alias("id"), F.col("th").alias("th"))
    local = ranged.withColumn("nx", F.lead(pair).over(inside)).withColumn("r", F.row_number().over(inside))
    heads = local.where("r = 1").select("part", pair.alias("head"))  # one row per range
    ring = Window.orderBy("part")
    first = F.first("head").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = heads.select(F.col("part").alias("p"), F.coalesce(F.lead("head").over(ring), first).alias("after"))
    out = local.join(F.broadcast(after), F.col("part") == F.col("p"))  # as many rows as ranges
    return out.select("id", "th", "n", F.coalesce("nx", "after").alias("nx")).select(
        "id", "th", "n", F.col("nx.id").alias("next_id"), F.col("nx.th").alias("next_th")
    )


def fingerprints_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, window: int = 8) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third is the next document's beginning."""
    body = text_or_empty(text)
    th = F.xxhash64(body)
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chain = checkpointed(next_documents(docs, key, F.length(body), th, ranges))
    n = chain.count()
    ahead = chain.select(F.col("id").alias("own_id"), F.col("th").alias("own_th"), "n", F.col("next_id").alias("id"), F.col("next_th").alias("th"))
    ahead = F.broadcast(ahead) if n <= MAX_BROADCAST_ROWS else ahead  # checked size
    own = docs.select(_row_id(key), th.alias("th"), body.alias("text"))
    given = own.join(ahead, ["id", "th"]).select(
        F.col("own_id").alias("id"), F.col("own_th").alias("th"),
        F.expr("substring(text, 1, cast(floor(n / 3) as int))").alias("head"),
        hashes_of(selected(F.col("text"), k, window)).alias("next_hashes"),
    )
    if n < docs.count():  # rows that repeat in full: the next document is given once
        given = given.dropDuplicates(["id", "th"])
    joined = own.join(given, ["id", "th"])
    n_chars = F.length("text").cast("long")
    edited = F.concat(F.expr("substring(text, 1, cast(length(text) - floor(length(text) / 3) as int))"), F.col("head"))
    step = joined.select("id", n_chars.alias("n_chars"), "text", edited.alias("edited"), "next_hashes")
    both = F.struct(selected(F.col("text"), k, window).alias("a"), selected(F.col("edited"), k, window).alias("b"))
    step = step.select("id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "next_hashes", F.inline(F.array(both)))
    mine, theirs = hashes_of(F.col("a")), hashes_of(F.col("b"))
    return step.select(
        F.col("id").try_cast(docs.schema[key].dataType).alias(key), "n_chars", "edited_sha256",
        fingerprint_text(F.col("a")).alias("fingerprint"), fingerprint_text(F.col("b")).alias("edited_fingerprint"),
        likeness(mine, theirs).alias("near_edited"), likeness(mine, F.col("next_hashes")).alias("near_next"),
    )
