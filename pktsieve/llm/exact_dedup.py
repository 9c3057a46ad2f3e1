"""Exact deduplication of texts by progressive refinement.

Texts are equal when they are identical after every run of white space
(``[\\x20\\x09-\\x0D]+``) is replaced by one space. Groups are refined in three steps, and
a row leaves as soon as it is alone in its group:

1. by the length of the normalised text;
2. by a hash of its first ``prefix`` characters;
3. by the SHA-256 of the whole text, which is read for the surviving groups only.

Steps 1 and 2 work on a table of a length and a hash per row. In step 3 the
surviving (length, hash) groups go to the tasks that read the texts, so no text
is ever shuffled. If they are too many for a broadcast (``MAX_BROADCAST_ROWS``),
every text is hashed where it is read instead, which is still cheaper than
moving texts to their groups. Counts and smallest ids are aggregated before
they are shuffled, so a group that holds a third of all rows is one row per
task.

Defined results: a null text is empty, and empty texts are equal to each other
(a text of white space alone is one space, not empty); the row with the
smallest key stays, a null key comes last; of rows that share the smallest key
(repeated rows too) exactly one stays; an empty table gives no rows; extra
columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS
from .common import checkpointed, small, text_or_empty

# a run that is not one plain space already
RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
PREFIX = 64


def normalised(text: str | Column) -> Column:
    """The text with every run of white space replaced by one space."""
    return F.regexp_replace(text_or_empty(text), RUN, " ")


def surviving_groups(docs: DataFrame, text: str, prefix: int = PREFIX) -> DataFrame:
    """``(n_chars, prefix_hash)`` of the groups that hold more than one row after steps 1 and 2."""
    norm = normalised(text)
    sketch = docs.select(F.length(norm).alias("n_chars"), F.xxhash64(F.substring(norm, 1, prefix)).alias("prefix_hash"))
    counts = checkpointed(sketch.groupBy("n_chars", "prefix_hash").agg(F.count(F.lit(1)).alias("n")))
    lengths = counts.groupBy("n_chars").agg(F.sum("n").alias("rows")).where("rows > 1").select("n_chars")
    shared = counts.join(lengths, "n_chars", "left_semi")
    return shared.where("n > 1").select("n_chars", "prefix_hash")


def _hashed(packed: DataFrame, groups: DataFrame, text: str, prefix: int, hash_all: bool) -> DataFrame:
    """``packed``'s columns but the text, and ``n_chars, prefix_hash, alive, sha`` of the text."""
    rest = [c for c in packed.columns if c != text]
    plain = packed.select(*rest, normalised(text).alias("norm")).select(
        *rest, "norm", F.length("norm").alias("n_chars"), F.xxhash64(F.substring("norm", 1, prefix)).alias("prefix_hash")
    )
    if groups.count() <= MAX_BROADCAST_ROWS:  # checked size
        plain = plain.join(F.broadcast(groups.withColumn("alive", F.lit(True))), ["n_chars", "prefix_hash"], "left")
    else:
        plain = plain.withColumn("alive", F.lit(True))
    alive = F.col("alive").isNotNull()
    sha = F.sha2(F.encode("norm", "utf-8"), 256)
    return plain.select(*rest, "n_chars", "prefix_hash", alive.alias("alive"), (sha if hash_all else F.when(alive, sha)).alias("sha"))


def _grouped(rows: DataFrame) -> DataFrame:
    """The rows ``(rid, id, n_chars, prefix_hash, alive, sha)`` with ``size`` and ``keep`` of groups of more than one."""
    whole = ["n_chars", "prefix_hash", "sha"]
    first = F.min(F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("rid").alias("rid")))
    copies = checkpointed(
        rows.where("alive").groupBy(*whole).agg(F.count(F.lit(1)).alias("size"), first.alias("keep")).where("size > 1")
    )
    # a row holds a hash of 64 characters beside its numbers
    return rows.where("alive").join(small(copies, copies.count(), 14), whole, "left").unionByName(rows.where("not alive"), allowMissingColumns=True)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = PREFIX, hash_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``(key, keep_id, group_size, kept, n_chars, prefix_hash, text_sha256)``.

    ``keep_id`` is the key of the row that stays of its group. ``text_sha256``
    (of the normalised text) is null for rows that were alone before the whole
    text was read, unless ``hash_all`` asks for it.
    """
    groups = checkpointed(surviving_groups(docs, text, prefix))
    hashed = _hashed(docs.select(F.col(key).alias("id"), F.col(text).alias("body")), groups, "body", prefix, hash_all)
    rows = checkpointed(hashed.select(F.monotonically_increasing_id().alias("rid"), "*"))
    alone = F.col("keep").isNull()
    return _grouped(rows).select(
        F.col("id").alias(key), F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("rid") == F.col("keep.rid"))).alias("kept"),
        F.col("n_chars").cast("long").alias("n_chars"), "prefix_hash", F.col("sha").alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """The rows of ``docs`` that stay, in the input's columns."""
    groups = checkpointed(surviving_groups(docs, text, prefix))
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("id"), F.col(text).alias("body"))
    hashed = _hashed(packed, groups, "body", prefix, False)
    rows = checkpointed(hashed.drop("row").select(F.monotonically_increasing_id().alias("rid"), "*"))
    found = _grouped(rows).where("size > 1")
    who = ["id", "n_chars", "prefix_hash", "sha"]
    # rows of one key and text go or stay together, then one of them stays
    one = F.struct(*[F.col(c) for c in who])
    decided = checkpointed(found.groupBy(*who).agg(F.max(F.col("rid") == F.col("keep.rid")).alias("stays"), F.count(F.lit(1)).alias("rows")))
    lost = decided.where("not stays").select(one.alias("w"))
    repeated = decided.where("stays and rows > 1").select(one.alias("w"))
    same = F.struct(*[F.col(c) for c in who]).eqNullSafe(F.col("w"))
    left = hashed.join(lost, same, "left_anti")
    kept_once = left.join(repeated, same, "left_semi").groupBy(*who).agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return left.join(repeated, same, "left_anti").select("row.*").unionByName(kept_once.select("row.*"))
