"""Near-duplicate vectors by Euclidean p-stable hashing, checked by exact cosines.

Valid vectors are normalised. In each of ``tables`` tables a vector's key is
made of ``projections`` random projections, shifted and quantised to steps of
``width``; vectors with equal label and key meet in a bucket. There all cosines
are computed in double precision and pairs at or above the threshold link. A
pair that meets in several tables is counted in the first of them only, which
both vectors' keys tell, so no pairs are emitted or made distinct: a bucket
returns one link count per vector and a spanning forest. Buckets of more than
``BUCKET`` vectors are cut into blocks, and each pair of blocks is a task's group.

Equal vectors with equal labels are one class before hashing; its copies count
as links of each other. With the default parameters a pair at a cosine of
exactly 0.93 meets in a table with probability 0.2, so it is missed with
probability 0.012; closer pairs are missed far less often.

Defined results: a null label, a null, empty or zero vector and one with null
or non-finite components link with nothing; so do rows with a null id, whose
component is null; vectors of different length never link; an empty table
gives no rows; extra columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, connected_components, groups_for

BUCKET = 1_500
PER_GROUP = 20_000


def _keys(v: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    rng = np.random.default_rng([seed, v.shape[1]])
    a = rng.standard_normal((v.shape[1], tables * projections))
    b = rng.uniform(0, width, tables * projections)
    q = np.floor((v @ a + b) / width).astype(np.int64).reshape(len(v), tables, projections)
    weights = rng.integers(1, 1 << 62, projections) * 2 + 1
    with np.errstate(over="ignore"):
        return (q * weights).sum(axis=2)


def _components(linked: np.ndarray) -> np.ndarray:
    """For each vertex of a boolean adjacency matrix one vertex that stands for its component."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] < 0:
            front = np.array([i])
            while len(front):
                root[front] = i
                front = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
    return root


def bucket_links(ids, copies, vectors, keys, table: int, threshold: float, sides=None):
    """Links of a bucket: per vector the number of linked rows not met in an earlier table, and its forest parent."""
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    linked = (vectors @ vectors.T) / np.outer(norm, norm) >= threshold
    np.fill_diagonal(linked, False)
    if sides is not None:  # two blocks: pairs inside a block belong to that block's own group
        linked &= sides[:, None] != sides[None, :]
    root = _components(linked)
    fresh = linked
    for t in range(table):
        if not fresh.any():
            break
        fresh = fresh & (keys[:, t][:, None] != keys[:, t][None, :])
    return fresh @ copies, ids[root]


def link_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = 0.93, tables: int = 20, projections: int = 10, width: float = 2.0, seed: int = 10) -> DataFrame:
    """``(key, n_links, component_id, kept)`` of every row."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    zero = ~F.exists(v, lambda x: x != 0)
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), v.alias("v"),
        F.coalesce(F.col(key).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & ~bad & ~zero, F.lit(False)).alias("ok"),
    )
    valid = rows.where("ok")
    classes = checkpointed(
        valid.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"))
    )

    def hash_(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length = frame["v"].map(len)
            for _, part in frame.groupby(length):
                a = np.array(part["v"].tolist(), dtype=np.float64)
                a = a / np.abs(a).max(axis=1, keepdims=True)  # no overflow in the squares
                a /= np.sqrt((a * a).sum(axis=1, keepdims=True))
                keys = _keys(a, tables, projections, width, seed)
                out = part[["rep", "m", "label", "v"]].copy()
                out["dim"] = len(part["v"].iloc[0])
                out["keys"] = list(keys)
                yield out

    hashed = checkpointed(
        classes.mapInPandas(hash_, "rep long, m long, label string, v array<double>, dim int, keys array<long>")
    )
    places = hashed.select("rep", "label", "dim", F.posexplode("keys").alias("t", "k"))
    bucket = ["label", "dim", "t", "k"]
    sizes = places.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    places = places.join(sizes, bucket)
    n_places = places.count()
    blocks = F.ceil(F.col("size") / F.lit(BUCKET)).cast("int")
    places = places.withColumn("nb", blocks).withColumn("blk", F.pmod(F.xxhash64(F.lit(seed), "rep"), F.col("nb")).cast("int"))
    places = places.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    groups = groups_for(n_places, PER_GROUP)
    b = F.xxhash64(*bucket)
    places = places.select(
        "rep", "t", b.alias("bucket"), "blk",
        F.when(F.col("nb") == 1, F.pmod(b, F.lit(groups))).otherwise(b).alias("g"),
        F.when(F.col("nb") == 1, -1).otherwise(F.least("blk", "other")).alias("b1"),
        F.when(F.col("nb") == 1, -1).otherwise(F.greatest("blk", "other")).alias("b2"),
    )
    work = places.join(hashed.select("rep", "m", "v", "keys"), "rep")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in frame.groupby(["bucket", "t"]):
            if len(part) < 2:
                continue
            ids = part["rep"].to_numpy()
            vectors = np.array(part["v"].tolist(), dtype=np.float64)
            vectors /= np.abs(vectors).max(axis=1, keepdims=True)
            blk = part["blk"].to_numpy()
            two = part["b1"].iloc[0] != part["b2"].iloc[0]
            n, root = bucket_links(
                ids, part["m"].to_numpy(), vectors, np.array(part["keys"].tolist()), int(part["t"].iloc[0]), threshold,
                blk if two else None,
            )
            hit = (n > 0) | (root != ids)
            out.append(pd.DataFrame({"rep": ids[hit], "n": n[hit], "root": root[hit]}))
        return pd.concat(out) if out else pd.DataFrame({"rep": [], "n": [], "root": []}, dtype="int64")

    found = checkpointed(work.groupBy("g", "b1", "b2").applyInPandas(compare, "rep long, n long, root long"))
    comps = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    of_class = (
        classes.join(links, "rep", "left").join(comps, F.col("rep") == F.col("id"), "left")
        .select(F.col("label").alias("cl"), F.col("v").alias("cv"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    )
    out = rows.join(of_class, F.col("ok") & (F.col("label") == F.col("cl")) & (F.col("v") == F.col("cv")), "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
