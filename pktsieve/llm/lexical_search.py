"""Ranked lexical search over a length-stratified index, in integer arithmetic.

Scores. ``N`` documents hold at least one term, ``L`` terms in all; a document
of ``n`` terms has the normaliser ``m = 25 + (75 * n * N) div L``. A term that
``df`` documents hold weighs ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and adds
``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` for every time the query holds it.

Index. Documents with equal ``m`` form a stratum: within it a term's impact
depends on ``tf`` alone. A stratum is cut into blocks of at most ``BLOCK`` documents,
so a stratum that holds a third of all documents is many blocks. A block lists
its postings by term and ``tf``; an impact is computed once per ``tf`` and shared by all
postings of that ``tf``.

Search. The largest ``tf`` of a term in a stratum bounds what the term can add
there, so every stratum has an upper bound per query. A query's strata are
visited in the order of their bounds: first those that come first and hold
``FIRST`` times ``k`` documents; the k-th best score found there is the query's
floor. Then only strata whose bound reaches the floor (ties count) are visited,
and in them only blocks whose own bound does. The result is exact.

Queries are handled ``QUERIES`` at a time, and their distinct terms are what is
broadcast, so the broadcast is bounded by the texts of that many queries,
whatever the number of queries or documents. Only postings of queried terms are
kept; ``N``, ``L``, ``n`` and ``df`` count everything.

Defined results: a null text, or one without terms, has no term and is in no
result; a query without terms has no result; rows that repeat are documents of
their own (equal scores by ascending key, null keys last); an empty table of
documents or of queries gives no rows; extra columns are never looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS
from .common import checkpointed, give_back, text_or_empty

BLOCK = 1_024  # documents of a block
QUERIES = 1_000  # queries searched together
FIRST = 20  # the first visit reads strata of so many times k documents
EXACT = 1 << 53  # integers below are exact in double precision

# ASCII letters and digits and everything beyond ASCII make terms; only A-Z are lower-cased
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)

POSTINGS = "n long, terms array<int>, tfs array<int>"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _vocabulary(queries: list[tuple[object, str]]) -> tuple[dict[bytes, int], list[tuple[object, dict[int, int]]]]:
    """Numbers of all terms, and every query with its terms' frequencies."""
    number: dict[bytes, int] = {}
    wanted = [(q, {number.setdefault(t, len(number)): c for t, c in Counter(terms_of(text)).items()}) for q, text in queries]
    return number, wanted


def document_terms(docs: DataFrame, key: str, text: str, number) -> DataFrame:
    """``(key, n, terms, tfs)``: term count and the frequencies of the numbered terms, of documents that hold a term.

    ``number`` is a broadcast variable of terms and their numbers.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = number.value
        for frame in frames:
            rows = []
            for doc, body in zip(frame["doc"], frame["text"]):
                words = terms_of(body)
                if words:
                    held = sorted((known[t], c) for t, c in Counter(words).items() if t in known)
                    rows.append((doc, len(words), [t for t, _ in held], [c for _, c in held]))
            yield pd.DataFrame(rows, columns=["doc", "n", "terms", "tfs"])
        give_back()

    plain = docs.select(F.col(key).cast("string").alias("doc"), text_or_empty(text).alias("text"))
    return plain.mapInPandas(count, f"doc string, {POSTINGS}")


def stratified_index(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Blocks ``(m, docs, ptr, terms, tfs, places)``: postings of one stratum's documents by term and ``tf``.

    ``terms[i]`` with ``tfs[i]`` is held by the documents at ``places[ptr[i]:ptr[i + 1]]``.
    """
    m = (25 + F.expr(f"(75 * n * {n_docs}L) div {max(n_terms, 1)}L")).cast("long")
    # strata are dealt by normaliser and a hash; a partition's documents come in the order of theirs
    dealt = counted.where(F.size("terms") > 0).withColumn("m", m).withColumn("u", F.xxhash64("doc", "n", "terms", "tfs"))
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartitionByRange(parts, "m", "u").sortWithinPartitions("m", "u")

    def block(m: int, part: pd.DataFrame) -> tuple:
        sizes = part["terms"].map(len).to_numpy()
        place = np.repeat(np.arange(len(part), dtype=np.int32), sizes)
        term, tf = np.concatenate(part["terms"].to_numpy()), np.concatenate(part["tfs"].to_numpy())
        order = np.lexsort((place, tf, term))
        term, tf, place = term[order], tf[order], place[order]
        head = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1]))))
        ptr = np.concatenate((head, [len(term)])).astype(np.int32)
        return m, part["doc"].tolist(), ptr, term[head], tf[head], place

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for m, stratum in frame.groupby("m", sort=True):
                for lo in range(0, len(stratum), BLOCK):
                    rows.append(block(m, stratum.iloc[lo : lo + BLOCK]))
            yield pd.DataFrame(rows, columns=["m", "docs", "ptr", "terms", "tfs", "places"])
        give_back()

    return dealt.select("m", "doc", "terms", "tfs").mapInPandas(
        build, "m long, docs array<string>, ptr array<int>, terms array<int>, tfs array<int>, places array<int>"
    )


class _Weights:
    """Weights of all terms in all queries of a batch: a sparse matrix by term."""

    def __init__(self, wanted: list[tuple[object, dict[int, int]]], weight: dict[int, int], n_terms: int):
        rows = sorted((t, q, c * weight[t]) for q, (_, held) in enumerate(wanted) for t, c in held.items() if t in weight)
        self.n = len(wanted)
        self.ptr = np.searchsorted(np.array([r[0] for r in rows], dtype=np.int64), np.arange(n_terms + 1))
        self.query = np.array([r[1] for r in rows], dtype=np.int64)
        self.value = np.array([r[2] for r in rows], dtype=np.int64)
        most = np.zeros(self.n, dtype=object)  # an impact is below 10^6
        for _, q, v in rows:
            most[q] += v * 1_000_000
        self.type = np.float64 if max(most, default=0) < EXACT else np.int64

    def of(self, terms: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """The dense weights of these terms in these queries (given by their numbers, ascending)."""
        out = np.zeros((len(terms), self.n), dtype=self.type)
        count = self.ptr[terms + 1] - self.ptr[terms]
        row = np.repeat(np.arange(len(terms)), count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.ptr[terms], count)
        out[row, self.query[at]] = self.value[at]
        return out[:, queries]


def impact(tf: np.ndarray, m) -> np.ndarray:
    """What a posting adds per unit of weight."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _largest(terms: np.ndarray, tfs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of a block and the largest ``tf`` of each."""
    last = np.flatnonzero(np.concatenate((terms[1:] != terms[:-1], [True])))
    return terms[last], tfs[last]


def stratum_bounds(index: DataFrame, weights) -> DataFrame:
    """``(m, n_docs, bounds)``: size of every stratum and the most that a document of it can score, per query."""

    def bound(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = weights.value
        every = np.arange(w.n)
        for frame in frames:
            rows = []
            for m, n, terms, tfs in zip(frame["m"], frame["n_docs"], frame["terms"], frame["tfs"]):
                term, tf = _largest(terms, tfs)
                b = (impact(tf, m).astype(w.type) @ w.of(term, every)).astype(np.int64)
                q = np.flatnonzero(b)
                rows.append(pd.DataFrame({"m": m, "q": q, "bound": b[q], "n_docs": n}))
            yield pd.concat(rows) if rows else pd.DataFrame({"m": [], "q": [], "bound": [], "n_docs": []}, dtype="int64")

    blocks = index.select("m", F.size("docs").cast("long").alias("n_docs"), "terms", "tfs")
    each = blocks.mapInPandas(bound, "m long, q int, bound long, n_docs long")
    return each.groupBy("m", "q").agg(F.max("bound").alias("bound"), F.sum("n_docs").alias("n_docs"))


def visit(index: DataFrame, visits: DataFrame, weights, k: int) -> DataFrame:
    """``(q, doc, score)``: the k best of every visited block for the queries that visit its stratum.

    ``visits`` is ``(m, wants)``, one row per stratum, ``wants`` being the queries' numbers
    and the floors that a score has to reach.
    """

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = weights.value
        for frame in frames:
            out = []
            for m, docs, ptr, terms, tfs, places, wants in frame.itertuples(index=False, name=None):
                want = sorted((x["q"], x["floor"]) for x in wants)
                q, floor = np.array([x[0] for x in want]), np.array([x[1] for x in want], dtype=np.int64)
                term, tf = _largest(terms, tfs)
                least = w.of(term, q)
                hit = (impact(tf, m).astype(w.type) @ least).astype(np.int64) >= floor
                if not hit.any():
                    continue
                q, floor, least = q[hit], floor[hit], least[:, hit]
                column = np.searchsorted(term, terms)
                size = np.diff(ptr)
                held = np.zeros((len(docs), len(term)), dtype=w.type)
                held[places, np.repeat(column, size)] = np.repeat(impact(tfs, m), size)  # one impact per term and tf
                scores = (held @ least).astype(np.int64)
                for j in range(len(q)):
                    s = scores[:, j]
                    good = np.flatnonzero(s >= floor[j])
                    if len(good) > k:  # ties at the k-th place stay
                        good = good[s[good] >= np.partition(s[good], -k)[-k]]
                    out.extend((q[j], docs[i], s[i]) for i in good)
            yield pd.DataFrame(out, columns=["q", "doc", "score"])
        give_back()

    reached = index.join(visits, "m")
    return reached.select("m", "docs", "ptr", "terms", "tfs", "places", "wants").mapInPandas(score, "q int, doc string, score long")


def search_batch(docs: DataFrame, key: str, text: str, queries: list[tuple[object, str]], k: int) -> DataFrame | None:
    """``(q, rank, doc, score)`` of a batch of queries, ``q`` being a query's place in the batch."""
    spark = docs.sparkSession
    number, wanted = _vocabulary(queries)
    if not number:
        return None
    counted = checkpointed(document_terms(docs, key, text, spark.sparkContext.broadcast(number)))
    total = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs = total["docs"]
    if not n_docs:
        return None
    dfs = counted.select(F.explode("terms").alias("t")).groupBy("t").count()  # at most the batch's terms
    weight = {r["t"]: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1))) for r in dfs.toLocalIterator()}
    weights = spark.sparkContext.broadcast(_Weights(wanted, weight, len(number)))
    index = checkpointed(stratified_index(counted, n_docs, total["terms"]))
    bounds = checkpointed(stratum_bounds(index, weights))
    ahead = Window.partitionBy("q").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    ordered = checkpointed(bounds.withColumn("seen", F.coalesce(F.sum("n_docs").over(ahead), F.lit(0))))
    small = F.broadcast if ordered.count() <= MAX_BROADCAST_ROWS else lambda df: df  # strata times queries of the batch, checked
    first = F.col("seen") < FIRST * k
    wants = F.collect_list(F.struct("q", "floor")).alias("wants")
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    early = checkpointed(visit(index, small(ordered.where(first).withColumn("floor", F.lit(1).cast("long")).groupBy("m").agg(wants)), weights, k))
    kth = early.withColumn("r", F.row_number().over(best)).where(F.col("r") == k).select("q", F.col("score").alias("kth"))
    rest = ordered.where(~first).join(F.broadcast(kth), "q", "left").withColumn("floor", F.coalesce("kth", F.lit(1)).cast("long"))
    late = visit(index, small(rest.where("bound >= floor").groupBy("m").agg(wants)), weights, k)
    every = early.unionByName(late).withColumn("doc", F.col("doc").cast(docs.schema[key].dataType))
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text",
                  query_key: str = "item_id", query_text: str = "text", k: int = 10) -> DataFrame:
    """``(query_key, rank, key, score)``: the ``k`` best documents of every query with a score above 0."""
    spark = docs.sparkSession
    q_type, d_type = queries.schema[query_key].dataType.simpleString(), docs.schema[key].dataType.simpleString()
    asked = queries.select(F.col(query_key).alias("qid"), text_or_empty(query_text).alias("text"))
    found, batch = [], []
    rows = asked.toLocalIterator(prefetchPartitions=False)

    def flush() -> None:
        result = search_batch(docs, key, text, batch, k)
        if result is not None:
            names = spark.createDataFrame([(i, b[0]) for i, b in enumerate(batch)], f"q int, qid {q_type}")
            found.append(checkpointed(result.join(F.broadcast(names), "q").select(
                F.col("qid").alias(query_key), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(key), "score"
            )))
        batch.clear()

    for row in rows:
        batch.append((row["qid"], row["text"]))
        if len(batch) == QUERIES:
            flush()
    if batch:
        flush()
    out = spark.createDataFrame([], f"{query_key} {q_type}, rank int, {key} {d_type}, score long")
    for part in found:
        out = out.unionByName(part)
    return out
