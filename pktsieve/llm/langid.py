"""Language identification by nearest centroids of TF-IDF character n-grams.

A text becomes a hashed vector of character 1- to 3-gram counts (letters only,
lower case; runs of other characters are one space), weighted by log term
frequency and inverse document frequency and normalised. Every language has
several centroids, found by spherical k-means over a bounded sample of its
labelled rows (``per_language`` distinct texts, those with the smallest text
hashes). A text gets the language of the centroid nearest by cosine; it is
rejected if its distance is beyond what nearly all training texts of that
language show (a share ``reject_share`` of the cosine at ``reject_quantile``).

Defined results: null texts and texts without letters are ``und`` with score 0
and rejected; with nothing to learn from every text is ``und``; rows are judged
one by one, so ties, repeats and order don't matter; extra columns are never
looked at. Whole texts are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS
from .common import checkpointed, give_back, giving_back

DIMS = 4096
_LETTER = re.compile(r"[^\W\d_]")
_SPACE, _OTHER = 32, 0x2FF


def _fold_table() -> np.ndarray:
    """Code points below 0x300: a lower-case letter, or one space for all else."""
    table = np.full(0x300, _SPACE, dtype=np.uint64)
    for cp in range(0x300):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            table[cp] = ord(low) if len(low) == 1 and ord(low) < 0x10000 else cp
    return table


_FOLD = _fold_table()


def _fold(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    small = codes < 0x300
    if small.all():
        out = _FOLD[codes]
    else:
        out = codes.astype(np.uint64)
        out[small] = _FOLD[codes[small]]
    gap = out == _SPACE
    return out[~(gap & np.r_[False, gap[:-1]])]


def ngram_counts(text: str) -> np.ndarray:
    """Hashed counts of the 1-, 2- and 3-grams of the folded text."""
    c = _fold(f" {text} ")
    shift = np.uint64(52)
    mix = np.uint64(0x9E3779B97F4A7C15)
    h1 = (c + np.uint64(1)) * mix
    out = np.bincount((h1 >> shift).astype(np.intp), minlength=DIMS)
    if len(c) > 1:
        h2 = (h1[:-1] ^ (c[1:] << np.uint64(20))) * mix
        out += np.bincount((h2 >> shift).astype(np.intp), minlength=DIMS)
        if len(c) > 2:
            h3 = (h2[:-1] ^ (c[2:] << np.uint64(11))) * mix
            out += np.bincount((h3 >> shift).astype(np.intp), minlength=DIMS)
    return out


def has_letter(text) -> bool:
    return bool(text) and _LETTER.search(text) is not None


@dataclass
class LanguageModel:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # one row each, normalised
    idf: np.ndarray
    least: dict[str, float]  # smallest cosine that is not rejected

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts).astype(np.float32) * self.idf
        n = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(n == 0, 1, n)

    def predict(self, texts) -> tuple[list[str], list[float], list[bool]]:
        langs, scores, rejected = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
        if not self.languages:
            return langs, scores, rejected
        for i in range(0, len(texts), 256):
            at = [k for k in range(i, min(i + 256, len(texts))) if has_letter(texts[k])]
            if not at:
                continue
            cos = self.vectors(np.array([ngram_counts(texts[k]) for k in at])) @ self.centroids.T
            best = cos.argmax(axis=1)
            for k, b, row in zip(at, best, cos):
                langs[k] = self.languages[b]
                scores[k] = float(min(1.0, max(0.0, row[b])))
                rejected[k] = bool(scores[k] < self.least[langs[k]])
        return langs, scores, rejected


def _kmeans(v: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means with farthest-first starts; deterministic."""
    centres = [v.mean(axis=0)]
    near = v @ centres[0]
    for _ in range(min(k, len(v)) - 1):
        centres.append(v[int(near.argmin())])
        near = np.maximum(near, v @ centres[-1])
    c = np.array(centres)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = (v @ c.T).argmax(axis=1)
        c = np.array([v[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 1000, centroids: int = 4,
        reject_quantile: float = 0.001, reject_share: float = 0.4) -> LanguageModel:
    """Fit on a bounded sample: at most ``per_language`` distinct texts of each language."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit(5), text).alias("h")
    )
    keys = rows.select("lang", "h").distinct()
    # the sample's bound for each language, from hashes alone; the texts are then filtered by it
    from pyspark.sql import Window

    top = keys.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= per_language)
    bound = checkpointed(top.groupBy("lang").agg(F.max("h").alias("most")))
    if bound.count() <= MAX_BROADCAST_ROWS:  # one row per language: the texts are filtered where they are read
        bound = F.broadcast(bound)
    sample = checkpointed(rows.join(bound, "lang").where("h <= most").dropDuplicates(["lang", "h"]).select("lang", "text"))

    def frequencies(frame: pd.DataFrame) -> pd.DataFrame:
        texts = [t for t in frame["text"] if has_letter(t)]
        df = np.zeros(DIMS)
        for t in texts:
            df += ngram_counts(t) > 0
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "n": [len(texts)], "df": [df.tolist()]})

    stats = sample.groupBy("lang").applyInPandas(frequencies, "lang string, n long, df array<double>").collect()
    n = sum(r["n"] for r in stats)
    if not n:
        return LanguageModel([], np.zeros((0, DIMS)), np.ones(DIMS), {})
    df = np.sum([r["df"] for r in stats], axis=0)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    shell = LanguageModel([], np.zeros((0, DIMS)), idf, {})

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        name = frame["lang"].iloc[0]
        texts = sorted(t for t in frame["text"] if has_letter(t))
        if not texts:
            return pd.DataFrame({"lang": [], "centre": [], "least": []})
        v = shell.vectors(np.array([ngram_counts(t) for t in texts]))
        c = _kmeans(v, centroids)
        near = (v @ c.T).max(axis=1)
        least = float(np.quantile(near, reject_quantile)) * reject_share
        del v, near, texts
        give_back()
        return pd.DataFrame({"lang": [name] * len(c), "centre": [x.tolist() for x in c], "least": [least] * len(c)})

    found = sample.groupBy("lang").applyInPandas(cluster, "lang string, centre array<double>, least double").collect()
    found = sorted(found, key=lambda r: (r["lang"], r["centre"]))
    return LanguageModel(
        [r["lang"] for r in found], np.array([r["centre"] for r in found], dtype=np.float32), idf,
        {r["lang"]: r["least"] for r in found},
    )


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred, score, rejected`` to the given columns (which must not hold these names)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    @giving_back
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores, rejected = sent.value.predict(texts.tolist())
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "rejected": rejected})

    return docs.withColumn("_judged", judge(F.col(text))).select(*docs.columns, "_judged.*")
