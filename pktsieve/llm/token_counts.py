"""Token counts without ids: pieces are counted once per distinct pre-token.

1. Every task counts the distinct pre-tokens of its documents; the counts are
   summed over the corpus.
2. The library counts the pieces of each distinct pre-token, once.
3. The counts are joined to the documents' pre-token frequencies and summed.
   The most frequent pre-tokens (``HOT`` of them, at most ``HOT_CHARS`` long, so
   the bound holds at any size) are broadcast, which keeps hot keys out of the
   shuffle; the others are joined by an ordinary shuffle join.

A pre-token here is what lies between two places where the byte-level
pre-tokeniser always cuts: a word with the space before it.

Defined results: null text counts as empty and has 0 tokens; special strings
inside texts are what the library makes of them by default; equal rows are
counted each; an empty table gives no rows; extra columns are never looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_or_empty
from .tokens import encoder, raw_unit, space_units

HOT = 400_000
HOT_CHARS = 64
FLUSH = 500_000  # distinct pre-tokens that a task holds before it emits them


def _distinct(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter = Counter()
    for frame in frames:
        for text in frame["text"]:
            if text:
                seen.update(space_units(text))
            if len(seen) > FLUSH:
                yield pd.DataFrame({"unit": list(seen), "freq": list(seen.values())})
                seen = Counter()
    if seen:
        yield pd.DataFrame({"unit": list(seen), "freq": list(seen.values())})


def pretoken_pieces(docs: DataFrame, text: str, tokenizer_path: str) -> DataFrame:
    """``(unit, freq, pieces)``: every distinct pre-token, its corpus frequency and its number of pieces."""
    units = docs.select(text_or_empty(text).alias("text")).mapInPandas(_distinct, "unit string, freq long")
    distinct = units.groupBy("unit").agg(F.sum("freq").alias("freq"))

    def count(frames):
        enc = encoder(tokenizer_path)
        for frame in frames:
            frame["pieces"] = [len(x) for x in enc.many([raw_unit(u) for u in frame["unit"]])]
            yield frame

    return distinct.mapInPandas(count, "unit string, freq long, pieces long")


def count_tokens(docs: DataFrame, key: str, text: str, tokenizer_path: str, hot: int = HOT) -> DataFrame:
    """``(key, n_bytes, n_tokens)`` of every row of ``docs``."""
    spark = docs.sparkSession
    vocab = checkpointed(pretoken_pieces(docs, text, tokenizer_path))
    common = vocab.where(F.length("unit") <= HOT_CHARS).orderBy(F.desc("freq"), "unit").limit(hot)
    known = spark.sparkContext.broadcast({r["unit"]: r["pieces"] for r in common.toLocalIterator()})

    def frequencies(frames):
        pieces = known.value
        for frame in frames:
            rows = []
            for row, doc, size, text in frame.itertuples(index=False, name=None):
                total, rare = 0, {}
                if text:
                    for unit in space_units(text):
                        n = pieces.get(unit)
                        if n is None:
                            rare[unit] = rare.get(unit, 0) + 1
                        else:
                            total += n
                # the known sum goes with the first rare unit, or with a row that joins nothing
                if not rare:
                    rare = {f"  {row}": 0}
                first = True
                for unit, n in rare.items():
                    rows.append((row, doc, size, total if first else 0, unit, n))
                    first = False
                if len(rows) > 200_000:
                    yield pd.DataFrame(rows, columns=["row", "doc", "size", "known", "unit", "freq"])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["row", "doc", "size", "known", "unit", "freq"])

    plain = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("string").alias("doc"),
        F.octet_length(text_or_empty(text)).cast("long").alias("size"), text_or_empty(text).alias("text"),
    )
    freqs = plain.mapInPandas(frequencies, "row long, doc string, size long, known long, unit string, freq long")
    joined = freqs.join(vocab.select("unit", "pieces"), "unit", "left")
    out = joined.groupBy("row").agg(
        F.first("doc").alias("doc"), F.first("size").alias("n_bytes"),
        (F.sum("known") + F.sum(F.col("freq") * F.coalesce("pieces", F.lit(0)))).alias("n_tokens"),
    )
    return out.select(F.col("doc").cast(docs.schema[key].dataType).alias(key), "n_bytes", "n_tokens")
