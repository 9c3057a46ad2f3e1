"""The stages of the corpus pipeline: one operator each, over all rows they are given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid
from .common import text_or_empty
from .jaccard_join import link_documents
from .mixing import mixed_documents
from .packing import pack
from .queries import held_out, tokenizer_path
from .suffix_dedup import dedup_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the nearest-centroid model rejects go."""
    model = langid.fit(docs.where(~held_out()), "text", "lang")
    judged = langid.predict(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text")), model)
    return judged.where(~F.col("rejected")).select("row.*")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, the one with the smallest id; rows without an id stay.

    Links are of the general rule: shingles of five words, similarity 0.8 or
    more. A document is a row's id and text: of rows that repeat both one stays
    (the one whose columns hash lowest), rows that share an id but not the text
    are judged each. Null and empty texts link with nothing; an empty table
    gives an empty table.
    """
    linked = link_documents(docs, "doc_id", "text", percent=80, width=5)
    gone = linked.where("doc_id <> component_id").select(F.col("doc_id").alias("own"), F.col("text_hash").alias("th")).distinct()
    packed = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own"), F.xxhash64(text_or_empty("text")).alias("th")
    )
    kept = packed.join(gone, ["own", "th"], "left_anti")
    # only rows that repeat an id and a text are gathered by them
    again = linked.where("doc_id = component_id").groupBy(F.col("doc_id").alias("own"), F.col("text_hash").alias("th")).count()
    again = again.where("count > 1").select("own", "th")
    repeats = kept.join(again, ["own", "th"], "left_semi").groupBy("own", "th").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.join(again, ["own", "th"], "left_anti").select("row.*").unionByName(repeats.select("row.*"))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose every byte of a 400-byte string that occurs again, and every passage of 50 words or more that another document holds.

    Words are compared with A-Z in lower case, whatever white space is between
    them. Documents of which no word is left go; those that had none stay.
    """
    return dedup_documents(docs, "doc_id", "text", length=400, words=50)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them, in the order of the mix."""
    return mixed_documents(docs, "text", "source")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"))
