"""The registered queries of the corpus operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import license_scan
from .common import table
from .exact_dedup import exact_groups
from .html_text import extract
from .jaccard_join import link_documents
from .langid import fit, predict
from .lexical_search import ranked_search
from .mixing import mix, word_count
from .packing import pack
from .suffix_dedup import dedup_digests
from .token_alignment import align_documents
from .token_counts import count_tokens
from .vector_dedup import link_vectors
from .winnowing import fingerprints_with_edits


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file (an installed package's data)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return license_scan.scan(docs, license_scan.fit(spark, docs), "doc_id", "text")


def op3_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extract(table(spark, sf, "pages").select("page_id", "url", "html"), "html").drop("html")


def op2_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_digests(table(spark, sf, "documents"), "doc_id", "text", length=400, words=50)


def op4_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text", F.xxhash64("text").alias("text_hash"))
    out = mix(docs, ["doc_id", "text_hash"], word_count("text"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def held_out(key: str = "doc_id"):
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = fit(docs.where(~held_out()), "text", "lang")
    judged = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return judged.drop("text")


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"), "doc_id", "text", tokenizer_path("word_bpe_49k.json"))


def op7_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints_with_edits(table(spark, sf, "documents"), "doc_id", "text")


def op8_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return link_documents(table(spark, sf, "documents"), "doc_id", "text", percent=90, width=3).drop("text_hash")


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN ws IS NULL OR len(ws) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)] END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM b JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 90 * (p.n + q.n - i)
), reach AS (
  SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = count_tokens(table(spark, sf, "documents"), "doc_id", "text", tokenizer_path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 1024)


def op10_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return link_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", threshold=0.93)


def op11_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = exact_groups(table(spark, sf, "documents"), "doc_id", "text", hash_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP11_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents),
g AS (SELECT x, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256 FROM t JOIN g USING (x)
"""


def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    docs, a, b = table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return align_documents(docs, "doc_id", "text", a, b)[0]


def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id", "text", "item_id", "text", k=10)


OP13_SQL = r"""
WITH word AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, * FROM documents)
), tf AS (SELECT rid, doc_id, term, count(*) AS tf FROM word GROUP BY ALL),
len AS (SELECT rid, sum(tf)::BIGINT AS n FROM tf GROUP BY rid),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM len),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, total GROUP BY term, big_n),
norm AS (SELECT rid, 25 + (75 * n * big_n) // big_l AS m FROM len, total),
query AS (
  SELECT qid, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS qid, * FROM benchmark)
), asked AS (SELECT qid, item_id, term, count(*) AS c FROM query GROUP BY ALL),
scored AS (
  SELECT qid, item_id, rid, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN norm USING (rid) GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
    op1_license_scan, op2_suffix_array_dedup, op3_html_extraction, op4_mix_sources, op5_language_id, op6_packing, op7_winnowing, op8_ngram_jaccard_join,
    op9_token_counts, op10_embedding_near_dedup, op11_exact_dedup, op12_token_alignment, op13_lexical_search)
}
ORACLES: dict[str, str] = {
    "op8_ngram_jaccard_join": OP8_SQL, "op11_exact_dedup": OP11_SQL, "op13_lexical_search": OP13_SQL,
}
