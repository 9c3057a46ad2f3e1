"""Model text sources (A3, A4, A5).

A model is a small text file; a directory of them is read in one job, one
``model_id`` per file (the file name without extension). File order carries
meaning (rule order, centre order, last feature line wins), so each file is
read whole and split into numbered lines; plain ``read.text`` gives no order.
A model file is one row of bounded size (it is a model, not data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    DT_FEATURE_LINE,
    DT_RULE_LINE,
    KM_CENTRE_LINE,
    LINE_BREAK,
)

# Unicode-aware character classes, as in the patterns' original (Python str) meaning.
UNI = "(?U)"
# What str.strip() removes: Unicode white space plus the separator controls.
WS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def model_id_from_path(path_col) -> F.Column:
    """File name without directory and extension."""
    return F.regexp_extract(path_col, r"([^/]*?)(\.[^./]*)?$", 1)


def model_lines_from_text(texts: DataFrame) -> DataFrame:
    """(model_id, text) -> (model_id, line_no, line), line numbers from 0."""
    return texts.select(
        F.col("model_id").cast("string").alias("model_id"),
        F.posexplode(F.split(F.col("text"), LINE_BREAK)).alias("line_no", "line"),
    )


def read_model_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per model file: (model_id, text). Two files of one name are an error, not one model."""
    raw = spark.read.text(path, wholetext=True)
    named = raw.select(
        model_id_from_path(F.col("_metadata.file_path")).alias("model_id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("text"),
    )
    doubled = named.groupBy("model_id").agg(F.count_distinct("path").alias("n")).filter("n > 1").select("model_id")
    total = doubled.count()
    if total:
        first = ", ".join(str(r.model_id) for r in doubled.orderBy("model_id").limit(5).collect())
        raise ValueError(f"{total} model name(s) stand for several files: {first}")
    return named.select("model_id", "text")


def read_model_lines(spark: SparkSession, path: str) -> DataFrame:
    return model_lines_from_text(read_model_texts(spark, path))


def strip(col: F.Column) -> F.Column:
    return F.btrim(col, F.lit(WS))


def parse_dt_lines(lines: DataFrame) -> DataFrame:
    """A3: classify decision-tree model lines.

    Output: (model_id, line_no, kind, name, rhs, cond, class_text); ``kind``
    is ``feature`` or ``rule``. Other lines are ignored without error.
    """
    feat_pat = UNI + DT_FEATURE_LINE
    rule_pat = UNI + DT_RULE_LINE
    # a found name or class is never empty; each pattern runs once per line and group
    named = lines.select("model_id", "line_no", strip(F.col("line")).alias("s")).withColumn("name", F.regexp_extract("s", feat_pat, 1))
    staged = named.withColumn("class_text", F.when(F.col("name") == "", F.regexp_extract("s", rule_pat, 2)))
    is_feat, is_rule = F.col("name") != "", F.col("class_text") != ""
    row = F.struct(
        F.when(is_feat, F.lit("feature")).when(is_rule, F.lit("rule")).alias("kind"),
        F.when(is_feat, F.col("name")).alias("name"),
        F.when(is_feat, F.regexp_extract("s", feat_pat, 2)).alias("rhs"),
        F.when(is_rule, F.regexp_extract("s", rule_pat, 1)).alias("cond"),
        F.when(is_rule, F.col("class_text")).alias("class_text"),
    )
    # a generator: filters on the kind aren't moved before the patterns, to run them again
    return staged.select("model_id", "line_no", F.inline(F.filter(F.array(row), lambda r: r["kind"].isNotNull())))


def read_dt_model(spark: SparkSession, path: str) -> DataFrame:
    """A3: read decision-tree model text file(s) into classified lines."""
    return parse_dt_lines(read_model_lines(spark, path))


def parse_km_lines(lines: DataFrame) -> DataFrame:
    """A4: centre lines, case-insensitive, first match per line, 3 integers.

    Output (model_id, line_no, frame_len, src_port, dst_port) as BIGINT.
    """
    pat = UNI + KM_CENTRE_LINE
    hit = lines.filter(F.col("line").rlike(pat))
    return hit.select(
        "model_id",
        "line_no",
        *[
            F.regexp_extract("line", pat, i).try_cast("bigint").alias(name)
            for i, name in ((1, "frame_len"), (2, "src_port"), (3, "dst_port"))
        ],
    )


def read_km_model(spark: SparkSession, path: str) -> DataFrame:
    """A4: read k-means centre text file(s)."""
    return parse_km_lines(read_model_lines(spark, path))


def require_centres(lines: DataFrame, centres: DataFrame) -> None:
    """A5: fail when a model file yields no centre at all."""
    missing = (
        lines.select("model_id").distinct()
        .join(centres.select("model_id").distinct(), "model_id", "left_anti")
        .limit(5)
        .collect()
    )
    if missing:
        ids = ", ".join(str(r.model_id) for r in missing)
        raise ValueError(f"no centres parsed from model(s): {ids}")
