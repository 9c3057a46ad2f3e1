"""The repository's own models, compiled once per session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..models.centres import centre_text
from ..models.tree import tree_text
from ..operators.dtree_compile import DTModel, compile_from_lines
from ..operators.kmeans import KMModel, compile_km_lines
from ..session import checkpointed
from ..sources.models import model_lines_from_text

DT_ID = "decision_tree"
KM_ID = "kmeans"
ALT_ID = "dt_no_rule10"
KM_ALT_ID = "kmeans_reversed"

_memo: dict = {}


def _key(spark: SparkSession, name: str):
    return (id(spark), spark.sparkContext.applicationId, name)


def shipped_dt(spark: SparkSession) -> DTModel:
    """The shipped decision tree, compiled and checkpointed (tables are small)."""
    k = _key(spark, "dt")
    if k not in _memo:
        _memo[k] = compile_from_lines(spark, dt_lines(spark))  # compiled tables come back checkpointed
    return _memo[k]


def shipped_km(spark: SparkSession) -> KMModel:
    k = _key(spark, "km")
    if k not in _memo:
        m = compile_km_lines(km_lines(spark))
        _memo[k] = KMModel(m.centres.transform(checkpointed))
    return _memo[k]


def dt_lines(spark: SparkSession) -> DataFrame:
    """The lines of the shipped tree's text, which is rendered from its table of fixed values."""
    return model_lines_from_text(spark.createDataFrame([(DT_ID, tree_text())], "model_id string, text string"))


def km_lines(spark: SparkSession) -> DataFrame:
    """The lines of the shipped centres' text, which is rendered from their table of fixed values."""
    return model_lines_from_text(spark.createDataFrame([(KM_ID, centre_text())], "model_id string, text string"))


def _rule_line(lines: DataFrame, rule_no: int) -> int:
    return (
        lines.filter(F.col("line").rlike(r"^\s*when\s"))
        .select("line_no")
        .orderBy("line_no")
        .limit(rule_no + 1)
        .agg(F.max("line_no"))
        .collect()[0][0]
    )


def dt_without_rule(spark: SparkSession, rule_no: int) -> DTModel:
    """A copy of the shipped tree with one rule line taken out of the text."""
    k = _key(spark, f"dt-{rule_no}")
    if k not in _memo:
        lines = dt_lines(spark)
        _memo[k] = compile_from_lines(spark, lines.filter(F.col("line_no") != _rule_line(lines, rule_no)))
    return _memo[k]


def two_trees(spark: SparkSession) -> DTModel:
    """The shipped tree and its copy without rule 10, compiled in one run."""
    k = _key(spark, "two")
    if k not in _memo:
        lines = dt_lines(spark)
        alt = lines.filter(F.col("line_no") != _rule_line(lines, 10)).withColumn("model_id", F.lit(ALT_ID))
        _memo[k] = compile_from_lines(spark, lines.unionByName(alt))
    return _memo[k]


def two_kmeans(spark: SparkSession) -> KMModel:
    """The shipped centres and a copy listing them in reverse order (classes
    permuted), compiled in one run."""
    k = _key(spark, "two-km")
    if k not in _memo:
        lines = km_lines(spark)
        rev = lines.withColumn("line_no", -F.col("line_no")).withColumn("model_id", F.lit(KM_ALT_ID))
        m = compile_km_lines(lines.unionByName(rev))
        _memo[k] = KMModel(m.centres.transform(checkpointed))
    return _memo[k]
