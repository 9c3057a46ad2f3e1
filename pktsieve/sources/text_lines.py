"""Model text at volume (A3, A4): files read in splits, lines numbered in file order.

A model file of any size is read by as many tasks as it has splits. Rows of one
split come in the order of the file, so a line's place in its split is its row
number there less the split's first one; the splits of a model are ordered by
file name and offset, and each adds the lines of the splits before it (a table
of one row per split). No model, file or split is ever gathered.

A model is one file (``model_id`` is its name without extension), or a folder
``model_id=<id>`` of part files that are one text in the order of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import LINE_BREAK
from ..session import MAX_BROADCAST_ROWS, checkpointed
from .models import model_id_from_path

SPLIT = ["model_id", "file", "start"]


def _model_id(path: Column) -> Column:
    folder = F.regexp_extract(path, r"/model_id=([^/]+)/[^/]*$", 1)
    plain = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    # the path is a URI, and a partition's folder name is escaped in it once more
    return F.when(folder != "", plain(plain(folder))).otherwise(model_id_from_path(path))


def read_model_lines_at_volume(spark: SparkSession, path: str) -> DataFrame:
    """(model_id, line_no, line) of all model files at ``path``; line numbers from 0 in text order.

    Two files of one name in different folders are an error, not one model.
    """
    raw = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"), "value",
    )
    # a row ends at a newline; the grammar knows more line breaks
    rows = checkpointed(raw.select(_model_id(F.col("file")).alias("model_id"), "file", "start", "seq", F.split("value", LINE_BREAK).alias("parts")))
    splits = rows.groupBy(*SPLIT).agg(F.min("seq").alias("first"), F.sum(F.size("parts") - 1).alias("extra"), F.count(F.lit(1)).alias("n"))
    splits = checkpointed(splits)
    single = splits.where(~F.col("file").rlike(r"/model_id=[^/]+/[^/]*$"))
    doubled = single.groupBy("model_id").agg(F.count_distinct("file").alias("files")).where("files > 1")
    n_doubled = doubled.count()
    if n_doubled:
        names = ", ".join(str(r.model_id) for r in doubled.orderBy("model_id").limit(5).collect())
        raise ValueError(f"{n_doubled} model name(s) stand for several files: {names}")
    before = Window.partitionBy("model_id").orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(*SPLIT, "first", F.coalesce(F.sum(F.col("n") + F.col("extra")).over(before), F.lit(0)).alias("off"))
    right = F.broadcast(offsets) if splits.count() <= MAX_BROADCAST_ROWS else offsets
    placed = rows.join(right, SPLIT)
    plain = placed.where(F.size("parts") == 1).select("model_id", *SPLIT[1:], "seq", "first", "off", F.col("parts")[0].alias("line"))
    # rows that hold several lines push the later rows of their split on; such splits are few and numbered on their own
    odd = splits.where("extra > 0").select(*SPLIT)
    n_odd = odd.count()
    if not n_odd:
        return plain.select("model_id", (F.col("off") + F.col("seq") - F.col("first")).cast("int").alias("line_no"), "line")
    odd_right = F.broadcast(odd) if n_odd <= MAX_BROADCAST_ROWS else odd
    shifted = placed.join(odd_right, SPLIT, "left_semi")
    ahead = Window.partitionBy(*SPLIT).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    shifted = shifted.withColumn("push", F.coalesce(F.sum(F.size("parts") - 1).over(ahead), F.lit(0)))
    shifted = shifted.select("model_id", (F.col("off") + F.col("seq") - F.col("first") + F.col("push")).alias("at"), F.posexplode("parts").alias("i", "line"))
    rest = plain.join(odd_right, SPLIT, "left_anti")
    return rest.select("model_id", (F.col("off") + F.col("seq") - F.col("first")).cast("int").alias("line_no"), "line").unionByName(
        shifted.select("model_id", (F.col("at") + F.col("i")).cast("int").alias("line_no"), "line")
    )


def write_model_text(lines: DataFrame, path: str, partitions: int | None = None, mode: str = "errorifexists") -> None:
    """Write (model_id, line_no, line) as folders ``model_id=<id>`` of part files in line order."""
    n = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(n, "model_id", "line_no").sortWithinPartitions("model_id", "line_no")
    ordered.select("model_id", F.col("line").alias("value")).write.mode(mode).partitionBy("model_id").text(path)


def render_tree_lines(values: DataFrame, preds: DataFrame, rules: DataFrame, times: int = 1) -> DataFrame:
    """Tree model text from tables: (model_id, line_no, line), threshold lines before rule lines.

    ``values`` is (model_id, feature, value), ``preds`` (model_id, rule_id, feature, op, value) and ``rules``
    (model_id, rule_id, class). Each condition is written ``times`` times. A feature line holds at most the values of one feature of one model.
    """
    items = values.groupBy("model_id", "feature").agg(F.array_sort(F.collect_set("value")).alias("v"))
    text = F.array_join(F.transform("v", lambda x: F.concat(F.lit("np.float64("), x.cast("string"), F.lit(")"))), ", ")
    features = items.select(
        "model_id", (F.pmod(F.xxhash64("feature"), F.lit(1 << 30)) - (1 << 31)).alias("line_no"),
        F.concat("feature", F.lit(" = ["), text, F.lit("];")).alias("line"),
    )
    cond = preds.select("model_id", "rule_id", F.concat("feature", "op", F.col("value").cast("string")).alias("c"))
    told = cond.groupBy("model_id", "rule_id").agg(F.collect_list("c").alias("c"))
    told = told.select("model_id", "rule_id", F.array_join(F.array_sort(F.flatten(F.array_repeat("c", times))), " and ").alias("cond"))
    ruled = rules.join(told, ["model_id", "rule_id"]).select(
        "model_id", F.col("rule_id").cast("long").alias("line_no"),
        F.concat(F.lit("when "), "cond", F.lit(" then "), F.col("class").cast("string"), F.lit(";")).alias("line"),
    )
    return features.unionByName(ruled)
