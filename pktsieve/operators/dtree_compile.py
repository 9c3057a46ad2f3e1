"""Decision-tree model compile operators (J1), all keyed by ``model_id``.

Model text -> thresholds -> bins -> per-rule feature bounds -> bin id ranges
-> numbered rule rows -> (optionally) the flat cell table. Every step is a
DataFrame operation, so one run compiles a whole directory of models, and the
same operators run on large generated rule corpora.

Groups are bounded: thresholds per (model, feature) by the 16-bit feature
domain, predicates per (rule, feature) by the rule text, rows per rule by the
five features.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import (
    DT_FEATURES,
    DT_PREDICATE,
    DT_THRESHOLD_ITEM,
    FEATURE_MAX,
    MAX_CLASS_LABEL,
)
from ..functions.arith import clamp, safe_double
from ..session import MAX_BROADCAST_ROWS, checkpointed
from ..sources.models import UNI, parse_dt_lines, read_model_lines, strip
from .box_index import BoxIndex
from .box_index import build as build_index
from .intervals import expand_blocks, locate
from .numbering import number_in_order

N_FEATURES = len(DT_FEATURES)
# Above this many (cell, rule) pairs the flat cell table is not built and
# scoring matches rule ranges directly.
MAX_CELL_PAIRS = 2_000_000


def feature_rows() -> F.Column:
    """Generator of the fixed feature list: (fpos, feature, fmax)."""
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("fpos"), F.lit(f).alias("feature"), F.lit(FEATURE_MAX[f]).alias("fmax")
                )
                for i, f in enumerate(DT_FEATURES)
            ]
        )
    )


def feature_table(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(feature_rows())


# --------------------------------------------------------------------------- thresholds


def feature_lines(parsed: DataFrame) -> DataFrame:
    """One feature line per (model, name): the last definition wins."""
    feats = parsed.filter(F.col("kind") == "feature")
    return feats.groupBy("model_id", "name").agg(F.max_by("rhs", "line_no").alias("rhs"))


def threshold_values(spark: SparkSession, parsed: DataFrame) -> DataFrame:
    """Split values of known features as doubles: (model_id, feature, value)."""
    last = feature_lines(parsed)
    known = last.join(F.broadcast(feature_table(spark)), last["name"] == F.col("feature"))
    items = known.select(
        "model_id", "feature", F.explode(F.regexp_extract_all("rhs", F.lit(UNI + DT_THRESHOLD_ITEM), 1)).alias("t")
    )
    return items.select("model_id", "feature", F.col("t").cast("double").alias("value"))


def build_thresholds(spark: SparkSession, values: DataFrame, models: DataFrame) -> DataFrame:
    """Integer upper edges and their bins.

    ``values``: (model_id, feature, value double); ``models``: (model_id).
    Every model gets every feature, with the domain maximum as last edge.
    Output (model_id, feature, fpos, fmax, bin_id, lo, hi); ``hi`` is the
    threshold ("upper") and ``bin_id`` its position from 0.
    """
    ft = F.broadcast(feature_table(spark))
    v = values.join(ft, "feature")
    in_domain = v.filter((F.col("value") >= 0) & (F.col("value") < F.col("fmax") + 1)).select(
        "model_id", "feature", F.floor("value").cast("int").alias("upper")
    )
    tops = models.select("model_id", feature_rows()).select("model_id", "feature", F.col("fmax").alias("upper"))
    edges = in_domain.unionByName(tops).distinct().join(ft, "feature")
    w = Window.partitionBy("model_id", "feature").orderBy("upper")
    return edges.select(
        "model_id",
        "feature",
        "fpos",
        "fmax",
        (F.row_number().over(w) - 1).cast("int").alias("bin_id"),
        F.coalesce(F.lag("upper").over(w) + 1, F.lit(0)).cast("int").alias("lo"),
        F.col("upper").alias("hi"),
    )


# --------------------------------------------------------------------------- rules


def rule_lines(parsed: DataFrame) -> DataFrame:
    """Rule lines with their class label: (model_id, line_no, cond, class)."""
    return parsed.filter(F.col("kind") == "rule").select(
        "model_id", "line_no", "cond", F.col("class_text").try_cast("bigint").alias("class")
    )


def check_classes(rules: DataFrame) -> None:
    """A class label must fit the 8-bit label (compile error otherwise)."""
    bad = rules.filter(F.col("class").isNull() | (F.col("class") > MAX_CLASS_LABEL))
    r = bad.agg(F.min(F.struct("model_id", "line_no")).alias("r")).first().r
    if r is not None:
        raise ValueError(f"model {r.model_id} line {r.line_no}: class label out of range 0..{MAX_CLASS_LABEL}")


def predicates(rules: DataFrame, keys: list[str]) -> DataFrame:
    """The predicates of each rule, in text order: keys + (feature, op, value)."""
    found = rules.select(*keys, F.explode(F.regexp_extract_all("cond", F.lit(UNI + DT_PREDICATE), 0)).alias("p"))
    # a predicate is cut at its only operator
    cut = found.withColumn("op", F.when(F.contains("p", F.lit("<=")), F.lit("<=")).otherwise(F.lit(">")))
    part = lambda i: strip(F.split_part("p", F.col("op"), F.lit(i)))
    return cut.select(*keys, part(1).alias("feature"), "op", part(2).cast("double").alias("value"))


def known_predicates(spark: SparkSession, preds: DataFrame) -> DataFrame:
    """Keep predicates on known features (semi join), adding fpos and fmax."""
    return preds.join(F.broadcast(feature_table(spark)), "feature")


def rule_bounds(spark: SparkSession, preds: DataFrame, keys: list[str], rules: DataFrame | None = None) -> DataFrame:
    """D2 (+ C7 when ``rules`` is given): integer bounds per rule and feature.

    ``<= v`` gives ``hi = floor(v)``, ``> v`` gives ``lo = floor(v) + 1``;
    several predicates on one feature intersect (max of lows, min of highs),
    the result is clamped into the feature domain. With ``rules``, every rule
    gets all five features, full range where the text says nothing; this is
    a union before the same aggregation, not a join.
    Output: keys + (feature, fpos, fmax, lo, hi, empty).
    """
    k = known_predicates(spark, preds)
    v = safe_double("value", "fmax")
    rows = k.select(
        *keys,
        "feature",
        "fpos",
        "fmax",
        F.when(F.col("op") == ">", F.floor(v) + 1).cast("bigint").alias("lo_c"),
        F.when(F.col("op") == "<=", F.floor(v)).cast("bigint").alias("hi_c"),
    )
    if rules is not None:
        full = rules.select(*keys, feature_rows()).select(
            *keys,
            "feature",
            "fpos",
            "fmax",
            F.lit(None).cast("bigint").alias("lo_c"),
            F.lit(None).cast("bigint").alias("hi_c"),
        )
        rows = rows.unionByName(full)
    agg = rows.groupBy(*keys, "feature", "fpos", "fmax").agg(
        F.max("lo_c").alias("lo_c"), F.min("hi_c").alias("hi_c")
    )
    lo = clamp(F.coalesce(F.col("lo_c"), F.lit(0)), "fmax").cast("int")
    hi = clamp(F.coalesce(F.col("hi_c"), F.col("fmax").cast("bigint")), "fmax").cast("int")
    return agg.select(*keys, "feature", "fpos", "fmax", lo.alias("lo"), hi.alias("hi")).withColumn(
        "empty", F.col("lo") > F.col("hi")
    )


def raw_boxes(spark: SparkSession, preds: DataFrame, keys: list[str], rules: DataFrame) -> DataFrame:
    """The rules' own conditions as boxes: keys + (lo ARRAY<INT>, hi ARRAY<INT>).

    Features are integers, so ``<= v`` is ``<= floor(v)`` and ``> v`` is ``>= floor(v) + 1``.
    Nothing is clamped or widened to bins; a rule that no value of the domain
    meets is left out. Each rule's predicates are intersected by one aggregation.
    """
    k = known_predicates(spark, preds)
    v = F.greatest(F.lit(-2.0), F.least(F.col("value"), F.col("fmax").cast("double") + 2))
    edge = F.floor(v).cast("int")
    cells = []
    for i, f in enumerate(DT_FEATURES):
        here = F.col("fpos") == i
        cells.append(F.max(F.when(here & (F.col("op") == ">"), edge + 1)).alias(f"a{i}"))
        cells.append(F.min(F.when(here & (F.col("op") == "<="), edge)).alias(f"b{i}"))
    bounds = k.groupBy(*keys).agg(*cells)
    full = rules.select(*keys).join(bounds, keys, "left")
    lo = [F.greatest(F.lit(0), F.coalesce(f"a{i}", F.lit(0))) for i in range(N_FEATURES)]
    hi = [F.least(F.lit(FEATURE_MAX[f]), F.coalesce(f"b{i}", F.lit(FEATURE_MAX[f]))) for i, f in enumerate(DT_FEATURES)]
    out = full.select(*keys, F.array(*lo).alias("lo"), F.array(*hi).alias("hi"))
    return out.where(F.forall(F.arrays_zip("lo", "hi"), lambda x: x["lo"] <= x["hi"]))


def id_ranges(bounds: DataFrame, bins: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """C6 + D3: first and last bin overlapping [lo, hi].

    Bins tile the domain, so the first overlapping bin is the one holding
    ``lo`` and the last the one holding ``hi``: two point lookups instead of
    listing every overlapping bin. Empty ranges get NULL ids.
    """
    keys = ["model_id", "feature"]
    # computed once (its size check and both lookups read the checkpoint)
    exp = expand_blocks(bins, keys, "lo", "hi", ["bin_id"]).transform(checkpointed)
    if broadcast is None:
        broadcast = exp.count() <= MAX_BROADCAST_ROWS
    s = locate(bounds, bins, keys, "lo", {"bin_id": "__s"}, expanded=exp, broadcast=broadcast)
    e = locate(s, bins, keys, "hi", {"bin_id": "__e"}, expanded=exp, broadcast=broadcast)
    return e.withColumn("id_start", F.when(~F.col("empty"), F.col("__s"))).withColumn(
        "id_end", F.when(~F.col("empty"), F.col("__e"))
    ).drop("__s", "__e")


def rule_rows(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """One row per valid rule with 5-wide id arrays in feature order.

    A rule is kept only if all five features have a non-empty range.
    """
    g = ranges.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_and(~F.col("empty")).alias("ok"),
        F.sort_array(F.collect_list(F.struct("fpos", "id_start", "id_end"))).alias("r"),
    )
    valid = g.filter((F.col("n") == N_FEATURES) & F.col("ok"))
    return valid.select(
        *keys,
        F.transform("r", lambda x: x["id_start"]).alias("id_start"),
        F.transform("r", lambda x: x["id_end"]).alias("id_end"),
    )


def number_rules(rows: DataFrame) -> DataFrame:
    """rule_id from 0 in file order, counted after removals, per model
    (two-level numbering: no model is numbered in a single task)."""
    numbered = number_in_order(rows, "model_id", "line_no", "rule_id", start=0)
    return numbered.select(
        "model_id",
        "rule_id",
        F.col("line_no").cast("int").alias("line_no"),
        F.col("class").cast("int").alias("class"),
        "id_start",
        "id_end",
    )


# --------------------------------------------------------------------------- model


@dataclass
class DTModel:
    """Compiled decision-tree tables (dt_bin / dt_rule), any number of models.

    Tables derived for scoring (radix, edge vectors, cells, rule masks) are
    computed once per compiled model and checkpointed into the shared work
    folder, so every scoring job broadcasts a plain scan of them.
    """

    bins: DataFrame  # model_id, feature, fpos, fmax, bin_id, lo, hi
    rules: DataFrame  # model_id, rule_id, line_no, class, id_start, id_end
    _cache: dict = field(default_factory=dict, repr=False)

    def thresholds(self) -> DataFrame:
        """dt_threshold: (model_id, feature, pos, upper)."""
        return self.bins.select("model_id", "feature", F.col("bin_id").alias("pos"), F.col("hi").alias("upper"))

    def radix(self) -> DataFrame:
        """Per model: bin counts n0..n4 and mixed-radix strides s0..s4."""
        if "radix" not in self._cache:
            counts = self.bins.groupBy("model_id").agg(
                *[F.max(F.when(F.col("fpos") == i, F.col("bin_id") + 1)).alias(f"n{i}") for i in range(N_FEATURES)]
            )
            strides = []
            for i in range(N_FEATURES):
                s = F.lit(1).cast("bigint")
                for j in range(i + 1, N_FEATURES):
                    s = s * F.col(f"n{j}")
                strides.append(s.alias(f"s{i}"))
            self._cache["radix"] = counts.select(
                "model_id", *[f"n{i}" for i in range(N_FEATURES)], *strides
            ).transform(checkpointed)
        return self._cache["radix"]

    def vectors(self) -> DataFrame:
        """Per model: sorted upper edges per feature (u0..u4) and strides.

        One row per model; each array holds at most the feature domain.
        """
        if "vectors" not in self._cache:
            per = self.bins.groupBy("model_id", "fpos").agg(F.sort_array(F.collect_list("hi")).alias("u"))
            wide = per.groupBy("model_id").agg(
                *[F.first(F.when(F.col("fpos") == i, F.col("u")), ignorenulls=True).alias(f"u{i}") for i in range(N_FEATURES)]
            )
            self._cache["vectors"] = wide.join(self.radix(), "model_id").transform(checkpointed)
        return self._cache["vectors"]

    def n_bins(self) -> int:
        """Total bins over all models (the size of every per-bin table)."""
        if "n_bins" not in self._cache:
            self._cache["n_bins"] = self.bins.count()
        return self._cache["n_bins"]

    def n_models(self) -> int:
        if "n_models" not in self._cache:
            self._cache["n_models"] = self.radix().count()
        return self._cache["n_models"]

    def rule_stats(self) -> tuple[int, int]:
        """(most rules in one model, rules over all models)."""
        if "rule_stats" not in self._cache:
            r = self.rules.groupBy("model_id").count().agg(F.max("count"), F.sum("count")).collect()[0]
            self._cache["rule_stats"] = (int(r[0] or 0), int(r[1] or 0))
        return self._cache["rule_stats"]

    def cell_pairs(self, model_id: str | None = None) -> float:
        """Number of (cell, rule) pairs the flat cell table would need, over all models or for one.

        A double: the number only serves as a size check, and must not overflow.
        """
        key = ("pairs", model_id)
        if key not in self._cache:
            width = F.lit(1.0)
            for i in range(N_FEATURES):
                width = width * (F.col("id_end")[i] - F.col("id_start")[i] + 1).cast("double")
            rules = self.rules if model_id is None else self.rules.filter(F.col("model_id") == model_id)
            row = rules.agg(F.sum(width).alias("p")).collect()[0]
            self._cache[key] = float(row.p or 0)
        return self._cache[key]

    def cells(self) -> DataFrame:
        """C9 + E5: (model_id, cell, rule_id, class) - one class per id combination.

        Each rule lists the cells inside its ranges (a generator, no join),
        and where rules overlap the lowest rule_id wins. Cells no rule covers
        are absent: the scoring left join leaves them NULL, i.e. dropped.
        """
        if "cells" not in self._cache:
            pairs = self.cell_rule_pairs()
            best = pairs.groupBy("model_id", "cell").agg(F.min(F.struct("rule_id", "class")).alias("m"))
            self._cache["cells"] = best.select(
                "model_id", "cell", F.col("m.rule_id").alias("rule_id"), F.col("m.class").alias("class")
            ).transform(checkpointed)
        return self._cache["cells"]

    def cell_rule_pairs(self) -> DataFrame:
        """(model_id, cell, rule_id, class): every cell inside every rule's ranges."""
        radix = F.broadcast(self.radix()) if self.n_models() <= MAX_BROADCAST_ROWS else self.radix()
        r = self.rules.join(radix, "model_id")
        for i in range(N_FEATURES):
            r = r.select("*", F.explode(F.sequence(F.col("id_start")[i], F.col("id_end")[i])).alias(f"i{i}"))
        cell = F.lit(0).cast("bigint")
        for i in range(N_FEATURES):
            cell = cell + F.col(f"i{i}").cast("bigint") * F.col(f"s{i}")
        return r.select("model_id", cell.alias("cell"), "rule_id", "class")

    def boxes(self) -> DataFrame:
        """The rules as boxes of raw values: (model_id, rule_id, class, lo ARRAY<INT>, hi ARRAY<INT>), inclusive."""
        vec = self.vectors()
        right = F.broadcast(vec) if self.n_bins() <= MAX_BROADCAST_ROWS else vec
        j = self.rules.join(right, "model_id")
        first = lambda i: F.col("id_start")[i]
        lo = [F.when(first(i) == 0, F.lit(0)).otherwise(F.get(f"u{i}", first(i) - 1) + 1) for i in range(N_FEATURES)]
        hi = [F.get(f"u{i}", F.col("id_end")[i]) for i in range(N_FEATURES)]
        return j.select("model_id", "rule_id", "class", F.array(*lo).alias("lo"), F.array(*hi).alias("hi"))

    def index(self) -> BoxIndex:
        """The first-match index of all models, built once per compiled model."""
        if "index" not in self._cache:
            self._cache["index"] = build_index(self.boxes(), self.model_ids())
        return self._cache["index"]

    def model_ids(self) -> DataFrame:
        """Distinct model ids (computed once per compiled model)."""
        if "ids" not in self._cache:
            self._cache["ids"] = self.bins.select("model_id").distinct().transform(checkpointed)
        return self._cache["ids"]

    def persist(self) -> "DTModel":
        """Cut lineage: the compiled tables are small; checkpoint them once."""
        return DTModel(self.bins.transform(checkpointed), self.rules.transform(checkpointed))


def strict_findings(spark: SparkSession, parsed: DataFrame) -> DataFrame:
    """What the compat reader would silently ignore, clamp or drop, per line:
    (model_id, line_no, finding)."""
    item_pat = r"^\s*np\.float64\(([-+]?\d*\.?\d+)\)\s*$"
    feats = parsed.filter(F.col("kind") == "feature")
    items = feats.select(
        "model_id", "line_no", "name",
        F.explode(F.split(F.regexp_replace("rhs", r"^\[|\]$", ""), ",")).alias("item"),
    ).filter(F.trim("item") != "")
    bad_items = items.filter(~F.col("item").rlike(UNI + item_pat)).select(
        "model_id", "line_no", F.concat(F.lit("unreadable threshold: "), F.trim("item")).alias("finding")
    )
    ft = F.broadcast(feature_table(spark))
    unknown_line = feats.join(ft, feats["name"] == F.col("feature"), "left_anti").select(
        "model_id", "line_no", F.concat(F.lit("unknown feature line: "), F.col("name")).alias("finding")
    )
    vals = threshold_values(spark, parsed).join(ft, "feature").filter(
        (F.col("value") < 0) | (F.col("value") >= F.col("fmax") + 1)
    )
    bad_vals = vals.select(
        "model_id", F.lit(None).cast("int").alias("line_no"),
        F.concat(F.lit("threshold outside the domain: "), F.col("feature")).alias("finding"),
    )
    rules = rule_lines(parsed)
    leftover = F.trim(F.regexp_replace(F.regexp_replace("cond", UNI + DT_PREDICATE, ""), r"(?i)\band\b", ""))
    bad_text = rules.filter(leftover != "").select(
        "model_id", "line_no", F.concat(F.lit("unread condition text: "), leftover).alias("finding")
    )
    keys = ["model_id", "line_no"]
    preds = predicates(rules, keys).join(ft, "feature", "left")
    unknown_pred = preds.filter(F.col("fpos").isNull()).select(
        *keys, F.concat(F.lit("unknown feature: "), F.col("feature")).alias("finding")
    )
    out_dom = preds.filter(
        F.col("fpos").isNotNull() & ((F.col("value") < 0) | (F.col("value") >= F.col("fmax") + 1))
    ).select(*keys, F.concat(F.lit("value outside the domain: "), F.col("feature")).alias("finding"))
    empty = rule_bounds(spark, predicates(rules, keys), keys).filter("empty").select(
        *keys, F.concat(F.lit("empty range on "), F.col("feature")).alias("finding")
    )
    return (
        bad_items.unionByName(unknown_line).unionByName(bad_vals).unionByName(bad_text)
        .unionByName(unknown_pred).unionByName(out_dom).unionByName(empty)
    )


def compile_from_lines(spark: SparkSession, lines: DataFrame, check: bool = True, mode: str = "compat") -> DTModel:
    """J1 over numbered model lines (model_id, line_no, line).

    ``mode="compat"`` reads model text exactly as the reference generator
    does (bad pieces silently ignored or clamped); ``mode="strict"`` raises
    on the first such finding instead.
    """
    # thresholds, class check and rules read the lines: parsed once, lineage cut
    parsed = parse_dt_lines(lines).transform(checkpointed)
    if mode == "strict":
        found = strict_findings(spark, parsed).transform(checkpointed)
        total = found.count()
        if total:
            first = found.orderBy("model_id", "line_no", "finding").limit(5).collect()
            named = "; ".join(f"model {r.model_id} line {r.line_no}: {r.finding}" for r in first)
            raise ValueError(f"{total} findings (strict_findings returns them all), the first: {named}")
    models = lines.select("model_id").distinct()
    # bins feed the lookups and the result: computed once, lineage cut
    bins = build_thresholds(spark, threshold_values(spark, parsed), models).transform(checkpointed)
    rules = rule_lines(parsed)
    if check:
        check_classes(rules)
    keys = ["model_id", "line_no", "class"]
    bounds = rule_bounds(spark, predicates(rules, keys), keys, rules=rules)
    rows = rule_rows(id_ranges(bounds, bins), keys).transform(checkpointed)
    return DTModel(bins=bins, rules=number_rules(rows).transform(checkpointed))


def compile_dt(spark: SparkSession, path: str, check: bool = True, mode: str = "compat") -> DTModel:
    """Compile decision-tree model text file(s) at ``path``."""
    return compile_from_lines(spark, read_model_lines(spark, path), check=check, mode=mode)


def model_counts(model: DTModel) -> DataFrame:
    """Per model - rules kept, features, thresholds, classes."""
    r = model.rules.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("n_rules"), F.countDistinct("class").alias("n_classes")
    )
    b = model.bins.groupBy("model_id").agg(
        F.countDistinct("feature").alias("n_features"), F.count(F.lit(1)).alias("n_thresholds")
    )
    return b.join(r, "model_id", "left").fillna(0, ["n_rules", "n_classes"])
