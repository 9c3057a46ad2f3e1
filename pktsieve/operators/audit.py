"""Model audit (X3): what the compiled form changes or cannot see.

- predicates the compiler ignores (unknown feature), clamps (value outside
  the feature domain) or widens to whole bins (value not a threshold);
- rules dropped for an empty range;
- cells no rule covers (packets there are dropped) and cells several rules
  cover (the lowest rule_id wins), counted without listing cells;
- classes with no egress port.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS, checkpointed
from .box_index import NODE, at_root, covers, halves, middle_cuts, per_node
from .dtree_compile import N_FEATURES, DTModel, feature_table, rule_bounds


def predicate_audit(spark: SparkSession, preds: DataFrame, bins: DataFrame, keys: list[str]) -> DataFrame:
    """Per model: predicate counts by finding, and rules left with an empty range.

    ``preds``: keys (model_id first) + (feature, op, value). An edge is
    ``floor(value)``; it is off-threshold when it is in the domain but not an
    upper edge of that model and feature (equi anti-join on the edge).
    """
    ft = F.broadcast(feature_table(spark))
    p = preds.join(ft, "feature", "left")
    edge = F.floor(F.greatest(F.lit(-2.0), F.least(F.col("value"), F.col("fmax").cast("double") + 2)))
    p = p.select(
        *keys, "feature", "fmax",
        F.col("fpos").isNull().alias("unknown"),
        edge.cast("bigint").alias("edge"),
    )
    known = p.filter(~F.col("unknown"))
    out_dom = (F.col("edge") < 0) | (F.col("edge") > F.col("fmax"))
    # computed once: the size check and the anti join read the checkpoint
    edges = bins.select("model_id", "feature", F.col("hi").cast("bigint").alias("edge")).transform(checkpointed)
    right = F.broadcast(edges) if edges.count() <= MAX_BROADCAST_ROWS else edges
    in_dom = known.filter(~out_dom)
    off = in_dom.join(right, ["model_id", "feature", "edge"], "left_anti")
    per = (
        p.groupBy("model_id").agg(
            F.count(F.lit(1)).alias("n_predicates"),
            F.sum(F.col("unknown").cast("int")).alias("n_unknown_feature"),
            F.sum((~F.col("unknown") & F.coalesce(out_dom, F.lit(False))).cast("int")).alias("n_out_of_domain"),
        )
    )
    offc = off.groupBy("model_id").agg(F.count(F.lit(1)).alias("n_off_threshold"))
    b = rule_bounds(spark, preds, keys)
    empty = b.groupBy(*keys).agg(F.max(F.col("empty").cast("int")).alias("e")).groupBy("model_id").agg(
        F.count(F.lit(1)).alias("n_rules_constrained"), F.sum("e").alias("n_rules_empty")
    )
    return (
        per.join(offc, "model_id", "left")
        .join(empty, "model_id", "left")
        .fillna(0, ["n_off_threshold", "n_rules_constrained", "n_rules_empty"])
    )


# A node with at most so many rules is counted in one group.
FEW = 512
CELLS = "decimal(38,0)"


def _volume(lo: str, hi: str) -> F.Column:
    """Cells of a box of id ranges."""
    v = F.lit(1).cast(CELLS)
    for i in range(N_FEATURES):
        v = (v * (F.col(hi)[i] - F.col(lo)[i] + 1).cast("decimal(10,0)")).cast(CELLS)
    return v


def _covered(lo: np.ndarray, hi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> tuple[int, int]:
    """Cells of a box that at least one, and that at least two, of some boxes hold.

    The box is cut at the middle of the edges inside it until at most one box is
    left that doesn't cover it whole.
    """
    once = twice = 0
    stack = [(blo, bhi, np.arange(len(lo)))]
    while stack:
        b, t, own = stack.pop()
        own = own[((lo[own] <= t) & (hi[own] >= b)).all(axis=1)]
        if not len(own):
            continue
        whole = ((lo[own] <= b) & (hi[own] >= t)).all(axis=1)
        n_whole, rest = int(whole.sum()), own[~whole]
        size = math.prod((t - b + 1).tolist())
        if n_whole >= 2 or not len(rest):
            once, twice = once + size, twice + (size if n_whole >= 2 else 0)
            continue
        if len(rest) == 1:
            part = math.prod((np.minimum(hi[rest[0]], t) - np.maximum(lo[rest[0]], b) + 1).tolist())
            once, twice = once + (size if n_whole else part), twice + (part if n_whole else 0)
            continue
        best = None
        for f in range(lo.shape[1]):
            begins, ended = lo[rest, f], hi[rest, f] + 1
            edges = np.concatenate((begins[begins > b[f]], ended[ended <= t[f]]))
            if len(edges) and (best is None or len(edges) > best[0]):
                best = len(edges), f, int(np.sort(edges)[len(edges) // 2])
        _, f, cut = best
        low_top, high_bottom = t.copy(), b.copy()
        low_top[f], high_bottom[f] = cut - 1, cut
        stack += [(b, low_top, own), (high_bottom, t, own)]
    return once, twice


def _count_node(frame: pd.DataFrame) -> pd.DataFrame:
    first = frame.iloc[0]
    arrays = [np.array(frame[c].tolist(), dtype=np.int64) for c in ("lo", "hi")]
    box = [np.array(first[c], dtype=np.int64) for c in ("blo", "bhi")]
    once, twice = _covered(*arrays, *box)
    return pd.DataFrame({"model_id": [first["model_id"]], "once": [Decimal(once)], "twice": [Decimal(twice)]})


def cell_audit(model: DTModel) -> DataFrame:
    """Per model: total cells, cells with no rule, cells with more than one rule (DECIMAL).

    Cells (combinations of bin ids) are counted, not listed: a model's id space
    is cut in halves, level by level over rows (model, node, rule). A node that
    two rules cover whole is settled; one with few rules (``FEW``) is counted in
    a group of those rules; only the others are cut, at the median edge of the
    feature with the most edges inside.
    """
    rad = model.radix()
    dims = rad.select("model_id", F.array(*[(F.col(f"n{i}") - 1).cast("int") for i in range(N_FEATURES)]).alias("top"))
    right = F.broadcast(dims) if model.n_models() <= MAX_BROADCAST_ROWS else dims
    rules = model.rules.join(right, "model_id").select("model_id", F.col("id_start").alias("lo"), F.col("id_end").alias("hi"), "top")
    rows = checkpointed(at_root(rules, F.col("top")).drop("top"))
    id_type = model.rules.schema["model_id"].dataType.simpleString()
    settled: list[DataFrame] = []
    while True:
        whole = F.sum(covers().cast("int"))
        box = [F.first(c).alias(c) for c in ("blo", "bhi")]  # the same in all rows of a node
        nodes = checkpointed(rows.groupBy(*NODE).agg(whole.alias("whole"), F.count(F.lit(1)).alias("n"), *box))
        n_nodes = nodes.count()
        if not n_nodes:
            break
        size = _volume("blo", "bhi")
        settled.append(nodes.where("whole >= 2").select("model_id", size.alias("once"), size.alias("twice")))
        open_nodes = nodes.where("whole < 2").select(*NODE, "n")
        left = per_node(rows, open_nodes, n_nodes)
        few = left.where(F.col("n") <= FEW).drop("n")
        settled.append(few.groupBy(*NODE).applyInPandas(_count_node, f"model_id {id_type}, once {CELLS}, twice {CELLS}"))
        many = checkpointed(left.where(F.col("n") > FEW).drop("n"))
        rows = checkpointed(halves(per_node(many, middle_cuts(many), n_nodes)))
    parts = rad.select("model_id", F.lit(0).cast(CELLS).alias("once"), F.lit(0).cast(CELLS).alias("twice"))
    for part in settled:
        parts = parts.unionByName(part)
    sums = parts.groupBy("model_id").agg(F.sum("once").cast(CELLS).alias("once"), F.sum("twice").cast(CELLS).alias("twice"))
    total = F.lit(1).cast(CELLS)
    for i in range(N_FEATURES):
        total = (total * F.col(f"n{i}").cast("decimal(10,0)")).cast(CELLS)
    cells = rad.select("model_id", total.alias("n_cells"))
    return cells.join(sums, "model_id").select(
        "model_id", "n_cells", (F.col("n_cells") - F.col("once")).cast(CELLS).alias("n_uncovered"), F.col("twice").alias("n_overlap")
    )


def classes_without_port(rules: DataFrame, ports: DataFrame) -> DataFrame:
    """Rules whose class has no egress port (model_id, rule_id, class)."""
    return rules.join(
        ports.select("model_id", F.col("class_id").alias("class")), ["model_id", "class"], "left_anti"
    ).select("model_id", "rule_id", "class")
