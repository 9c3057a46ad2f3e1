"""First matching rule of many boxes per model, through a tree of cuts.

A rule is a box: an inclusive range per feature. A model's space is cut again and
again at a value of one feature, and every node keeps the rules that reach into
its box. Rules behind the first one that covers a whole node can never be first
there and go. A node with few rules left, or with nothing left to cut, is a
leaf, and holds its rules in order. So a packet walks a short path to one leaf
and looks at a short list, however many rules its model has; no row is made per
rule and packet.

The tree is built level by level as DataFrame steps over rows
``(model, node, rule)``: nodes are aggregates (pre-aggregated before the
shuffle), and what is decided per node comes back by an equi-join on it. A node
that no cut makes smaller is a leaf with a longer list, and so are the nodes
that are left when the rows have grown ``SPREAD``-fold. Only nodes of more than
``FEW`` rules are cut level by level; smaller ones are cut to the end in a group
of their rules.

For scoring, each model is one row: arrays of its nodes and of its leaves' rule
lists. The rows are broadcast after their entries are counted, otherwise they
are joined by ``model_id`` in a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DT_FEATURES, FEATURE_MAX
from ..session import MAX_BROADCAST_ROWS, checkpointed
from .numbering import number_in_order

N = len(DT_FEATURES)
LEAF = 12  # rules of a node that is not cut any more
SPREAD = 16  # rows that rules may grow to, against the rules
FEW = 2_000  # rules of a node that is cut to the end in one group
MAX_LEVELS = 60  # node numbers are 64-bit: the root is 1, halves are 2n and 2n + 1
NODE = ["model_id", "node"]


def covers() -> Column:
    """The rule holds the whole box of its node."""
    c = F.lit(True)
    for i in range(N):
        c = c & (F.col("lo")[i] <= F.col("blo")[i]) & (F.col("hi")[i] >= F.col("bhi")[i])
    return c


def inside_edges() -> Column:
    """(f, edge) for every place inside the node's box where the rule begins or has ended."""
    out = []
    for i in range(N):
        begins = F.when(F.col("lo")[i] > F.col("blo")[i], F.col("lo")[i])
        ended = F.when(F.col("hi")[i] < F.col("bhi")[i], F.col("hi")[i] + 1)
        out += [F.struct(F.lit(i).alias("f"), e.cast("int").alias("edge")) for e in (begins, ended)]
    return F.filter(F.array(*out), lambda x: x["edge"].isNotNull())


def middle_cuts(rows: DataFrame) -> DataFrame:
    """``(model_id, node, f, cut)``: the feature with the most edges inside the node, and their median."""
    edges = rows.select(*NODE, F.explode(inside_edges()).alias("e"))
    per = edges.groupBy(*NODE, "e.f").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("e.edge", 0.5, 1000).alias("cut"))
    best = per.groupBy(*NODE).agg(F.max(F.struct("n", (-F.col("f")).alias("g"), "cut")).alias("m"))
    return best.select(*NODE, (-F.col("m.g")).cast("int").alias("f"), F.col("m.cut").cast("int").alias("cut"))


def halves(rows: DataFrame) -> DataFrame:
    """The rows ``(..., f, cut)`` dealt to the two halves of their node."""
    edge = F.col("cut")
    low = F.struct((F.col("node") * 2).alias("node"), F.col("blo").alias("blo"), F.transform("bhi", lambda x, i: F.when(i == F.col("f"), edge - 1).otherwise(x)).alias("bhi"))
    high = F.struct((F.col("node") * 2 + 1).alias("node"), F.transform("blo", lambda x, i: F.when(i == F.col("f"), edge).otherwise(x)).alias("blo"), F.col("bhi").alias("bhi"))
    both = F.array(F.when(F.get("lo", "f") < edge, low), F.when(F.get("hi", "f") >= edge, high))
    kept = [c for c in rows.columns if c not in ("node", "blo", "bhi", "f", "cut")]
    return rows.select(*kept, F.explode(F.filter(both, lambda x: x.isNotNull())).alias("h")).select(*kept, "h.*")


def per_node(rows: DataFrame, nodes: DataFrame, n_nodes: int) -> DataFrame:
    """Join what was decided per node back to the node's rows."""
    return rows.join(F.broadcast(nodes) if n_nodes <= MAX_BROADCAST_ROWS else nodes, NODE)


def at_root(boxes: DataFrame, top: Column | None = None) -> DataFrame:
    """The boxes as rows of their model's root node, the box from 0 to ``top`` (the feature domains)."""
    top = F.array(*[F.lit(FEATURE_MAX[f]) for f in DT_FEATURES]) if top is None else top
    return boxes.select("*", F.lit(1).cast("long").alias("node"), F.array(*[F.lit(0)] * N).alias("blo"), top.alias("bhi"))


@dataclass
class BoxIndex:
    """``models``: (model_id, f, cut, low, high, leaves), one row per model; ``low`` and ``high``
    are the halves' nodes, or ``-1 - i`` for the leaf ``i``; ``depth`` is the longest path."""

    models: DataFrame
    depth: int
    entries: int

    def match(self, df: DataFrame, features: list[str] = DT_FEATURES) -> DataFrame:
        """Add ``rule_id, class_id`` of the first rule of the packet's model that holds it (NULL: none)."""
        right = F.broadcast(self.models) if self.entries <= MAX_BROADCAST_ROWS else self.models
        names = [c for c in df.columns]
        j = df.join(right.withColumnsRenamed({c: f"__{c}" for c in ("f", "cut", "low", "high", "leaves")}), "model_id", "left")
        x = F.array(*[F.col(f).cast("int") for f in features])
        j = j.select(*names, "__f", "__cut", "__low", "__high", "__leaves", x.alias("__x"))
        at = F.when(F.size("__f") == 0, F.lit(-1)).otherwise(F.lit(0))

        def step(n: Column, _: Column) -> Column:
            goes_low = F.get("__x", F.get("__f", n)) < F.get("__cut", n)
            return F.when(n < 0, n).when(goes_low, F.get("__low", n)).otherwise(F.get("__high", n))

        if self.depth:
            at = F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), at, step)
        rules = j.withColumn("__list", F.get("__leaves", -1 - at))

        def holds(r: Column) -> Column:
            c = None
            for i, f in enumerate(features):
                one = (F.col(f) >= r[f"l{i}"]) & (F.col(f) <= r[f"h{i}"])
                c = one if c is None else c & one
            return c

        hit = F.get(F.filter("__list", holds), F.lit(0))
        return rules.select(*names, hit["rule_id"].alias("rule_id"), hit["class"].cast("int").alias("class_id"))


def cut_node(lo: np.ndarray, hi: np.ndarray, blo: np.ndarray, bhi: np.ndarray, node: int) -> tuple[list, list]:
    """Cuts (node, f, cut) and leaves (node, places of rules) below a node whose rules come in order."""
    cuts, leaves = [], []
    room = SPREAD * len(lo) + 1000
    stack = [(node, blo, bhi, np.arange(len(lo)))]
    while stack:
        n, b, t, own = stack.pop()
        whole = np.flatnonzero(((lo[own] <= b) & (hi[own] >= t)).all(axis=1))
        if len(whole):
            own = own[: whole[0] + 1]
        best = None
        if len(own) > LEAF and n < 1 << MAX_LEVELS and room > 0:
            for f in range(N):
                begins, ended = lo[own, f], hi[own, f] + 1
                edges = np.concatenate((begins[begins > b[f]], ended[ended <= t[f]]))
                if len(edges) and (best is None or len(edges) > best[0]):
                    best = len(edges), f, int(np.sort(edges)[len(edges) // 2])
        if best is not None:
            _, f, cut = best
            low, high = own[lo[own, f] < cut], own[hi[own, f] >= cut]
            if len(low) + len(high) == 2 * len(own):
                best = None
        if best is None:
            leaves.append((n, own))
            continue
        room -= len(low) + len(high) - len(own)
        cuts.append((n, f, cut))
        low_top, high_bottom = t.copy(), b.copy()
        low_top[f], high_bottom[f] = cut - 1, cut
        stack += [(2 * n, b, low_top, low), (2 * n + 1, high_bottom, t, high)]
    return cuts, leaves


def _cut_group(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("rule_id").reset_index(drop=True)
    first = frame.iloc[0]
    lo, hi = (np.array(frame[c].tolist(), dtype=np.int64) for c in ("lo", "hi"))
    box = [np.array(first[c], dtype=np.int64) for c in ("blo", "bhi")]
    cuts, leaves = cut_node(lo, hi, *box, int(first["node"]))
    parts = [frame.iloc[own][["model_id", "rule_id", "class", "lo", "hi"]].assign(node=n) for n, own in leaves if len(own)]
    parts.append(pd.DataFrame({
        "node": [c[0] for c in cuts], "f": [c[1] for c in cuts], "cut": [c[2] for c in cuts], "model_id": [first["model_id"]] * len(cuts), "lo": [None] * len(cuts), "hi": [None] * len(cuts),
    }))
    out = pd.concat(parts, ignore_index=True).astype({"f": "Int32", "cut": "Int32", "rule_id": "Int64", "class": "Int32"})
    return out[["model_id", "node", "f", "cut", "rule_id", "class", "lo", "hi"]]


def build(boxes: DataFrame, models: DataFrame) -> BoxIndex:
    """Index ``boxes`` (model_id, rule_id, class, lo ARRAY<INT>, hi ARRAY<INT>) of all ``models`` (model_id)."""
    columns = ["model_id", "rule_id", "class", "lo", "hi"]
    rows = checkpointed(at_root(boxes.select(*columns)))
    most = SPREAD * rows.count() + FEW
    types = {c: rows.schema[c].dataType.simpleString() for c in columns}
    local_schema = f"model_id {types['model_id']}, node long, f int, cut int, rule_id long, class int, lo array<int>, hi array<int>"
    cut_tables, leaf_tables, level = [], [], 0
    while True:
        # rules behind the first that covers the node go
        cover = checkpointed(rows.groupBy(*NODE).agg(F.min(F.when(covers(), F.col("rule_id"))).alias("cover"), F.count(F.lit(1)).alias("n")))
        n_nodes = cover.count()
        rows = per_node(rows, cover.drop("n"), n_nodes).where(F.col("cover").isNull() | (F.col("rule_id") <= F.col("cover"))).drop("cover")
        rows = checkpointed(rows)
        sizes = checkpointed(rows.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n")))
        wide = checkpointed(sizes.where(F.col("n") > FEW))
        n_wide = wide.count()
        few = per_node(rows, sizes.where(F.col("n") <= FEW).select(*NODE), n_nodes)
        local = checkpointed(few.groupBy(*NODE).applyInPandas(_cut_group, local_schema))
        cut_tables.append(local.where("f is not null").select(*NODE, "f", "cut"))
        leaf_tables.append(local.where("f is null").select(*NODE, F.col("rule_id").cast(types["rule_id"]).alias("rule_id"), "class", "lo", "hi"))
        if not n_wide:
            break
        open_rows = per_node(rows, wide, n_wide)
        if level >= MAX_LEVELS or rows.count() > most:
            leaf_tables.append(open_rows.select(*NODE, "rule_id", "class", "lo", "hi"))
            break
        # a cut is made where it leaves fewer rules in one half at least
        both = (F.get("lo", "f") < F.col("cut")).cast("int") + (F.get("hi", "f") >= F.col("cut")).cast("int")
        tried = per_node(open_rows, middle_cuts(open_rows), n_wide)
        pays = tried.groupBy(*NODE, "f", "cut").agg(F.sum(both).alias("after"), F.max("n").alias("n"))
        good = checkpointed(pays.where(F.col("after") < 2 * F.col("n")).select(*NODE, "f", "cut"))
        n_good = good.count()
        stuck = open_rows.join(F.broadcast(good) if n_good <= MAX_BROADCAST_ROWS else good, NODE, "left_anti")
        leaf_tables.append(stuck.select(*NODE, "rule_id", "class", "lo", "hi"))
        cut_tables.append(good)
        rows = checkpointed(halves(per_node(open_rows.drop("n"), good, n_good)))
        level += 1
    return _packed(models, cut_tables, leaf_tables)


def _packed(models: DataFrame, cut_tables: list[DataFrame], leaf_tables: list[DataFrame]) -> BoxIndex:
    """One row per model out of the levels' cuts and leaves."""
    leaves, cuts = leaf_tables[0], cut_tables[0]
    for t in leaf_tables[1:]:
        leaves = leaves.unionByName(t)
    for t in cut_tables[1:]:
        cuts = cuts.unionByName(t)
    ranges = [x for i in range(N) for x in (F.col("lo")[i].alias(f"l{i}"), F.col("hi")[i].alias(f"h{i}"))]
    rule = F.struct("rule_id", F.col("class").cast("int").alias("class"), *ranges)
    lists = leaves.groupBy(*NODE).agg(F.sort_array(F.collect_list(rule)).alias("rules"))
    cuts = checkpointed(cuts)
    deepest = cuts.agg(F.max("node")).first()[0]
    depth = int(deepest).bit_length() if deepest else 0
    # numbers are dense and in the order of the nodes, so the root is 0; a half that no rule reaches has no leaf
    cuts = checkpointed(number_in_order(cuts, "model_id", "node", "i"))
    lists = checkpointed(number_in_order(lists, "model_id", "node", "i"))
    ends = cuts.select(*NODE, F.col("i").alias("to")).unionByName(lists.select(*NODE, (-1 - F.col("i")).alias("to")))
    absent = -(1 << 30)
    half = lambda name, n: (
        cuts.select("model_id", "i", n.alias("node")).join(ends, NODE, "left")
        .select("model_id", "i", F.coalesce("to", F.lit(absent)).cast("int").alias(name))
    )
    nodes = cuts.select("model_id", "i", "f", "cut").join(half("low", F.col("node") * 2), ["model_id", "i"])
    nodes = nodes.join(half("high", F.col("node") * 2 + 1), ["model_id", "i"])
    tree = nodes.groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("i", "f", "cut", "low", "high"))).alias("t"))
    lists = lists.groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("i", "rules"))).alias("l"))
    per = models.join(lists, "model_id", "left").join(tree, "model_id", "left")
    empty = F.expr("cast(array() as array<int>)")
    out = per.select(
        "model_id", *[F.coalesce(F.col(f"t.{c}"), empty).alias(c) for c in ("f", "cut", "low", "high")],
        F.col("l.rules").alias("leaves"),
    )
    out = checkpointed(out)
    return BoxIndex(out, depth, _entries(out))


def _entries(models: DataFrame) -> int:
    """Numbers held in all rows: four per node and twelve per listed rule."""
    lists = F.aggregate("leaves", F.lit(0).cast("long"), lambda a, x: a + F.size(x))
    return int(models.agg(F.sum(4 * F.size("f") + 12 * F.coalesce(lists, F.lit(0)))).first()[0] or 0)
