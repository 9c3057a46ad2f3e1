"""Decision-tree scoring (J3) and the direct rule check.

Packet path, per row and without a shuffle:
features -> 5 bin ids (C1) -> mixed-radix cell -> class (C9 lookup, or C2
rule-range match when the cell table would be too large) -> port (C4) ->
outcome. Model tables are joined by ``model_id`` (equi keys), so one pass can
score packets of many models; each model table is broadcast only after its
size is checked, otherwise the join shuffles on its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DT_CLASS_PORTS, DT_FEATURES
from ..functions.features import bypass_port, features, is_bypass
from ..session import MAX_BROADCAST_ROWS, checkpointed
from .box_index import BoxIndex
from .box_index import build as build_index
from .dtree_compile import MAX_CELL_PAIRS, N_FEATURES, DTModel, known_predicates, predicates, raw_boxes, rule_lines
from .intervals import expand_blocks, locate

# Above this many edges per feature and model, bins are found by a join
# instead of a scan of the edge array.
MAX_EDGES_EXPR = 256


def _maybe_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= MAX_BROADCAST_ROWS else df


def with_model_id(df: DataFrame, model_id: str | None) -> DataFrame:
    if model_id is not None:
        return df.withColumn("model_id", F.lit(str(model_id)))
    if "model_id" not in df.columns:
        raise ValueError("packets need a model_id column or an explicit model_id")
    return df


def class_port_table(models: DataFrame, mapping: dict[int, int] | None = None) -> DataFrame:
    """The class -> egress port map for every model: (model_id, class_id, egress_port)."""
    mapping = DT_CLASS_PORTS if mapping is None else mapping
    pairs = F.array(*[F.struct(F.lit(c).alias("class_id"), F.lit(p).alias("egress_port")) for c, p in sorted(mapping.items())])
    return models.select("model_id", F.inline(pairs))


def check_ports(rules: DataFrame, ports: DataFrame, class_col: str = "class") -> None:
    """Every class a rule can emit needs a port (compile error naming the rule)."""
    bad = (
        rules.join(ports.withColumnRenamed("class_id", class_col), ["model_id", class_col], "left_anti")
        .limit(1)
        .collect()
    )
    if bad:
        r = bad[0]
        raise ValueError(f"model {r.model_id} rule {r.rule_id}: class {r[class_col]} has no egress port")


# --------------------------------------------------------------------------- C1


def bin_expr(value: str, uppers: str) -> F.Column:
    """Bin id = number of upper edges strictly below the value."""
    return F.aggregate(F.col(uppers), F.lit(0), lambda acc, t: acc + F.when(F.col(value) > t, 1).otherwise(0))


def discretise(df: DataFrame, model: DTModel, vectors: DataFrame | None = None) -> DataFrame:
    """C1, expression form: one broadcast row per model, ids by array scan.

    Adds ``id0..id4`` and the model's strides ``s0..s4``.
    """
    vec = model.vectors() if vectors is None else vectors
    # one row per model, but each row carries every edge: check the edge count
    j = df.join(_maybe_broadcast(vec, rows=model.n_bins()), "model_id", "left")
    ids = [bin_expr(f, f"u{i}").cast("int").alias(f"id{i}") for i, f in enumerate(DT_FEATURES)]
    keep = [c for c in df.columns]
    return j.select(*keep, *ids, *[f"s{i}" for i in range(N_FEATURES)])


def discretise_join(df: DataFrame, model: DTModel) -> DataFrame:
    """C1, join form: each feature value joins the bin holding it.

    Five block equi-joins against the bin table (see ``intervals.locate``);
    used when a model has too many edges for the array scan.
    """
    keys = ["model_id", "feature"]
    bins = model.bins
    if "blocks" not in model._cache:
        exp = expand_blocks(bins, keys, "lo", "hi", ["bin_id"]).transform(checkpointed)
        model._cache["blocks"] = (exp, exp.count())
    exp, n_blocks = model._cache["blocks"]
    bc = n_blocks <= MAX_BROADCAST_ROWS
    out = df
    for i, f in enumerate(DT_FEATURES):
        out = out.withColumn("feature", F.lit(f))
        out = locate(out, bins, keys, f, {"bin_id": f"id{i}"}, expanded=exp, broadcast=bc).drop("feature")
    rad = model.radix().select("model_id", *[f"s{i}" for i in range(N_FEATURES)])
    return out.join(_maybe_broadcast(rad, rows=model.n_models()), "model_id", "left")


def cell_id() -> F.Column:
    c = F.lit(0).cast("bigint")
    for i in range(N_FEATURES):
        c = c + F.col(f"id{i}").cast("bigint") * F.col(f"s{i}")
    return c


# --------------------------------------------------------------------------- C2 / C9


def match_cells(df: DataFrame, model: DTModel) -> DataFrame:
    """C9 lookup: (model_id, cell) equi-join to the flat cell table -> rule_id, class_id."""
    cells = model.cells().select("model_id", "cell", "rule_id", F.col("class").alias("class_id"))
    pairs = model.cell_pairs()
    right = F.broadcast(cells) if pairs <= MAX_BROADCAST_ROWS else cells
    return df.withColumn("cell", cell_id()).join(right, ["model_id", "cell"], "left").drop("cell")


BITS = 63  # rule bits per word; bit 63 stays clear so masks never go negative


def rule_masks(model: DTModel) -> DataFrame:
    """Per (model, feature, bin, word): the bitmask of rules whose range holds the bin.

    Each rule lists the bins of its five ranges (a generator over its own
    ranges) and sets bit ``rule_id % 63`` of word ``rule_id / 63``.
    """
    r = model.rules.select(
        "model_id", "rule_id", F.posexplode(F.arrays_zip("id_start", "id_end")).alias("fpos", "rng")
    )
    e = r.select(
        "model_id", "rule_id", "fpos", F.explode(F.sequence("rng.id_start", "rng.id_end")).alias("bin_id")
    )
    return e.groupBy(
        "model_id", "fpos", "bin_id", F.floor(F.col("rule_id") / BITS).cast("int").alias("word")
    ).agg(F.bit_or(F.expr(f"shiftleft(CAST(1 AS BIGINT), CAST(rule_id % {BITS} AS INT))")).alias("mask"))


def mask_table(model: DTModel, words: int) -> DataFrame:
    """(model_id, fpos, bin_id, words ARRAY<BIGINT>): dense, one row per bin."""
    m = rule_masks(model)
    per_bin = model.bins.select("model_id", "fpos", "bin_id").join(m, ["model_id", "fpos", "bin_id"], "left")
    return per_bin.groupBy("model_id", "fpos", "bin_id").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("mm")
    ).select(
        "model_id", "fpos", "bin_id",
        F.transform(
            F.sequence(F.lit(0), F.lit(words - 1)),
            lambda w: F.coalesce(F.try_element_at(F.col("mm"), w), F.lit(0).cast("bigint")),
        ).alias("words"),
    )


def _ctz(m: F.Column) -> F.Column:
    """Trailing zero count of a positive BIGINT: bits set below its lowest set bit."""
    return F.bit_count(m.bitwiseAND(-m) - F.lit(1))


def match_rules(df: DataFrame, model: DTModel) -> DataFrame:
    """First rule (lowest rule_id) whose 5 id ranges all hold the packet's ids.

    Bit-vector form of the 5-way interval match: per feature, the packet's
    bin id picks (equi-join on model_id, bin id) the bitmask of rules whose
    range holds that bin; the AND over the five features is the set of
    matching rules and its lowest set bit the first one. The mask table
    (bins x words entries) is broadcast after its size check, otherwise the
    five joins shuffle; no theta join either way.
    """
    most, total = model.rule_stats()
    words = max(1, -(-most // BITS))
    key = ("masks", words)
    if key not in model._cache:
        model._cache[key] = mask_table(model, words).transform(checkpointed)
    mt = model._cache[key]
    bc = model.n_bins() * words <= MAX_BROADCAST_ROWS
    out = df
    for i in range(N_FEATURES):
        t = mt.filter(F.col("fpos") == i).select("model_id", F.col("bin_id").alias(f"id{i}"), F.col("words").alias(f"__w{i}"))
        out = out.join(F.broadcast(t) if bc else t, ["model_id", f"id{i}"], "left")
    hit_words = []
    for w in range(words):
        m = None
        for i in range(N_FEATURES):
            x = F.try_element_at(F.col(f"__w{i}"), F.lit(w + 1))
            m = x if m is None else m.bitwiseAND(x)
        hit_words.append(F.coalesce(m, F.lit(0).cast("bigint")))
    rule = None
    for w, m in enumerate(hit_words):
        idx = F.lit(w * BITS) + _ctz(m)
        rule = F.when(m != 0, idx) if rule is None else rule.when(m != 0, idx)
    hit = out.select(*df.columns, rule.cast("int").alias("rule_id"))
    classes = model.rules.select("model_id", "rule_id", F.col("class").cast("int").alias("class_id"))
    right = F.broadcast(classes) if total <= MAX_BROADCAST_ROWS else classes
    return hit.join(right, ["model_id", "rule_id"], "left")


# --------------------------------------------------------------------------- single model, inlined

# A single model's compiled tables are folded into the expression when they
# are at most this many entries (cells, or bins x words of masks): constants
# travel with every task, so they stay small; larger tables are broadcast.
MAX_INLINE = 1 << 16


def inline_fits(model: DTModel, model_id: str) -> tuple[str, ...]:
    """The inlined forms, 'cells' before 'ranges', that one model is small enough for.

    Edges become one comparison each, so at most MAX_EDGES_EXPR per feature;
    the cell array or the rule masks must fit MAX_INLINE entries.
    """
    key = ("inline_fits", model_id)
    if key not in model._cache:
        per = (
            model.bins.filter(F.col("model_id") == model_id)
            .groupBy("fpos").count()
            .agg(F.max("count").alias("widest"), F.sum("count").alias("bins"), F.product("count").alias("cells"))
            .collect()[0]
        )
        most = model.rules.filter(F.col("model_id") == model_id).count()
        words = max(1, -(-most // BITS))
        fits = []
        if per.widest is not None and per.widest <= MAX_EDGES_EXPR:
            if per.cells <= MAX_INLINE and model.cell_pairs(model_id) <= MAX_CELL_PAIRS:
                fits.append("cells")
            if per.bins * words <= MAX_INLINE:
                fits.append("ranges")
        model._cache[key] = tuple(fits)
    return model._cache[key]


class InlineDT:
    """One compiled tree as Python values, for literal (constant) expressions.

    Built from the compiled DataFrames of one model after a size check; the
    tables are bounded by the model (edges by the feature domain, cells by
    the product of bin counts), never by the packet data.
    """

    def __init__(self, model: DTModel, model_id: str, method: str = "auto"):
        vec = model.vectors().filter(F.col("model_id") == model_id).collect()
        if not vec:
            raise ValueError(f"model {model_id} not compiled")
        v = vec[0]
        self.uppers = [list(v[f"u{i}"]) for i in range(N_FEATURES)]
        self.strides = [int(v[f"s{i}"]) for i in range(N_FEATURES)]
        n_cells = 1
        for u in self.uppers:
            n_cells *= len(u)
        if method == "auto":
            method = "cells" if n_cells <= MAX_INLINE and model.cell_pairs(model_id) <= MAX_CELL_PAIRS else "ranges"
        self.method = method
        one = DTModel(model.bins.filter(F.col("model_id") == model_id), model.rules.filter(F.col("model_id") == model_id))
        if method == "cells":
            if n_cells > MAX_INLINE:
                raise ValueError("cell table too large to inline")
            rule_of = [None] * n_cells
            class_of = [None] * n_cells
            for r in one.cells().select("cell", "rule_id", "class").collect():
                rule_of[r.cell] = r.rule_id
                class_of[r.cell] = r["class"]
            self.rule_of, self.class_of = rule_of, class_of
        else:
            rules = one.rules.select("rule_id", "class", "id_start", "id_end").orderBy("rule_id").collect()
            self.words = max(1, -(-len(rules) // BITS))
            if sum(len(u) for u in self.uppers) * self.words > MAX_INLINE:
                raise ValueError("rule masks too large to inline")
            self.rule_class = [r["class"] for r in rules]
            self.masks = [[[0] * self.words for _ in u] for u in self.uppers]
            for r in rules:
                w, bit = divmod(r.rule_id, BITS)
                for i in range(N_FEATURES):
                    for b in range(r.id_start[i], r.id_end[i] + 1):
                        self.masks[i][b][w] |= 1 << bit

    def ids(self) -> list[F.Column]:
        """C1 with literal edges: id = number of edges strictly below the value."""
        out = []
        for i, f in enumerate(DT_FEATURES):
            c = F.lit(0)
            for t in self.uppers[i][:-1]:  # the last edge is the domain maximum
                c = c + (F.col(f) > F.lit(t)).cast("int")
            out.append(c.cast("int").alias(f"id{i}"))
        return out

    def match(self) -> tuple[F.Column, F.Column]:
        """(rule_id, class_id) from the ids columns."""
        if self.method == "cells":
            cell = F.lit(0)
            for i in range(N_FEATURES):
                cell = cell + F.col(f"id{i}") * F.lit(self.strides[i])
            idx = cell + 1
            rule = F.try_element_at(array_literal(self.rule_of), idx)
            klass = F.try_element_at(array_literal(self.class_of), idx)
            return rule, klass
        hit_words = []
        for w in range(self.words):
            m = None
            for i in range(N_FEATURES):
                arr = array_literal([b[w] for b in self.masks[i]], "BIGINT")
                x = F.try_element_at(arr, F.col(f"id{i}") + 1)
                m = x if m is None else m.bitwiseAND(x)
            hit_words.append(F.coalesce(m, F.lit(0).cast("bigint")))
        rule = None
        for w, m in enumerate(hit_words):
            idx = F.lit(w * BITS) + _ctz(m)
            rule = F.when(m != 0, idx) if rule is None else rule.when(m != 0, idx)
        rule = rule.cast("int")
        klass = F.try_element_at(array_literal(self.rule_class), rule + 1)
        return rule, klass


def inline_dt(model: DTModel, model_id: str, method: str = "auto") -> InlineDT:
    """The inlined form of one model, built once per compiled model."""
    key = ("inline", model_id, method)
    if key not in model._cache:
        model._cache[key] = InlineDT(model, model_id, method)
    return model._cache[key]


def array_literal(values: list, sql_type: str = "INT") -> F.Column:
    """A constant array as one SQL expression (NULL for None)."""
    items = ", ".join("NULL" if v is None else str(int(v)) for v in values)
    return F.expr(f"CAST(array({items}) AS ARRAY<{sql_type}>)")


def port_expr(class_col: str, mapping: dict[int, int]) -> F.Column:
    """C4 with a literal class -> port map; no entry gives NULL (drop)."""
    c = None
    for k, p in sorted(mapping.items()):
        c = F.when(F.col(class_col) == k, F.lit(p)) if c is None else c.when(F.col(class_col) == k, F.lit(p))
    return c.cast("int")


def score_dt_inline(
    packets: DataFrame, model: DTModel, model_id: str, mapping: dict[int, int], method: str = "auto",
    keep: list[str] | None = None,
) -> DataFrame:
    """J3 for one model: a single projection over the scan (no join, no shuffle)."""
    inl = inline_dt(model, model_id, method)
    missing = {c for c in (inl.class_of if inl.method == "cells" else inl.rule_class) if c is not None} - set(mapping)
    if missing:
        raise ValueError(f"model {model_id}: classes {sorted(missing)} have no egress port")
    f = features(packets, keep=keep)
    d = f.select("*", *inl.ids())
    rule, klass = inl.match()
    m = d.select("*", rule.alias("rule_id"), klass.alias("class_id"))
    p = m.select("*", port_expr("class_id", mapping).alias("egress_port"))
    base = ["pkt_id", "ingress_port", "rule_id", "class_id", "egress_port"]
    out = p.select(*base, *[c for c in dict.fromkeys(keep or []) if c not in base])
    res = finish(out, ["rule_id", "class_id"])
    return res if "ingress_port" in (keep or []) else res.drop("ingress_port")


# --------------------------------------------------------------------------- C3 / C4 / J3


def assign_port(df: DataFrame, ports: DataFrame) -> DataFrame:
    """C4 + C3: class -> egress port by broadcast equi-join; no class or no port = NULL (drop)."""
    return df.join(_maybe_broadcast(ports), ["model_id", "class_id"], "left")


def finish(df: DataFrame, model_cols: list[str]) -> DataFrame:
    """B7 + outcome: bypass first (model columns NULL), then forward or drop."""
    byp = F.coalesce(is_bypass(), F.lit(False))  # a NULL ingress port is no bypass
    cols = []
    for c in df.columns:
        if c in model_cols:
            cols.append(F.when(~byp, F.col(c)).alias(c))
        elif c == "egress_port":
            cols.append(F.when(byp, bypass_port()).otherwise(F.col(c)).cast("int").alias(c))
        else:
            cols.append(F.col(c))
    outcome = F.when(byp, F.lit("bypass")).when(F.col("egress_port").isNotNull(), F.lit("forward")).otherwise(F.lit("drop"))
    return df.select(*cols, outcome.alias("outcome"))


def score_dt(
    packets: DataFrame,
    model: DTModel,
    model_id: str | None = None,
    ports: DataFrame | None = None,
    method: str = "auto",
    discretise_by: str = "auto",
    keep: list[str] | None = None,
    check: bool = True,
) -> DataFrame:
    """Score and route flat packets with compiled decision trees.

    Output: pkt_id, rule_id, class_id, egress_port, outcome (+ ``keep``).
    With ``model_id`` given (one model), the compiled tables are folded into
    the projection: one narrow stage, no join. With a ``model_id`` column
    (many models), or a model too large to fold, the first-match index is joined
    by ``model_id``, one row per model (``method="index"``). ``"cells"`` and ``"ranges"`` are
    the table forms: bins, then the flat cell table or the rule masks, joined by
    equi keys - broadcast after their size check, shuffle joins beyond it.
    """
    if model_id is not None and ports is None and discretise_by in ("auto", "expr"):
        fits = [m for m in inline_fits(model, str(model_id)) if method in ("auto", m)]
        if fits:
            return score_dt_inline(packets, model, str(model_id), DT_CLASS_PORTS, method=fits[0], keep=keep)
        # too large to fold: the join path, whose bins (if it needs any) come
        # from the block join, as a literal model_id folds away as a join key
        discretise_by = "join"
    ports = class_port_table(model.model_ids()) if ports is None else ports
    if check:
        check_ports(model.rules, ports)
    f = with_model_id(features(packets, keep=(keep or []) + (["model_id"] if "model_id" in packets.columns else [])), model_id)
    if method in ("auto", "index"):
        return _routed(model.index().match(f), ports, keep)
    if discretise_by == "auto":
        widest = model.bins.groupBy("model_id", "feature").count().agg(F.max("count")).collect()[0][0] or 0
        discretise_by = "expr" if widest <= MAX_EDGES_EXPR else "join"
    d = discretise(f, model) if discretise_by == "expr" else discretise_join(f, model)
    return _routed(match_cells(d, model) if method == "cells" else match_rules(d, model), ports, keep)


def _routed(matched: DataFrame, ports: DataFrame, keep: list[str] | None) -> DataFrame:
    """C4, C3 and B7 for packets with their rule and class."""
    p = assign_port(matched, ports)
    base = ["pkt_id", "ingress_port", "rule_id", "class_id", "egress_port"]
    out = p.select(*base, *[c for c in dict.fromkeys(keep or []) if c not in base])
    res = finish(out, ["rule_id", "class_id"])
    return res if "ingress_port" in (keep or []) else res.drop("ingress_port")


# --------------------------------------------------------------------------- J6


def rule_conditions(spark: SparkSession, lines: DataFrame, model_id: str) -> list[tuple[int, str, int]]:
    """The rules of one model as SQL conditions on raw feature values.

    Collects the predicates of one model (bounded by the model text) so the
    rule list can be written as one CASE. Output (rule_no, condition, class).
    Long rule lists, and many models, are evaluated through ``rules_index`` instead.
    """
    from ..sources.models import parse_dt_lines

    rules = rule_lines(parse_dt_lines(lines.filter(F.col("model_id") == model_id)))
    keys = ["line_no", "class"]
    preds = known_predicates(spark, predicates(rules, keys))
    rows = preds.select("line_no", "class", "feature", "op", "value").collect()
    line_order = sorted({r.line_no for r in rules.select("line_no").collect()})
    classes = {r.line_no: r["class"] for r in rules.select("line_no", "class").collect()}
    by_line: dict[int, list[str]] = {ln: [] for ln in line_order}
    for r in rows:
        by_line[r.line_no].append(f"{r.feature} {r.op} {float(r.value)!r}")
    return [(i, " AND ".join(by_line[ln]) or "TRUE", int(classes[ln])) for i, ln in enumerate(line_order)]


def rules_index(spark: SparkSession, preds: DataFrame, rules: DataFrame) -> BoxIndex:
    """J6 for rule lists of any length and any number of models: an index of the rules' own conditions.

    ``preds`` is (model_id, rule_id, feature, op, value), ``rules`` (model_id, rule_id, class).
    """
    keys = ["model_id", "rule_id", "class"]
    with_class = preds.join(rules.select(*keys), ["model_id", "rule_id"])
    return build_index(raw_boxes(spark, with_class, keys, rules), rules.select("model_id").distinct())


def eval_rules(df: DataFrame, conditions: list[tuple[int, str, int]]) -> DataFrame:
    """The rule text evaluated directly on raw features (first true rule).

    Adds ``rule_id`` and ``class_id``; the independent check of J3.
    """
    rid = None
    cls = None
    for rule_no, cond, klass in conditions:
        c = F.expr(cond)
        rid = F.when(c, F.lit(rule_no)) if rid is None else rid.when(c, F.lit(rule_no))
        cls = F.when(c, F.lit(klass)) if cls is None else cls.when(c, F.lit(klass))
    if rid is None:
        rid = cls = F.lit(None)
    return df.select("*", rid.cast("int").alias("rule_id"), cls.cast("int").alias("class_id"))
