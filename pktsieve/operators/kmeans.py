"""Nearest-centre (k-means) compile (J2) and scoring.

Scoring is arithmetic on BIGINT inside one projection: per class the three
capped squared differences are summed, the nearest class is the first strict
minimum (ties go to the lowest class id), and for three classes the IPv4
identification is stamped from min_dist and delta. Centres join the packets
by ``model_id`` as one broadcast row per model after their entries are counted.
Models of three centres give ``d1, d2, d3``; any other number of centres gives one
array ``dist``, whatever the number. Without distances asked for, centres lie in
spatial blocks with a lower bound each, and blocks that cannot hold the nearest
one are skipped. The per-value distance table (C8) and its lookup form (C5) are
the second, table-driven path; both must agree.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import KM_CLASS_PORTS, KM_FEATURES, KM_VALUE_DOMAIN
from ..functions.arith import cap, delta_u32, sq, stamp_identification
from ..functions.features import features
from ..session import MAX_BROADCAST_ROWS, checkpointed
from ..sources.models import parse_km_lines, read_model_lines, require_centres
from .numbering import number_in_order
from .dtree_score import assign_port, class_port_table, finish, port_expr, with_model_id

# Centres of a block, whose bounding box gives the block's lower bound.
BLOCK_CENTRES = 32
ENTRY = "struct<d: bigint, class_id: int>"


def number_centres(centres: DataFrame) -> DataFrame:
    """Class id = position of the centre line in its file, from 1."""
    n = number_in_order(centres, "model_id", "line_no", "class_id", start=1)
    return n.select("model_id", "class_id", *KM_FEATURES)


@dataclass
class KMModel:
    centres: DataFrame  # model_id, class_id, frame_len, src_port, dst_port
    _cache: dict = field(default_factory=dict, repr=False)

    def k(self, model_id: str | None = None) -> int:
        """Largest number of classes over the models, or of one model (a tiny aggregate)."""
        key = ("k", model_id)
        if key not in self._cache:
            c = self.centres if model_id is None else self.centres.filter(F.col("model_id") == model_id)
            self._cache[key] = int(c.agg(F.max("class_id")).collect()[0][0] or 0)
        return self._cache[key]

    def all_of_three(self, model_id: str | None = None) -> bool:
        """Every model (or the given one) has exactly three centres."""
        key = ("three", model_id)
        if key not in self._cache:
            c = self.centres if model_id is None else self.centres.filter(F.col("model_id") == model_id)
            per = c.groupBy("model_id").agg(F.max("class_id").alias("k"))
            row = per.agg(F.min("k").alias("least"), F.max("k").alias("most")).first()
            self._cache[key] = row.least == row.most == 3
        return self._cache[key]

    def n_centres(self) -> int:
        if "n" not in self._cache:
            self._cache["n"] = self.centres.count()
        return self._cache["n"]

    def wide(self) -> DataFrame:
        """One row per model: the coordinates of its first three centres as columns c{class}_{feature}."""
        if "wide" not in self._cache:
            aggs = []
            for c in (1, 2, 3):
                for f in KM_FEATURES:
                    aggs.append(F.max(F.when(F.col("class_id") == c, F.col(f))).alias(f"c{c}_{f}"))
            self._cache["wide"] = self.centres.groupBy("model_id").agg(*aggs).transform(checkpointed)
        return self._cache["wide"]

    def blocks(self) -> DataFrame:
        """One row per model: ``k`` and ``blocks``, arrays of centres that lie near each other, with their bounding boxes.

        Centres are numbered along a curve through the cells of a 16 x 16 grid
        of the two ports (their bits interleaved) and cut every BLOCK_CENTRES.
        """
        if "blocks" not in self._cache:
            bit = lambda c, i: F.shiftright(F.greatest(F.lit(0), F.least(F.col(c), F.lit(65535))).cast("bigint"), 12 + i).bitwiseAND(F.lit(1))
            z = sum((bit("src_port", i) * (1 << (2 * i + 1)) + bit("dst_port", i) * (1 << (2 * i)) for i in range(4)), F.lit(0).cast("bigint"))
            placed = self.centres.withColumn("at", F.shiftleft(z, 32) + F.col("class_id"))
            numbered = number_in_order(placed, "model_id", "at", "i")
            centre = F.struct("class_id", *[F.col(f).cast("bigint").alias(f) for f in KM_FEATURES])
            boxes = [x for f in KM_FEATURES for x in (F.min(F.col(f).cast("bigint")).alias(f"lo_{f}"), F.max(F.col(f).cast("bigint")).alias(f"hi_{f}"))]
            per = numbered.groupBy("model_id", F.floor(F.col("i") / BLOCK_CENTRES).alias("b")).agg(*boxes, F.sort_array(F.collect_list(centre)).alias("centres"))
            names = [f"{s}_{f}" for f in KM_FEATURES for s in ("lo", "hi")]
            rows = per.groupBy("model_id").agg(
                F.sum(F.size("centres")).alias("k"), F.sort_array(F.collect_list(F.struct("b", *names, "centres"))).alias("blocks")
            )
            self._cache["blocks"] = checkpointed(rows)
        return self._cache["blocks"]

    def model_ids(self) -> DataFrame:
        """Distinct model ids (computed once per compiled model)."""
        if "ids" not in self._cache:
            self._cache["ids"] = self.centres.select("model_id").distinct().transform(checkpointed)
        return self._cache["ids"]

    def centre_arrays(self) -> DataFrame:
        """One row per model: ``centres`` ARRAY<STRUCT<class_id, frame_len, src_port, dst_port>>
        in class order (bounded by the model's k)."""
        if "arrays" not in self._cache:
            self._cache["arrays"] = self.centres.groupBy("model_id").agg(
                F.sort_array(F.collect_list(F.struct("class_id", *KM_FEATURES))).alias("centres")
            ).transform(checkpointed)
        return self._cache["arrays"]

    def distance_table(self) -> DataFrame:
        """C8, built once per compiled model and checkpointed."""
        if "distances" not in self._cache:
            self._cache["distances"] = build_distance_table(self).transform(checkpointed)
        return self._cache["distances"]


def compile_km_lines(lines: DataFrame, check: bool = True) -> KMModel:
    cents = parse_km_lines(lines)
    if check:
        require_centres(lines, cents)
        too_large = cents.filter(" OR ".join(f"{f} IS NULL" for f in KM_FEATURES)).limit(1).collect()
        if too_large:
            raise ValueError(f"model {too_large[0].model_id} line {too_large[0].line_no}: centre coordinate beyond 64 bits")
    return KMModel(number_centres(cents))


def compile_km(spark: SparkSession, path: str, check: bool = True) -> KMModel:
    """Compile k-means centre text file(s) at ``path``."""
    return compile_km_lines(read_model_lines(spark, path), check=check)


def model_counts(model: KMModel) -> DataFrame:
    """D6 for k-means: classes per model."""
    return model.centres.groupBy("model_id").agg(F.count(F.lit(1)).alias("n_classes"))


# --------------------------------------------------------------------------- B12-B16


def distances(df: DataFrame, model: KMModel) -> DataFrame:
    """The capped squared differences to every centre, summed.

    ``df`` needs model_id, frame_len, src_port, dst_port. Models of three
    centres give d1, d2, d3; any other number gives ``dist`` in class order.
    """
    if not model.all_of_three():
        return nearest_array(_with_arrays(df, model), F.col("centres")).select(*df.columns, "dist")
    # one row per model carrying 3 x 3 coordinates: check the coordinate count
    n = model.n_centres() * len(KM_FEATURES)
    j = df.join(F.broadcast(model.wide()) if n <= MAX_BROADCAST_ROWS else model.wide(), "model_id", "left")
    ds = []
    for c in (1, 2, 3):
        d = None
        for f in KM_FEATURES:
            centre = F.col(f"c{c}_{f}")
            term = F.when(centre.isNotNull(), cap(sq(f, centre)))  # the cap would turn NULL into a distance
            d = term if d is None else d + term
        ds.append(d.alias(f"d{c}"))
    return j.select(*df.columns, *ds)


def _with_arrays(df: DataFrame, model: KMModel) -> DataFrame:
    arr = model.centre_arrays()
    n = model.n_centres() * (len(KM_FEATURES) + 1)
    return df.join(F.broadcast(arr) if n <= MAX_BROADCAST_ROWS else arr, "model_id", "left")


def centres_of(model: KMModel, model_id: str) -> list[tuple[int, int, int]]:
    """The centres of one model, in class order."""
    key = ("centres", model_id)
    if key not in model._cache:
        rows = model.centres.filter(F.col("model_id") == model_id).orderBy("class_id").collect()
        if not rows:
            raise ValueError(f"model {model_id} not compiled")
        model._cache[key] = [tuple(int(r[f]) for f in KM_FEATURES) for r in rows]
    return model._cache[key]


def nearest_in_blocks(df: DataFrame, model: KMModel) -> DataFrame:
    """B12-B15 without listing distances: adds min_dist, class_id and, for models of three centres, delta.

    Blocks are gone through once. A block whose lower bound (the capped
    distance to its bounding box) is above the best distance so far is skipped;
    in the others the nearest centre is taken, ties to the lower class.
    """
    right = model.blocks()
    n = model.n_centres() * (len(KM_FEATURES) + 1)
    j = df.join(F.broadcast(right) if n <= MAX_BROADCAST_ROWS else right, "model_id", "left")

    def bound(b: F.Column) -> F.Column:
        out = F.lit(0).cast("bigint")
        for f in KM_FEATURES:
            x = F.col(f).cast("bigint")
            gap = F.greatest(b[f"lo_{f}"] - x, x - b[f"hi_{f}"], F.lit(0).cast("bigint"))
            out = out + cap(gap * gap)
        return out

    def distance(c: F.Column) -> F.Column:
        return sum((cap(sq(f, c[f])) for f in KM_FEATURES[1:]), cap(sq(KM_FEATURES[0], c[KM_FEATURES[0]])))

    def entry(c: F.Column) -> F.Column:
        return F.struct(distance(c).alias("d"), c["class_id"].cast("int").alias("class_id"))

    none = F.lit(None).cast(ENTRY)
    best = F.aggregate(
        "blocks", none,
        lambda acc, b: F.when(bound(b) > acc["d"], acc).otherwise(F.least(acc, F.array_min(F.transform(b["centres"], entry))).cast(ENTRY)),
    )
    # three centres: their distances in class order
    three = F.transform(F.col("blocks")[0]["centres"], distance)
    found = j.select(*df.columns, best.alias("best"), F.when(F.col("k") == 3, three).alias("three"))
    delta = F.when(F.col("three").isNotNull(), delta_u32(F.col("three")[2], F.least(F.col("three")[0], F.col("three")[1])))
    return found.select(*df.columns, F.col("best.d").alias("min_dist"), F.col("best.class_id").alias("class_id"), delta.alias("delta"))


def distances_inline(df: DataFrame, centres: list[tuple[int, int, int]]) -> DataFrame:
    """B12-B14 with the centre values as literals (one model)."""
    ds = []
    for c, centre in enumerate(centres, start=1):
        d = None
        for f, v in zip(KM_FEATURES, centre):
            term = cap(sq(f, F.lit(v)))
            d = term if d is None else d + term
        ds.append(d.alias(f"d{c}"))
    return df.select("*", *ds)


def nearest_array(df: DataFrame, centres: F.Column) -> DataFrame:
    """B12-B15 over an array of centres: ``dist`` in class order, min_dist and
    the nearest class (ties to the lower class: structs compare field by field)."""
    pairs = F.transform(
        centres,
        lambda c: F.struct(
            sum((cap(sq(f, c[f])) for f in KM_FEATURES[1:]), cap(sq(KM_FEATURES[0], c[KM_FEATURES[0]]))).alias("d"),
            c["class_id"].alias("class_id"),
        ),
    )
    m = F.array_min(pairs)
    return df.select(
        "*",
        F.transform(pairs, lambda x: x["d"]).alias("dist"),
        m["d"].alias("min_dist"),
        m["class_id"].cast("int").alias("class_id"),
    )


def nearest(df: DataFrame, k: int) -> DataFrame:
    """Min distance and class; a later class wins only if strictly nearer."""
    m = F.col("d1")
    cls = F.when(F.col("d1").isNotNull(), F.lit(1))
    for c in range(2, k + 1):
        d = F.col(f"d{c}")
        better = d.isNotNull() & (m.isNull() | (d < m))
        cls = F.when(better, F.lit(c)).otherwise(cls)
        m = F.when(better, d).otherwise(m)
    return df.select("*", m.alias("min_dist"), cls.cast("int").alias("class_id"))


def nearest_long(dist_long: DataFrame, keys: list[str]) -> DataFrame:
    """Arg-min in long form (keys, class_id, dist) -> keys, min_dist, class_id.

    min over struct(dist, class_id) orders by distance, then the lower class.
    """
    g = dist_long.groupBy(*keys).agg(F.min(F.struct("dist", "class_id")).alias("m"))
    return g.select(*keys, F.col("m.dist").alias("min_dist"), F.col("m.class_id").alias("class_id"))


def delta3() -> F.Column:
    """d3 - min(d1, d2) as unsigned 32-bit (the last delta the chain computes)."""
    return delta_u32("d3", F.least("d1", "d2"))


# --------------------------------------------------------------------------- C8 / C5


def build_distance_table(model: KMModel) -> DataFrame:
    """(model_id, feature, value, dist array<bigint>) for every 16-bit value.

    Each (model, feature) lists the value domain with a generator; the entries
    are the capped squared distances to every centre, in class order.
    """
    feats = F.array(*[F.struct(F.lit(f).alias("feature"), F.transform("centres", lambda c: c[f]).alias("at")) for f in KM_FEATURES])
    rows = model.centre_arrays().select("model_id", F.inline(feats)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(KM_VALUE_DOMAIN - 1))).alias("value")
    )
    dist = F.transform("at", lambda c: cap(sq(F.col("value"), c)))
    return rows.select("model_id", "feature", F.col("value").cast("int").alias("value"), dist.alias("dist"))


def lookup_distances(df: DataFrame, table: DataFrame, k: int, entries: int | None = None) -> DataFrame:
    """Three exact-match lookups (one per feature), distances summed into ``dist`` (class order).

    A missing entry adds nothing (the table default is no action). ``k`` is the
    largest number of classes; ``entries`` the table's values times classes, counted if not given.
    """
    size = table.count() * max(1, k) if entries is None else entries
    out = df
    for f in KM_FEATURES:
        t = table.filter(F.col("feature") == f).select("model_id", F.col("value").alias(f), F.col("dist").alias(f"__dist_{f}"))
        right = F.broadcast(t) if size <= MAX_BROADCAST_ROWS else t
        out = out.join(right, ["model_id", f], "left")
    none = F.expr("cast(array() as array<bigint>)")
    nought = F.lit(0).cast("bigint")
    if k <= 3:  # plain columns instead of a function over arrays
        one = lambda c: sum((F.coalesce(F.get(f"__dist_{f}", F.lit(c)), nought) for f in KM_FEATURES), nought)
        held = F.greatest(*[F.coalesce(F.size(f"__dist_{f}"), F.lit(0)) for f in KM_FEATURES], F.lit(0))
        return out.select(*df.columns, F.slice(F.array(*[one(c) for c in range(k)]), F.lit(1), held).alias("dist"))
    total = none
    for f in KM_FEATURES:
        total = F.zip_with(total, F.coalesce(f"__dist_{f}", none), lambda a, b: F.coalesce(a, nought) + F.coalesce(b, nought))
    return out.select(*df.columns, total.alias("dist"))


# --------------------------------------------------------------------------- J4


def score_km(
    packets: DataFrame,
    model: KMModel,
    model_id: str | None = None,
    ports: DataFrame | None = None,
    method: str = "arith",
    distance_table: DataFrame | None = None,
    keep: list[str] | None = None,
    distances_too: bool = True,
) -> DataFrame:
    """Score and route flat packets with nearest-centre models.

    Output: pkt_id, class_id, egress_port, outcome, min_dist, delta and
    ipv4_identification (stamped on IPv4 packets whose own model has three
    centres, never on bypass; delta is NULL for other models), and the
    distances: d1, d2, d3 if every model asked for has three centres, else the
    array ``dist`` - for any number of centres. ``method="lookup"`` takes distances from
    the C8 table. With ``distances_too=False`` no distances are returned, and
    blocks of centres that are too far away are skipped.
    """
    own = None if model_id is None else str(model_id)
    three = model.all_of_three(own)
    f = features(packets, keep=(keep or []) + (["model_id"] if "model_id" in packets.columns and model_id is None else []))
    if three and distances_too and model_id is not None and ports is None and method == "arith":
        n = nearest(distances_inline(f, centres_of(model, own)), 3)
        p = n.select("*", delta3().alias("delta"), port_expr("class_id", KM_CLASS_PORTS).alias("egress_port"))
        return _finish_km(p, ["d1", "d2", "d3"], keep)
    ports = class_port_table(model.model_ids(), KM_CLASS_PORTS) if ports is None else ports
    f = with_model_id(f, model_id)
    if not distances_too:
        return _finish_km(assign_port(nearest_in_blocks(f, model), ports), [], keep)
    if method == "lookup":
        table = model.distance_table() if distance_table is None else distance_table
        entries = model.n_centres() * len(KM_FEATURES) * KM_VALUE_DOMAIN if distance_table is None else None
        d = lookup_distances(f, table, model.k(), entries)
    elif model.all_of_three():
        d = distances(f, model)
    else:
        d = nearest_array(_with_arrays(f, model), F.col("centres")).select(*f.columns, "dist")
    if model.all_of_three():
        if method == "lookup":
            d = d.select(*f.columns, *[F.get("dist", F.lit(c)).alias(f"d{c + 1}") for c in range(3)])
        n = nearest(d, 3)
        return _finish_km(assign_port(n.select("*", delta3().alias("delta")), ports), ["d1", "d2", "d3"], keep)
    pairs = F.transform("dist", lambda x, i: F.struct(x.alias("d"), (i + 1).cast("int").alias("class_id")))
    n = d.select("*", F.array_min(pairs).alias("best"), *[F.get("dist", F.lit(c)).alias(f"d{c + 1}") for c in range(3)])
    n = n.select("*", F.col("best.d").alias("min_dist"), F.col("best.class_id").alias("class_id"), F.when(F.size("dist") == 3, delta3()).alias("delta"))
    return _finish_km(assign_port(n, ports), ["d1", "d2", "d3"] if three else ["dist"], keep)


def _finish_km(p: DataFrame, dcols: list[str], keep: list[str] | None) -> DataFrame:
    """Bypass, outcome and the stamp (B17): where there is a delta (three centres), on IPv4, never on bypass."""
    cols = ["pkt_id", "ingress_port", "ipv4_identification", "class_id", "egress_port", *dcols, "min_dist", "delta"]
    cols += [c for c in dict.fromkeys(keep or []) if c not in cols]
    res = finish(p.select(*cols), ["class_id", *dcols, "min_dist", "delta"])
    byp = F.col("outcome") == "bypass"
    ident = F.when(
        F.col("ipv4_identification").isNotNull() & F.col("delta").isNotNull() & ~byp,
        stamp_identification("ipv4_identification", "min_dist", "delta"),
    ).otherwise(F.col("ipv4_identification"))
    res = res.withColumn("ipv4_identification", ident.cast("int"))
    return res if "ingress_port" in (keep or []) else res.drop("ingress_port")
