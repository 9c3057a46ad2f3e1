"""Similarity join of documents on word shingles, exact at a Jaccard threshold.

Index. A document's set of shingles is sorted by hash value and cut at fixed
values into blocks, so a block is a stretch of positions. Two sets of sizes a
and b that link differ in at most (a + b) / 19 elements (at 0.9; (a + b) / 9 at
0.8), so if there are more blocks than that they agree in at least one whole block: the index
list of a block's content skips everything else at that position. Sizes are
dealt to classes, and a set also enters the next class if it is large enough
to link there, so lists hold sets of comparable size only. Blocks that are
empty tell nothing; spare blocks make up for them, and the few sets with more
empty blocks than that are indexed again under another order. Classes of small
sets, in which no number of blocks leaves enough of them filled, are listed by
single shingles instead: the shingles of a set are ordered by how many sets hold
them, rarest first, and two sets that link share one of the first
``size - least overlap + 1`` of both.

Bounds. Sets that share a list are compared by parity bitmaps of their shingles: the
bits in which two bitmaps differ are at most the elements in which the sets
differ, so pairs that differ in more bits than linked sets may are skipped. What
is left makes the candidate clusters. Pairs of short lists are told once, however
many lists they share. A list of more than ``LONG`` sets is a star
around its smallest set instead, which skips nothing and loses nothing.

Answers. In a cluster, sets are ranked by size and every shingle's list holds
ranks in ascending order. A set's overlaps are counted over the stretch of each
list whose ranks it can still link with; the rest of the list is skipped by
position. A set linked to one whose overlaps are known (its leader) derives its
own from them: the lists of the shingles that only it has are added, those of the
shingles that only the leader has are taken off. Before that, the triangle
inequality of the Jaccard distance tells whether any set is left that it can
link with. Only links that join components are emitted, so the output is linear
in the sets. Large clusters are cut into blocks of sets, and every pair of blocks
is looked at in a task of its own.

Equal sets are one class before anything is compared, so copies cost nothing.
Sets are held as 64-bit shingle hashes.

Defined results: a null text or one without words has an empty set, links with
nothing and is its own component; rows with a null id link with nothing and
have a null component; rows that share an id are told
apart by their texts, rows that repeat are one set; an
empty table gives no rows; extra columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, connected_components, give_back, giving_back, groups_for, small, text_or_empty
from .hashing import mixed, shingle_set

LEVELS = 3  # orders under which a set with too many empty blocks is indexed again
BLOCK_SETS = 2_048  # sets and shingles of a block of a large cluster
BLOCK_SHINGLES = 1_000_000
GROUP_SETS = 2_000  # sets of small clusters handled in one group
ROWS = 1_000  # rows whose index lists a task holds
SHORT = 8  # sets of a list whose pairs are listed
LONG = 10_000  # sets of a list that are compared by their bitmaps
LIST_ROWS = 50_000  # list entries compared in one group
BITS = 16_384  # bits of a bitmap at most
LOOSE = -1  # the class of sets that are listed by shingles


class Threshold:
    """Links need ``100 * intersection >= percent * union``."""

    def __init__(self, percent: int):
        self.percent = percent
        self._shapes: dict[int, tuple[int, int]] = {}
        self.bounds = [1]
        while self.bounds[-1] < 1 << 40:
            self.bounds.append(max(self.bounds[-1] + 1, -(-self.bounds[-1] * 3 // 2)))

    def links(self, both, union):
        return 100 * both >= self.percent * union

    def most_apart(self, larger: int) -> int:
        """Elements in which two linked sets of at most this size can differ."""
        return 2 * larger * (100 - self.percent) // (100 + self.percent)

    def prefix(self, size: int) -> int:
        """How many of a set's shingles, in an order common to all sets, hold one that any linked set's first hold too."""
        return size + (-self.percent * size) // 100 + 1

    def _shape(self, k: int) -> tuple[int, int]:
        """Blocks and spare blocks of a class; (0, 0) if no number of blocks will do, (0, -1) if only equal sets link."""
        if k not in self._shapes:
            apart = self.most_apart(self.bounds[k + 1] - 1)
            # the smallest sets of the class leave more blocks empty, the lower the threshold
            least = max(1, -(-self.percent * self.bounds[k] // 100))
            shape = (0, 0) if apart else (0, -1)
            for n in range(apart + 2 + apart // 50, 2 * apart + 8) if apart else ():
                empty = n * (1 - 1 / n) ** least
                if n - apart - 1 >= empty + 2 * empty**0.5:
                    shape = n, n - apart - 1
                    break
            self._shapes[k] = shape
        return self._shapes[k]

    def classes(self, size: int) -> list[tuple[int, int, int]]:
        """(class, blocks, spare blocks) that a set of this size is indexed in; 0 blocks: it is listed by shingles."""
        c = int(np.searchsorted(self.bounds, size, side="right")) - 1
        found = [c]
        if 100 * size >= self.percent * self.bounds[c + 1]:
            found.append(c + 1)
        # in a class whose shape has -1 only equal sets link, which are one before anything is compared
        return [(k, *self._shape(k)) for k in found if self._shape(k)[1] >= 0]


def _blocks(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sizes of the n blocks of sorted values."""
    edges = (np.arange(1, n, dtype=np.float64) * (2.0**64 / n)).astype(np.uint64)
    at = np.concatenate(([0], np.searchsorted(values, edges), [len(values)]))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mixed(values ^ np.uint64(0x5851F42D4C957F2D)))))
    return sums[at[1:]] - sums[at[:-1]], np.diff(at)


def signatures(s: np.ndarray, threshold: Threshold) -> list[tuple[int, np.ndarray]]:
    """Keys of the index lists that a set of sorted hashes is in, by class."""
    found = []
    for k, n, spare in threshold.classes(len(s)):
        if not n:
            continue
        out = []
        for level in range(LEVELS):
            values = s if level == 0 else np.sort(mixed(s + np.uint64(level)))
            sums, sizes = _blocks(values, n)
            full = sizes > 0
            last = level == LEVELS - 1
            salt = mixed(np.arange(n, dtype=np.uint64) + np.uint64((k * LEVELS + level) << 40))
            keys = mixed(sums ^ salt)
            if (~full).sum() <= spare:
                out.append(keys[full])
                break
            out.append(keys if last else keys[full])
        found.append((k, np.concatenate(out)))
    return found


def bitmap(s: np.ndarray, threshold: Threshold, k: int) -> bytes:
    """Parity of the shingles that fall on each bit, as many bits as the largest set of the class (``BITS`` at most)."""
    bits = 128 if k == LOOSE else min(BITS, -(-threshold.bounds[k + 1] // 64) * 64)
    odd = np.bincount((mixed(s ^ np.uint64(0x8EBC6AF09C88C6E3)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def indexed(docs: DataFrame, key: str, text: str, threshold: Threshold, width: int) -> DataFrame:
    """``(id, n, h1, h2, lists, loose, th)`` per row.

    Set size, content hash, index lists and bitmap by class, the shingles of a
    set that is listed by them, and the text's hash.
    """

    @giving_back
    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in (f.iloc[i : i + ROWS] for f in frames for i in range(0, len(f), ROWS)):
            rows = []
            for doc, body in zip(frame["id"], frame["text"]):
                s = shingle_set(body, width)
                h1 = mixed(s).sum(dtype=np.uint64)
                h2 = mixed(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
                lists = [
                    {"k": k, "sigs": x.view(np.int64), "bits": bitmap(s, threshold, k)} for k, x in signatures(s, threshold)
                ] if len(s) else []
                loose = s if len(s) and any(not n for _, n, _ in threshold.classes(len(s))) else s[:0]
                if len(loose):
                    lists.append({"k": LOOSE, "sigs": loose[:0].view(np.int64), "bits": bitmap(s, threshold, LOOSE)})
                rows.append((doc, len(s), int(h1.astype(np.int64)), int(h2.astype(np.int64)), lists, loose.view(np.int64)))
            out = pd.DataFrame(rows, columns=["id", "n", "h1", "h2", "lists", "loose"])
            out["th"] = frame["th"].to_numpy()
            out["id"] = frame["id"].to_numpy()
            yield out

    body = text_or_empty(text)
    plain = docs.select(F.col(key).cast("string").alias("id"), body.alias("text"), F.xxhash64(body).alias("th"))
    lists = "lists array<struct<k: int, sigs: array<long>, bits: binary>>"
    out = plain.mapInPandas(build, f"id string, n long, h1 long, h2 long, {lists}, loose array<long>, th long")
    return out.withColumn("id", F.col("id").cast("long"))


def rare_first(sets: DataFrame, threshold: Threshold) -> DataFrame:
    """``(sig, node)``: the index lists of the sets that are listed by single shingles.

    ``sets`` holds ``(node, n, loose)``. A shingle that one set alone holds
    lists nothing, but takes one of the first places of its set.
    """
    p = threshold.percent
    held = sets.where(F.size("loose") > 0).select("node", "n", F.explode("loose").alias("sh"))
    often = held.groupBy("sh").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = held.join(often, "sh").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sh"))).alias("s"))
    first = F.expr(f"n - cast(ceil({p} * n / 100) as int) + 1 - (n - size(s))").cast("int")
    lists = shared.select("node", F.explode(F.slice("s", F.lit(1), F.greatest(first, F.lit(0)))).alias("x"))
    return lists.select(F.xxhash64(F.lit(9), "x.sh").alias("sig"), "node", F.lit(LOOSE).alias("k"))


def _near(one: np.ndarray, other: np.ndarray, sizes: np.ndarray, threshold: Threshold) -> np.ndarray:
    """Whether the bitmaps of two sets (rows of words) leave it open that they link; ``sizes`` are their sizes' sums."""
    apart = np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)
    return apart <= sizes * (100 - threshold.percent) // (100 + threshold.percent)


def _words(bits) -> np.ndarray:
    return np.frombuffer(b"".join(bits), dtype=np.uint64).reshape(len(bits), -1)


def feasible_pairs(sig: np.ndarray, node: np.ndarray, size: np.ndarray, maps: np.ndarray, threshold: Threshold) -> set[tuple[int, int]]:
    """Pairs of nodes that connect, list by list, what the bitmaps don't tell apart.

    All lists are of one class and come in order of ``sig``, so ``maps`` (a row of words per entry) have one width.
    """
    heads = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    counts = np.diff(np.concatenate((heads, [len(sig)])))
    found: set[tuple[int, int]] = set()
    for lo, n in zip(heads, counts):
        left = np.arange(lo, lo + n)
        while len(left):  # grow a component from the first one left
            reached, left = [left[0]], left[1:]
            while reached and len(left):
                x = reached.pop()
                hit = _near(maps[x][None, :], maps[left], size[x] + size[left], threshold)
                found.update((int(min(node[x], node[y])), int(max(node[x], node[y]))) for y in left[hit])
                reached.extend(left[hit])
                left = left[~hit]
    return found


class _Components:
    def __init__(self, n: int):
        self.of = np.arange(n)
        self.members = {i: [i] for i in range(n)}

    def union(self, a: int, b: int) -> bool:
        a, b = self.of[a], self.of[b]
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        moved = self.members.pop(b)
        self.of[moved] = a
        self.members[a].extend(moved)
        return True


def _stretches(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers first[i]..last[i]-1 of all i, one after the other."""
    n = np.maximum(last - first, 0)
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def link_cluster(sets: list[np.ndarray], threshold: Threshold) -> list[tuple[int, int]]:
    """Links among the sets that join components: a spanning forest of the link graph."""
    m = len(sets)
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if threshold.links(both, len(sets[0]) + len(sets[1]) - both) else []
    by_size = np.argsort([len(s) for s in sets], kind="stable")  # rank -> set
    sizes = np.array([len(sets[i]) for i in by_size])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    shingles = np.concatenate([sets[i] for i in by_size])
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    del shingles, ranked
    token = np.empty(len(order), dtype=np.int64)
    token[order] = np.cumsum(new) - 1
    lists = np.repeat(np.arange(m, dtype=np.int32), sizes)[order]  # ranks, ascending in every token's list
    place = token[order] * m + lists
    del order, new
    comps, found = _Components(m), []
    limit = 1 - threshold.percent / 100
    leader, near = np.full(m, -1), np.zeros(m)  # a set linked to each set, and their distance
    answers: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}

    def overlaps(tokens: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """How many of the tokens the sets of ranks lo..hi-1 hold; the lists' other stretches are skipped."""
        at = _stretches(np.searchsorted(place, tokens * m + lo), np.searchsorted(place, tokens * m + hi))
        return np.bincount(lists[at] - lo, minlength=hi - lo)

    for x in range(m):
        lo, hi = x + 1, int(np.searchsorted(threshold.percent * sizes, 100 * sizes[x], side="right"))
        if hi <= lo:
            continue
        open_ = comps.of[lo:hi] != comps.of[x]
        known = answers.get(leader[x])
        if known is not None:
            first, both_l, apart_l = known
            end = min(hi, first + len(apart_l))
            # sets beyond the leader's stretch are too large for the leader, so they are looked at anyway
            open_[: end - lo] &= apart_l[lo - first : end - first] <= limit + near[x] + 1e-5
        if not open_.any():
            continue
        mine = token[starts[x] : starts[x + 1]]
        if known is not None and end == hi:  # derived from the leader's answers
            theirs = token[starts[leader[x]] : starts[leader[x] + 1]]
            more = np.setdiff1d(mine, theirs, assume_unique=True)
            less = np.setdiff1d(theirs, mine, assume_unique=True)
            both = both_l[lo - first : hi - first] + overlaps(more, lo, hi) - overlaps(less, lo, hi)
        else:
            both = overlaps(mine, lo, hi)
        union = sizes[lo:hi] + sizes[x] - both
        apart = 1 - both / union
        linked = lo + np.flatnonzero(threshold.links(both, union))
        fresh = linked[leader[linked] < 0]
        if len(fresh) > 1:
            answers[x] = lo, both, apart
            leader[fresh], near[fresh] = x, apart[fresh - lo]
        for y in linked:
            if comps.union(x, y):
                found.append((int(by_size[x]), int(by_size[y])))
    return found


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 90, width: int = 3) -> DataFrame:
    """``(key, n_shingles, component_id, text_hash)`` of every row: set size, the smallest id reachable by links, xxhash64 of the text."""
    threshold = Threshold(percent)
    rows = checkpointed(indexed(docs, key, text, threshold, width))
    named = rows.where("id is not null and n > 0")
    same = ["n", "h1", "h2"]
    reps = checkpointed(named.groupBy(*same).agg(F.min(F.struct("id", "th")).alias("rep"), F.count(F.lit(1)).alias("rows")))
    n_reps = reps.count()
    # of equal sets only the one with the smallest id is indexed
    more = checkpointed(
        named.select(*same, "id", "th").join(reps.where("rows > 1"), same).where(F.struct("id", "th") != F.col("rep"))
        .select(*same, "id", "th").distinct()
    )
    one_each = named.join(small(more, more.count(), 5), [*same, "id", "th"], "left_anti")
    kept = one_each.select(F.col("h1").alias("node"), "n", "loose", F.inline("lists"))
    maps = checkpointed(kept.select("node", "k", F.col("n").alias("size"), "bits"))
    loose = rare_first(one_each.select(F.col("h1").alias("node"), "n", "loose"), threshold)
    # index lists with more than one set
    posts = kept.select(F.explode("sigs").alias("sig"), "node", "k").unionByName(loose).repartition("sig")
    # (it reads all columns of the lists, so that both sides of the join share one shuffle)
    shape = posts.groupBy("sig").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("len"), F.max("k").alias("k_too")
    )
    listed = checkpointed(posts.join(shape.where("low <> high and k_too is not null"), "sig").select("sig", "node", "k", "low", "len"))
    stars = listed.where((F.col("len") > LONG) & (F.col("node") != F.col("low"))).select(F.col("node").alias("a"), F.col("low").alias("b"))
    # short lists: their pairs, each once
    held = listed.where(F.col("len") <= SHORT).groupBy("sig", "k").agg(F.sort_array(F.collect_set("node")).alias("s"))
    each = F.expr(f"inline(flatten(transform(s, (x, i) -> transform(slice(s, i + 2, {SHORT}), y -> named_struct('a', x, 'b', y)))))")
    pairs = held.where(F.size("s") > 1).select("k", each).distinct()
    of = lambda c: maps.select("k", F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("bits").alias(f"bits_{c}"))
    pairs = pairs.join(of("a"), ["k", "a"]).join(of("b"), ["k", "b"])

    @giving_back
    def compare_pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, part in frame.groupby("k"):
                good = _near(_words(part["bits_a"]), _words(part["bits_b"]), (part["size_a"] + part["size_b"]).to_numpy(), threshold)
                yield part.loc[good, ["a", "b"]]

    told = pairs.mapInPandas(compare_pairs, "a long, b long")
    between = (F.col("len") > SHORT) & (F.col("len") <= LONG)
    entries = listed.where(between).select("sig", "node", "k").join(maps, ["node", "k"])
    n_groups = groups_for(listed.where(between).count(), LIST_ROWS)

    def compare_lists(frame: pd.DataFrame) -> pd.DataFrame:
        pairs: set[tuple[int, int]] = set()
        for k, part in frame.groupby("k"):
            part = part.sort_values(["sig", "node"]).drop_duplicates(["sig", "node"])
            columns = (part[c].to_numpy() for c in ("sig", "node", "size"))
            pairs |= feasible_pairs(*columns, _words(part["bits"]), threshold)
        give_back()
        return pd.DataFrame(sorted(pairs), columns=["a", "b"], dtype="int64")

    near = (
        entries.withColumn("g", F.pmod(F.xxhash64(F.lit(10), "sig"), F.lit(n_groups)))
        .groupBy("g").applyInPandas(compare_lists, "a long, b long")
    )
    clusters = connected_components(told.unionByName(near).unionByName(stars).distinct())
    members = checkpointed(
        reps.join(clusters, F.col("h1") == F.col("id")).select("rep", "n", F.col("h1").alias("node"), F.col("component").alias("cluster"))
    )
    n_members = members.count()
    shape = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    cut = F.ceil(F.greatest(F.col("m") / F.lit(BLOCK_SETS), F.col("total") / F.lit(BLOCK_SHINGLES))).cast("int")
    dealt = members.join(shape.select("cluster", cut.alias("nb")), "cluster")
    dealt = dealt.withColumn("blk", F.pmod(F.xxhash64(F.lit(8), "node"), F.col("nb")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    groups = groups_for(n_members, GROUP_SETS)
    dealt = dealt.select(
        "rep.id", "rep.th", "node", "cluster",
        F.when(F.col("nb") == 1, F.pmod(F.xxhash64(F.lit(8), "cluster"), F.lit(groups))).otherwise(F.col("cluster")).alias("g"),
        F.when(F.col("nb") == 1, -1).otherwise(F.least("blk", "other")).alias("b1"),
        F.when(F.col("nb") == 1, -1).otherwise(F.greatest("blk", "other")).alias("b2"),
    )
    body = text_or_empty(text)
    bodies = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(body).alias("th"), body.alias("text"))
    work = bodies.join(small(dealt, n_members, 8), ["id", "th"])

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in frame.drop_duplicates(["cluster", "node"]).groupby("cluster"):
            nodes = part["node"].to_numpy()
            for x, y in link_cluster([shingle_set(t, width) for t in part["text"]], threshold):
                out.append((nodes[x], nodes[y]))
        give_back()
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    links = work.groupBy("g", "b1", "b2").applyInPandas(compare, "a long, b long")
    # a component's id is the smallest of its classes' smallest ids
    comps = connected_components(links)
    linked = checkpointed(reps.join(comps, F.col("h1") == F.col("id")).select(*same, "rep.id", "component"))
    least = linked.groupBy("component").agg(F.min("id").alias("component_id"))
    n_linked = linked.count()
    least = linked.join(small(least, n_linked, 2), "component").select(*same, F.col("component_id").alias("linked_id"))
    of_class = reps.where("rows > 1").select(*same, "rep.id").withColumnRenamed("id", "own_id")
    out = rows.select("id", "n", "h1", "h2", "th").join(small(least, n_linked, 4), same, "left")
    out = out.join(small(of_class, more.count(), 4), same, "left")
    comp = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("linked_id", "own_id", "id"))
    return out.select(
        F.col("id").cast(docs.schema[key].dataType).alias(key), F.col("n").alias("n_shingles"),
        comp.cast(docs.schema[key].dataType).alias("component_id"), F.col("th").alias("text_hash"),
    )
