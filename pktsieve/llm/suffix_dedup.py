"""Removal of repeated byte strings with suffix arrays built by Lyndon grouping.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else in the corpus. The work is dealt to tasks by content:

1. Anchors. Of the k-byte windows in every ``length``-byte string the one with
   the smallest hash (rightmost of ties) is its anchor. Equal strings have the
   same anchor at the same place, so strings are compared only where anchors
   are equal. All starts with one anchor are a segment.
2. Segments whose anchor occurs nowhere else drop out; those that are equal are
   counted once (pre-aggregated).
3. The distinct segments of an anchor are aligned at it and cut into cells. The
   cells are the alphabet of a text whose suffix array is built by Lyndon
   grouping (:func:`suffix_array`). Suffixes that share enough whole cells are
   neighbours there, and only within such a run of neighbours the bytes before
   and after the whole cells are compared (by hashes of the whole strings).
4. An anchor with more than ``SEGMENTS`` distinct segments isn't gathered in a
   task: its strings are dealt once more by their hashes and counted. This is
   exact too.

The marked starts go back to all documents that hold the segments.

Passages may also be told by words (:func:`repeated_words`): strings of so many
words that occur in another document, whatever their bytes. They are dealt by
anchors of words in the same way; only segments whose anchor occurs in several
documents are looked at, and their strings are dealt by hashes and counted.

Defined results: null text is empty; texts shorter than ``length`` lose
nothing; ids need not be unique (a row is told by its id and its text's hash);
an empty table gives no rows; extra columns are kept or ignored as the caller
asks. Strings never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS
from .common import checkpointed, give_back, giving_back, groups_for, text_or_empty
from .hashing import Prefix, batches, mixed, word_edges, words_of

SEGMENTS = 16_000  # distinct segments of an anchor that one task compares
CHUNK = 1_000  # segments whose strings are hashed at once
PER_GROUP = 2_000  # segments of small anchors in one group


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of a text of non-negative integers whose last is the smallest and unique.

    Linear grouping: suffixes are grouped by their first symbol and groups are
    taken in descending order. For each suffix of the group the previous
    suffix of a lower group is found by pointers over what is done already; the
    suffixes pointed at move up within their own group, by how often they are
    pointed at, so that at the end a group holds the suffixes with one common
    Lyndon prefix. A second pass fills the array from the smallest suffix on:
    an emitted suffix places the one before it and the chain of its previous
    pointers at the heads of their groups.
    """
    n = len(text)
    symbols = sorted(set(text))
    number = {s: i for i, s in enumerate(symbols)}
    group = [number[s] for s in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    below = list(range(-1, len(symbols) - 1))  # the next lower group
    above = list(range(1, len(symbols) + 1))
    above[-1] = -1
    done = bytearray(n)
    prev = [-1] * n
    head = [0] * len(symbols)
    end = n
    g = len(symbols) - 1
    while g >= 0:
        now = [i for i in members[g] if group[i] == g]
        if now:
            now.sort()
            count: dict[int, int] = {}
            for i in now:
                p = i - 1
                while p >= 0 and done[p]:
                    p = prev[p]
                prev[i] = p
                done[i] = 1
                if p >= 0:
                    count[p] = count.get(p, 0) + 1
            end -= len(now)
            head[g] = end
            if count:
                split: dict[tuple[int, int], list[int]] = {}
                for p, c in count.items():
                    split.setdefault((c, group[p]), []).append(p)
                keys = sorted(split, reverse=True) if len(split) > 1 else split
                for key in keys:
                    moved, old = split[key], key[1]
                    new = len(members)
                    members.append(moved)
                    head.append(0)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    above[old] = new
                    if up >= 0:
                        below[up] = new
                    for p in moved:
                        group[p] = new
        g = below[g]
    out = [0] * n
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            k = group[j]
            out[head[k]] = j
            head[k] += 1
            placed[j] = 1
            j = prev[j]
    return out


def find_anchors(a: np.ndarray, counts: np.ndarray, length: int, k: int):
    """Of byte strings (or sequences of word hashes) that follow one another, of ``counts`` members each.

    Returns for each segment its text's number, its anchor's hash, the hash of its
    content, and the places of the anchor and of its first and last start in ``a``.
    """
    ends = np.cumsum(counts)
    starts = np.maximum(counts - length + 1, 0)  # of each text; no string runs into the next one
    valid = np.repeat(ends - counts - (np.cumsum(starts) - starts), starts) + np.arange(int(starts.sum()))
    if not len(valid):
        none = np.zeros(0, dtype=np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none, none
    prefix = Prefix(a)
    h = prefix.windows(k)
    m, w = len(h), length - k + 1
    low = np.uint64(0xFFFFFFFF)
    rank = (h & ~low) | (low - np.arange(m, dtype=np.uint64))
    blocks = -(-m // w)
    padded = np.full(blocks * w, ~np.uint64(0))
    padded[:m] = rank
    grid = padded.reshape(blocks, w)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (low - (np.minimum(backward[valid], forward[valid + w - 1]) & low)).astype(np.int64)
    turn = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    first, last = valid[turn], valid[np.concatenate((turn[1:], [len(valid)])) - 1]
    place = at[turn]
    content = prefix.spans(first, last + length)
    content = mixed(content ^ mixed((place - first).astype(np.uint64) << np.uint64(32) | (place - last).astype(np.uint64)))
    return np.searchsorted(ends, place, "right"), h[place], content, place, first, last


def _by_text(owner: np.ndarray, texts: int, *columns: np.ndarray) -> list[list[np.ndarray]]:
    """Columns of segments cut into one array for each text."""
    cuts = np.searchsorted(owner, np.arange(texts + 1)).tolist()
    return [[c[x:y] for x, y in zip(cuts, cuts[1:])] for c in columns]


def _row_id(key: str):
    """The key as a string; a null key is one of its own."""
    return F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id")


def _utf8(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _segments(docs: DataFrame, length: int, k: int) -> DataFrame:
    """One row per text: its segments as arrays (anchor, content, far, near: starts lie far..near bytes before the anchor)."""

    @giving_back
    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raws = [_utf8(t) for t in frame["text"]]
            for lo, hi in batches([len(r) for r in raws]):
                counts = np.array([len(r) for r in raws[lo:hi]])
                owner, h, content, place, first, last = find_anchors(np.frombuffer(b"".join(raws[lo:hi]), dtype=np.uint8), counts, length, k)
                base = (np.cumsum(counts) - counts)[owner]
                columns = _by_text(owner, hi - lo, h.view(np.int64), content.view(np.int64), place - base, place - first, place - last)
                yield frame[["id", "th"]].iloc[lo:hi].assign(**dict(zip(["h", "c", "p", "far", "near"], columns)))

    long_enough = docs.where(F.octet_length("text") >= length)
    return long_enough.mapInPandas(
        find, "id string, th long, h array<long>, c array<long>, p array<int>, far array<int>, near array<int>"
    )


def _strings_of(counts: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment and place in the segment of every string of the segments lo..hi-1."""
    n = counts[lo:hi]
    owner = np.repeat(np.arange(lo, hi), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)


def repeated_starts(anchor: np.ndarray, far: np.ndarray, near: np.ndarray, bodies: list[bytes], length: int) -> np.ndarray:
    """Which strings of the segments occur in another segment of the same anchor.

    Returns a boolean for every string, segment by segment, in ascending start.
    """
    cell = max(1, length // 10)
    whole = (length - cell + 1) // cell  # whole cells in any string
    prefix = Prefix(np.frombuffer(b"".join(bodies), dtype=np.uint8))
    base = np.concatenate(([0], np.cumsum([len(b) for b in bodies])))[:-1]
    counts = far - near + 1
    low = -(far // cell)  # the first whole cell of each segment, counted from the anchor
    cells = (length - near) // cell - low
    seg = np.repeat(np.arange(len(bodies)), cells)
    index = np.arange(len(seg)) - np.repeat(np.cumsum(cells) - cells, cells) + low[seg]
    at = base[seg] + far[seg] + index * cell
    content = prefix.spans(at, at + cell)
    keys = mixed(content ^ mixed(anchor[seg].view(np.uint64) + (index + (1 << 20)).astype(np.uint64)))
    _, rank = np.unique(keys, return_inverse=True)
    m = len(bodies)
    # the text: each segment's cells and a separator of its own, then the end; smallest symbols are separators
    heads = np.concatenate(([0], np.cumsum(cells + 1)))
    text = np.empty(heads[-1] + 1, dtype=np.int64)
    text[heads[1:] - 1] = np.arange(1, m + 1)
    spot = heads[seg] + (index - low[seg])
    text[spot] = rank + m + 1
    text[-1] = 0
    order = np.array(suffix_array(text.tolist()), dtype=np.int64)
    # neighbours in the array that share ``whole`` cells are one run; separators keep cells of two segments apart
    padded = np.concatenate((text, -1 - np.arange(whole)))
    same = np.ones(len(order) - 1, dtype=bool)
    for i in range(whole):
        same &= padded[order[1:] + i] == padded[order[:-1] + i]
    run = np.concatenate(([0], np.cumsum(~same)))
    run_of = np.empty(len(text), dtype=np.int64)
    run_of[order] = run
    size = np.bincount(run)
    # the strings whose whole cells occur again, some segments at a time
    ends = np.cumsum(counts)
    spots, keys = [], []
    for lo in range(0, m, CHUNK):
        hi = min(m, lo + CHUNK)
        owner, inside = _strings_of(counts, lo, hi)
        back = far[owner] - inside  # bytes from the string's start to the anchor
        r = run_of[heads[owner] + (-(back // cell) - low[owner])]
        some = np.flatnonzero(size[r] > 1)
        start = base[owner[some]] + inside[some]
        place = (r[some].astype(np.uint64) << np.uint64(24)) + back[some].astype(np.uint64)
        keys.append(mixed(prefix.spans(start, start + length) ^ mixed(place)))
        spots.append(some + (ends[lo] - counts[lo]))
    marked = np.zeros(int(ends[-1]), dtype=bool)
    _, inverse, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    marked[np.concatenate(spots)] = n[inverse] > 1
    return marked


def _runs(flags: np.ndarray, far: int) -> list[dict]:
    """Runs of marked strings, as starts counted back from the anchor."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return [{"far": int(far - a), "near": int(far - b + 1)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


RUNS = "array<struct<far: int, near: int>>"


def repeated_spans(docs: DataFrame, key: str, text: str, length: int = 400, anchor: int | None = None) -> DataFrame:
    """``(id, th, spans)`` of each text that loses bytes: ``spans`` are start and end of strings to remove (they may overlap).

    ``id`` is the key as a string, ``th`` a hash of the text.
    """
    k = anchor or max(1, length // 4)
    plain = docs.select(
        _row_id(key), text_or_empty(text).alias("text"), F.xxhash64(text_or_empty(text)).alias("th")
    )
    small = lambda df, n: F.broadcast(df) if n <= MAX_BROADCAST_ROWS else df  # noqa: E731  checked size
    found = checkpointed(_segments(plain, length, k))
    several = checkpointed(found.select(F.explode("h").alias("h")).groupBy("h").count().where("count > 1").select("h"))
    places = found.select("id", "th", F.inline(F.arrays_zip("h", "c", "p", "far", "near")))
    places = places.join(small(several, several.count()), "h", "left_semi")
    kinds = places.groupBy("h", "c", "far", "near").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "p")).alias("rep")
    )
    anchors = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"))
    kinds = checkpointed(kinds.join(anchors, "h"))
    # a text that holds one or more segments to compare reads them out
    wanted = checkpointed(
        kinds.where("kinds > 1").groupBy("rep.id", "rep.th").agg(
            F.collect_list(F.struct("h", "c", "rep.p", "far", "near", "n", F.col("kinds").alias("kinds"))).alias("segs")
        )
    )
    texts = plain.join(small(wanted.select("id", "th"), wanted.count()), ["id", "th"], "left_semi").dropDuplicates(["id", "th"])

    @giving_back
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for body, segs in zip(frame["text"], frame["segs"]):
                raw = _utf8(body)
                for s in segs:
                    rows.append((s["h"], s["c"], s["far"], s["near"], s["n"], s["kinds"], raw[s["p"] - s["far"] : s["p"] - s["near"] + length]))
            yield pd.DataFrame(rows, columns=["h", "c", "far", "near", "n", "kinds", "body"])

    bodies = texts.join(wanted, ["id", "th"]).mapInPandas(read, "h long, c long, far int, near int, n long, kinds long, body binary")
    hot = kinds.where(F.col("kinds") > SEGMENTS).count()
    if hot:  # else the bodies are read once and needn't be kept
        bodies = checkpointed(bodies)
    few = bodies.where(F.col("kinds") <= SEGMENTS)
    groups = groups_for(kinds.where(F.col("kinds").between(2, SEGMENTS)).count(), PER_GROUP)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        far, near = frame["far"].to_numpy().astype(np.int64), frame["near"].to_numpy().astype(np.int64)
        marked = repeated_starts(frame["h"].to_numpy(), far, near, list(frame["body"]), length)
        ends = np.cumsum(far - near + 1)
        runs = [_runs(marked[b - (f - e + 1) : b], f) for f, e, b in zip(far, near, ends)]
        out = pd.DataFrame({"h": frame["h"], "c": frame["c"], "runs": runs})
        del marked
        give_back()
        return out[[len(r) > 0 for r in runs]]

    compared = (
        few.withColumn("g", F.pmod(F.xxhash64(F.lit(2), "h"), F.lit(groups)))
        .groupBy("g").applyInPandas(compare, f"h long, c long, runs {RUNS}")
    )

    # the strings of anchors with very many segments, dealt by their content
    @giving_back
    def explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(0, len(frame), CHUNK):
                part = frame.iloc[i : i + CHUNK]
                far, near = part["far"].to_numpy().astype(np.int64), part["near"].to_numpy().astype(np.int64)
                base = np.concatenate(([0], np.cumsum(part["body"].map(len))))[:-1]
                owner, inside = _strings_of(far - near + 1, 0, len(part))
                start = base[owner] + inside
                strings = Prefix(np.frombuffer(b"".join(part["body"]), dtype=np.uint8)).spans(start, start + length)
                yield pd.DataFrame({
                    "h": part["h"].to_numpy()[owner], "c": part["c"].to_numpy()[owner],
                    "back": (far[owner] - inside).astype(np.int32), "s": strings.view(np.int64),
                })

    many = bodies.where(F.col("kinds") > SEGMENTS).select("h", "c", "far", "near", "body")
    strings = many.mapInPandas(explode, "h long, c long, back int, s long").repartition("h", "back", "s")
    often = strings.groupBy("h", "back", "s").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    dealt = strings.join(often, ["h", "back", "s"]).groupBy("h", "c").agg(F.array_sort(F.collect_list("back")).alias("b"))
    dealt = dealt.select("h", "c", F.expr("transform(b, x -> named_struct('far', x, 'near', x))").alias("runs"))
    # a segment that occurs more than once goes as a whole
    copies = kinds.where("n > 1").select("h", "c", F.array(F.struct("far", "near")).alias("runs"))
    once = kinds.where("n = 1").select("h", "c")
    alone = (compared.unionByName(dealt) if hot else compared).join(once, ["h", "c"], "left_semi")
    runs = copies.unionByName(alone)
    hits = places.join(runs, ["h", "c"])
    spans = F.expr(f"transform(runs, r -> named_struct('start', p - r.far, 'end', p - r.near + {length}))")
    return hits.select("id", "th", spans.alias("spans")).groupBy("id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def repeated_words(docs: DataFrame, key: str, text: str, words: int = 50, anchor: int | None = None) -> DataFrame:
    """``(id, th, passages)`` of each text that shares a string of ``words`` words with another row.

    ``passages`` are first word and word after the last (they may overlap). Words are
    ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case; what only repeats within a text stays.
    """
    k = anchor or max(1, words // 6)
    plain = docs.select(
        _row_id(key), text_or_empty(text).alias("text"), F.xxhash64(text_or_empty(text)).alias("th")
    )
    long_enough = plain.where(F.octet_length("text") >= 2 * words - 1)

    def anchors_in(frame: pd.DataFrame):
        texts = frame["text"].tolist()
        for lo, hi in batches([len(t) for t in texts]):
            hashes, counts = words_of(texts[lo:hi])
            yield lo, hi, counts, *find_anchors(hashes, counts, words, k)

    def once(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Marks one of equal hashes of a text."""
        order = np.lexsort((hashes, owner))
        o, x = owner[order], hashes[order]
        out = np.zeros(len(order), dtype=np.int32)
        out[order[np.concatenate(([True], (o[1:] != o[:-1]) | (x[1:] != x[:-1])))[: len(order)]]] = 1
        return out

    @giving_back
    def anchors_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, _, _, owner, h, *_ in anchors_in(frame):
                yield pd.DataFrame({"h": h[once(owner, h) > 0].view(np.int64)})

    @giving_back
    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo, hi, counts, owner, h, content, place, first, last in anchors_in(frame):
                base = (np.cumsum(counts) - counts)[owner]
                new = once(owner, content)  # a segment counts once in a text
                columns = _by_text(owner, hi - lo, h.view(np.int64), content.view(np.int64), place - base, place - first, place - last, new)
                yield frame[["id", "th"]].iloc[lo:hi].assign(**dict(zip(["h", "c", "p", "far", "near", "new"], columns)))

    several = long_enough.select("text").mapInPandas(anchors_of, "h long").groupBy("h").count().where("count > 1").select("h")
    several = checkpointed(several)
    small = lambda df, n: F.broadcast(df) if n <= MAX_BROADCAST_ROWS else df  # noqa: E731  checked size
    found = long_enough.mapInPandas(
        find, "id string, th long, h array<long>, c array<long>, p array<int>, far array<int>, near array<int>, new array<int>"
    )
    places = found.select("id", "th", F.inline(F.arrays_zip("h", "c", "p", "far", "near", "new")))
    places = checkpointed(places.join(small(several, several.count()), "h", "left_semi"))
    kinds = places.groupBy("h", "c", "far", "near").agg(F.sum("new").alias("n"), F.min(F.struct("id", "th", "p")).alias("rep"))
    kinds = checkpointed(kinds)
    # segments that only one text holds are compared with the others of their anchor, string by string
    mixed_anchors = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    wanted = checkpointed(
        kinds.join(mixed_anchors.select("h"), "h", "left_semi").groupBy("rep.id", "rep.th").agg(
            F.collect_list(F.struct("h", "c", "rep.p", "far", "near", "n")).alias("segs")
        ).select("id", "th", *[F.col(f"segs.{x}").alias(x) for x in ("h", "c", "p", "far", "near", "n")])
    )
    texts = plain.join(small(wanted.select("id", "th"), wanted.count()), ["id", "th"], "left_semi").dropDuplicates(["id", "th"])

    @giving_back
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo, hi in batches(frame["text"].map(len).tolist()):
                part = frame.iloc[lo:hi]
                hashes, counts = words_of(part["text"].tolist())
                text = np.repeat(np.arange(hi - lo), part["h"].map(len))
                h, c, p, far, near, n = (np.concatenate(part[x].tolist()).astype(np.int64) for x in ("h", "c", "p", "far", "near", "n"))
                owner, inside = _strings_of(far - near + 1, 0, len(text))
                back = far[owner] - inside
                start = (np.cumsum(counts) - counts)[text[owner]] + p[owner] - back
                strings = Prefix(hashes).spans(start, start + words)
                yield pd.DataFrame({
                    "h": h[owner], "back": back.astype(np.int32), "s": strings.view(np.int64), "c": c[owner], "n": n[owner],
                    "d": part["d"].to_numpy()[text[owner]],
                })

    strings = texts.join(wanted, ["id", "th"]).select("text", F.xxhash64("id", "th").alias("d"), "h", "c", "p", "far", "near", "n")
    strings = strings.mapInPandas(read, "h long, back int, s long, c long, n long, d long")
    same = Window.partitionBy("h", "back", "s")
    strings = strings.select("*", F.max("n").over(same).alias("most"), F.min("d").over(same).alias("lo"), F.max("d").over(same).alias("hi"))
    alone = strings.where("n = 1 and (most > 1 or lo <> hi)").groupBy("h", "c").agg(F.collect_list("back").alias("b"))
    alone = alone.select("h", "c", F.expr("transform(b, x -> named_struct('far', x, 'near', x))").alias("runs"))
    # a segment that several texts hold goes as a whole
    shared = kinds.where("n > 1").select("h", "c", F.array(F.struct("far", "near")).alias("runs"))
    hits = places.join(shared.unionByName(alone), ["h", "c"])
    spans = F.expr(f"transform(runs, r -> named_struct('start', p - r.far, 'end', p - r.near + {words}))")
    return hits.select("id", "th", spans.alias("spans")).groupBy("id", "th").agg(F.flatten(F.collect_list("spans")).alias("passages"))


def words_to_bytes(raw: bytes, passages) -> list[dict]:
    """Spans of words as spans of bytes, from the first word's start to the last one's end."""
    starts, ends = word_edges(np.frombuffer(raw, dtype=np.uint8))
    return [{"start": starts[s["start"]], "end": ends[s["end"] - 1]} for s in passages]


def covered(n: int, spans) -> tuple[np.ndarray, list[dict]]:
    """Which of n bytes the spans cover, and the maximal runs of these."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, [s["start"] for s in spans], 1)
    np.add.at(depth, [s["end"] for s in spans], -1)
    gone = np.cumsum(depth)[:-1] > 0
    edge = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
    return gone, [{"start": int(x), "end": int(y)} for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


def remove_spans(raw: bytes, spans) -> tuple[bytes, int, int]:
    """What is left, how many bytes went, and in how many maximal runs."""
    gone, runs = covered(len(raw), spans)
    return np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes(), int(gone.sum()), len(runs)


def _all_spans(docs: DataFrame, key: str, text: str, length: int, words: int | None) -> DataFrame:
    """``(sid, sth, spans, passages)`` of each text that has any; without ``words`` passages are null."""
    spans = repeated_spans(docs, key, text, length)
    if words is None:
        spans = spans.withColumn("passages", F.lit(None).cast("array<struct<start: int, end: int>>"))
    else:
        spans = spans.join(repeated_words(docs, key, text, words), ["id", "th"], "full")
    return checkpointed(spans.withColumnsRenamed({"id": "sid", "th": "sth"}))


def dedup_digests(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400, words: int | None = None
) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept_sha256, n_kept, text)`` of every row.

    ``n_kept`` counts the bytes that are left, ``text`` is what is left (a cut inside a
    character drops what is left of that character there, not in the digest).

    With ``words``, ``passages`` tells where the input has strings of so many words that
    another document holds (maximal runs of bytes, start and end), ``n_passage_bytes`` how
    many bytes these are. They are told only: the columns before them go by ``length``.
    """
    spans = _all_spans(docs, key, text, length, words)
    body = text_or_empty(text)
    plain = docs.select(_row_id(key), body.alias("text"), F.xxhash64(body).alias("th"))
    touched = spans.select("sid", "sth")
    if spans.count() <= MAX_BROADCAST_ROWS:  # texts without any span stay where they are read
        touched = F.broadcast(touched)
    same = (F.col("id") == F.col("sid")) & (F.col("th") == F.col("sth"))

    @giving_back
    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for i, body, s, w in zip(frame["id"], frame["text"], frame["spans"], frame["passages"]):
                raw = _utf8(body)
                kept, removed, runs = remove_spans(raw, () if s is None else s)
                gone, passages = covered(len(raw), () if w is None else words_to_bytes(raw, w))
                rows.append((
                    i, len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), len(kept), kept.decode("utf-8", "ignore"),
                    int(gone.sum()), passages,
                ))
            yield pd.DataFrame(rows, columns=out.fieldNames())

    rest = plain.join(touched, same, "left_anti").select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"),
        F.octet_length("text").cast("long").alias("n_kept"), "text", F.lit(0).cast("long").alias("n_passage_bytes"),
        F.array().cast("array<struct<start: int, end: int>>").alias("passages"),
    )
    out = rest.schema
    cut = plain.join(touched, same, "left_semi").join(spans, same).select("id", "text", "spans", "passages")
    every = rest.unionByName(cut.mapInPandas(digest, out))
    columns = [c for c in every.columns if words is not None or c not in ("n_passage_bytes", "passages")]
    return every.withColumn("id", F.col("id").try_cast(docs.schema[key].dataType)).select(*columns).withColumnRenamed("id", key)


def dedup_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400, words: int | None = None
) -> DataFrame:
    """The documents without their repeated strings, in the input's columns.

    With ``words``, strings of so many words that occur in another document go
    too. Rows that are left without any text (with ``words``: without any word)
    go, rows that had none stay. A cut inside a character drops what is left of
    that character.
    """
    spans = _all_spans(docs, key, text, length, words)
    body = text_or_empty(text)
    at = docs.columns.index(text)
    packed = docs.select(
        F.struct(*docs.columns).alias("row"), _row_id(key), F.xxhash64(body).alias("th")
    )
    same = (F.col("id") == F.col("sid")) & (F.col("th") == F.col("sth"))
    rest = None
    if spans.count() <= MAX_BROADCAST_ROWS:  # texts that lose nothing stay where they are read
        touched = F.broadcast(spans.select("sid", "sth"))
        rest = packed.join(touched, same, "left_anti").select("row.*")
        packed = packed.join(touched, same, "left_semi")
    joined = packed.join(spans, same, "left")

    @F.pandas_udf("string")
    @giving_back
    def left(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans, passages in parts:
            out = []
            for t, s, w in zip(texts, spans, passages):
                raw = _utf8(t)
                gone = [*(() if s is None else s), *(() if w is None else words_to_bytes(raw, w))]
                out.append(remove_spans(raw, gone)[0].decode("utf-8", "ignore") if gone else t)
            yield pd.Series(out, dtype=object)

    left = left.asNondeterministic()  # else the filter below runs it once more, in a second Python worker of every task
    own = F.col("row")[docs.columns[at]]
    clean = F.col("sid").isNull()
    kept = joined.select("row", "sid", F.when(clean, own).otherwise(left(own, F.col("spans"), F.col("passages"))).alias("kept"))
    some = F.col("kept") != "" if words is None else F.col("kept").rlike(r"[^\x20\x09-\x0D]")
    kept = kept.where(clean | some)
    kept = kept.select(*[F.col("kept").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
    return kept if rest is None else rest.unionByName(kept)
