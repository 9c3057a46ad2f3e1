"""Alignment of two tokenizers' tokens over a corpus, with inverted pair bitmaps.

Both tokenizers spell the same bytes (a space and the text). Byte offsets where
a token of A and a token of B both end cut the tokens into groups; every A token
of a group is linked to every B token of it. A pair's count is the number of
documents that hold it linked.

1. Tokens. Both tokenizers always cut at a single space between other
   characters, so a text is a sequence of units (a space and a word, or a longer
   stretch around other white space). Each distinct unit of a batch is encoded
   and aligned once; a document is the concatenation of its units.
2. Inverted bitmaps. Documents form chunks of at most ``CHUNK_DOCS``. A chunk keeps, per pair,
   a compressed bitmap of its documents: only the 64-bit words that are not zero,
   each OR-merged from its documents' bits. The multiplicity of a pair in a
   document (its number of links) is kept in planes: plane ``j`` is a bitmap of
   the documents whose multiplicity has bit ``j``.
3. Counts. Chunks hold different documents, so a pair's count is the sum of the
   popcounts of its bitmaps, aggregated before the shuffle; the best count of
   every A token follows.
4. Scores. The pairs' counts go back to the chunks, a range of pairs at a time
   (``RANGE`` pairs, the bound of the broadcast), and the postings return them to
   their documents: plane ``j`` adds ``2^j`` times the count to every document in it.

A document is linked to its row only by its place in its chunk, so ids may be
null or repeat. Chunks are written to the shared folder, so a lost executor
costs its own chunks only.

Defined results: texts that are null or empty, or that a tokenizer doesn't spell
byte for byte (normalisation, unknown pieces), have no tokens: zeros and an empty
``groups_sha256``; special strings inside texts are plain text; repeated rows are
documents of their own; an empty table gives no rows; extra columns are never
looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS
from .common import checkpointed, give_back, text_or_empty

CHUNK_DOCS = 4_096  # documents of a chunk
CHUNK_BYTES = 8_000_000  # bytes of texts after which a chunk ends
CACHE = 400_000  # distinct units that a task holds
RANGE = MAX_BROADCAST_ROWS  # pairs whose counts are broadcast together
SPAN = np.int64(1 << 20)  # pairs are numbered a * SPAN + b

CHUNK = (
    "ids array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, sha array<string>, "
    "pair array<long>, held array<int>, plane array<int>, at array<int>, word array<int>, bits array<long>"
)
_CUT = re.compile(r"(?<=\S) (?=\S)")


class Aligner:
    """Encodes units by a ``tokenizers`` file (A) and a ``sentencepiece`` model (B), and aligns them."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer, pre_tokenizers

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {c: i for i, c in enumerate(self._alphabet(pre_tokenizers))}
        spelt_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            if all(c in byte for c in token):
                spelt_a[i] = bytes(byte[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        spelt_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.spelt_a, self.spelt_b = _Strings(spelt_a), _Strings(spelt_b)
        # an id of A before another one of A or before B, an id of B before another one of B or before the next group
        shown = [f"{i}{mark}".encode() for n, marks in ((len(spelt_a), ",|"), (len(pieces), ",;")) for mark in marks for i in range(n)]
        self.shown = np.array(shown, dtype=object)
        self.shown_size = np.array([len(x) for x in shown])
        # units stand alone only if no piece of B runs over a space
        self.by_units = not any(re.search("[^▁]▁", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.text: list[bytes] = []  # the groups of every unit, each with a ";" behind it
        self.figures = np.zeros((0, 5), dtype=np.int64)  # of every unit: tokens of A, of B, groups, links; 1 if bytes differ
        self.pairs = np.zeros(0, dtype=np.int64)  # the linked pairs of all units, unit by unit

    @staticmethod
    def _alphabet(pre_tokenizers) -> str:
        """The 256 characters that stand for bytes, in the order of the bytes."""
        shown = sorted(pre_tokenizers.ByteLevel.alphabet())
        same = {c for c in shown if ord(c) < 256}
        rest = iter(c for c in shown if ord(c) >= 256)
        return "".join(chr(b) if chr(b) in same else next(rest) for b in range(256))

    def cut(self, text: str) -> list[str]:
        return _CUT.split(text) if self.by_units else [text]

    def learn(self, units: list[str]) -> None:
        """Encode and align units that are not known yet."""
        if len(self.known) > CACHE:
            self.forget()
        new = [u for u in dict.fromkeys(units) if u not in self.known]
        if not new:
            return
        in_a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in new], add_special_tokens=False)]
        in_b = self.b.encode(new, num_threads=1)
        raw = [(" " + u).encode("utf-8", "surrogatepass") for u in new]
        good = self.spelt_a.spell(in_a, raw) & self.spelt_b.spell(in_b, raw)
        texts, figures, pairs = self._align([x for x, g in zip(in_a, good) if g], [x for x, g in zip(in_b, good) if g])
        rows = np.zeros((len(new), 5), dtype=np.int64)
        rows[good, :4] = figures
        rows[~good, 4] = 1
        shown = iter(texts)
        self.text.extend(next(shown) if g else b"" for g in good)
        self.known.update(zip(new, range(len(self.figures), len(self.figures) + len(new))))
        self.figures = np.concatenate((self.figures, rows))
        self.pairs = np.concatenate((self.pairs, pairs))

    def _align(self, in_a: list[list[int]], in_b: list[list[int]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Of units spelt alike: their groups as text, (tokens of A, of B, groups, links), and all linked pairs."""
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (in_a, in_b))
        a, b = (np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int64) for ids in (in_a, in_b))
        end_a, end_b = np.cumsum(self.spelt_a.size[a]), np.cumsum(self.spelt_b.size[b])
        both = end_a[np.isin(end_a, end_b, assume_unique=True)]  # ends of groups; a unit's end is one
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        p, q = np.bincount(group_a, minlength=len(both)), np.bincount(group_b, minlength=len(both))
        first_b = np.cumsum(q) - q
        # every A token with each B token of its group
        times = q[group_a]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first_b[group_a], times)
        pairs = np.repeat(a, times) * SPAN + b[at]
        # the ids in the order of the text: a group's ids of A, then its ids of B
        size_a, size_b = len(self.spelt_a.size), len(self.spelt_b.size)
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        codes[np.arange(len(a)) + first_b[group_a]] = a + size_a * last_a[: len(a)]
        codes[np.arange(len(b)) + np.cumsum(p)[group_b]] = b + 2 * size_a + size_b * last_b[: len(b)]
        blob = b"".join(self.shown[codes].tolist())
        ends = np.concatenate(([0], np.cumsum(self.shown_size[codes])))[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()
        last = np.cumsum(n_a) - 1  # the last A token of every unit
        groups = np.diff(np.concatenate(([0], group_a[last] + 1)))
        links = np.diff(np.concatenate(([0], np.cumsum(times)[last])))
        return [blob[x:y] for x, y in zip(ends, ends[1:])], np.stack((n_a, n_b, groups, links), axis=1), pairs


class _Strings:
    """Byte strings by number."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(x) for x in strings], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def spell(self, ids: list[list[int]], raw: list[bytes]) -> np.ndarray:
        """Which of some sequences of numbers spell the given bytes."""
        flat = np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int64)
        owner = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        size = self.size[flat]
        want = np.array([len(x) for x in raw])
        good = (np.bincount(owner, weights=size, minlength=len(ids)) == want) & (np.bincount(owner[size == 0], minlength=len(ids)) == 0)
        keep = good[owner]
        size, first = size[keep], self.first[flat[keep]]
        spelt = self.blob[np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)]
        told = np.frombuffer(b"".join([x for x, g in zip(raw, good) if g]), dtype=np.uint8)
        wrong = np.repeat(np.flatnonzero(good), want[good])[spelt != told]
        good[wrong] = False
        return good


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process and pair of files."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def inverted(pair: np.ndarray, doc: np.ndarray) -> dict[str, np.ndarray]:
    """Pair bitmaps and multiplicity planes of a chunk from its links (pair, document in the chunk).

    ``pair`` holds the distinct pairs in ascending order, ``held`` the popcount of each one's bitmap. Posting lists are
    rows of ``(plane, at, word, bits)``: of the pair at place ``at``, plane ``plane``'s word number ``word``.
    A pair's bitmap of documents is the OR of its planes, as a link counts once or more.
    """
    if not len(pair):
        none = np.zeros(0, dtype=np.int64)
        return dict.fromkeys(("pair", "held", "plane", "at", "word", "bits"), none)
    key, times = np.unique(pair * CHUNK_DOCS + doc, return_counts=True)
    pair, doc = key // CHUNK_DOCS, key % CHUNK_DOCS
    new = np.concatenate(([True], pair[1:] != pair[:-1]))
    names, at = pair[new], np.cumsum(new) - 1
    bit = np.uint64(1) << (doc % 64).astype(np.uint64)
    rows = []

    def words(mask: np.ndarray):
        """The non-zero words of the bitmap of some (pair, document)s, OR-merged."""
        spot = at[mask] * 64 + doc[mask] // 64
        head = np.flatnonzero(np.concatenate(([True], spot[1:] != spot[:-1])))
        return spot[head], np.bitwise_or.reduceat(bit[mask], head)

    spot, merged = words(np.ones(len(at), dtype=bool))
    held = np.zeros(len(names), dtype=np.int64)
    np.add.at(held, spot // 64, np.bitwise_count(merged))
    for j in range(int(times.max()).bit_length()):
        mask = (times >> j) & 1 == 1
        if mask.any():
            spot, merged = words(mask)
            rows.append((np.full(len(spot), j), spot // 64, spot % 64, merged.view(np.int64)))
    plane, place, word, bits = (np.concatenate(x) for x in zip(*rows))
    return {"pair": names, "held": held, "plane": plane, "at": place, "word": word, "bits": bits}


def aligned_chunks(docs: DataFrame, key: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """One row per chunk of documents: their own figures and the inverted pair bitmaps (see ``CHUNK``)."""

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = aligner(path_a, path_b)
        heads: list[tuple] = []
        found: list[tuple] = []
        size = 0

        def chunk() -> pd.DataFrame:
            parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 2
            row = dict(zip(("ids", "n_a", "n_b", "n_groups", "n_links", "sha"), map(list, zip(*heads)))) | inverted(*parts)
            heads.clear()
            found.clear()
            return pd.DataFrame([row])

        for frame in frames:
            for lo in range(0, len(frame), 256):
                part = frame.iloc[lo : lo + 256]
                cut = [tool.cut(t) if t else [] for t in part["text"]]
                tool.learn([u for units in cut for u in units])
                at = [np.array([tool.known[u] for u in units], dtype=np.int64) for units in cut]
                first = np.cumsum(tool.figures[:, 3]) - tool.figures[:, 3]  # of every unit's pairs
                for doc, units, text in zip(part["doc"], at, part["text"]):
                    told = tool.figures[units].sum(axis=0)
                    if not len(units) or told[4]:
                        heads.append((doc, 0, 0, 0, 0, ""))
                    else:
                        shown = b"".join([tool.text[i] for i in units.tolist()])[:-1]
                        heads.append((doc, *told[:4].tolist(), hashlib.sha256(shown).hexdigest()))
                        n = tool.figures[units, 3]
                        spot = np.arange(told[3]) + np.repeat(first[units] - (np.cumsum(n) - n), n)
                        found.append((tool.pairs[spot], np.full(len(spot), len(heads) - 1, dtype=np.int64)))
                    size += len(text)
                    if len(heads) == CHUNK_DOCS or size > CHUNK_BYTES:
                        yield chunk()
                        size = 0
        if heads:
            yield chunk()
        tool.forget()  # a worker lives on, its memory is the next task's
        give_back()

    plain = docs.select(F.col(key).cast("string").alias("doc"), text_or_empty(text).alias("text"))
    return plain.mapInPandas(align, CHUNK)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``(a, b, pair, count, best)``: documents that hold a pair linked, and whether no pair of its A token has more."""
    each = chunks.select(F.inline(F.arrays_zip("pair", "held")))
    counts = checkpointed(each.groupBy("pair").agg(F.sum("held").cast("long").alias("count")))
    counts = counts.withColumn("a", F.floor(F.col("pair") / int(SPAN)).cast("long")).withColumn("b", F.col("pair") % int(SPAN))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))  # at most one row per id of A
    return counts.join(F.broadcast(most), "a").select("a", "b", "pair", "count", (F.col("count") == F.col("most")).alias("best"))


def scored(chunks: DataFrame, table) -> DataFrame:
    """``(chunk, best, total)``: what the postings of a range of pairs return to each document of a chunk.

    ``table`` is a broadcast variable of arrays: pairs in ascending order, their counts, and whether they are best.
    """

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, counts, top = table.value
        for frame in frames:
            rows = []
            for chunk, n, pair, plane, at, word, bits in frame.itertuples(index=False, name=None):
                best, total = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
                if len(pair) and len(pairs):
                    spot = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
                    here = pairs[spot] == pair
                    count, is_top = np.where(here, counts[spot], 0), np.where(here, top[spot], False)
                    for lo in range(0, len(bits), 1 << 17):
                        part = slice(lo, lo + (1 << 17))
                        flags = np.unpackbits(bits[part].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                        row, low = np.nonzero(flags)
                        doc = word[part][row].astype(np.int64) * 64 + low
                        weight = np.int64(1) << plane[part][row].astype(np.int64)
                        who = at[part][row]
                        np.add.at(total, doc, weight * count[who])
                        np.add.at(best, doc, np.where(is_top[who], weight, 0))
                rows.append((chunk, best, total))
            yield pd.DataFrame(rows, columns=["chunk", "best", "total"])
        give_back()

    plain = chunks.select("chunk", F.size("ids").alias("n"), "pair", "plane", "at", "word", "bits")
    return plain.mapInPandas(score, "chunk long, best array<long>, total array<long>")


def align_documents(docs: DataFrame, key: str, text: str, path_a: str, path_b: str, limit: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """Per document ``(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, and the table of pairs."""
    spark = docs.sparkSession
    chunks = aligned_chunks(docs, key, text, path_a, path_b).withColumn("chunk", F.monotonically_increasing_id())
    chunks = checkpointed(chunks)
    pairs = checkpointed(pair_counts(chunks))
    ranges = max(1, -(-pairs.count() // limit))
    parts = []
    for r in range(ranges):
        some = pairs.where(F.pmod(F.xxhash64(F.lit(12), "pair"), F.lit(ranges)) == r) if ranges > 1 else pairs
        held = some.select("pair", "count", "best").toPandas().sort_values("pair")  # about ``limit`` rows
        table = spark.sparkContext.broadcast(tuple(held[c].to_numpy() for c in ("pair", "count", "best")))
        parts.append(scored(chunks, table))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    if ranges > 1:
        place = every.select("chunk", F.posexplode(F.arrays_zip("best", "total")).alias("p", "x"))
        added = place.groupBy("chunk", "p").agg(F.sum("x.best").alias("best"), F.sum("x.total").alias("total"))
        every = added.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("p", "best", "total"))).alias("x"))
        every = every.select("chunk", F.col("x.best").alias("best"), F.col("x.total").alias("total"))
    own = chunks.select("chunk", "ids", "n_a", "n_b", "n_groups", "n_links", "sha").join(every, "chunk")
    rows = own.select(F.inline(F.arrays_zip("ids", "n_a", "n_b", "n_groups", "n_links", "best", "total", "sha")))
    names = {"best": "n_best", "total": "count_sum", "sha": "groups_sha256"}
    out = rows.withColumnsRenamed(names).withColumn("ids", F.col("ids").cast(docs.schema[key].dataType))
    return out.withColumnRenamed("ids", key), pairs
