"""Packing documents into sequences: first-fit decreasing over a tournament tree.

Documents are tokenised and cut into pieces of at most ``limit`` ids. Pieces
that fill a sequence are sequences of their own. The others are dealt to
randomised groups (by a hash of the document and its ids) and each group is
packed on its own: pieces in descending length, each into the first sequence
with room. The tournament tree holds the room of every sequence at its leaves
and the largest room below at every inner node, so the first fit is found in a
logarithmic walk.

Defined results: null text is empty (the document is its end id alone); rows
that repeat are packed each; an empty table gives no rows; extra columns are
never looked at. Results don't depend on the order of rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back, groups_for, text_or_empty
from .tokens import encoder

DOCS_PER_GROUP = 8_000
CACHE = 300_000  # distinct words, and distinct pieces of words, that a task holds
BATCH = 3_000_000  # bytes of texts that are encoded together
PIECE = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, h long"
ARROW = pa.schema([(c, pa.string() if c == "doc_id" else pa.int64()) for c in re.findall(r"(\w+) (?:string|long)", PIECE)])
PLACED = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_words: dict[str, bytes] = {}
_pieces: dict[str, bytes] = {}

# Words of printable Latin-1 characters are cut as the vocabulary's pre-tokeniser
# cuts them (lower-casing is all that its normaliser does to them), so that words
# with other case or punctuation share pieces.
_PLAIN = re.compile(r"[!-~\xa1-\xff]+")
_LETTERS = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")


def _byte_alphabet() -> dict[int, str]:
    """How the library writes the bytes of each printable Latin-1 character."""
    from tokenizers import pre_tokenizers

    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: level.pre_tokenize_str(chr(c))[0][0] for c in (*range(33, 127), *range(161, 256))}


def _encode_words(new: list[str], path: str) -> None:
    enc = encoder(path)
    if not hasattr(enc, "alphabet"):
        enc.alphabet = _byte_alphabet()
    model, alphabet = enc.tokenizer.model, enc.alphabet
    rest = []
    for word in new:
        if _PLAIN.fullmatch(word) and "<|" not in word:
            out = []
            low = word.lower()
            for piece in (low,) if low.isalpha() else _CUT.findall(low):
                ids = _pieces.get(piece)
                if ids is None:
                    tokens = model.tokenize(piece.translate(alphabet))
                    ids = _pieces[piece] = np.array([t.id for t in tokens], dtype="<u4").tobytes()
                out.append(ids)
            _words[word] = b"".join(out)
        elif word:
            rest.append(word)
        else:
            _words[word] = b""
    for word, ids in zip(rest, enc.many(rest)):
        _words[word] = ids.tobytes()


def document_ids(texts: pa.StringArray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after the other, and where each text's ids end, by the tokenizers library.

    The vocabulary drops white space, so the words between spaces and newlines
    are encoded on their own, each distinct one once for as long as it is held.
    """
    if len(_words) > CACHE:
        _words.clear()
    if len(_pieces) > CACHE:
        _pieces.clear()
    words = pc.split_pattern(pc.replace_substring(texts, pattern="\n", replacement=" "), pattern=" ")
    coded = words.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    ids = list(map(_words.get, distinct))
    new = [i for i, x in enumerate(ids) if x is None]
    _encode_words([distinct[i] for i in new], path)
    for i in new:
        ids[i] = _words[distinct[i]]
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
    first = np.cumsum(sizes) - sizes
    codes = coded.indices.to_numpy()
    lengths = sizes[codes]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    # the i-th id of a word lies i places after the word's first id
    out = flat[np.repeat(first[codes] - ends[:-1], lengths) + np.arange(ends[-1])]
    bounds = words.offsets.to_numpy()
    return out, ends[bounds[1:] - bounds[0]]


def _slices(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of texts of about ``BATCH`` bytes, at least one text each."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if i > start and size + n > BATCH:
            yield start, i
            start, size = i, 0
        size += n
    if len(texts):
        yield start, len(texts)


def cut_pieces(docs: DataFrame, key: str, text: str, tokenizer_path: str, limit: int = 4096, end_id: int = 2) -> DataFrame:
    """One row per piece: ``doc_id`` (as string), ``start, length, ids_crc32, doc_tokens`` and a hash ``h`` of the document."""
    end = np.array([end_id], dtype="<u4")

    @giving_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, all_texts = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.string())
            for lo, hi in _slices(all_texts):
                rows = []
                flat, ends = document_ids(all_texts.slice(lo, hi - lo), tokenizer_path)
                begin = 0
                for doc, stop in zip(names[lo:hi], ends.tolist()):
                    ids = np.concatenate([flat[begin:stop], end])
                    begin = stop
                    n = len(ids)
                    h = zlib.crc32(ids)
                    for start in range(0, n, limit):
                        piece = ids[start : start + limit]
                        crc = h if len(piece) == n else zlib.crc32(piece)
                        rows.append((doc, start, len(piece), crc, n, h))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)], schema=ARROW)
        _words.clear()  # a worker lives on, its memory is the next task's
        _pieces.clear()

    plain = docs.select(F.col(key).cast("string").alias("doc_id"), text_or_empty(text).alias("text"))
    return plain.mapInArrow(cut, PIECE)


class RoomTree:
    """A tournament tree over the room left in bins; bins open as they are needed."""

    def __init__(self, limit: int, leaves: int = 64):
        self.limit, self.leaves = limit, leaves
        self.room = [limit] * (2 * leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Put a piece into the first bin with room; its bin and its offset there."""
        while self.room[1] < length:
            self._double()
        node, room = 1, self.room
        while node < self.leaves:
            node *= 2
            if room[node] < length:
                node += 1
        offset = self.limit - room[node]
        bin_, left = node - self.leaves, room[node] - length
        room[node] = left
        while node > 1:
            node >>= 1
            a, b = room[2 * node], room[2 * node + 1]
            most = a if a > b else b
            if room[node] == most:
                break
            room[node] = most
        return bin_, offset

    def _double(self) -> None:
        old, n = self.room, self.leaves
        self.leaves = 2 * n
        self.room = [self.limit] * (4 * n)
        self.room[2 * n : 3 * n] = old[n:]
        for node in range(2 * n - 1, 0, -1):
            self.room[node] = max(self.room[2 * node], self.room[2 * node + 1])


def first_fit_decreasing(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece; ``lengths`` must already be in descending order."""
    tree = RoomTree(limit)
    placed = [tree.place(int(x)) for x in lengths]
    return np.array([p[0] for p in placed], dtype=np.int64), np.array([p[1] for p in placed], dtype=np.int64)


def pack(docs: DataFrame, key: str, text: str, tokenizer_path: str, limit: int = 4096, end_id: int = 2, seed: int = 6) -> DataFrame:
    """One row per piece: the document's ``key``, ``start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    groups = groups_for(docs.select(key).count(), DOCS_PER_GROUP)
    pieces = cut_pieces(docs, key, text, tokenizer_path, limit, end_id)
    # every full piece is a sequence already; it is dealt by its place too, so a long document isn't one group's
    place = F.when(F.col("length") == limit, F.col("start")).otherwise(F.lit(-1))
    dealt = pieces.withColumn("g", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "h", place), F.lit(groups)))

    def pack_group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["length", "doc_id", "h", "start"], ascending=[False, True, True, True], na_position="first", kind="stable"
        )
        bins, offsets = first_fit_decreasing(frame["length"].to_numpy(), limit)
        frame["sequence_id"] = (frame["g"].to_numpy() << 32) + bins
        frame["offset"] = offsets
        return frame[[c.split()[0] for c in PLACED.split(", ")]]

    out = dealt.groupBy("g").applyInPandas(pack_group, PLACED)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType)).withColumnRenamed("doc_id", key)
