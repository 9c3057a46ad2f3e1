"""Piece ids and counts of whitespace-delimited units, through the tokenizers library.

A unit is cut where the pre-tokeniser always cuts, so units can be encoded one
by one. Many distinct units are encoded in one call: they are joined by a
special token of the vocabulary, which the library takes out before any
normalisation, and the ids are split at that token again.
"""

from __future__ import annotations

import os
import re

import numpy as np

CHUNK = 2000


class UnitEncoder:
    """Encodes distinct units; ``path`` is a tokenizers .json file, ``special`` one of its special tokens."""

    def __init__(self, path: str, special: str = "<|endoftext|>"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = special
        self.mark = self.tokenizer.token_to_id(special)

    def ids(self, unit: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(unit, add_special_tokens=False).ids, dtype="<u4")

    def many(self, units: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for i in range(0, len(units), CHUNK):
            part = units[i : i + CHUNK]
            odd = [k for k, u in enumerate(part) if "<|" in u or "|>" in u or u == ""]
            plain = part
            if odd:
                plain = list(part)
                for k in odd:
                    plain[k] = "a"
            ids = np.array(self.tokenizer.encode(self.special.join(plain), add_special_tokens=False).ids, dtype="<u4")
            got = np.split(ids, np.flatnonzero(ids == self.mark))
            got = [got[0], *(g[1:] for g in got[1:])]
            for k in odd:
                got[k] = self.ids(part[k])
            out.extend(got)
        return out


_encoders: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path)
    return _encoders[path]


_GAP = re.compile(r"\s \s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def space_units(text: str) -> list[str]:
    """Cut a text at single spaces between other characters, where the pre-tokeniser always cuts.

    A unit stands for the space before it and itself; the first one, which has
    none, is marked by a space in front
    (no other unit starts with one).
    """
    if "  " in text or text[:1] == " " or text[-1:] == " " or _GAP.search(text):
        parts = _CUT.split(text)
    else:
        parts = text.split(" ")
    parts[0] = " " + parts[0]
    return parts


def raw_unit(key: str) -> str:
    """The characters that a unit of ``space_units`` stands for."""
    return key[1:] if key[:1] == " " else " " + key
