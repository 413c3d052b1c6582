"""Token ids of many texts at once: texts are cut into units that a tokenizer treats apart, and each distinct unit is
encoded by the library once.

A unit begins where white space follows something else, and where ASCII punctuation follows an ASCII letter; no
pre-tokenizer of letters, digits, punctuation and blanks reaches across either place. Cutting, looking up and joining
work on whole Arrow arrays; Python sees only the distinct units of a batch. A text that may hold the name of a special
token is one unit.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from pathlib import Path
from struct import pack
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers

SPACE, LETTER, PUNCT = 1, 2, 4
WHITE = " \t\n\x0b\x0c\r"
KIND = np.zeros(256, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
KIND[65:91] = KIND[97:123] = LETTER
KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = PUNCT
#: Last and last but one bytes of white space beyond ASCII; characters that share both are not cut behind either.
WIDE_LAST, WIDE_BEFORE = np.zeros(256, bool), np.zeros(256, bool)
WIDE_LAST[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
WIDE_BEFORE[[0xC2, 0x9A, 0x80, 0x81]] = True
LONGEST_KEPT = 64


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each with a blank before it, and the place where each ends. Nulls count as empty."""
    kind = pa.large_string()
    marked = pc.binary_join_element_wise(pa.scalar(" ", kind), pc.fill_null(texts.cast(kind), ""), pa.scalar("", kind))
    ends = np.frombuffer(marked.buffers()[1], np.int64)[marked.offset:marked.offset + len(marked) + 1]
    return np.frombuffer(marked.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].copy(), ends[1:] - ends[0]


def word_cuts(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where units begin, ascending; every text begins one."""
    kind = KIND[raw]
    space = kind == SPACE
    wide = WIDE_LAST[raw]
    wide[1:] &= WIDE_BEFORE[raw[:-1]]
    cut = np.zeros(len(raw), bool)
    cut[1:] = space[1:] & ~(space | wide)[:-1] | (kind[1:] == PUNCT) & (kind[:-1] == LETTER)
    starts = ends[:-1]
    cut[0:1] = True
    cut[starts[starts < len(raw)]] = True
    return cut


def as_units(raw: np.ndarray, cut: np.ndarray) -> pa.Array:
    begins = np.append(np.flatnonzero(cut), len(raw)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(raw)])


class Kept:
    """What was worked out for units, in two generations: what the older one holds is forgotten unless it is used again."""

    def __init__(self, fill: Callable[[list[bytes]], list], most: int):
        self.fill, self.most, self.young, self.old = fill, most, {}, {}

    def __call__(self, units: list[bytes]) -> list:
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old = self.young.get, self.old.pop
        found = [young(u) for u in units]
        again = [i for i, x in enumerate(found) if x is None]
        missing = []
        for i in again:
            x = found[i] = old(units[i], None)
            if x is None:
                missing.append(i)
            else:
                self.young[units[i]] = x
        for i, x in zip(missing, self.fill([units[i] for i in missing]) if missing else [], strict=True):
            found[i] = x
            if len(units[i]) <= LONGEST_KEPT:
                self.young[units[i]] = x
        return found


def lists_of(parts: list[bytes], kind: pa.DataType = pa.int32()) -> pa.LargeListArray:
    """Lists of 32-bit numbers from their bytes."""
    ends = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    return pa.LargeListArray.from_arrays(pa.array(ends // 4), pa.array(np.frombuffer(b"".join(parts), "<i4"), kind))


def gathered(lists: pa.LargeListArray, order: pa.Array, unit_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all units in ``order``, and how many there are up to the end of each text."""
    taken = lists.take(order)
    ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1]
    return taken.values.to_numpy()[ends[0]:ends[-1]], ends[unit_ends] - ends[0]


class WordIds:
    """Ids of texts under a tokenizer that normalizes to NFC and lower case and drops white space.

    Letters that normalization leaves as they are go straight to the library's merges; all else goes through the whole
    tokenizer. Lower-casing ASCII first changes nothing, but for the names of special tokens.
    """

    def __init__(self, tokenizer: str, most: int = 250_000):
        self.tokenizer = tokenizers.Tokenizer.from_str(tokenizer)
        self.merge, self.kept = self.tokenizer.model.tokenize, Kept(self._new, most)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level vocabularies show as they are
        hidden = [b for b in range(256) if b not in set(visible)]
        self.shown = {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}

    def _new(self, units: list[bytes]) -> list[bytes]:
        out, whole = [], []
        for i, unit in enumerate(units):
            word = unit.decode().lstrip(WHITE)
            if word.isalpha() and (word.isascii() and unit.islower() or word.lower() == word and is_normalized("NFC", word)):
                text = word if word.isascii() else "".join(map(self.shown.__getitem__, word.encode()))
                found = [t.id for t in self.merge(text)]
                out.append(pack(f"<{len(found)}i", *found))
            else:
                out.append(None)
                whole.append(i)
        for i, e in zip(whole, self.tokenizer.encode_batch_fast([units[i].decode() for i in whole], add_special_tokens=False), strict=True):
            out[i] = pack(f"<{len(e.ids)}i", *e.ids)
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many there are up to the end of each text."""
        raw, ends = joined(texts)
        cut = word_cuts(raw, ends)
        plain = raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32)
        plain[plain == 10] = 32
        for i in np.flatnonzero(pc.fill_null(pc.match_substring(texts, "<|"), False).to_numpy(zero_copy_only=False)):
            a, b = ends[i - 1] if i else 0, ends[i]
            cut[a + 1:b], plain[a:b] = False, raw[a:b]
        unit_ends = np.cumsum(cut)[ends - 1] if len(ends) else np.zeros(0, np.int64)
        units = as_units(plain, cut).dictionary_encode()
        return gathered(lists_of(self.kept(units.dictionary.to_pylist())), units.indices, unit_ends)


def read_tokenizer(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")
