"""Token ids of whole texts by a public byte-level BPE vocabulary (library ``tokenizers``).

Byte-level BPE first splits a text into pieces and merges inside a piece only.  Two places
are always such a split: before an ASCII space, tab or line feed that follows a visible
character, and between a letter and ASCII punctuation.  Texts are cut there, each distinct
cut is encoded by the library once per slice, and frequent cuts stay in a table of the
worker.  Added tokens of the vocabulary, such as an end mark written out in a text, come before
that split: texts are cut around them.  The ids are those of encoding the whole text."""

from __future__ import annotations

import os
import re

import numpy as np
import pandas as pd

from barwright.llm.common import span_hashes

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 32]] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = _VISIBLE & ~_LETTER
_PUNCT[48:58] = False

# Byte-level vocabularies name a byte by a visible character: printable Latin-1 bytes by
# themselves, the others by the characters from U+0100 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_NAMES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}

TABLE_ENTRIES = 1_000_000
ENCODE_BYTES = 500_000  # of text encoded at a time: the arrays of a slice take some 100 times as much


def cut_places(data: np.ndarray, bounds: np.ndarray, added: re.Pattern | None = None) -> np.ndarray:
    """Starts of the pieces; every row start is one.  A literal added token is a piece."""
    if not len(data):
        return np.empty(0, np.int64)
    latin = np.zeros(len(data), bool)  # last byte of a letter U+00C0..U+00FF
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    before, now = data[:-1], data[1:]
    cut = np.zeros(len(data), bool)
    cut[1:] = (_BLANK[now] & (_VISIBLE[before] | latin[:-1])) | (
        _PUNCT[now] & (_LETTER[before] | latin[:-1])
    )
    raw = data.tobytes() if added is not None else b""
    if added is not None and added.search(raw):
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            for found in added.finditer(raw, low, high):
                cut[found.start()] = True
                cut[found.start() + 1 : found.end()] = False
                cut[found.end() : found.end() + 1] = True
    cut[bounds[:-1][bounds[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes slices; keeps ids of pieces seen before, up to TABLE_ENTRIES."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("added tokens that depend on what is around them are not supported")
        self.added = {t.content.encode() for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, longest_first))) if longest_first else None
        self._clear()

    def _plain(self, pieces: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [e.ids for e in found]

    def _encode(self, pieces: list[bytes]) -> list[list[int]]:
        """A blank and Latin letters are one piece for the merges as well, so the merges of
        the library are called at once; anything else goes through the full encoder."""
        merge = self.tokenizer.model.tokenize
        out: list[list[int]] = [[]] * len(pieces)
        rest = []
        for i, p in enumerate(pieces):
            word = p[1:] if p[:1] == b" " else p
            if p in self.added:
                rest.append(i)
            elif word.isalpha() or ((text := word.decode()).isalpha() and max(text) < "\u0250"):
                out[i] = [t.id for t in merge(p.decode("latin1").translate(_BYTE_NAMES))]
            else:
                rest.append(i)
        for i, ids in zip(rest, self._plain([pieces[i].decode() for i in rest]), strict=True):
            out[i] = ids
        return out

    def _clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.place = np.zeros(0, np.int32)
        self.count = np.zeros(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        order = np.argsort(keys)
        keys, pieces = keys[order], [pieces[i] for i in order]
        if len(self.keys) + len(keys) > TABLE_ENTRIES:
            self._clear()
        found = self._encode(pieces)
        count = np.fromiter(map(len, found), np.int64, len(found))
        place = len(self.ids) + np.cumsum(count) - count
        flat = np.fromiter((i for x in found for i in x), np.uint32, int(count.sum()))
        self.ids = np.concatenate([self.ids, flat])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.place = np.insert(self.place, at, place)
        self.count = np.insert(self.count, at, count)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows as one array, and the number of ids of each row."""
        starts = cut_places(data, bounds, self.pattern)
        rows = len(bounds) - 1
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(rows, np.int64)
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, ends)
        back, distinct = pd.factorize(hashes)
        example = np.empty(len(distinct), np.int64)
        example[back[::-1]] = np.arange(len(back) - 1, -1, -1)
        where = np.searchsorted(self.keys, distinct)
        known = where < len(self.keys)
        known[known] = self.keys[where[known]] == distinct[known]
        if not known.all():
            raw = data.tobytes()
            new = example[~known]
            pieces = [raw[a:b] for a, b in zip(starts[new], ends[new], strict=True)]
            before = len(self.keys)
            self._learn(distinct[~known], pieces)
            if len(self.keys) != before + len(pieces):  # the table was emptied
                old = example[known]
                pieces = [raw[a:b] for a, b in zip(starts[old], ends[old], strict=True)]
                self._learn(distinct[known], pieces)
            where = np.searchsorted(self.keys, distinct)
        at = where[back]
        count = self.count[at]
        total = np.cumsum(count)
        ids = self.ids[
            np.repeat(self.place[at] - (total - count), count) + np.arange(total[-1])
        ]
        upto = np.append(0, total)[np.searchsorted(starts, bounds)]
        return ids, np.diff(upto)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_rows(
    data: np.ndarray, bounds: np.ndarray, path: str, end_id: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows with the end id after each row; bounds of the rows in them."""
    ids, count = encoder(path).encode(data, bounds)
    to = np.append(0, np.cumsum(count + 1))
    out = np.full(to[-1], end_id, np.uint32)
    inside = np.ones(to[-1], bool)
    inside[to[1:] - 1] = False
    out[inside] = ids
    return out, to
