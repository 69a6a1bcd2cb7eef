"""Encoding texts by their distinct space-delimited units, which a worker remembers."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa

# Units remembered in each of two generations of a worker. When the young one is full it becomes the old one.
MEMO_ENTRIES = 500_000
MEMO_BYTES = 64
# Text whose units are looked up together.
SLICE = 5 << 20

# Bytes that may not stand beside a cut: ASCII white space and separators.
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
# First bytes of characters among which there is white space: one of them after a space forbids a cut.
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True

#: Ids of each unit of a list, as little-endian 32-bit integers.
EncodeUnits = Callable[[list[bytes]], list[bytes]]


def punctuation(names: list[str]) -> np.ndarray:
    """For each byte whether it is an ASCII punctuation mark that ends a word: none that stands in one of the ``names``,
    which may not be cut, and no apostrophe, which may stand within a word."""
    marks = np.zeros(256, bool)
    marks[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'".join(["'", *names])]] = True
    return marks


def _fine(data: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Where a mark follows a letter, and where a letter follows a lone line feed. Letters are ASCII or Latin-1 here."""
    at = np.flatnonzero(marks[data[1:]]) + 1
    last, lead = data[at - 1], data[at - 2]
    latin = (lead == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
    line = np.flatnonzero(data[1:-1] == 10) + 2
    before = data[line - 2]
    plain = (before < 128) & ~_BLANK[before]
    # The first byte of a slice has none before it.
    return np.concatenate((at[_LETTERS[last] | latin], line[plain & _LETTERS[data[line]]]))


def begins(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray | None = None) -> np.ndarray:
    """Where units begin: at the first byte of each text, and at every space between two characters that are not white
    space. Such a space begins a pre-token whatever stands around it; where this is not plain, no cut is made.

    With ``marks``, also at these marks after a letter and at letters after a lone line feed. That is right for patterns in
    which no pre-token holds a letter and such a mark after it, nor white space and a letter other than a space and it."""
    at = np.flatnonzero(data == 32)
    at = at[(at > 0) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    fit = ~(_BLANK[before] | _BLANK[after] | _LEADS[after])
    fit &= ~((data[at - 2] == 0xC2) & ((before == 0x85) | (before == 0xA0)))
    fit &= ~((before >= 0x80) & _LEADS[data[at - 3]])
    mark = np.zeros(len(data) + 1, bool)
    mark[at[fit]] = True
    if marks is not None:
        mark[_fine(data, marks)] = True
    edges = offsets[:-1][np.diff(offsets) > 0]
    mark[edges] = False
    ends = np.maximum(edges - 1, 0)
    mark[ends[data[ends] == 32]] = False  # a space that ends a text
    mark[edges] = True
    return np.flatnonzero(mark[:-1])


# A space and a character that is none, and no white space at the end; of the rest a look at the last character decides.
_PLAIN = re.compile(rb" (?:[^\x09-\x0d\x1c-\x20\xc2\xe1-\xe3].*)?[^\x09-\x0d\x1c-\x20\x80-\xff]", re.DOTALL).fullmatch


def joinable(unit: bytes) -> bool:
    """Whether such units may be put together and encoded as one text, without a change to the ids of any."""
    if _PLAIN(unit):
        return True
    last = unit[-1]
    plain = last >= 128 and not unit.decode()[-1].isspace()
    return plain and len(unit) > 1 and unit[0] == 32 and not _BLANK[unit[1]] and not _LEADS[unit[1]]


def cut_ids(ids: np.ndarray, lengths: np.ndarray, units: list[bytes]) -> list[bytes]:
    """The ids of joined units, dealt to the units by the number of bytes that each id stands for."""
    ends = np.searchsorted(np.cumsum(lengths), np.cumsum([len(u) for u in units]), "left") + 1
    raw = ids.astype("<u4").tobytes()
    return [raw[4 * a : 4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class Memo:
    """Encoded strings, with those long unused forgotten a generation at a time. Very long strings are never kept."""

    def __init__(self, encode: EncodeUnits, entries: int = MEMO_ENTRIES):
        self.encode, self.entries = encode, entries
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def forget(self) -> None:
        self.young, self.old = {}, {}

    def values(self, wanted: list[bytes]) -> list[bytes]:
        """The ids of distinct strings."""
        young, old = self.young, self.old
        out = [*map(young.get, wanted)]
        missed = [i for i, ids in enumerate(out) if ids is None]
        new = []
        for i in missed:
            out[i] = old.get(wanted[i])
            if out[i] is None:
                new.append(i)
        if len(young) + len(missed) > self.entries:
            self.old, self.young = young, {}
            missed = range(len(wanted))
        for i, ids in zip(new, self.encode([wanted[i] for i in new]), strict=True):
            out[i] = ids
        self.young.update((wanted[i], out[i]) for i in missed if len(wanted[i]) <= MEMO_BYTES)
        return out


def encode_texts(
    data: np.ndarray, offsets: np.ndarray, memo: Memo, marks: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts of a slice back to back, and the offsets of the texts in them. ``marks`` as in ``begins``."""
    at = begins(data, offsets, marks)
    if not len(at):
        return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
    edges = np.append(at, len(data)).astype(np.int64)
    cut = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
    ).dictionary_encode()
    known = memo.values(cut.dictionary.to_pylist())
    index = cut.indices.to_numpy()
    sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
    table = np.frombuffer(b"".join(known), "<u4")
    first = np.cumsum(sizes) - sizes
    count = sizes[index]
    ends = np.cumsum(count)
    place = np.repeat(first[index] - (ends - count), count) + np.arange(ends[-1])
    return table[place], np.concatenate(([0], ends))[np.searchsorted(at, offsets)]
