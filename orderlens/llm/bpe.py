"""Operator 10: byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of symbols. Every neighbouring pair that is a token stands in the bucket of its rank; a
two-level bitmap says which buckets hold entries, so that find-first-set gives the next rank without a heap over all
pairs. Entries whose pair has changed meanwhile are recognised by the rank now noted at their position and skipped. The
work is nearly linear in the length of a pre-token, however long it is. Pre-tokens do not touch one another, so one queue
serves many of them at once, and the search for the next rank is shared.

Ranks, pattern and file are parameters; no tokenizer is trained. Null text counts as empty and encodes to no ids.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, give_back, slices
from .units import MEMO_ENTRIES, SLICE, Memo, encode_texts, joinable

LEAF_BITS = 8
# Bytes of new pre-tokens that share one queue.
QUEUE_BYTES = 1 << 19
# Pre-tokens remembered in each generation of a worker.
PIECES = 200_000


def first_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """Rank of each token of two bytes, by its bytes as a number; -1 for none."""
    table = np.full(1 << 16, -1, np.int64)
    for token, r in ranks.items():
        if len(token) == 2:
            table[token[0] << 8 | token[1]] = r
    return table


def merge(pieces: list[bytes], ranks: dict[bytes, int], pairs: np.ndarray) -> list[bytes]:
    """The ids of each pre-token, little-endian. In each, always the leftmost pair of lowest rank is merged."""
    text = b"".join(pieces)
    n = len(text)
    find = ranks.get
    raw = np.frombuffer(text, np.uint8).astype(np.int64)
    starts = np.cumsum([0, *map(len, pieces)])
    edge = np.zeros(n + 1, bool)  # begins of pre-tokens
    edge[starts] = True
    border = edge.tobytes()
    stop = list(range(1, n + 1))  # end of the symbol that begins at a position
    back = list(range(-1, n - 1))  # begin of the symbol before it
    begun = np.full(n, -1, np.int64)
    begun[:-1] = np.where(edge[1:-1], -1, pairs[raw[:-1] << 8 | raw[1:]])
    noted = begun.tolist()  # rank of the pair that begins at a position, -1 for none
    symbols = np.array([ranks[bytes([i])] for i in range(256)])[raw].tolist()
    held = np.flatnonzero(begun >= 0)
    held = held[np.argsort(begun[held], kind="stable")]
    found, at = np.unique(begun[held], return_index=True)
    edges = [*at.tolist(), len(held)]
    places = held.tolist()
    buckets = {r: places[a:b] for r, a, b in zip(found.tolist(), edges[:-1], edges[1:], strict=True)}
    leaves: dict[int, int] = {}
    top = 0
    for r in buckets:
        c = r >> LEAF_BITS
        leaves[c] = leaves.get(c, 0) | 1 << (r & 255)
        top |= 1 << c
    while top:
        c = (top & -top).bit_length() - 1
        leaf = leaves[c]
        rank = lowest = c << LEAF_BITS | (leaf & -leaf).bit_length() - 1
        bucket = buckets.pop(rank)
        bucket.sort()
        used = 0
        for i in bucket:
            used += 1
            if noted[i] != rank:
                continue
            middle = stop[i]
            end = stop[i] = stop[middle]
            symbols[i] = rank
            symbols[middle] = -1
            noted[middle] = r = -1
            if not border[end]:
                back[end] = i
                r = find(text[i : stop[end]], -1)
            noted[i] = r
            if r >= 0:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    c = r >> LEAF_BITS
                    leaves[c] = leaves.get(c, 0) | 1 << (r & 255)
                    top |= 1 << c
                    if r < lowest:
                        lowest = r
            if not border[i]:
                first = back[i]
                noted[first] = r = find(text[first:end], -1)
                if r >= 0:
                    if r in buckets:
                        buckets[r].append(first)
                    else:
                        buckets[r] = [first]
                        c = r >> LEAF_BITS
                        leaves[c] = leaves.get(c, 0) | 1 << (r & 255)
                        top |= 1 << c
                        if r < lowest:
                            lowest = r
            if lowest < rank:
                break
        if used < len(bucket):
            buckets[rank] = bucket[used:]  # a merge made a pair of lower rank, which comes first
        else:
            c = rank >> LEAF_BITS
            leaves[c] &= ~(1 << (rank & 255))
            if not leaves[c]:
                top &= ~(1 << c)
    ids = np.array(symbols)
    alive = ids >= 0
    sizes = np.add.reduceat(alive, starts[:-1], dtype=np.int64)
    ends = (np.cumsum(sizes) * 4).tolist()
    packed = ids[alive].astype("<u4").tobytes()
    return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class Codec:
    """Encodes texts to little-endian 32-bit ids and back, by the ranks of one file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, units: int = MEMO_ENTRIES, pieces: int = PIECES):
        self.ranks, self.pairs = ranks, first_pairs(ranks)
        self.split = regex.compile(pattern).findall
        # Bytes of the tokens by id, and which ids there are.
        self.known = np.zeros(max(ranks.values(), default=-1) + 1, bool)
        table = [b""] * len(self.known)
        for token, r in ranks.items():
            table[r], self.known[r] = token, True
        self.tokens = pa.array(table, pa.large_binary())
        # Whether a space and letters are one pre-token.
        self.words = r" ?\p{L}+" in pattern
        self.pieces = Memo(self._merged, pieces)
        self.units = Memo(self._encoded, units)

    def forget(self) -> None:
        """Gives the memory of both memos back."""
        self.units.forget()
        self.pieces.forget()
        give_back()

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """A pre-token that is a token is one id; the others go through the queue, a run of them at a time."""
        out = [self.ranks[p].to_bytes(4, "little") if p in self.ranks else None for p in pieces]
        run, size = [], 0
        for i, ids in enumerate(out):
            if ids is None:
                run.append(i)
                size += len(pieces[i])
            if run and (size >= QUEUE_BYTES or i == len(out) - 1):
                for j, merged in zip(run, merge([pieces[j] for j in run], self.ranks, self.pairs), strict=True):
                    out[j] = merged
                run, size = [], 0
        return out

    def _is_word(self, unit: bytes) -> bool:
        """Whether the unit is a space and Latin letters, and so one pre-token."""
        if unit[:1] != b" ":
            return False
        if unit[1:].isalpha():  # of bytes: ASCII
            return True
        letters = unit[1:].decode()
        return letters.isalpha() and max(letters) < "\u0250"

    def _encoded(self, units: list[bytes]) -> list[bytes]:
        """Units of one word are pre-tokens, remembered as units alone; of the others, those that may stand together are
        split as one text."""
        word = [self.words and self._is_word(u) for u in units]
        out = [b""] * len(units)
        whole = [i for i, w in enumerate(word) if w]
        for i, ids in zip(whole, self._merged([units[i] for i in whole]), strict=True):
            out[i] = ids
        rest = [i for i, w in enumerate(word) if not w]
        together = [i for i in rest if joinable(units[i])]
        alone = sorted(set(rest).difference(together))
        split = [p.encode() for p in self.split(b"".join(units[i] for i in together).decode())]
        ends = np.cumsum([len(units[i]) for i in together])
        ends = np.searchsorted(np.cumsum([len(p) for p in split]), ends, "left") + 1
        parts = [split[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)] if together else []
        for i in alone:
            parts.append([p.encode() for p in self.split(units[i].decode())])
        wanted = list(dict.fromkeys(p for pieces in parts for p in pieces))
        known = dict(zip(wanted, self.pieces.values(wanted), strict=True))
        for i, pieces in zip(together + alone, parts, strict=True):
            out[i] = known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[pa.Buffer | None, np.ndarray]:
        """The bytes that rows of ids stand for, back to back, and the offsets of the rows in them."""
        if not (ids < len(self.known)).all() or not self.known[ids].all():
            raise ValueError("an id that the ranks do not have")
        found = self.tokens.take(pa.array(ids))
        ends = np.frombuffer(found.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        return found.buffers()[2], ends[offsets]


@functools.cache
def codec(ranks_file: str, pattern: str, units: int = MEMO_ENTRIES, pieces: int = PIECES) -> Codec:
    """Read in each worker, where the file lies as on the driver."""
    with open(ranks_file, "rb") as lines:
        pairs = (line.split() for line in lines)
        return Codec({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern, units, pieces)


def _ids_of(texts: pa.Array, known: Codec, slice_bytes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of runs of texts of about ``slice_bytes``: their number, the ids back to back, and the offsets of the texts in them."""
    rows = pa.RecordBatch.from_arrays([texts], names=["text"])
    for start, stop, data, offsets in slices(rows, "text", slice_bytes):
        yield stop - start, *encode_texts(data, offsets, known.units)


def _binary(n: int, offsets: np.ndarray, data: object) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32)), data])


def encode(
    text: Column,
    ranks_file: str,
    pattern: str,
    *,
    units: int = MEMO_ENTRIES,
    pieces: int = PIECES,
    slice_bytes: int = SLICE,
    keep: bool = True,
) -> Column:
    """A struct of ``ids``, those of each text as little-endian unsigned 32-bit integers, and ``decoded``, the bytes that
    these ids stand for. One worker does both, so a task needs the tables of the codec once.

    ``units`` and ``pieces`` are what a worker remembers in each generation, ``slice_bytes`` the text whose units it looks
    up together, and ``keep`` whether it remembers beyond a task; they change its memory and speed, not the ids.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = codec(ranks_file, pattern, units, pieces)
        try:
            for texts in batches:
                for n, ids, at in _ids_of(texts, known, slice_bytes):
                    raw, ends = known.decode(ids, at)
                    yield pa.StructArray.from_arrays(
                        [_binary(n, at * 4, pa.py_buffer(ids)), _binary(n, ends, raw)], names=["ids", "decoded"]
                    )
        finally:
            if keep:
                give_back()
            else:
                known.forget()

    return F.arrow_udf(run, "ids binary, decoded binary")(text)


def encoded(
    docs: DataFrame,
    ranks_file: str,
    pattern: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    units: int = MEMO_ENTRIES,
    pieces: int = PIECES,
    slice_bytes: int = SLICE,
    keep: bool = True,
) -> DataFrame:
    """key, ids, decoded for every row of ``docs``; repeated rows are encoded each, other columns are not read.

    An empty or null text has empty ids. A null key stays null.
    """
    bounded_batches(docs.sparkSession)
    both = encode(F.col(text), ranks_file, pattern, units=units, pieces=pieces, slice_bytes=slice_bytes, keep=keep)
    return docs.select(F.col(key), both.alias("_both")).select(key, "_both.ids", "_both.decoded")


def digests(rows: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 from the ids and decoded bytes."""
    return rows.select(
        key,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
