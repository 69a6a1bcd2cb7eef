"""Operator 8: token counts that follow edits without encoding whole texts again.

A document is kept as a list of leaves, runs of whole space-delimited units, whose token counts add up because every leaf
begins at a space that begins a pre-token whatever stands before it. Two segment trees over the leaves hold the sums of
characters and of tokens. An edit finds its leaves by descending the first tree, rewrites them, and takes a neighbour in
only where a border is no longer such a space; the new text is encoded, and the sums on the paths to the root change. A
leaf that has grown long is cut again.

Edits are structs (at, removed, inserted): from code point ``at`` of the text as it then is, ``removed`` code points give
way to ``inserted``. They are applied in order, clipped to the text; nulls count as 0 and as empty. A null or empty text has no
tokens and can be edited. Repeated rows are counted each.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices
from .units import begins

LEAF_UNITS = 48
# A leaf longer than this, in characters, is cut again.
LONG_LEAF = 4000

EDITS = "array<struct<at:long,removed:long,inserted:string>>"
COUNTED = (
    "doc_id long, n_edits long, n_tokens_before long, n_tokens_after long, n_chars_after long, "
    "n_chars_encoded long, text_after string"
)


@functools.cache
def encoder(ranks_file: str, pattern: str):
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def leaves_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[list[str]]:
    """The leaves of each text of a slice."""
    at = begins(data, offsets)
    raw = data.tobytes()
    for a, b, end in zip(np.searchsorted(at, offsets[:-1]), np.searchsorted(at, offsets[1:]), offsets[1:], strict=True):
        edges = [*at[a:b:LEAF_UNITS].tolist(), int(end)]
        yield [raw[x:y].decode() for x, y in zip(edges[:-1], edges[1:], strict=True)] if b > a else []


def cut(text: str) -> list[str]:
    data = np.frombuffer(text.encode(), np.uint8)
    return next(leaves_of(data, np.array([0, len(data)]))) if len(data) else []


def firm(left: str, right: str) -> bool:
    """Whether two neighbours may be encoded apart."""
    return not left[-1].isspace() and len(right) > 1 and right[0] == " " and not right[1].isspace()


class CountTree:
    """Leaves with sums of characters and tokens over them."""

    def __init__(self, leaves: list[str], counts: list[int], count: Callable[[str], int]):
        self.count, self.encoded = count, 0
        self._build(leaves, counts)

    def _build(self, leaves: list[str], counts: list[int]) -> None:
        self.leaves = leaves or [""]
        self.base = 1 << (len(self.leaves) - 1).bit_length()
        rest = [0] * (self.base - len(self.leaves))
        self.chars = [0] * self.base + [len(x) for x in self.leaves] + rest
        self.tokens = [0] * self.base + (list(counts) or [0]) + rest
        for i in range(self.base - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def _find(self, at: int) -> tuple[int, int]:
        """Leaf and offset of a character; the end of the text is in the last leaf that holds any."""
        i = 1
        while i < self.base:
            i *= 2
            if at > self.chars[i] or (at == self.chars[i] and self.chars[i + 1]):
                at -= self.chars[i]
                i += 1
        return i - self.base, at

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        i = leaf + self.base
        chars, more = len(text) - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += chars
            self.tokens[i] += more
            i //= 2

    def _neighbour(self, leaf: int, step: int) -> int | None:
        leaf += step
        while 0 <= leaf < len(self.leaves):
            if self.leaves[leaf]:
                return leaf
            leaf += step
        return None

    def edit(self, at: int, removed: int, inserted: str) -> None:
        at = min(max(at, 0), self.n_chars)
        low, begin = self._find(at)
        high, end = self._find(min(at + max(removed, 0), self.n_chars))
        text = self.leaves[low][:begin] + inserted + self.leaves[high][end:]
        if text:
            while (left := self._neighbour(low, -1)) is not None and not firm(self.leaves[left], text):
                low, text = left, self.leaves[left] + text
            while (right := self._neighbour(high, 1)) is not None and not firm(text, self.leaves[right]):
                high, text = right, text + self.leaves[right]
        self.encoded += len(text)
        if len(text) > LONG_LEAF and len(fresh := cut(text)) > 1:
            tokens = self.tokens[self.base :]
            self._build(
                self.leaves[:low] + fresh + self.leaves[high + 1 :],
                tokens[:low] + [self.count(x) for x in fresh] + tokens[high + 1 : len(self.leaves)],
            )
            return
        for leaf in range(low + 1, high + 1):
            self._set(leaf, "", 0)
        self._set(low, text, self.count(text) if text else 0)

    def text(self) -> str:
        return "".join(self.leaves)


def trees(docs: DataFrame, ranks_file: str, pattern: str, *, key: str = "doc_id", text: str = "text", edits: str | None = None) -> DataFrame:
    """doc_id, leaves, counts of every row, and the column ``edits`` where one is named. Can be stored and edited later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_file, pattern).encode_ordinary
        for batch in batches:
            for start, stop, data, offsets in slices(batch, "text"):
                leaves = list(leaves_of(data, offsets))
                counts = [[len(encode(x)) for x in row] for row in leaves]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), pa.array(leaves, pa.list_(pa.string())),
                     pa.array(counts, pa.list_(pa.int64())), batch.column("edits").slice(start, stop - start)],
                    names=["doc_id", "leaves", "counts", "edits"],
                )

    given = F.col(edits).cast(EDITS) if edits else F.lit(None).cast(EDITS)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), given.alias("edits"))
    return rows.mapInArrow(run, f"doc_id long, leaves array<string>, counts array<long>, edits {EDITS}")


def with_edits(stored: DataFrame, edits: DataFrame) -> DataFrame:
    """Stored trees with the edits of a table (doc_id, seq, at, removed, inserted), in the order of ``seq``."""
    lists = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "at", "removed", "inserted"))).alias("e"))
    lists = lists.select("doc_id", F.transform("e", lambda x: F.struct(x.at.alias("at"), x.removed.alias("removed"), x.inserted.alias("inserted"))).cast(EDITS).alias("edits"))
    return stored.drop("edits").join(lists, "doc_id", "left")


def counted(stored: DataFrame, ranks_file: str, pattern: str, *, keep_text: bool = False) -> DataFrame:
    """doc_id, n_edits, n_tokens_before, n_tokens_after, n_chars_after, n_chars_encoded and, if asked for, text_after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_file, pattern).encode_ordinary
        names = ["n_edits", "n_tokens_before", "n_tokens_after", "n_chars_after", "n_chars_encoded"]
        for batch in batches:
            out = {name: [] for name in names}
            texts = []
            for leaves, counts, edits in zip(*(batch.column(c) for c in ("leaves", "counts", "edits")), strict=True):
                tree = CountTree(leaves.as_py() or [], counts.as_py() or [], lambda t: len(encode(t)))
                out["n_tokens_before"].append(tree.n_tokens)
                edits = edits.as_py() or []
                for e in edits:
                    tree.edit(e["at"] or 0, e["removed"] or 0, e["inserted"] or "")
                out["n_edits"].append(len(edits))
                out["n_tokens_after"].append(tree.n_tokens)
                out["n_chars_after"].append(tree.n_chars)
                out["n_chars_encoded"].append(tree.encoded)
                texts.append(tree.text() if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(out[n], pa.int64()) for n in names), pa.array(texts, pa.string())],
                names=["doc_id", *names, "text_after"],
            )

    rows = stored.select("doc_id", "leaves", "counts", "edits").mapInArrow(run, COUNTED)
    return rows if keep_text else rows.drop("text_after")


def revision(key: Column, text: Column, source: Column) -> Column:
    """The edits of the registered query, by code point of the original text: a span is blanked out, a longer one is
    deleted, a line that names the source is added, and the first words are repeated at a place in the middle."""
    n = F.char_length(F.coalesce(text, F.lit("")))

    def place(name: str) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(name)), n + 1)

    def edit(at: Column, removed: Column, inserted: Column) -> Column:
        return F.struct(at.cast("long").alias("at"), removed.cast("long").alias("removed"), inserted.alias("inserted"))

    return F.array(
        edit(place("blank"), F.lit(24), F.lit("[REMOVED]")),
        edit(place("delete"), F.pmod(F.xxhash64(key), F.lit(400)), F.lit("")),
        edit(n, F.lit(0), F.concat(F.lit("\nSource: "), F.coalesce(source, F.lit("unknown")))),
        edit(place("repeat"), F.lit(0), F.substring(F.coalesce(text, F.lit("")), 1, 60)),
    )
