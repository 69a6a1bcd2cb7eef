"""Operator 11: alignment of two tokenizers' tokens over exact-text deduplicated documents.

Tokenizer A is a byte-level BPE of the tokenizers library and gets a space and the text; tokenizer B is a sentencepiece
model and gets the text, before which it puts the space itself. Both are laid over the same bytes: where a token of A and
a token of B end at the same byte, a group ends; an A and a B token are linked if their byte ranges overlap.

Documents are shuffled by their full text, and each distinct text is tokenised and aligned once. Its links, folded to one
row per pair of ids, are weighted by the number of documents with this text and summed to the corpus count of every pair.
A bounded number of the most frequent pairs (``HOT_PAIRS``) is sent to all tasks, which settles most links of a text where
they lie; the links of all other pairs meet their counts in a join on the pair. The measures of a text are joined to its
documents by its SHA-256.

Within a text, tokens are found by space-delimited units, which a worker remembers: no token of either tokenizer crosses
the begin of a unit (for B this is checked on its pieces; where it does not hold, a text is one unit).

Null, empty texts, and texts whose joined tokens of A or B give other bytes than a space and the text (such as a text with
U+2581, which B takes for a space) have no tokens: zeros, and an empty string for the digest. The strings of special
tokens are plain text. Rows that repeat an id are documents of their own, null ids stay, other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, give_back, slices, staged
from .units import Memo, begins, joinable

# Most frequent pairs that every task holds: 16 bytes and a flag each.
HOT_PAIRS = 1 << 18
# Units remembered in each generation of a worker, and text looked up at once.
UNITS = 300_000
SLICE_BYTES = 1 << 20
# Units that the tokenizers get as one text.
JOINED = 512

ALIGNED = (
    "sha string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<int>, times array<int>"
)


#: Alignment of one unit: numbers of tokens of A, of B, of groups, the linked pairs as 32-bit integers, the groups as text.
Unit = tuple[int, int, int, bytes, bytes]


class Aligner:
    """Tokenises with both libraries and aligns. A pair is the number of A's id times ``width`` plus B's id."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer, decoders

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        alphabet = byte_alphabet()
        self.a_bytes = {i: bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
                        for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.b_bytes = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes[i] = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
        self.width = self.b.get_piece_size()
        if (max(self.a_bytes) + 1) * self.width >= 1 << 32:
            raise ValueError("vocabularies too large for 32-bit pairs")
        # Whether no piece has a space behind another character, so that no piece crosses the begin of a unit.
        self.cuts = not any("▁" in p.lstrip("▁") for p in map(self.b.id_to_piece, range(self.width)))
        self.a_size, self.b_size = _sizes(self.a_bytes), _sizes(self.b_bytes)
        self.memo = Memo(self.aligned, UNITS)

    def tokens(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units by A and by B, back to back. Units that may stand together are encoded as one text."""
        runs: list[list[bytes]] = []
        open_ = False
        for unit in units:
            if self.cuts and joinable(unit):
                if not open_ or len(runs[-1]) == JOINED:
                    runs.append([])
                runs[-1].append(unit)
                open_ = True
            else:
                runs.append([unit])
                open_ = False
        texts = [b"".join(run).decode() for run in runs]
        a = [row.ids for row in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        return np.array([*chain.from_iterable(a)], np.int64), np.array([*chain.from_iterable(b)], np.int64)

    def aligned(self, units: list[bytes]) -> list[Unit | None]:
        """Each unit's alignment, None where the bytes of the tokens are not the unit. Units begin with a space."""
        if not units:
            return []
        ids_a, ids_b = self.tokens(units)
        raw = b"".join(units)
        if b"".join(map(self.b_bytes.__getitem__, ids_b.tolist())) != raw or b"".join(map(self.a_bytes.__getitem__, ids_a.tolist())) != raw:
            if len(units) == 1:
                return [None]
            half = len(units) // 2
            return self.aligned(units[:half]) + self.aligned(units[half:])
        end_a, end_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        # The tokens of B that overlap a token of A are those from the first that ends after its begin.
        first = np.searchsorted(end_b, end_a - self.a_size[ids_a], "right")
        last = np.searchsorted(end_b, end_a, "left")
        count = last - first + 1
        upto = np.cumsum(count)
        place = np.repeat(first - (upto - count), count) + np.arange(upto[-1])
        pairs = (np.repeat(ids_a, count) * self.width + ids_b[place]).astype("<u4").tobytes()
        both_a = end_b[last] == end_a
        both_b = end_a[np.searchsorted(end_a, end_b, "left")] == end_b
        ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        to_a = np.searchsorted(end_a, ends, "left") + 1
        to_b = np.searchsorted(end_b, ends, "left") + 1
        to_g = np.cumsum(both_a)[to_a - 1]
        to_p = (4 * upto[to_a - 1]).tolist()
        groups = [*map("|".join, zip(_groups(ids_a, both_a), _groups(ids_b, both_b), strict=True))]
        n_a, n_b, n_g = (np.diff(x, prepend=0).tolist() for x in (to_a, to_b, to_g))
        stops = to_g.tolist()
        return [
            (na, nb, ng, pairs[p0:p1], ";".join(groups[g1 - ng : g1]).encode())
            for na, nb, ng, p0, p1, g1 in zip(n_a, n_b, n_g, [0, *to_p[:-1]], to_p, stops, strict=True)
        ]

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """For the texts of a slice: n_a, n_b, n_groups, n_links as rows of one array; digests; and the distinct pairs of
        all texts back to back, how often each occurs, and the offsets of the texts in them."""
        n = len(offsets) - 1
        full = np.diff(offsets) > 0
        # A space before every text that is not empty.
        spread = np.full(len(data) + int(full.sum()), 32, np.uint8)
        shift = np.cumsum(full)
        spread[np.arange(len(data)) + np.repeat(shift, np.diff(offsets))] = data
        edges = offsets + np.concatenate(([0], shift))
        begin = begins(spread, edges) if self.cuts else edges[:-1][full]
        if not len(begin):
            return np.zeros((4, n), np.int64), [""] * n, _NONE, np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
        cut = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(spread)).astype(np.int64)), pa.py_buffer(spread)]
        ).dictionary_encode()
        known = self.memo.values(cut.dictionary.to_pylist())
        index = cut.indices.to_numpy()
        wrong = np.fromiter((u is None for u in known), bool, len(known))
        n_a, n_b, n_g, packed, groups = zip(*[u or (0, 0, 0, b"", b"") for u in known], strict=True)
        n_p = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        bounds = np.searchsorted(begin, edges)
        row = np.repeat(np.arange(n), np.diff(bounds))
        # A text with a wrong unit has no tokens at all.
        bad = np.zeros(n, bool)
        bad[row[wrong[index]]] = True
        good = ~bad[row]
        index, row = index[good], row[good]
        bounds = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n))))
        measures = np.zeros((4, n), np.int64)
        for k, values in enumerate((n_a, n_b, n_g, n_p)):
            sums = np.concatenate(([0], np.cumsum(np.array(values, np.int64)[index])))
            measures[k] = sums[bounds[1:]] - sums[bounds[:-1]]
        count = n_p[index]
        upto = np.cumsum(count)
        total = int(upto[-1]) if len(upto) else 0
        flat = np.frombuffer(b"".join(packed), "<u4")
        place = np.repeat((np.cumsum(n_p) - n_p)[index] - (upto - count), count) + np.arange(total)
        keys = np.repeat(row, count).astype(np.uint64) << np.uint64(32) | flat[place]
        keys.sort()
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if total else np.zeros(0, np.int64)
        times = np.diff(np.append(new, total))
        distinct = keys[new]
        ends = np.searchsorted(distinct >> np.uint64(32), np.arange(n + 1, dtype=np.uint64))
        order, stops = index.tolist(), bounds.tolist()
        digests = [
            hashlib.sha256(b";".join([groups[j] for j in order[a:b]])).hexdigest() if b > a else ""
            for a, b in zip(stops[:-1], stops[1:], strict=True)
        ]
        return measures, digests, distinct.astype(np.uint32), times, ends


_NONE = np.zeros(0, np.uint32)


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the others are
    numbered from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _sizes(table: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(max(table) + 1, np.int64)
    for i, raw in table.items():
        out[i] = len(raw)
    return out


def _groups(ids: np.ndarray, ends: np.ndarray) -> list[str]:
    """The ids of each group, joined by commas; ``ends`` marks the last of a group."""
    words = [*map(str, ids.tolist())]
    stops = (np.flatnonzero(ends) + 1).tolist()
    return [",".join(words[a:b]) if b - a > 1 else words[a] for a, b in zip([0, *stops[:-1]], stops, strict=True)]


@functools.cache
def aligner(a_file: str, b_file: str) -> Aligner:
    return Aligner(a_file, b_file)


def _align(a_file: str, b_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(a_file, b_file)
        try:
            for batch in batches:
                for start, stop, data, offsets in slices(batch, "text", SLICE_BYTES):
                    measures, digests, pairs, times, ends = known.texts(data, offsets)
                    ends = pa.array(ends.astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("sha").slice(start, stop - start), batch.column("copies").slice(start, stop - start),
                            *map(pa.array, measures), pa.array(digests, pa.string()),
                            pa.ListArray.from_arrays(ends, pa.array(pairs.view(np.int32))),
                            pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                        ],
                        names=["sha", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                    )
        finally:
            known.memo.forget()
            give_back()

    return run


def aligned_texts(docs: DataFrame, a_file: str, b_file: str, *, text: str = "text") -> DataFrame:
    """One row per distinct text that is not null or empty: its digest, copies, measures and linked pairs."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text")).where(F.octet_length("text") > 0)
    distinct = rows.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    return distinct.select(F.sha2("text", 256).alias("sha"), "copies", "text").mapInArrow(_align(a_file, b_file), ALIGNED)


def pair_counts(texts: DataFrame, width: int) -> DataFrame:
    """pair, n (links of the corpus that hold it), best (whether no other pair of its B id has more)."""
    each = texts.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    sums = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("copies") * F.col("p.times")).alias("n"))
    sums = staged(sums, "pairs")
    # The pair is an unsigned number in a signed column.
    b = F.pmod(F.col("pair").cast("long"), F.lit(1 << 32)) % width
    top = sums.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return staged(sums.withColumn("b", b).join(top, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair_counts")


def _settle(hot):
    """Adds up the links of hot pairs; what is left of a text are its other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = hot.value
        for batch in batches:
            column = batch.column("pairs")
            have, times = column.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            edges = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
            at = np.minimum(np.searchsorted(pairs, have), max(len(pairs) - 1, 0))
            met = pairs[at] == have if len(pairs) else np.zeros(len(have), bool)
            done = np.zeros((2, len(have) + 1), np.int64)
            done[0, 1:] = np.cumsum(np.where(met, best[at], False) * times) if len(pairs) else 0
            done[1, 1:] = np.cumsum(np.where(met, n[at], 0) * times) if len(pairs) else 0
            left = np.concatenate(([0], np.cumsum(~met)))[edges]
            ends = pa.array(left.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("sha"), pa.array(done[0][edges[1:]] - done[0][edges[:-1]]),
                    pa.array(done[1][edges[1:]] - done[1][edges[:-1]]),
                    pa.ListArray.from_arrays(ends, pa.array(have[~met])),
                    pa.ListArray.from_arrays(ends, pa.array(times[~met].astype(np.int32))),
                ],
                names=["sha", "n_best", "count_sum", "pairs", "times"],
            )

    return run


def aligned(
    docs: DataFrame, a_file: str, b_file: str, *, key: str = "doc_id", text: str = "text", hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    spark = docs.sparkSession
    texts = staged(aligned_texts(docs, a_file, b_file, text=text), "aligned")
    counts = pair_counts(texts, aligner(a_file, b_file).width)
    top = counts.orderBy(F.desc("n"), "pair").limit(hot_pairs).toPandas().sort_values("pair")
    hot = spark.sparkContext.broadcast((top["pair"].to_numpy(np.int32), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))
    part = staged(
        texts.select("sha", "pairs", "times").mapInArrow(
            _settle(hot), "sha string, n_best long, count_sum long, pairs array<int>, times array<int>"
        ),
        "settled",
    )
    rare = part.where(F.size("pairs") > 0).select("sha", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    rare = rare.select("sha", F.col("p.pairs").alias("pair"), F.col("p.times").alias("k")).join(counts.hint("merge"), "pair")
    late = rare.select("sha", F.when(F.col("best"), F.col("k")).otherwise(0).alias("n_best"), (F.col("k") * F.col("n")).alias("count_sum"))
    sums = part.select("sha", "n_best", "count_sum").unionByName(late).groupBy("sha").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    measures = texts.select("sha", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "sha")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.when(F.octet_length(text) > 0, F.sha2(F.col(text), 256)).alias("sha"))
    found = rows.where("sha is not null").join(measures.hint("merge"), "sha")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    bare = rows.where("sha is null").select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in numbers], F.lit("").alias("groups_sha256")
    )
    return found.select("doc_id", *numbers, "groups_sha256").unionByName(bare)
