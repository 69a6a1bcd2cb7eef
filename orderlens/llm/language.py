"""Operator 4: language identification by rank-order profiles of n-grams.

A profile lists the most frequent n-grams (one to three letters, words padded with a space, lower case) of a language by
rank. A document's own most frequent n-grams are ranked in the same way, and the out-of-place distance to a profile is
the sum of the differences of ranks, with the longest distance for an n-gram that the profile lacks. The nearest profile
wins, ties go to the smaller language name. Digits, punctuation and white space only separate words.

Profiles are learned from a bounded sample of labelled rows per language (``SAMPLE_ROWS`` in expectation, chosen by a hash
of the id); prediction reads every row and its whole text. A text that is null or has no letter is ``und`` with score 0, and so is every text
when nothing could be learned. The score is one minus the distance as a share of the largest possible one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, give_back

PROFILE = 300
SAMPLE_ROWS = 1500
NONE = "und"
# Characters whose n-grams are sorted together.
SLICE_CHARS = 1 << 20
# A code point takes 18 bits, as no letter lies above; three of them and the number of a row in its slice fit 64 bits.
BITS = 18
ROW_BITS = 7


@functools.cache
def _letters() -> np.ndarray:
    """For each code point below 2**18 whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(1 << BITS)), bool, 1 << BITS)


def code_points(text: str) -> np.ndarray:
    """The lower-case text as code points, with 32 for everything that is no letter, and one at either end."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    out = np.full(len(raw) + 2, 32, np.uint64)
    small = np.minimum(raw, (1 << BITS) - 1)
    out[1:-1] = np.where(_letters()[small] & (raw < 1 << BITS), raw, 32)
    return out


def ngrams(points: np.ndarray) -> np.ndarray:
    """All n-grams as integers: letters, pairs and triples, none with a space inside or only of spaces."""
    space = points == 32
    two = points[:-1] << np.uint64(BITS) | points[1:]
    three = two[:-1] << np.uint64(BITS) | points[2:]
    ones = points[~space]
    twos = two[~(space[:-1] & space[1:])]
    threes = three[~space[1:-1]]
    return np.concatenate((ones, twos, threes))


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, n-gram and count of every distinct n-gram of each text, sorted by row and n-gram. At most 512 texts."""
    rows, grams, counts = [], [], []
    size, pending = 0, []

    def flush() -> None:
        if pending:
            found, n = np.unique(np.concatenate(pending), return_counts=True)
            rows.append((found >> np.uint64(3 * BITS)).astype(np.int64))
            grams.append(found & np.uint64((1 << 3 * BITS) - 1))
            counts.append(n)
            pending.clear()

    for row, text in enumerate(texts):
        # A very long text is counted in pieces that share two characters, so that memory stays bounded.
        points = code_points(text)
        for at in range(0, len(points), SLICE_CHARS):
            piece = points[max(0, at - 2) : at + SLICE_CHARS]
            found = ngrams(piece)
            if at:  # what lies within the two shared characters was counted before
                found = _without(found, ngrams(piece[:2]))
            pending.append(found | np.uint64(row) << np.uint64(3 * BITS))
            size += len(piece)
            if size >= SLICE_CHARS:
                flush()
                size = 0
    flush()
    if not rows:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none
    row, gram, count = np.concatenate(rows), np.concatenate(grams), np.concatenate(counts)
    if len(rows) > 1:
        order = np.lexsort((gram, row))
        row, gram, count = row[order], gram[order], count[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
        at = np.flatnonzero(new)
        row, gram, count = row[at], gram[at], np.add.reduceat(count, at) if len(at) else count
    return row, gram, count


def _without(grams: np.ndarray, doubles: np.ndarray) -> np.ndarray:
    """The n-grams less one occurrence of each double."""
    keep = np.ones(len(grams), bool)
    for g in doubles.tolist():
        keep[np.flatnonzero(keep & (grams == np.uint64(g)))[:1]] = False
    return grams[keep]


@dataclass(frozen=True)
class Profiles:
    """Languages by name, and for every n-gram of any profile its rank in each (``PROFILE`` where it is missing)."""

    names: list[str]
    grams: np.ndarray
    ranks: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for at in range(0, len(texts), 1 << ROW_BITS):
            some = texts[at : at + (1 << ROW_BITS)]
            n, s = self._predict(some)
            names += n
            scores += s
        return names, scores

    def _predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        row, gram, count = counted(texts)
        if not self.names or not len(row):
            return [NONE] * len(texts), [0.0] * len(texts)
        order = np.lexsort((gram, -count, row))
        row, gram = row[order], gram[order]
        first = np.searchsorted(row, np.arange(len(texts)))
        rank = np.arange(len(row)) - first[row]
        top = rank < PROFILE
        row, gram, rank = row[top], gram[top], rank[top]
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        known = self.grams[at] == gram
        places = np.where(known[:, None], self.ranks[at], PROFILE)
        apart = np.where(places < PROFILE, np.abs(places - rank[:, None]), PROFILE)
        distance = np.zeros((len(texts), len(self.names)))
        np.add.at(distance, row, apart)
        used = np.bincount(row, minlength=len(texts))
        best = distance.argmin(axis=1)
        worst = np.maximum(used * PROFILE, 1)
        score = np.where(used > 0, 1 - distance[np.arange(len(texts)), best] / worst, 0.0)
        return [self.names[b] if u else NONE for b, u in zip(best, used, strict=True)], np.clip(score, 0, 1).tolist()


def learn(labelled: DataFrame, *, key: str, text: str, label: str, sample_rows: int = SAMPLE_ROWS) -> Profiles:
    """Profiles from rows whose label is not null. The driver gets ``PROFILE`` n-grams of each language, no more."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    names = sorted(sizes)
    if not names:
        return Profiles([], np.zeros(0, np.uint64), np.zeros((0, 0), np.int64))
    share = F.create_map(*[F.lit(x) for n in names for x in (n, min(1.0, sample_rows / sizes[n]))])
    # ``share`` of the range of a hash; a language with fewer rows than the bound is taken whole.
    chance = F.shiftrightunsigned(F.xxhash64("key", F.lit("sample")), 11) / F.lit(float(1 << 53))
    sample = rows.where(chance < share[F.col("label")]).select("label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_pylist()
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), 1 << ROW_BITS):
                row, gram, n = counted(texts[at : at + (1 << ROW_BITS)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([labels[at + r] for r in row.tolist()], pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)],
                    names=["label", "gram", "n"],
                )

    sums = sample.mapInArrow(count, "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "gram"))
    top = sums.withColumn("rank", place - 1).where(F.col("rank") < PROFILE).collect()
    names = sorted({r["label"] for r in top})
    grams = np.unique(np.array([r["gram"] for r in top], np.uint64))
    ranks = np.full((len(grams), len(names)), PROFILE, np.int64)
    for r in top:
        ranks[np.searchsorted(grams, np.uint64(r["gram"])), names.index(r["label"])] = r["rank"]
    return Profiles(names, grams, ranks)


def predict(text: Column, profiles: Profiles) -> Column:
    """A struct of ``lang`` and ``score`` for each text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = profiles.predict([t or "" for t in texts.to_pylist()])
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])
        give_back()  # what a worker keeps is missing in the stages after this one

    return F.arrow_udf(run, "lang string, score double")(text)


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: checksum of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, with profiles learned from the labelled rows not held out."""
    profiles = learn(docs.where(~held_out(F.col(key))), key=key, text=text, label=label)
    rows = docs.select(F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out"), predict(F.col(text), profiles).alias("p"))
    return rows.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
