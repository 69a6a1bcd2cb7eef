"""Operator 3: exact deduplication of a new batch against an immutable snapshot.

The snapshot is kept as exact buckets (one row per distinct digest) and one static binary-fuse filter per bucket. A batch
is first grouped by digest, which finds its own duplicates and leaves one row per digest. These digests are screened by
the filter of their bucket; only positives join the exact buckets, by all bytes of digest and length, and of each pair found
the normalised texts of the two rows that stay on either side are compared byte by byte. Only these texts are sent.
Texts are equal when they agree after deleting white space; the digest is the SHA-256 of that text in UTF-8.

Of equal texts the row with the most code points in the original text stays, then the one with the smallest doc_id.
Null text counts as empty, and empty texts equal each other. Rows with a null doc_id lose ties against any id. Rows that
repeat a doc_id are counted each; they share their answer. An empty batch or snapshot is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, staged, text_or_empty, without_spaces

# Digests that one filter screens, about.
FILTER_KEYS = 100_000
FINGERPRINT = np.uint8


class BinaryFuse:
    """A static filter: a stored key is always found, another one with probability 1/256.

    Three cells in neighbouring segments are XORed into the key's fingerprint. Built by peeling: cells that only one key
    uses are taken off in rounds, then filled in reverse order.
    """

    def __init__(self, seed: int, segment: int, segments: int, cells: np.ndarray):
        self.seed, self.segment, self.segments, self.cells = seed, segment, segments, cells

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + np.uint64(seed))
        first = ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
        g = mix(h ^ np.uint64(0x8CB92BA72F3D8DD7))
        at = np.stack(
            [(first + i) * segment + ((g >> np.uint64(21 * i)) % np.uint64(segment)).astype(np.int64) for i in range(3)],
            axis=1,
        )
        return at, (h & np.uint64(255)).astype(FINGERPRINT)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        """``keys`` are distinct 64-bit values."""
        n = len(keys)
        # A few segments of the size that peels well; small filters get more room.
        segment = 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
        room = 1.125 if n > 10_000 else 1.4
        segments = max(1, -(-int(n * room + 64) // segment) - 2)
        for seed in range(1, 200):
            at, prints = cls._places(keys, seed * 0x9E3779B9, segment, segments)
            order = cls._peel(at, (segments + 2) * segment)
            if order is not None:
                break
            if seed % 20 == 0:
                segments += 1 + segments // 8
        else:
            raise ValueError("keys are not distinct")
        cells = np.zeros((segments + 2) * segment, FINGERPRINT)
        for keys_of_round, cell in reversed(order):
            a = at[keys_of_round]
            cells[cell] = 0
            cells[cell] = prints[keys_of_round] ^ cells[a[:, 0]] ^ cells[a[:, 1]] ^ cells[a[:, 2]]
        return cls(seed * 0x9E3779B9, segment, segments, cells)

    @staticmethod
    def _peel(at: np.ndarray, size: int) -> list | None:
        flat = at.ravel()
        use = np.bincount(flat, minlength=size)
        owner = np.bincount(flat, np.repeat(np.arange(len(at), dtype=np.float64), 3), minlength=size)
        left, order = len(at), []
        while left:
            single = np.flatnonzero(use == 1)
            keys = owner[single].astype(np.int64)
            keys, where = np.unique(keys, return_index=True)
            if not len(keys):
                return None
            order.append((keys, single[where]))
            gone = at[keys].ravel()
            use -= np.bincount(gone, minlength=size)
            owner -= np.bincount(gone, np.repeat(keys.astype(np.float64), 3), minlength=size)
            left -= len(keys)
        return order

    def find(self, keys: np.ndarray) -> np.ndarray:
        at, prints = self._places(keys, self.seed, self.segment, self.segments)
        return prints == self.cells[at[:, 0]] ^ self.cells[at[:, 1]] ^ self.cells[at[:, 2]]


@dataclass
class Snapshot:
    """exact: bucket, digest, length, best, n, one row per digest. filters: bucket, seed, segment, segments, cells."""

    exact: DataFrame
    filters: DataFrame
    buckets: int


def _keys(digests) -> np.ndarray:
    """The first eight bytes of each digest."""
    return np.frombuffer(b"".join(d[:8] for d in digests), "<u8").astype(np.uint64)


def digested(docs: DataFrame, *, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, digest, length (bytes of the normalised text), points (code points of the original), plain (that text in
    UTF-8) of every row, and the columns ``carry`` as they are."""
    plain = without_spaces(text_or_empty(text))
    return docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.unhex(F.sha2(plain.cast("binary"), 256)).alias("digest"),
        F.octet_length(plain).cast("long").alias("length"),
        F.char_length(text_or_empty(text)).cast("long").alias("points"),
        plain.cast("binary").alias("plain"),
        *carry,
    )


def _best() -> Column:
    """Largest of the points, then smallest id: struct order, with the id negated and null last."""
    return F.max(F.struct("points", (-F.col("doc_id")).alias("negative")))


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest", "length").agg(_best().alias("best"), F.count(F.lit(1)).alias("n"))


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def snapshot(rows: DataFrame, *, filter_keys: int = FILTER_KEYS) -> Snapshot:
    """Freezes digested rows: exact buckets and a filter for each. The number of buckets follows the number of digests."""
    grouped = staged(_grouped(rows), "snapshot")
    buckets = max(1, -(-grouped.count() // filter_keys))
    exact = grouped.withColumn("bucket", bucket(buckets))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        made = BinaryFuse.build(np.unique(_keys(frame["digest"])))
        return pd.DataFrame(
            {"bucket": frame["bucket"].iloc[:1], "seed": made.seed, "segment": made.segment,
             "segments": made.segments, "cells": [made.cells.tobytes()]}
        )

    filters = (
        exact.select("bucket", F.substring("digest", 1, 8).alias("digest"))
        .groupBy("bucket")
        .applyInPandas(build, "bucket int, seed long, segment long, segments long, cells binary")
    )
    return Snapshot(exact, staged(filters, "filters"), buckets)


def screened(digests: DataFrame, frozen: Snapshot, *, filter_keys: int = FILTER_KEYS) -> DataFrame:
    """Of one row per digest: those that the filter of their bucket lets through.

    A bucket that gets many digests is cut into parts, each of which meets a copy of the filter.
    """
    parts = max(1, -(-digests.count() // (filter_keys * frozen.buckets)))

    def sift(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return left.slice(0, 0)
        made = [BinaryFuse(r["seed"], r["segment"], r["segments"], np.frombuffer(r["cells"], FINGERPRINT))
                for r in right.to_pylist()]
        return left.filter(pa.array(made[0].find(_keys(left.column("digest").to_pylist()))))

    part = F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(parts)).cast("int")
    placed = digests.withColumn("bucket", bucket(frozen.buckets)).withColumn("part", part)
    filters = frozen.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = placed.groupBy("bucket", "part").cogroup(filters.groupBy("bucket", "part")).applyInArrow(sift, placed.schema)
    return met.drop("bucket", "part")


def _checked(matched: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the matched digests those whose texts agree byte for byte: the row that stays in the batch's group against the
    one in the snapshot's. A row is looked up by its id, length and digest, so copies do not meet in one task."""
    ends = [F.struct(F.lit(new).alias("new"), F.col(best).alias("best")) for new, best in ((True, "best"), (False, "old_best"))]
    heads = matched.select("digest", "length", F.explode(F.array(*ends)).alias("head")).select(
        F.col("digest").alias("head_digest"), F.col("length").alias("head_length"), F.col("head.new").alias("head_new"),
        F.col("head.best.points").alias("head_points"), F.col("head.best.negative").alias("head_negative"),
    )
    same = (
        (F.col("digest") == F.col("head_digest")) & (F.col("length") == F.col("head_length"))
        & (F.col("new") == F.col("head_new")) & (F.col("points") == F.col("head_points"))
        & (-F.col("doc_id")).eqNullSafe(F.col("head_negative"))
    )
    # One way of joining at every size: the plan at scale is the plan of small tables.
    found = texts.select("doc_id", "digest", "length", "points", "plain", "new").join(heads.hint("merge"), same)
    # Rows that repeat an id are all compared.
    equal = found.groupBy("digest", "length").agg(F.min("plain").alias("low"), F.max("plain").alias("high"))
    return matched.join(equal.where("low = high").select("digest", "length"), ["digest", "length"], "left_semi")


def dedup(
    batch: DataFrame, frozen: Snapshot, snapshot_rows: DataFrame, *, texts: DataFrame | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Answers for the digested rows of batch and snapshot: doc_id, keep_id, group_size, kept, text_sha256, ``carry``.

    ``texts`` may hold the same rows with their ``plain`` texts and ``new`` (of the batch or not), if batch and snapshot
    come without. No group is ever gathered: a row meets its group's answer in a join on the digest, whose hot keys Spark
    splits.
    """
    fresh = staged(_grouped(batch), "batch")
    positive = screened(fresh, frozen)
    old = frozen.exact.select(
        F.col("digest").alias("old_digest"), F.col("length").alias("old_length"),
        F.col("best").alias("old_best"), F.col("n").alias("old_n"),
    )
    matched = positive.join(old, (F.col("digest") == F.col("old_digest")) & (F.col("length") == F.col("old_length")))
    rows = batch.withColumn("new", F.lit(True)).unionByName(snapshot_rows.withColumn("new", F.lit(False)))
    merged = _checked(staged(matched, "matched"), rows if texts is None else texts).select(
        "digest", "length", F.greatest("best", "old_best").alias("best"), (F.col("n") + F.col("old_n")).alias("n"),
        F.explode(F.array(F.lit(True), F.lit(False))).alias("new"),
    )
    # At most two rows for each digest and side: the side's own group, and the group of both.
    every = frozen.exact.select("digest", "length", "best", "n", F.lit(False).alias("new"))
    every = every.unionByName(fresh.withColumn("new", F.lit(True))).unionByName(merged)
    groups = every.groupBy("digest", "length", "new").agg(F.max("best").alias("best"), F.max("n").alias("group_size"))
    groups = staged(groups, "groups")
    return rows.join(groups, ["digest", "length", "new"]).select(
        "doc_id",
        (-F.col("best.negative")).alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(-F.col("best.negative")) & (F.col("points") == F.col("best.points"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *carry,
    )


def dedup_table(docs: DataFrame, *, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """A whole table as two arrivals: rows whose hashed id is even are frozen first, the others come as the new batch."""
    whole = digested(docs, key=key, text=text, carry=carry).withColumn("new", F.pmod(F.xxhash64("doc_id"), F.lit(2)) != 0)
    # Texts are normalised a second time for the comparison rather than stored.
    rows = staged(whole.drop("plain"), "digests")
    early, late = rows.where("not new").drop("new"), rows.where("new").drop("new")
    return dedup(late, snapshot(early), early, texts=whole, carry=carry)
