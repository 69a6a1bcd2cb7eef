"""Operator 5: removal of repeated passages, by Rabin-Karp hashes of every window of a fixed number of words.

A window is removed where the same words also start in a document with a smaller id. Hashes of all windows would be one
row per word. Windows are therefore first told apart by the smallest hash of the short spans inside them: equal windows
have the same smallest hash, so a window whose smallest hash occurs in one document only is not repeated. Consecutive
windows with the same smallest hash form a segment, about one row for twenty words. Three steps then decide every window:

1. smallest hashes that occur in several documents are counted out; segments without such a hash are done;
2. a segment whose words stand in a document with a smaller id as the same segment is removed whole;
3. where different segments share a smallest hash (the edges of a passage), one copy of each segment has all its windows
   hashed, counted, and compared one by one.

Equal words are told by two independent 64-bit hashes besides the smallest one. A row is known by its id and a hash of its
text. Removed windows merge into maximal intervals per document. Hot passages are pre-aggregated to their smallest id, and rows
meet these in joins on the hash, which Spark splits. Null text has no words. Documents with a null id keep all words and
are no source. Rows that repeat an id are judged each by its own text, and none of them is a source for the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OTHER_BASE, WORD_BASE, mix, prefix_hashes, slices, span_hashes, staged, word_hashes, words

WINDOW = 50
# Words of the spans whose hashes choose the segment of a window.
SPAN = 8

SEGMENT = "row_key long, doc_id long, m long, s long, t long, w0 int, nw int"
FIRST = "doc_id long, row_key long, n_words long, n_removed long, kept_sha256 string, text string, gone array<struct<a:int,b:int>>, asked array<struct<w0:int,nw:int,m:bigint>>"


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n consecutive values."""
    width, out = 1, values
    while 2 * width <= n:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = n - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def segments_of(data: np.ndarray, offsets: np.ndarray, window: int, span: int) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows, smallest hash and two independent hashes of the words of every segment in a
    slice."""
    starts, stops, firsts = words(data, offsets)
    counts = np.diff(firsts)
    none = np.zeros(0, np.int64)
    if not len(starts) or counts.max() < window:
        return none, none, none, none, none, none
    hashes = word_hashes(data, starts, stops)
    prefix = prefix_hashes(hashes, WORD_BASE)
    at = np.arange(len(hashes) - span + 1)
    spans = mix(span_hashes(prefix, at, at + span, WORD_BASE))
    least = sliding_min(spans, window - span + 1)
    row = np.repeat(np.arange(len(counts)), counts)
    valid = row[: len(least)] == row[window - 1 : window - 1 + len(least)]
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | (row[1 : len(least)] != row[: len(least) - 1]) | ~valid[:-1]
    begin = np.flatnonzero(change & valid)
    # A segment ends where the next one begins or at the last window of its document.
    follow = np.append(begin[1:], len(least))
    last = firsts[row[begin] + 1] - window
    end = np.minimum(follow, last + 1)
    content = mix(span_hashes(prefix, begin, end + window - 1, WORD_BASE))
    prefix = prefix_hashes(word_hashes(data, starts, stops, 1), OTHER_BASE)
    other = mix(span_hashes(prefix, begin, end + window - 1, OTHER_BASE))
    return (
        row[begin], begin - firsts[row[begin]], end - begin,
        least[begin].view(np.int64), content.view(np.int64), other.view(np.int64),
    )


def segments(rows: DataFrame, window: int, span: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            for start, stop, data, offsets in slices(batch, "text"):
                row, w0, nw, m, s, t = segments_of(data, offsets, window, span)
                ids = batch.column("doc_id").slice(start, stop - start).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[start:stop][row]), ids, pa.array(m), pa.array(s), pa.array(t),
                     pa.array(w0.astype(np.int32)), pa.array(nw.astype(np.int32))],
                    names=["row_key", "doc_id", "m", "s", "t", "w0", "nw"],
                )

    return rows.mapInArrow(run, SEGMENT)


def kept_words(text: str | None, gone: list[dict] | None) -> tuple[int, int, str]:
    """Number of words, number removed, digest of the kept words joined by a space. Intervals are [a, b)."""
    all_words = (text or "").encode().split()
    removed = 0
    if gone:
        edges = np.zeros(len(all_words) + 1, np.int64)
        for i in gone:
            edges[i["a"]] += 1
            edges[i["b"]] -= 1
        keep = np.cumsum(edges[:-1]) == 0
        removed = int(len(all_words) - keep.sum())
        kept = [w for w, k in zip(all_words, keep.tolist(), strict=True) if k]
    else:
        kept = all_words
    return len(all_words), removed, hashlib.sha256(b" ".join(kept)).hexdigest()


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finishes every document that needs no single windows; the others keep their text."""
    for batch in batches:
        texts, gone, asked = batch.column("text"), batch.column("gone").to_pylist(), batch.column("asked").to_pylist()
        done = [(None, None, None) if a else kept_words(t.as_py(), g) for t, g, a in zip(texts, gone, asked, strict=True)]
        n, removed, digest = (list(x) for x in zip(*done, strict=True)) if done else ([], [], [])
        open_ = pa.array([bool(a) for a in asked], pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(digest, pa.string()), pa.compute.if_else(open_, texts, pa.scalar(None, texts.type)),
             batch.column("gone"), batch.column("asked")],
            names=["doc_id", "row_key", "n_words", "n_removed", "kept_sha256", "text", "gone", "asked"],
        )


def _single_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, asked = batch.column("row_key").to_pylist(), batch.column("asked").to_pylist()
            for start, stop, data, offsets in slices(batch, "text"):
                begin, end, firsts = words(data, offsets)
                prefix = prefix_hashes(word_hashes(data, begin, end), WORD_BASE)
                second = prefix_hashes(word_hashes(data, begin, end, 1), OTHER_BASE)
                out = {name: [] for name in ("row_key", "doc_id", "m", "h", "g", "w")}
                for i in range(start, stop):
                    for part in asked[i]:
                        w = np.arange(part["w0"], part["w0"] + part["nw"])
                        at = firsts[i - start] + w
                        out["h"].append(mix(span_hashes(prefix, at, at + window, WORD_BASE)).view(np.int64))
                        out["g"].append(mix(span_hashes(second, at, at + window, OTHER_BASE)).view(np.int64))
                        out["w"].append(w.astype(np.int32))
                        out["m"].append(np.full(len(w), part["m"]))
                        out["row_key"].append(np.full(len(w), keys[i]))
                        out["doc_id"].append(np.full(len(w), batch.column("doc_id")[i].as_py()))
                names = list(out)
                if out["w"]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out[n])) for n in names], names=names)

    return run


def _last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = [kept_words(t.as_py(), g) for t, g in zip(batch.column("text"), batch.column("gone").to_pylist(), strict=True)]
        n, removed, digest = (list(x) for x in zip(*done, strict=True)) if done else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def _interval(window: int) -> Column:
    return F.struct(F.col("w0").alias("a"), (F.col("w0") + F.col("nw") + (window - 1)).cast("int").alias("b"))


def without_repeats(
    docs: DataFrame, *, window: int = WINDOW, span: int = SPAN, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs``; other columns are not read."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("row_key", F.xxhash64("text"))
    found = staged(segments(rows, window, span), "segments")
    # 1. Smallest hashes in more than one document; ``mixed`` if they stand in different segments.
    shared = staged(
        found.groupBy("m")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("s").alias("s0"), F.max("s").alias("s1"), F.min("t").alias("t0"), F.max("t").alias("t1"))
        .where("low < high")
        .select("m", ((F.col("s0") != F.col("s1")) | (F.col("t0") != F.col("t1"))).alias("mixed")),
        "shared",
    )
    shared_segments = staged(found.join(shared, "m"), "shared_segments")
    # 2. The first document of each segment.
    origin = staged(shared_segments.groupBy("m", "s", "t").agg(F.min("doc_id").alias("first")), "origin")
    judged = shared_segments.join(origin, ["m", "s", "t"])
    per_row = (
        judged.where("doc_id > first or (mixed and doc_id = first)")
        .groupBy("doc_id", "row_key")
        .agg(
            F.collect_set(F.when(F.col("doc_id") > F.col("first"), _interval(window))).alias("gone"),
            F.collect_set(F.when(F.col("doc_id") == F.col("first"), F.struct("w0", "nw", "m"))).alias("asked"),
        )
    )
    first = staged(rows.join(per_row, ["doc_id", "row_key"], "left").select("doc_id", "text", "row_key", "gone", "asked").mapInArrow(_first_pass, FIRST), "first")
    # 3. Windows of one copy of every segment that shares its smallest hash with another one.
    open_rows = first.where("text is not null")
    single = staged(
        open_rows.select("row_key", "doc_id", "text", "asked").mapInArrow(
            _single_windows(window), "row_key long, doc_id long, m long, h long, g long, w int"
        ),
        "windows",
    )
    repeated = staged(
        single.groupBy("m", "h", "g").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last"),
        "repeated",
    )
    late = single.join(repeated, ["m", "h", "g"]).where("doc_id > first")
    more = late.groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct(F.col("w").alias("a"), (F.col("w") + window).cast("int").alias("b"))).alias("more")
    )
    gone = F.concat(F.coalesce("gone", F.array()), F.coalesce("more", F.array()))
    closed = open_rows.join(more, ["doc_id", "row_key"], "left").select("doc_id", "text", gone.alias("gone"))
    closed = closed.mapInArrow(_last_pass, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return first.where("text is null").select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(closed)
