"""Staged tables, and words and hashes of whole Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text handled at once inside a task; a longer document is handled alone.
SLICE_BYTES = 1 << 18
MASK = (1 << 64) - 1
# Rabin-Karp hashes are taken modulo a prime: modulo 2**64, sequences of two values collide whatever the base.
PRIME = (1 << 61) - 1
# Two independent bases.
WORD_BASE, OTHER_BASE = 0x1342543DE82EF95A, 0x0AF251AF3B0F025B

# The white space of the word contracts: space and the code points 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="orderlens-llm-")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends.

    A session that sets no ``spark.checkpoint.dir`` and runs in one process, as in tests, gets a local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = _local_root()
    path = f"{root.rstrip('/')}/orderlens-llm/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this library to the Python workers, unless their path has it. Once per application."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="orderlens-"), "orderlens")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, "orderlens"))
    _SHIPPED.add(app)


# Folders that staged tables of this driver lie in.
STAGED: list[str] = []


def remove_staged(spark: SparkSession, paths: list[str]) -> None:
    """Removes staged tables that nobody reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        if path in STAGED:
            STAGED.remove(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: cuts lineage, outlives any executor."""
    path = shared_path(df.sparkSession, name)
    STAGED.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows that Spark hands to a Python worker at once, for columns of whole texts.
TEXT_ROWS = 2_000


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session hands at most ``TEXT_ROWS`` rows to a Python worker at once, which bounds the memory of
    both sides. A smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= TEXT_ROWS:
        spark.conf.set(name, TEXT_ROWS)


def give_back() -> None:
    """Returns what a worker has freed to the system: Arrow's pool, and the C heap where its library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def without_spaces(column: Column) -> Column:
    """The text with every white-space character of the contracts deleted."""
    for c in SPACES:
        column = F.replace(column, F.lit(c), F.lit(""))
    return column


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, end row, bytes, and offsets of the rows in them. Null is empty."""
    text = batch.column(column)
    if text.null_count:
        text = text.fill_null("")
    text = text.cast(pa.large_binary())
    n = len(text)
    if not n:
        return
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + n + 1]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, for numbers below it."""
    low, mask = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> low, a & mask, b >> low, b & mask
    middle = a1 * b0 + a0 * b1  # stands for itself times 2**31
    # 2**62 is 2, and 2**61 is 1.
    out = a1 * b1 * np.uint64(2) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << low) + a0 * b0
    return reduced(out)


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME."""
    p = np.uint64(PRIME)
    x = (x & p) + (x >> np.uint64(61))
    return np.where(x >= p, x - p, x)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo PRIME for i < n. Tables up to one slice are kept."""
    if base in _TABLES and len(_TABLES[base][0]) >= n:
        return _TABLES[base][0][:n], _TABLES[base][1][:n]
    size = max(n, SLICE_BYTES // 2 + 2)
    out = []
    for factor in (base, pow(base, -1, PRIME)):
        table = np.ones(1, np.uint64)
        while len(table) < size:
            table = np.concatenate((table, times(table, np.full(len(table), pow(factor, len(table), PRIME), np.uint64))))
        out.append(table[:size])
    if size <= SLICE_BYTES:
        _TABLES[base] = (out[0], out[1])
    return out[0][:n], out[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer with full avalanche on 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(values: np.ndarray, base: int) -> np.ndarray:
    """n + 1 running sums of values[i] * base**i modulo PRIME."""
    terms = times(reduced(values.astype(np.uint64, copy=False)), powers(base, len(values))[0])
    # The halves of the terms are summed apart, so that no sum overflows.
    high, low = np.cumsum(terms >> np.uint64(31)), np.cumsum(terms & np.uint64((1 << 31) - 1))
    out = np.zeros(len(values) + 1, np.uint64)
    out[1:] = reduced(times(reduced(high), np.full(len(high), 1 << 31, np.uint64)) + reduced(low))
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp hashes of the spans, the same wherever a span stands."""
    return times(reduced(prefix[stop] + np.uint64(PRIME) - prefix[start]), powers(base, len(prefix))[1][start])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in a slice, and for each row the index of its first word (one more at the end)."""
    inside = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    stops = np.flatnonzero(inside & (~after | edge[1:])) + 1 if len(data) else np.zeros(0, np.int64)
    return starts, stops, np.searchsorted(starts, offsets, "left")


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of the bytes of each word: eight at a time, each scrambled with its place, and their sum scrambled again."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = stops - starts
    lanes = (length + 7) >> 3
    upto = np.cumsum(lanes)
    place = np.arange(upto[-1]) - np.repeat(upto - lanes, lanes)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))[np.repeat(starts, lanes) + 8 * place]
    rest = np.minimum(np.repeat(length, lanes) - 8 * place, 8).astype(np.uint64)
    eight = eight & (np.uint64(MASK) >> (np.uint64(64) - np.uint64(8) * rest))
    step = np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & MASK)
    mixed = mix(mix(eight + step) + (place.astype(np.uint64) + np.uint64(1)) * step)
    sums = np.add.reduceat(mixed, upto - lanes)
    return mix(sums ^ (length.astype(np.uint64) * step))
