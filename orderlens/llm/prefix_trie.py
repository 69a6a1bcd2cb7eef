"""Operator 12: trie of shared conversation prefixes, by range minima over the longest common prefixes of sorted rows.

A conversation is the sequence of its turns, each reduced to a 128-bit digest of role and text and the bytes of its text.
The sequences are range-partitioned and sorted. In a sorted partition the common prefix of neighbours is computed, and a
sparse table over it answers range minima. Each candidate prefix, one row and a depth at which the row differs from the
one before it, binary-searches the left and the right end of its members independently: an interval of rows, found without
a stack. All values follow from intervals: the smallest member is a range minimum over the ids, members are the length of
the interval, children are counted at the parent that a left search finds, leaves and saved bytes are differences of
running sums. For saved bytes, every member but the first of a node shares with its predecessor the bytes up to their
common prefix, of which those above the node are taken off.

A prefix of a partition's first or last row may go on in its neighbours. Such open nodes, as many as the two rows are
long, leave each partition as parts, which are added by the digest of the prefix; what depends on the common prefix of two
neighbouring partitions is added from a table with one row per partition. All other nodes are finished where they are.
Equal conversations are ordered by id and may spread over many partitions, each of which counts its own. A node's members
that end at it stand in ascending order of id; their digest is a chain over all of them, so it is taken from blocks of
joined ids, streamed in order.

Rows without a conv_id belong to no conversation and are left out. Turns come by turn number, null first; equal numbers
come by the digest of the turn. Null role or text is empty. Repeated rows are turns of their own. A conversation's digests
(about 50 bytes a turn, not its texts) pass through one task. Other columns are not read. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, staged

# Hexadecimal digits of a turn's digest.
DIGITS = 32
# Conversations in a partition, about, and bytes of joined ids in a block.
PART_ROWS = 50_000
BLOCK_BYTES = 1 << 15
# Rows in a batch of finished nodes.
OUT_ROWS = 10_000

#: One row per finished node (``part`` null), part of an open node, or partition (``edge`` true, with its first and last row).
PIECE = (
    "part int, edge boolean, node binary, above binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, shared long, above_bytes long, ends_sha256 string, ends array<string>, "
    "first boolean, last boolean, first_length long, first_key string, first_bytes array<long>, last_key string"
)
ROOT = b""


def turns(rows: DataFrame, *, key: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id and its turns in order, each with its digest and the UTF-8 bytes of its text."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    # The length of the role keeps role and text apart.
    digest = F.substring(F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256), 1, DIGITS)
    one = F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(said).cast("long").alias("bytes"))
    short = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("conv_id"), one.alias("one"))
    return short.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))


def borrowed(conv: Column) -> tuple[Column, Column]:
    """Whose first turns a conversation starts with, and how many."""
    return conv - conv % 5, (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int")


def rebuilt(rows: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most: int = 8) -> DataFrame:
    """conv_id, key (digests of all turns, joined), bytes (of each turn) of every rebuilt conversation."""
    own = staged(turns(rows, key=key, turn=turn, role=role, text=text), "turns")
    base, h = borrowed(F.col("conv_id"))
    wanted = own.withColumn("base", base).withColumn("h", h)
    heads = own.where(F.col("conv_id") % 5 == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    met = wanted.join(heads.hint("merge"), "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(own.schema["turns"].dataType))
    whole = F.concat(head, F.slice("turns", F.col("h") + 1, F.greatest(F.lit(0), F.size("turns") - F.col("h"))))
    return met.select("conv_id", whole.alias("turns")).select(
        "conv_id", F.array_join(F.col("turns.digest"), "").alias("key"), F.col("turns.bytes").alias("bytes")
    )


class Range:
    """Sparse table of minima: level k holds the minimum of each 2**k consecutive values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def least(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Minima of the ranges [start, stop), none empty."""
        level = np.frexp((stop - start).astype(np.float64))[1] - 1
        out = np.empty(len(start), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            values = self.levels[k]
            out[at] = np.minimum(values[start[at]], values[stop[at] - (1 << k)])
        return out

    def right(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last row such that all values behind ``start`` up to it are at least ``bound``."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values, step = self.levels[k], 1 << k
            go = np.flatnonzero(at + step < len(self.levels[0]))
            go = go[values[at[go] + 1] >= bound[go]]
            at[go] += step
        return at

    def left(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first row such that all values behind it up to ``start`` are at least ``bound``."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values, step = self.levels[k], 1 << k
            go = np.flatnonzero(at - step >= 0)
            go = go[values[at[go] - step + 1] >= bound[go]]
            at[go] -= step
        return at


def common_prefixes(turn: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many turns each row shares with the one before it; the first row none."""
    length = np.diff(offsets)
    out = np.zeros(len(length), np.int64)
    if len(length) < 2:
        return out
    most = np.minimum(length[1:], length[:-1])
    row = np.repeat(np.arange(len(most)), most)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(most) - most, most)
    differs = turn[offsets[1:-1][row] + depth] != turn[offsets[:-2][row] + depth]
    out[1:] = most
    np.minimum.at(out, row[differs] + 1, depth[differs])
    return out


def chain(raw: bytes) -> list[bytes]:
    """A digest of each prefix of the digests in ``raw``."""
    made, out = hashlib.sha256(), []
    for i in range(0, len(raw), DIGITS):
        made.update(raw[i : i + DIGITS])
        out.append(made.copy().digest()[:16])
    return out


def blocks(ids: list[str]) -> list[str]:
    """The ids joined by commas, in blocks of bounded length."""
    out, run, size = [], [], 0
    for i in ids:
        if size + len(i) > BLOCK_BYTES and run:
            out.append(",".join(run))
            run, size = [], 0
        run.append(i)
        size += len(i) + 1
    return [*out, ",".join(run)] if run else out


EMPTY = hashlib.sha256(b"").hexdigest()


def pieces(conv: np.ndarray, keys: list[bytes], sizes: np.ndarray, part: int) -> tuple[dict[str, object], list[dict]]:
    """The nodes of one sorted partition: finished ones as columns; parts of open ones and the partition's edge as rows."""
    n = len(conv)
    length = np.fromiter(map(len, keys), np.int64, n) // DIGITS
    offsets = np.concatenate(([0], np.cumsum(length)))
    digests = np.frombuffer(b"".join(keys), f"S{DIGITS}")
    turn = np.unique(digests, return_inverse=True)[1].reshape(-1) if len(digests) else np.zeros(0, np.int64)
    shared = common_prefixes(turn, offsets)
    # Bytes of the turns that each row shares with the one before it, and their running sum.
    running = np.concatenate(([0], np.cumsum(sizes)))
    saved = np.concatenate(([0], np.cumsum(running[offsets[:-1] + shared] - running[offsets[:-1]])))
    prefixes, ids = Range(shared), Range(conv)
    # A row is a leaf if the next one does not repeat or continue it; of the last row the next partition tells.
    leaf = np.zeros(n + 1, np.int64)
    leaf[1:n] = np.cumsum(shared[1:] < length[:-1])
    leaf[n] = leaf[n - 1]
    # Where runs of equal rows begin, and the end.
    runs = np.append(np.flatnonzero(np.append(True, (shared[1:] < length[1:]) | (length[:-1] != length[1:]))), n)

    # Candidates: each row's prefixes that are new in it.
    new = length - shared
    row = np.repeat(np.arange(n), new)
    first_of = np.cumsum(new) - new
    depth = np.arange(len(row)) - first_of[row] + shared[row] + 1
    start, stop = prefixes.left(row, depth), prefixes.right(row, depth) + 1
    smallest = ids.least(start, stop)
    # The parent stands where a left search with one turn less ends; -1 is the root.
    top = prefixes.left(row, depth - 1)
    parent = np.where(depth > 1, first_of[top] + depth - 2 - shared[top], -1)
    children = np.bincount(parent[parent >= 0], minlength=len(row))
    # Rows as long as the node stand first in its interval.
    n_ends = np.where(length[start] == depth, runs[np.searchsorted(runs, start, "right")] - start, 0)
    above = running[offsets[row] + depth - 1] - running[offsets[row]]
    inner = saved[stop] - saved[start + 1]
    leaves = leaf[stop] - leaf[start]
    names = [*map(str, conv.tolist())]
    paths = {i: chain(keys[i]) for i in {0, n - 1}}

    def path(node: int) -> bytes:
        """The digest of an open node, which is a prefix of the first row or else of the last."""
        return paths[0 if start[node] == 0 else n - 1][depth[node] - 1]

    is_open = (start == 0) | (stop == n)
    at = np.flatnonzero(~is_open)
    mother = parent[at]
    inside = mother >= 0
    inside[inside] = ~is_open[mother[inside]]
    ends = np.full(len(at), EMPTY, object)
    for i in np.flatnonzero(n_ends[at]).tolist():
        a, k = int(start[at[i]]), int(n_ends[at[i]])
        ends[i] = hashlib.sha256(",".join(names[a : a + k]).encode()).hexdigest()
    over = np.full(len(at), None, object)
    for i in np.flatnonzero(~inside).tolist():
        over[i] = path(mother[i]) if mother[i] >= 0 else ROOT
    closed = {
        "edge": np.zeros(len(at), bool), "above": over, "conv_id": smallest[at], "depth": depth[at],
        "parent_conv_id": np.ma.array(smallest[np.maximum(mother, 0)], mask=~inside), "n_convs": (stop - start)[at],
        "n_children": children[at], "n_leaves": leaves[at],
        "shared": (inner - (stop - start - 1) * above)[at], "ends_sha256": ends,
    }
    rows = [
        {
            "part": part, "edge": False, "node": path(i), "above": path(int(parent[i])) if parent[i] >= 0 else ROOT,
            "conv_id": int(smallest[i]), "depth": int(depth[i]), "n_convs": int(stop[i] - start[i]),
            # Without the child that the part's first row begins, which the partition before may have begun.
            "n_children": int(children[i]) - int(length[start[i]] > depth[i]), "n_leaves": int(leaves[i]),
            "shared": int(inner[i]), "above_bytes": int(above[i]), "first": bool(start[i] == 0), "last": bool(stop[i] == n),
            "first_length": int(length[start[i]]), "ends": blocks(names[int(start[i]) : int(start[i] + n_ends[i])]),
        }
        for i in np.flatnonzero(is_open).tolist()
    ]
    # The root is always open. Its children begin at rows that share nothing with the one before.
    rows.append({
        "part": part, "edge": False, "node": ROOT, "conv_id": int(conv.min()), "depth": 0, "n_convs": n,
        "n_children": int(((shared[1:] == 0) & (length[1:] > 0)).sum()), "n_leaves": int(leaf[n]),
        "shared": int(saved[n] - saved[1]), "above_bytes": 0, "first": True, "last": True,
        "first_length": int(length[0]), "ends": blocks(names[: int((length == 0).sum())]),
    })
    rows.append({
        "part": part, "edge": True, "first_key": keys[0].decode(), "last_key": keys[-1].decode(),
        "first_bytes": sizes[: int(length[0])].tolist(),
    })
    return closed, rows


def _partition(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(some) if (some := [b for b in batches if len(b)]) else None
        if table is None:
            return
        sizes = table.column("bytes").combine_chunks().flatten().to_numpy()
        keys = [k.encode() for k in table.column("key").to_pylist()]
        closed, rows = pieces(table.column("conv_id").to_numpy(), keys, sizes, TaskContext.get().partitionId())
        n = len(closed["depth"])
        columns = [pa.array(closed[f.name], f.type) if f.name in closed else pa.nulls(n, f.type) for f in schema]
        whole = pa.RecordBatch.from_arrays(columns, schema=schema)
        for a in range(0, n, OUT_ROWS):
            yield whole.slice(a, OUT_ROWS)
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each partition: turns and bytes that its first row shares with the row before it, and whether the last row of
    the partition before is a leaf."""
    for batch in batches:
        rows = batch.to_pylist()
        out = []
        for r in rows:
            a, b = r["before"], r["first_key"]
            d = 0
            if a is not None:
                most = min(len(a), len(b)) // DIGITS
                low, high = 0, most  # equal prefixes are found by halving
                while low < high:
                    middle = (low + high + 1) // 2
                    low, high = (middle, high) if a[: middle * DIGITS] == b[: middle * DIGITS] else (low, middle - 1)
                d = low
            out.append((r["part"], d if a is not None else -1, sum(r["first_bytes"][:d]),
                        r["previous"], int(a is not None and d * DIGITS < len(a))))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        names = ["part", "common", "common_bytes", "previous", "leaf_before"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's blocks, which come sorted by node and order. Only the running digest is held."""
    node, made, begun = None, None, False

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([made.hexdigest()])], names=["node", "ends_sha256"])

    for batch in batches:
        for of, block in zip(batch.column("node").to_pylist(), batch.column("block").to_pylist(), strict=True):
            if of != node or made is None:
                if made is not None:
                    yield done()
                node, made, begun = of, hashlib.sha256(), False
            if begun:
                made.update(b",")
            made.update(block.encode())
            begun = True
    if made is not None:
        yield done()


def nodes(sequences: DataFrame) -> DataFrame:
    """All nodes of the trie of ``sequences`` (conv_id, key, bytes): see the columns of ``trie``."""
    spark = sequences.sparkSession
    sequences = staged(sequences, "sequences")
    parts = max(partitions(spark), -(-sequences.count() // PART_ROWS))
    ranged = sequences.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    schema = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in PIECE.split(", ")])
    found = staged(ranged.mapInArrow(_partition(schema), PIECE), "pieces")
    # One row a partition, so one task holds them.
    by_part = Window.orderBy("part")
    edges = found.where("edge").select(
        "part", "first_key", "first_bytes", F.lag("last_key").over(by_part).alias("before"), F.lag("part").over(by_part).alias("previous")
    )
    edge = staged(
        edges.mapInArrow(_boundaries, "part int, common long, common_bytes long, previous int, leaf_before long"), "edges"
    )
    after = edge.where("previous is not null").select(F.col("previous").alias("part"), F.col("leaf_before").alias("leaf_last"))
    open_ = found.where("not edge and part is not null").join(edge.select("part", "common", "common_bytes"), "part")
    open_ = open_.join(after, "part", "left")
    goes_on = F.col("first") & (F.col("common") >= F.col("depth"))
    begins = F.when(F.col("first_length") <= F.col("depth"), 0).when(goes_on, (F.col("common") == F.col("depth")).cast("int")).otherwise(1)
    merged = staged(
        open_.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            F.min("above").alias("above"),
            F.sum("n_convs").alias("n_convs"),
            F.sum(F.col("n_children") + begins).alias("n_children"),
            F.sum(F.col("n_leaves") + F.when(F.col("last"), F.coalesce("leaf_last", F.lit(1))).otherwise(0)).alias("leaves"),
            (
                F.sum(F.col("shared") + F.when(goes_on, F.col("common_bytes")).otherwise(0))
                - (F.sum("n_convs") - 1) * F.min("above_bytes")
            ).alias("saved_tokens"),
        ),
        "open",
    )
    ends = found.where("not edge and part is not null").select("node", "part", F.posexplode("ends").alias("i", "block"))
    dealt = ends.repartition(partitions(spark), "node").sortWithinPartitions("node", "part", "i")
    digests = dealt.mapInArrow(_chained, "node binary, ends_sha256 string")
    closed = found.where("not edge and part is null")
    numbers = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    done = closed.withColumnRenamed("shared", "saved_tokens")
    whole = merged.join(digests, "node", "left").select(
        "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"), "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"), "above",
    )
    waiting = done.where("above is not null").select(*numbers, "above").unionByName(whole)
    parents = merged.select(F.col("node").alias("above"), F.col("conv_id").alias("found"))
    # The root is the parent of very many; its smallest member is one number.
    root = merged.where(F.col("node") == F.lit(ROOT)).select("conv_id").first()
    rest = waiting.where(F.col("above") != F.lit(ROOT)).join(parents.hint("merge"), "above")
    named = rest.withColumn("parent_conv_id", F.col("found")).select(numbers)
    top = waiting.where(F.col("above") == F.lit(ROOT)).withColumn("parent_conv_id", F.lit(root and root[0]).cast("long"))
    named = named.unionByName(top.select(numbers))
    alone = waiting.where("above is null").select(numbers)
    return done.where("above is null").select(numbers).unionByName(named).unionByName(alone)


_TYPES = {
    "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string(),
    "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()),
}


def trie(rows: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every
    node of the trie of the rebuilt conversations."""
    return nodes(rebuilt(rows, key=key, turn=turn, role=role, text=text))
