"""Operator 9: near-duplicate groups by MinHash with tensored banding.

Two small collections of band hashes are made from minima over a document's shingles. A table is a pair of one band from
each collection, so ``2 * bands * rows`` minima give ``bands ** 2`` tables of ``2 * rows`` minima each; plain banding would
need ``2 * rows * bands ** 2``. Two documents meet if one band of either collection agrees. ``bands`` is the smallest
number for which a pair at the threshold is missed with a probability of at most ``MISS``.

Steps: documents with equal shingle sets, told by their size and two independent 64-bit hashes of words, shingles and sets,
collapse to one class, whose smallest id goes on. Classes that share no band of
the first collection with another one cannot meet anyone and are done. The others are keyed by all tables; the members of
a table are linked to its smallest id, and the components of these links are the candidate clusters: any two documents
that meet in a table are in one cluster. In every cluster all links are then confirmed or refused on full shingle sets,
compared without hashing. A cluster too large for one task is cut into blocks by set size and hash, in two rounds. First
each block is compared within itself and with a few pivots, documents of the cluster that visit all blocks of near sizes;
a group of near copies holds together through them. Then the documents outside the largest group found so far, and only
these, meet all blocks of near sizes, so every link between different groups is seen. Sizes that differ by more than the
threshold allows never meet. Only a spanning forest of confirmed links leaves a task, as links of each document to the
smallest one of its group there. In a cluster compared by one task these are the groups; only the groups of large clusters,
and those that rows of one id connect, are joined over all tasks. What a table's smallest id does not see itself is found in its cluster, so nothing depends on which document
that is, nor on the choice of pivots, which decides about the work alone: a cluster with one dominant group costs work in
proportion to its size, one of many large groups that are no near copies of each other the product of their sizes.

Lower-cased are A to Z alone. Null text has no words; documents without words have size 0 and are linked with nothing.
Documents with fewer words than a shingle have one shingle, their whole sequence. Rows with a null id get a null
component and are kept. Rows that repeat an id are one node, joined by the links of each. An empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OTHER_BASE, WORD_BASE, give_back, lower_ascii, mix, prefix_hashes, slices, span_hashes, staged, word_hashes, words
from .components import components

# Probability with which a pair at the threshold shares no table.
MISS = 1e-4
ROWS = 4
# Documents and bytes of text in a block of a large cluster.
BLOCK_DOCS = 512
BLOCK_BYTES = 8 << 20
# Documents of each size level of a large cluster that visit all blocks, about.
PIVOTS = 8

SIGNATURE = "doc_id long, n_shingles long, h1 long, h2 long, first array<long>, second array<long>"


def bands_for(threshold: Fraction, rows: int, miss: float = MISS) -> int:
    return math.ceil(math.log(miss / 2) / math.log(1 - float(threshold) ** rows))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row back to back, a second and independent hash of each shingle, and the offsets
    of the rows in them."""
    starts, stops, firsts = words(data, offsets)
    count = np.diff(firsts)
    prefixes = [
        prefix_hashes(word_hashes(data, starts, stops, seed), base) for seed, base in ((0, WORD_BASE), (1, OTHER_BASE))
    ]
    row = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(starts))
    whole = count[row] < size
    use = np.where(whole, at == firsts[:-1][row], at + size <= firsts[1:][row])
    at, row = at[use], row[use]
    length = np.where(count[row] < size, count[row], size)
    made, other = (
        mix(span_hashes(prefix, at, at + length, base) + length.astype(np.uint64))
        for prefix, base in zip(prefixes, (WORD_BASE, OTHER_BASE), strict=True)
    )
    order = np.lexsort((made, row))
    made, other, row = made[order], other[order], row[order]
    new = np.ones(len(made), bool)
    new[1:] = (made[1:] != made[:-1]) | (row[1:] != row[:-1])
    return made[new], other[new], np.searchsorted(row[new], np.arange(len(count) + 1))


def signatures(rows: DataFrame, size: int, bands: int, per_band: int) -> DataFrame:
    """The band hashes of both collections, and two independent and order-free hashes of the whole set."""
    total = 2 * bands * per_band
    seeds = mix(np.arange(1, total + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, offsets in slices(batch, "text"):
                made, other, at = shingle_hashes(lower_ascii(data), offsets, size)
                n = np.diff(at)
                full = np.flatnonzero(n)
                begin = at[:-1][full]
                bands_of = np.zeros((len(full), 2 * bands), np.uint64)
                h1, h2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if len(full):
                    for i in range(total):
                        # Multiplication by an odd number permutes the hashes; minima take the high bits first.
                        least = np.minimum.reduceat(made * seeds[i], begin)
                        bands_of[:, i // per_band] = mix(bands_of[:, i // per_band] ^ least)
                    h1[full] = np.add.reduceat(made, begin)
                    h2[full] = np.add.reduceat(other, begin)
                lists = np.zeros((len(n), 2 * bands), np.uint64)
                lists[full] = bands_of
                signed = lists.view(np.int64)
                ends = pa.array(np.arange(len(n) + 1, dtype=np.int32) * bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, stop - start),
                        pa.array(n.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                        pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(signed[:, :bands]).ravel())),
                        pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(signed[:, bands:]).ravel())),
                    ],
                    names=["doc_id", "n_shingles", "h1", "h2", "first", "second"],
                )
        give_back()

    return rows.mapInArrow(run, SIGNATURE)


def shingle_codes(texts: list[str], size: int) -> list[np.ndarray]:
    """The shingle sets of some texts as sorted integers, equal exactly for equal word sequences. No hashing."""
    numbers: dict[bytes, int] = {}
    raw = lower_ascii(np.frombuffer("\n".join(texts).encode(), np.uint8)).tobytes() if texts else b""
    bounds = np.cumsum([0, *[len(t.encode()) + 1 for t in texts]])
    sequences = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        found = raw[a : b - 1].split()
        sequences.append(np.array([numbers.setdefault(w, len(numbers)) for w in found], np.int64))
    count = np.array([len(s) for s in sequences], np.int64)
    row = np.repeat(np.arange(len(texts)), count)
    flat = np.concatenate(sequences) if texts else np.zeros(0, np.int64)
    first = np.cumsum(count) - count
    at = np.arange(len(flat))
    use = np.where(count[row] < size, at == first[row], at + size <= first[row] + count[row])
    at, row = at[use], row[use]
    # A missing word counts as zero, so a short sequence differs from every longer one.
    code = np.zeros(len(at), np.int64)
    for i in range(size):
        inside = at + i < first[row] + count[row]
        word = np.where(inside, flat[np.minimum(at + i, len(flat) - 1)] + 1, 0) if len(flat) else code
        code = np.unique(code * (len(numbers) + 1) + word, return_inverse=True)[1]
    pairs = np.unique(np.stack((row, code)), axis=1) if len(row) else np.zeros((2, 0), np.int64)
    return np.split(pairs[1], np.searchsorted(pairs[0], np.arange(1, len(texts)))) if texts else []


def forest(sets: list[np.ndarray], side: np.ndarray, known: np.ndarray, threshold: Fraction) -> list[tuple[int, int]]:
    """Links that hold all documents together which confirmed links connect. ``side`` tells two blocks apart: where
    both occur, only pairs across are compared. Documents with the same ``known`` group are connected already."""
    n = len(sets)
    sides, side = np.unique(side, return_inverse=True)
    both = len(sides) > 1
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if n else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    owners = owner[order]
    starts = np.searchsorted(flat[order], np.arange(flat.max(initial=-1) + 2))
    group = np.unique(known, return_inverse=True)[1]
    links = []
    # Pairs across are all seen from the smaller side.
    for x in np.flatnonzero(side == np.bincount(side).argmin()).tolist() if both else range(n):
        if (group == group[x]).all():
            # All are connected: nothing is left for anyone.
            break
        begin, count = starts[sets[x]], starts[sets[x] + 1] - starts[sets[x]]
        place = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        shared = np.bincount(owners[place], minlength=n)
        union = size[x] + size - shared
        linked = (shared > 0) & (shared * threshold.denominator >= union * threshold.numerator) & (group != group[x])
        if both:
            linked &= side != side[x]
        for y in np.flatnonzero(linked).tolist():
            if group[y] != group[x]:
                links.append((x, y))
                group[group == group[y]] = group[x]
    return links


def stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Every node of some links but the smallest one of its component, with that one."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    for a, b in links:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in above if root(x) != x]


def _confirm(size: int, threshold: Fraction):
    """Of the ``known`` groups that confirmed links connect, all but the smallest one with that one."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "side"])
        known = frame["known"].to_numpy()
        sets = shingle_codes(frame["text"].tolist(), size)
        found = stars([(int(known[x]), int(known[y])) for x, y in forest(sets, frame["side"].to_numpy(), known, threshold)])
        if len(known) > BLOCK_DOCS // 4:
            del sets
            give_back()  # a worker outlives the task
        return pd.DataFrame({"a": [a for a, _ in found], "b": [b for _, b in found]}, dtype="int64")

    return run


def _across(confirm):
    """Without visitors, or without anyone to visit, a task has no pair to compare."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return confirm(frame if frame["side"].nunique() > 1 else frame.iloc[:0])

    return run


def clusters(classes: DataFrame, bands: int) -> DataFrame:
    """node, component: candidate clusters of the classes that meet another one in a table."""
    one = classes.select("doc_id", F.posexplode("first").alias("i", "band"))
    met = one.groupBy("i", "band").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    met = staged(met.select("i", "band"), "bands")
    # The docs that share a band: a semi join on the band, whose common values Spark splits.
    near = staged(one.join(met, ["i", "band"]).select("doc_id").distinct(), "near")
    pairs = (
        classes.join(near, "doc_id")
        .select("doc_id", F.posexplode("first").alias("i", "x"), "second")
        .select("doc_id", "i", "x", F.posexplode("second").alias("j", "y"))
        .select(F.xxhash64("i", "x", "j", "y").alias("table"), "doc_id")
    )
    least = pairs.groupBy("table").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    least = staged(least.select("table", "low"), "tables")
    links = pairs.join(least, "table").where("doc_id > low").select(F.col("doc_id").alias("a"), F.col("low").alias("b"))
    return components(links)


def _parts() -> Column:
    """Of the documents of one size level: the number of blocks that they are dealt to."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("parts")


def _by_level(name: str) -> Column:
    return F.map_from_entries(F.collect_list(F.struct("level", name))).alias(name)


def _block(level: Column, part: Column) -> Column:
    return (level.cast("long") * F.lit(1 << 32) + part).cast("long")


def _near_blocks(parts: str) -> Column:
    """The blocks of the own level and of both next to it, as a map from levels to their numbers of blocks tells."""

    def of(level: Column) -> Column:
        count = F.coalesce(F.col(parts)[level], F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda p: _block(level, p))
        return F.when(count > 0, blocks).otherwise(F.array().cast("array<long>"))

    return F.concat(*(of(F.col("level") + step) for step in (-1, 0, 1)))


def _dealt(parts: str, salt: str) -> Column:
    return _block(F.col("level"), F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.col(parts)[F.col("level")]).cast("int"))


def confirmed(texts: DataFrame, size: int, threshold: Fraction) -> tuple[DataFrame, DataFrame | None]:
    """Links that connect what all links within a cluster connect; rows doc_id, text, cluster, n_shingles. First come the
    stars a, b of groups, each document with the smallest one of its group; then, where clusters are large, links a, b
    between these smallest documents, which join groups."""
    ratio = -math.log(float(threshold))
    level = F.floor(F.log(F.col("n_shingles").cast("double")) / ratio + F.lit(1e-9)).cast("int")
    rows = staged(texts.withColumn("level", level).withColumn("bytes", F.octet_length("text").cast("long")), "clustered")
    levels = rows.groupBy("cluster", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), _parts())
    whole = levels.groupBy("cluster").agg(
        F.sum("n").alias("docs"), F.sum("bytes").alias("all_bytes"), _by_level("parts"), _by_level("n")
    )
    whole = staged(whole.withColumn("fits", (F.col("docs") <= BLOCK_DOCS) & (F.col("all_bytes") <= BLOCK_BYTES)), "cluster_sizes")
    confirm, pair = _confirm(size, threshold), "a long, b long"
    small = rows.join(whole.where("fits").select("cluster"), "cluster")
    small = small.select("cluster", "doc_id", "text", F.lit(0).alias("side"), F.col("doc_id").alias("known"))
    # A small cluster is compared in one task, so its stars are final.
    links = small.groupBy("cluster").applyInPandas(confirm, pair)
    large = whole.where("not fits").select("cluster", "parts", "n")
    if large.isEmpty():
        return links, None

    # First round. Blocks are dealt by an explicit repartition: a join may leave the rows dealt by cluster, which Spark
    # would take for grouping enough and hand all blocks of a large cluster to one task.
    placed = rows.join(large, "cluster")
    share = F.ceil(F.col("n")[F.col("level")] / F.lit(PIVOTS))
    pivot = F.pmod(F.xxhash64("doc_id", F.lit("pivot")), share) == 0
    blocks = F.when(pivot, _near_blocks("parts")).otherwise(F.array(_dealt("parts", "block")))
    own = placed.select("cluster", "doc_id", "text", F.explode(blocks).alias("block"), F.lit(0).alias("side"), F.col("doc_id").alias("known"))
    first = components(own.repartition("cluster", "block").groupBy("cluster", "block").applyInPandas(confirm, pair))

    # Second round: documents outside the largest group of their cluster against all blocks of near sizes.
    found = first.select(F.col("node").alias("doc_id"), F.col("component").alias("found"))
    known = placed.select("cluster", "doc_id", "level", "bytes").join(found, "doc_id", "left")
    known = known.select("cluster", "doc_id", "level", "bytes", F.coalesce("found", "doc_id").alias("known"))
    known = staged(known, "known_groups")
    counted = known.groupBy("cluster", "known").agg(F.count(F.lit(1)).alias("n"))
    main = counted.groupBy("cluster").agg(F.max(F.struct("n", "known"))["known"].alias("main"))
    apart = staged(known.join(main, "cluster").where("known <> main").drop("main"), "apart")
    few = apart.groupBy("cluster", "level").agg(_parts()).groupBy("cluster").agg(_by_level("parts"))
    few = staged(few.withColumnRenamed("parts", "few"), "apart_sizes")
    # A repeated id has several texts, which are one node.
    groups = known.select("doc_id", "known").distinct()
    met = placed.join(few, "cluster").join(groups, "doc_id")
    lone = met.join(apart.select("doc_id").distinct(), "doc_id", "left_semi")
    tasks = met.select(
        "cluster", "doc_id", "text", "known", F.lit(0).alias("side"),
        _dealt("parts", "block").alias("block"), F.explode(_near_blocks("few")).alias("visitor"),
    ).unionByName(
        lone.select(
            "cluster", "doc_id", "text", "known", F.lit(1).alias("side"),
            F.explode(_near_blocks("parts")).alias("block"), _dealt("few", "visitor").alias("visitor"),
        )
    )
    keys = ["cluster", "block", "visitor"]
    second = tasks.repartition(*keys).groupBy(*keys).applyInPandas(_across(confirm), pair)
    grouped = first.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return links.unionByName(grouped), second


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = 5,
    threshold: Fraction = Fraction(4, 5),
    rows: int = ROWS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; other columns are not read.

    ``component_id`` is the smallest id that links reach, ``kept`` whether that is the row's own.
    """
    bands = bands_for(threshold, rows)
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = staged(signatures(source, shingle, bands, rows), "signatures")
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    # Equal sets have equal bands.
    same = ["n_shingles", "h1", "h2"]
    heads = staged(
        filled.groupBy(same).agg(F.min("doc_id").alias("head"), F.first("first").alias("first"), F.first("second").alias("second")), "heads"
    )
    member = staged(
        filled.select("doc_id", *same).join(heads.select("head", *same), same).select("doc_id", "n_shingles", "head"), "members"
    )
    classes = heads.select(F.col("head").alias("doc_id"), "n_shingles", "first", "second")
    found = clusters(classes, bands)
    # Rows of a repeated id have several texts; all take part, as sets of the same node.
    wanted = found.withColumnRenamed("component", "cluster").withColumnRenamed("node", "doc_id")
    sizes = classes.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    wanted = staged(wanted.join(sizes, "doc_id"), "wanted")
    # One way of joining at every size: the plan at scale is the plan of small tables.
    texts = source.where("doc_id is not null").join(wanted.hint("merge"), "doc_id").select("cluster", "doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_shingles")
    within, between = confirmed(texts, shingle, threshold)
    within = staged(within, "groups")
    # Rows that share an id but not a class are one node, so their groups are one.
    repeated = member.groupBy("doc_id").agg(F.min("head").alias("a"), F.max("head").alias("b")).where("a < b").select("a", "b")
    for end in ("a", "b"):
        group = within.select(F.col("a").alias(end), F.col("b").alias("group"))
        repeated = repeated.join(group, end, "left").withColumn(end, F.coalesce("group", end)).drop("group")
    joined = components(between.unionByName(repeated) if between else repeated)
    grouped = member.join(within.select(F.col("a").alias("head"), F.col("b").alias("group")), "head", "left").select(
        "doc_id", "n_shingles", F.coalesce("group", "head").alias("group")
    )
    labelled = grouped.join(joined.withColumnRenamed("node", "group"), "group", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "group").alias("component_id")
    )
    alone = signed.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return labelled.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
