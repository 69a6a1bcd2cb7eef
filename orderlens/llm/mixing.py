"""Operator 2: mixing sources to target weights, with DataFrame functions only.

Each source is a stream of words: its documents in hashed order, cut into blocks of a fixed number of words. Output
shards of equal size hold slots. Every shard draws how many slots each source gets: the whole part of the expected number
is given, the rest is a multinomial draw over the remainders, so that shares come near their targets in small mixes too.
The slots of a source are numbered through; a pseudorandom permutation of its block numbers, another one for each round
through the source, maps them to blocks, and documents meet the taken blocks by block number.

Nothing is random at run time: draws and permutations are hashes of seed, shard, slot and source, so reruns agree.

Sizes are words. The sources by code point, null last, weigh ``weights`` in turn and share the size of all documents;
no target is above ``most`` times its source, what is left over goes to the others by weight. A block is taken ``most``
times at most, and so is every word of a document. Null or empty texts have size 0 and take nothing. Rows that repeat an
id are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, staged, text_or_empty

BLOCK_WORDS = 64
SHARD_SLOTS = 1024
# Rows of a source that one window orders, about.
BUCKET_ROWS = 2000
# Cells of the unit interval in which draws meet the sources.
CELLS = 4096
ROUNDS = 24


def sizes(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", carry: Sequence[str] = ()
) -> DataFrame:
    """doc_id, source, name (the source, never null), size, order of every row, and the columns ``carry``."""
    return docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("name"),
        F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        # With the text, so that rows without an id or with the same one are spread like others.
        F.xxhash64(F.col(key), F.lit(7), F.col(text)).alias("order"),
        *carry,
    )


def targets(rows: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """One row per source: source, name, rows, source_size, target. Windows here run over one row per source."""
    every = Window.partitionBy()
    cap = (F.lit(most) * F.col("source_size")).cast("double")
    sums = rows.groupBy("source", "name").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    ranked = sums.withColumn("weight", turn).withColumn("total", F.sum("source_size").over(every))
    # Sources in the order in which they reach their bound; the level is what each unit of weight gets once the earlier
    # ones are at theirs. It rises as long as sources are at their bound and falls after, so the largest one holds.
    order = Window.orderBy(cap / F.col("weight"), "name")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum(cap).over(earlier), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    )
    levels = ranked.withColumn("level", level)
    fixed = F.max("level").over(every)
    return levels.select(
        "source", "name", "rows", "source_size", F.least(cap, fixed * F.col("weight")).alias("target")
    )


def placed(rows: DataFrame, sources: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The rows with ``start``, their first word in the stream of their source. A hot source is ordered in buckets."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET_ROWS))
    spread = rows.join(sources.select("name", "rows"), "name").withColumn("bucket", F.pmod("order", buckets))
    spread = staged(spread.drop("rows"), "spread")
    inside = Window.partitionBy("name", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    sums = spread.groupBy("name", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("name", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    within = spread.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return within.join(offsets, ["name", "bucket"]).select(
        "doc_id", "source", "name", "size", (F.col("offset") + F.col("within")).alias("start"), *carry
    )


def unit(*parts) -> Column:
    """A hashed number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def permuted(index: Column, n: Column, *key) -> Column:
    """The place of ``index`` in a keyed permutation of 0 to n - 1.

    Swap-or-not: in each round an index and its partner, the keyed mirror image, change places or not by one hashed bit
    of the larger of them. Every round is its own inverse, so the whole is a permutation for any n.
    """

    def step(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit("k"), r, *key), n) - x, n)
        swap = F.pmod(F.xxhash64(F.greatest(x, mirror), r, *key), F.lit(2)) == 1
        return F.when(swap, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), index, step)


def taken_blocks(sources: DataFrame, block_words: int, shard_slots: int, most: int, seed: int) -> DataFrame:
    """name, block, takes: how often the mix takes each block."""
    spark = sources.sparkSession
    # Slots that a source needs: its target in blocks, where the last block of its stream counts by what it holds.
    live = sources.where("source_size > 0").select(
        "name", F.ceil(F.col("source_size") / block_words).alias("blocks"),
        (F.col("target") * F.ceil(F.col("source_size") / block_words) / F.col("source_size")).alias("need"),
    )
    need = live.agg(F.sum("need")).first()[0] or 0.0
    shards = max(1, math.ceil(need / shard_slots))
    slots = max(1, round(need / shards))
    by_name = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    expected = F.col("need") * F.lit(slots / need if need else 0.0)
    drawn = live.withColumn("given", F.floor(expected + F.lit(1e-9))).withColumn(
        "rest", F.greatest(F.lit(0.0), expected - F.col("given"))
    )
    drawn = staged(
        drawn.withColumn("first", F.coalesce(F.sum("given").over(by_name), F.lit(0)))
        .withColumn("low", F.coalesce(F.sum("rest").over(by_name), F.lit(0.0)))
        .withColumn("all_given", F.sum("given").over(Window.partitionBy()))
        .withColumn("all_rest", F.sum("rest").over(Window.partitionBy())),
        "sources",
    )
    # Whole parts: the same slots in every shard, so the number of a slot within its source is arithmetic.
    every = spark.range(0, shards * slots, 1, partitions(spark)).select(
        "id", F.floor(F.col("id") / slots).alias("shard"), F.pmod("id", F.lit(slots)).alias("slot")
    )
    mine = drawn.where("given > 0").select(
        "name", "blocks", "given", F.posexplode(F.expr("sequence(first, first + given - 1)")).alias("j", "slot")
    )
    given = every.join(mine, "slot").select(
        "name", "blocks", (F.col("shard") * F.col("given") + F.col("j")).alias("index")
    )
    # Remainders: each open slot of a shard draws a source; draws and sources meet in the cells of the unit interval.
    taken = drawn.agg(F.max("all_given")).first()[0] or 0
    draws = every.where(F.col("slot") >= taken).select("shard", "id", unit(F.lit(seed), F.lit("draw"), F.col("id")).alias("x"))
    low = F.col("low") / F.col("all_rest")
    spans = drawn.where("rest > 0").select(
        "name", "blocks", F.col("given"), low.alias("low"),
        F.when(F.col("low") + F.col("rest") >= F.col("all_rest") * (1 - 1e-12), F.lit(2.0))
        .otherwise((F.col("low") + F.col("rest")) / F.col("all_rest")).alias("high"),
    )
    cells = spans.select(
        "*",
        F.explode(
            F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))
        ).alias("cell"),
    )
    hits = draws.withColumn("cell", F.floor(F.col("x") * CELLS)).join(cells, "cell").where("x >= low and x < high")
    hits = staged(hits.select("name", "blocks", "given", "shard", "id", (F.floor(F.col("shard") / 1024)).alias("group")), "draws")
    inside = Window.partitionBy("name", "group").orderBy("id")
    before = Window.partitionBy("name").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hits.groupBy("name", "group").count().select(
        "name", "group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    rest = hits.withColumn("within", F.row_number().over(inside) - 1).join(offsets, ["name", "group"]).select(
        "name", "blocks", (F.col("given") * shards + F.col("offset") + F.col("within")).alias("index")
    )
    numbered = given.unionByName(rest).where(F.col("index") < most * F.col("blocks"))
    turn = F.floor(F.col("index") / F.col("blocks"))
    block = permuted(F.pmod("index", "blocks"), F.col("blocks"), F.lit(seed), F.col("name"), turn)
    return numbered.select("name", block.alias("block")).groupBy("name", "block").agg(F.count(F.lit(1)).alias("takes"))


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 17,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs``, and its columns ``carry``; others are
    not read. Names of ``carry`` begin with an underscore.

    ``taken`` counts the words of the document in the taken blocks, a word as often as its block is taken.
    """
    rows = staged(sizes(docs, key=key, text=text, source=source, carry=carry), "sizes")
    sources = staged(targets(rows, weights, most), "targets")
    placed_rows = staged(placed(rows, sources, carry), "placed")
    blocks = taken_blocks(sources, block_words, shard_slots, most, seed)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    first = F.floor(F.col("start") / block_words)
    parts = placed_rows.where("size > 0").select("*", F.explode(F.sequence(first, last)).alias("block"))
    overlap = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest(
        F.col("start"), F.col("block") * block_words
    )
    # The number of taken blocks grows with the data while their plan looks small, so the way of joining is stated.
    found = parts.join(blocks.hint("merge"), ["name", "block"]).groupBy("name", "start").agg(F.sum(overlap * F.col("takes")).alias("taken"))
    # A document of size 0 shares its start with the next one, and takes nothing.
    taken = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return (
        placed_rows.join(found.hint("merge"), ["name", "start"], "left")
        .join(sources.select("name", "source_size", "target"), "name")
        .select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), *carry)
    )
