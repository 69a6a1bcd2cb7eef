"""Exact quantiles of groups of any size.

``percentile`` holds every distinct value of a group in one task, and a plain
ranking window sorts the whole group there. Here a bounded sketch first brackets
each wanted rank; values outside the brackets are folded into their edges by
partial aggregation. The values inside still grow with the group, so they are
dealt to ``CELLS`` cells of ascending values: cumulated cell counts tell which
cells hold a wanted rank, and only the values of those cells are ranked, each
cell by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .money import dec

SKETCH_ACCURACY = 10_000
# Twice the sketch's rank error on each side, so the wanted rank is always inside.
MARGIN = 2.0 / SKETCH_ACCURACY
# Cells of equal width in each bracket.
CELLS = 4096


def _ranks(p: float, interpolate: bool) -> list[Column]:
    """The ranks whose values make up a quantile of ``_n`` values."""
    if interpolate:
        return [F.floor(dec(p) * (F.col("_n") - 1)) + 1, F.ceil(dec(p) * (F.col("_n") - 1)) + 1]
    return [F.greatest(F.lit(1), F.ceil(dec(p) * F.col("_n")))]


def _pick(ranked: DataFrame, keys: Sequence[str], probs: dict[str, float], interpolate: bool):
    out = []
    for name, p in probs.items():
        found = [F.min(F.when(F.col("_cum") >= rank, F.col("_v"))) for rank in _ranks(p, interpolate)]
        out.append(((found[0] + found[1]) / 2 if interpolate else found[0]).alias(name))
    return ranked.groupBy(*keys).agg(*out)


def _same(keys: Sequence[str], prefix: str) -> Column:
    """A NULL key is a group like any other."""
    return reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys], F.lit(True))


def _wanted_cells(counted: DataFrame, keys: list[str], probs: dict[str, float], interpolate: bool) -> DataFrame:
    """The rows of cells that hold a wanted rank, with the running count of their values."""
    sums = counted.groupBy(*keys, "_n", "_cell").agg(F.sum("_c").alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = sums.withColumn("_before", F.coalesce(F.sum("_s").over(earlier), F.lit(0)))
    holds = [
        (F.col("_before") < rank) & (rank <= F.col("_before") + F.col("_s"))
        for p in probs.values()
        for rank in _ranks(p, interpolate)
    ]
    wanted = cells.where(reduce(lambda x, y: x | y, holds)).select(
        *[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_cell").alias("_w_cell"), "_before"
    )
    rows = counted.join(wanted, _same(keys, "_w_") & (F.col("_cell") == F.col("_w_cell")))
    inside = Window.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_cum", F.col("_before") + F.sum("_c").over(inside))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    *,
    interpolate: bool = False,
    counted_by: str | None = None,
) -> DataFrame:
    """One row per key with the named quantiles of the non-NULL values.

    Discrete quantiles are the element at rank ceil(p * n). ``interpolate``
    gives the continuous median (the mean of the two middle elements) and is
    meant for p = 0.5. ``counted_by`` names a column of row counts when the frame
    already holds one row per key and value; that suits values of which only a
    bounded number can occur, such as whole hours, and needs no sketch.
    """
    if interpolate and set(probs.values()) != {0.5}:
        raise ValueError("interpolation is only defined here for the median")
    keys = list(keys)
    ordered = sorted(probs.items(), key=lambda item: item[1])

    if counted_by:
        counted = df.where(F.col(value).isNotNull()).select(
            *keys,
            F.col(value).alias("_v"),
            F.col(counted_by).alias("_c"),
            F.sum(counted_by).over(Window.partitionBy(*keys)).alias("_n"),
        )
    else:
        values = df.select(*keys, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
        edges = [
            edge
            for _, p in ordered
            for edge in (max(0.0, p - MARGIN), min(1.0, p + MARGIN))
        ]
        brackets = values.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            F.percentile_approx("_v", edges, SKETCH_ACCURACY).alias("_b"),
        )
        if keys:
            right = brackets.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_n", "_b")
            joined = values.join(right, _same(keys, "_k_"))
        else:
            one = F.lit(1).alias("_one")
            joined = values.select("*", one).join(brackets.select("*", one), "_one")
        clamped = cell = None
        for i in range(len(ordered)):
            low, high = F.col("_b")[2 * i], F.col("_b")[2 * i + 1]
            inside = F.greatest(F.col("_v"), low)
            test = F.col("_v") <= high
            # Ascending with the value; a bracket of no or no finite width is one cell.
            width = high.cast("double") - low.cast("double")
            share = F.when((width > 0) & (width < float("inf")), (inside.cast("double") - low.cast("double")) / width)
            number = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * CELLS), F.lit(CELLS - 1)).cast("int") + i * CELLS
            clamped = F.when(test, inside) if clamped is None else clamped.when(test, inside)
            cell = F.when(test, number) if cell is None else cell.when(test, number)
        counted = (
            joined.select(*keys, "_n", clamped.alias("_v"), cell.alias("_cell"))
            .where(F.col("_v").isNotNull())
            .groupBy(*keys, "_n", "_v", "_cell")
            .agg(F.count(F.lit(1)).alias("_c"))
        )
        return _pick(_wanted_cells(counted, keys, probs, interpolate), keys, probs, interpolate)
    running = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return _pick(counted.withColumn("_cum", F.sum("_c").over(running)), keys, probs, interpolate)
