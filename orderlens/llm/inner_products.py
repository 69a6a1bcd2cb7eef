"""Operator 7: exact top-k search by inner product, with bounds from norms and rotated partial sums.

Components become integers (floor of ``scale`` times the value) and scores exact integer inner products. All vectors are
rotated by the eigenvectors of their Gram matrix, so that the first coordinates carry most of every product, and lie in
blocks by descending length. For a query the product with a vector is at most the partial sum over the first coordinates
plus the product of the lengths of the two rests (Cauchy-Schwarz). The blocks of longest vectors, searched first, give
each query a lower bound for its k-th score; later a block whose longest vector cannot reach it is passed over whole, a
vector whose partial sum plus rest cannot is not finished, and only the others get an exact score.

Queries meet candidates in blocks: each block of queries goes once to each block of candidates, no pairs of rows are
made. The Gram matrix is summed in Spark, one matrix per task.

Vectors that are null or hold null or non-finite components take no part. Vectors of different length (number of
components) do not meet. Bounds carry a margin for rounding; scores are exact while they fit 53 bits. Rows that repeat id
and vector are one, which asks if one of them does; only rows with another id than the query's count. Rows that repeat an
id with different vectors are candidates each; where they score alike they are one result. Ties go to the smaller id; rows
of one query id that have different vectors are searched as one query each, and share the ranking of their best scores.
The hits of a block, the bounds and the ranks all count distinct pairs of id and score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SCALE = 1024
BLOCK = 4096
QUERY_BLOCK = 1024
# Share of the coordinates in the partial sum, and candidates that make the first bound.
HEAD = 4
MARGIN = 1e-9

HIT = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, vector: str) -> Column:
    """Whether no component is null, NaN or infinite. Null vectors are not usable."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim).astype(np.float64)


def gram_matrices(rows: DataFrame) -> dict[int, np.ndarray]:
    """Sum of the outer products for each vector length; one small matrix from every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                m = _matrix(batch.column("vec").filter(pa.array(dims == dim)), int(dim))
                sums[int(dim)] = sums.get(int(dim), 0) + m.T @ m
        cells = [(d, i, v) for d, s in sums.items() for i, v in enumerate(s.ravel().tolist())]
        yield pa.RecordBatch.from_pylist(
            [{"dim": d, "cell": i, "v": v} for d, i, v in cells],
            pa.schema([("dim", pa.int32()), ("cell", pa.int32()), ("v", pa.float64())]),
        )

    sums = rows.mapInArrow(run, "dim int, cell int, v double").groupBy("dim", "cell").agg(F.sum("v").alias("v"))
    out: dict[int, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r["dim"], np.zeros(r["dim"] * r["dim"]))[r["cell"]] = r["v"]
    return {d: m.reshape(d, d) for d, m in out.items()}


def rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """Orthogonal matrices whose first columns are the directions of largest energy."""
    return {d: np.linalg.eigh(m)[1][:, ::-1] for d, m in gram_matrices(rows).items()}


class Block:
    """Integer vectors of one length with their rotation."""

    def __init__(self, ids: np.ndarray, raw: bytes, dim: int, rotation: np.ndarray):
        self.ids = ids
        self.exact = np.frombuffer(raw, "<f8").reshape(len(ids), dim)
        turned = self.exact @ rotation
        head = max(1, dim // HEAD) if dim else 0
        self.head = turned[:, :head]
        self.rest = np.sqrt((turned[:, head:] ** 2).sum(axis=1))
        self.length = np.sqrt((self.exact**2).sum(axis=1))


def search(queries: Block, candidates: Block, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, candidate and score of the k best pairs of id and score of each query that can reach its bound ``least``."""
    longest = candidates.length.max(initial=0.0)
    slack = MARGIN * (queries.length * longest + 1)
    alive = np.flatnonzero(queries.length * longest + slack >= least)
    out = []
    for q in alive:
        # Candidates come by descending length: a prefix can reach the bound at all.
        reach = queries.length[q] * candidates.length + slack[q] >= least[q]
        some = np.flatnonzero(reach)
        bound = candidates.head[some] @ queries.head[q] + candidates.rest[some] * queries.rest[q]
        some = some[(bound + slack[q] >= least[q]) & (candidates.ids[some] != queries.ids[q])]
        score = candidates.exact[some] @ queries.exact[q]
        keep = np.flatnonzero(score >= least[q])
        if len(keep) > k:
            keep = keep[np.lexsort((candidates.ids[some[keep]], -score[keep]))]
            ids, best = candidates.ids[some[keep]], score[keep]
            fresh = np.append(True, (ids[1:] != ids[:-1]) | (best[1:] != best[:-1]))
            keep = keep[fresh][:k]
        out.append((np.full(len(keep), q), some[keep], score[keep]))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(float)
    q, c, s = (np.concatenate(x) for x in zip(*out, strict=True))
    return q, c, s


def blocks(rows: DataFrame, size: int, *, by_length: bool) -> DataFrame:
    """dim, block, ids, raw, longest: vectors packed together, by descending length or by hash."""
    count = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    if by_length:
        # Bounds of the blocks from a sketch of the lengths: how full a block is may vary, what it holds may not overlap.
        cuts = {
            r["dim"]: r["cuts"]
            for r in rows.groupBy("dim")
            .agg(F.percentile_approx("length", [i / 64 for i in range(1, 64)], 1000).alias("cuts")).collect()
        }
        band = F.create_map(*[x for d, c in cuts.items() for x in (F.lit(d), F.array(*[F.lit(float(v)) for v in c]))]) if cuts else None
        level = F.size(F.filter(band[F.col("dim")], lambda c: c >= F.col("length"))) if cuts else F.lit(0)
    else:
        level = F.lit(0)
    parts = (
        F.create_map(*[F.lit(x) for d, n in count.items() for x in (d, max(1, -(-n // (size * (64 if by_length else 1)))))])
        if count else None
    )
    part = F.pmod(F.xxhash64("vec_id"), parts[F.col("dim")]).cast("int") if count else F.lit(0)
    placed = rows.withColumn("level", level.cast("int")).withColumn("part", part)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "vec_id"], ascending=[False, True])
        raw = b"".join(np.asarray(v, "<f8").tobytes() for v in frame["vec"])
        return pd.DataFrame(
            {"dim": frame["dim"].iloc[:1], "level": frame["level"].iloc[:1], "part": frame["part"].iloc[:1],
             "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()], "raw": [raw], "longest": frame["length"].max()}
        )

    return placed.groupBy("dim", "level", "part").applyInPandas(
        pack, "dim int, level int, part int, ids binary, raw binary, longest double"
    )


def top_k(
    vectors: DataFrame, is_query: Column, *, k: int = 10, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each query against every other row. Extra columns are not read."""
    rows = vectors.where(usable(vectors, vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    # Copies of a row would fill the hits of a block and lift the bounds, so they are folded before anything counts.
    rows = rows.groupBy("vec_id", "vec").agg(F.max("asks").alias("asks"))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    rows = staged(rows.select("*", F.size("vec").alias("dim"), length.alias("length")), "vectors")
    turn = rotations(rows)
    candidates = staged(blocks(rows.drop("asks"), BLOCK, by_length=True), "candidates")
    queries = staged(blocks(rows.where("asks").drop("asks"), QUERY_BLOCK, by_length=False), "queries")
    asked = queries.select("dim", F.col("part").alias("q"), F.col("ids").alias("q_ids"), F.col("raw").alias("q_raw"))
    asked_longest = queries.select("dim", F.col("part").alias("q"), F.col("longest").alias("q_longest"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                dim = row["dim"]
                rotation = turn.get(dim, np.eye(dim))
                q = Block(np.frombuffer(row["q_ids"], np.int64), row["q_raw"], dim, rotation)
                c = Block(np.frombuffer(row["ids"], np.int64), row["raw"], dim, rotation)
                bounds = row.get("least")
                least = np.full(len(q.ids), -np.inf) if bounds is None else np.frombuffer(bounds, "<f8")
                at, found, score = search(q, c, least, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.ids[at]), pa.array(c.ids[found]), pa.array(score.astype(np.int64))],
                    names=["query_id", "vec_id", "score"],
                )

    # The longest vectors first; they bound the k-th score of every query from below.
    early = candidates.where("level = 0").join(asked, "dim").repartition("dim", "q", "part").mapInArrow(meet, HIT)
    early = staged(early.distinct(), "early")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = early.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") == k).select("query_id", "score")
    known = rows.where("asks").select("dim", "vec_id").join(kth, kth.query_id == F.col("vec_id"), "left")
    known = known.withColumn("q", _query_part(rows)).groupBy("dim", "q").agg(
        F.map_from_entries(F.collect_set(F.struct("vec_id", F.coalesce(F.col("score").cast("double"), F.lit(float("-inf"))).alias("s")))).alias("bound"),
        F.min(F.coalesce(F.col("score").cast("double"), F.lit(float("-inf")))).alias("least"),
    )
    known = staged(known, "bounds")

    def with_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_ = batch.to_pylist()
            for row in rows_:
                bound = dict(row.pop("bound"))
                row["least"] = np.array([bound[i] for i in np.frombuffer(row["q_ids"], np.int64).tolist()], "<f8").tobytes()
            yield pa.RecordBatch.from_pylist(
                rows_, pa.schema([("dim", pa.int32()), ("q", pa.int32()), ("q_ids", pa.binary()), ("q_raw", pa.binary()), ("least", pa.binary())])
            )

    # Pairs of blocks that can hold a hit at all, by their longest vectors, before any vector travels.
    reach = F.col("longest") * F.col("q_longest")
    pairs = (
        candidates.where("level > 0").select("dim", "level", "part", "longest")
        .join(asked_longest.join(known.select("dim", "q", "least"), ["dim", "q"]), "dim")
        .where(reach + MARGIN * (reach + 1) >= F.col("least"))
        .select("dim", "level", "part", "q")
    )
    bounded = asked.join(known.drop("least"), ["dim", "q"]).mapInArrow(with_bounds, "dim int, q int, q_ids binary, q_raw binary, least binary")
    met = pairs.hint("merge").join(candidates, ["dim", "level", "part"]).join(bounded.hint("merge"), ["dim", "q"])
    late = met.repartition("dim", "q", "level", "part").mapInArrow(meet, HIT)
    hits = early.unionByName(late).distinct()
    return (
        hits.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _query_part(rows: DataFrame) -> Column:
    count = {r["dim"]: r["count"] for r in rows.where("asks").groupBy("dim").count().collect()}
    if not count:
        return F.lit(0)
    parts = F.create_map(*[F.lit(x) for d, n in count.items() for x in (d, max(1, -(-n // QUERY_BLOCK)))])
    return F.pmod(F.xxhash64("vec_id"), parts[F.col("dim")]).cast("int")
