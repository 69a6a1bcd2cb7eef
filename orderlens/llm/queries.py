"""The registered queries of this package: each applies one operator, with production settings, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, edit_counts, exact_dedup, inner_products, language, main_text, minhash, mixing, passages, prefix_trie, token_store, toxicity
from .common import shared_path, ship

END_ID = 0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_store.write(_documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_store.catalogue(spark, path).withColumnRenamed("key", "doc_id")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_table(_documents(spark, sf_dir))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.without_repeats(_documents(spark, sf_dir))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(_table(spark, sf_dir, "pages"))


def op7_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts tokens of every document before and after one revision of each."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = _documents(spark, sf_dir)
    edits = edit_counts.revision(F.col("doc_id"), F.col("text"), F.col("source"))
    stored = edit_counts.trees(docs.select("doc_id", "text", edits.alias("edits")), ranks, pattern, edits="edits")
    return edit_counts.counted(stored, ranks, pattern)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir), shingle=3, threshold=Fraction(85, 100))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = bpe.encoded(_documents(spark, sf_dir), ranks, pattern, units=300_000, pieces=50_000, slice_bytes=2 << 20)
    return bpe.digests(rows)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.aligned(_documents(spark, sf_dir), a, b)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    return run


QUERIES = {
    query.__name__: _shipped(query)
    for query in (
        op1_token_store, op2_mix_sources, op3_exact_dedup, op4_language, op5_substring_dedup, op6_main_text,
        op7_top_inner_products, op8_edit_counts, op9_near_duplicates, op10_byte_bpe, op11_token_alignment, op12_prefix_trie, op13_toxicity,
    )
}

#: DuckDB statements for the operators that SQL can express.
ORACLE: dict[str, str] = {
    "op3_exact_dedup": """
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(translate(coalesce(text, ''), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13), '')) AS text_sha256
            FROM documents)
        SELECT doc_id, first(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first(doc_id) OVER best AS kept, text_sha256
        FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
    """,
    "op7_top_inner_products": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vec
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
}
