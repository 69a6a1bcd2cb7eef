"""From raw documents to token ids, in five stages. Each reads what its predecessor wrote as Parquet.

1. language: rejects documents in which no language is recognised (null, or without a letter);
2. exact_dedup: of equal texts one row stays;
3. near_dedup: of each near-duplicate group (five-word shingles, similarity 0.8) the smallest id stays;
4. mix: documents come as often as the mix to target weights takes their words, from not at all to three times;
5. bpe: ids of every document that came through, each repetition a row of its own.

All stages but the last return the columns of ``documents``. Other columns than ``doc_id``, ``text``, ``lang`` and
``source`` pass unread, whatever their names. The dedup stages decide row by row, whatever ids repeat or are missing: of rows with equal texts
exactly one stays, and rows that share an id but not a text are compared one by one. Among rows with the same id the hash
of text, language and source decides. Rows with a null id pass the dedup stages as far as their texts differ,
and the mix takes each of them by itself.

Write a stage's rows before the next stage runs on them, as ``run`` does: a stage removes what earlier ones have staged.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import bpe, exact_dedup, language, minhash, mixing
from orderlens.llm import common
from orderlens.llm.common import shared_path, ship, staged


# Folders that earlier stages have staged tables in.
_LEFT: list[str] = []


def _stage(run: Callable) -> Callable:
    """A stage that first removes what stages before it have staged, as far as its own input does not read it: they have
    been written. So the shared folder holds the intermediate tables of one stage, not of all."""

    def cleaning(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _LEFT:
            # Folders of the input's files; a stage of a written pipeline reads one.
            used = {file.rsplit("/", 1)[0] for file in docs.inputFiles()}
            gone = [path for path in _LEFT if not any(path.rsplit("/", 1)[-1] in folder for folder in used)]
            common.remove_staged(spark, gone)
            _LEFT[:] = [path for path in _LEFT if path not in gone]
        before = len(common.STAGED)
        out = run(spark, docs, sf_dir)
        _LEFT.extend(common.STAGED[before:])
        return out

    cleaning.__name__ = run.__name__
    return cleaning


def _fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores before them as it takes to differ from all columns."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def _own(docs: DataFrame) -> list[Column]:
    """The columns as they came in, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def _numbered(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The rows written once with a number of their own, and a hash that decides between rows of one id; the names of
    these two columns."""
    row, tie = _fresh(docs, "_row", "_tie")
    both = F.monotonically_increasing_id().alias(row), F.xxhash64("text", "lang", "source").alias(tie)
    return staged(docs.select(*_own(docs), *both), "numbered"), row, tie


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    profiles = language.learn(docs.where(~language.held_out(F.col("doc_id"))), key="doc_id", text="text", label="lang")
    (found,) = _fresh(docs, "_found")
    named = docs.select(*_own(docs), language.predict(F.col("text"), profiles)["lang"].alias(found))
    return named.where(F.col(found) != language.NONE).select(_own(docs))


@_stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows, row, tie = _numbered(docs)
    kept = exact_dedup.dedup_table(rows, carry=(tie, row)).where("kept")
    # Rows that repeat the id and the length of the longest text are all marked.
    one = kept.groupBy("text_sha256").agg(F.min(F.struct(tie, row))[row].alias(row))
    return rows.join(one.select(row), row, "left_semi").select(_own(docs))


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows, row, tie = _numbered(docs)
    named = rows.where("doc_id is not null").select(row, "doc_id", tie, "text")
    groups = minhash.near_duplicates(named, shingle=5, threshold=Fraction(4, 5), key=row)
    found = groups.select(F.col("doc_id").alias(row), F.col("component_id").alias("_group"))
    member = staged(named.select(row, "doc_id", tie).join(found, row), "grouped")
    best = member.groupBy("_group").agg(F.min(F.struct("doc_id", tie, row))[row].alias("_best"))
    dropped = member.join(best, "_group").where(F.col(row) != F.col("_best"))
    return rows.join(dropped.select(row), row, "left_anti").select(_own(docs))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats whole documents: the taken words over the size, a remainder rounded up with its probability by a hash.

    Every row is taken by itself, also where ids repeat or are missing.
    """
    rows, row, tie = _numbered(docs)
    mixed = mixing.mix(rows, carry=(row, tie)).where("taken > 0")
    luck = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("repeat"), tie), 11) / F.lit(float(1 << 53))
    (times,) = _fresh(rows, "_times")
    repeats = mixed.select(row, F.floor(F.col("taken") / F.col("size") + luck).alias(times))
    repeats = staged(repeats.where(F.col(times) > 0), "times")
    met = rows.join(repeats, row)
    return met.select(*_own(docs), F.explode(F.sequence(F.lit(1), F.col(times))).alias(times)).select(_own(docs))


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    # Other stages need the workers too, so less is remembered here than by the encoder alone, and within a task only.
    rows = bpe.encoded(docs, ranks, pattern, units=100_000, pieces=50_000, slice_bytes=2 << 20, keep=False)
    return bpe.digests(rows)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("bpe", encode),
]

#: Language profiles, near duplicates and the mix have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
