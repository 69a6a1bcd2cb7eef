"""Replicating a table: extract a delta, clean it, merge it, lay it out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import ContractError, TableContract, registry_frame
from ..functions.time import When, ts
from ..sources import snapshots

OVERLAP_MINUTES = 10
PART = "_part"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
UNSUPPORTED = (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)


# -- what to pull ------------------------------------------------------------


def high_watermark(target: DataFrame, column: str, *, overlap_minutes: int = OVERLAP_MINUTES) -> DataFrame:
    """One row: newest change already stored, minus an overlap; NULL for an empty target."""
    mark = F.max(F.col(column).cast("timestamp")) - F.make_dt_interval(mins=F.lit(overlap_minutes))
    return target.agg(mark.alias("mark"))


def stored_mark(target: DataFrame, column: str, *, overlap_minutes: int = OVERLAP_MINUTES) -> int | None:
    """The mark in microseconds since 1970, so that it does not depend on the driver's time zone."""
    return high_watermark(target, column, overlap_minutes=overlap_minutes).select(F.unix_micros("mark")).first()[0]


def delta_extract(source: DataFrame, column: str, mark: dt.datetime | int | None) -> DataFrame:
    """Rows changed at or after the mark; everything when there is no mark. An int counts microseconds since 1970.

    The mark is a literal, so the bound reaches the scan. Rows with a NULL
    watermark never come in a delta; the reconcile report exposes them.
    """
    if mark is None:
        return source
    bound = F.timestamp_micros(F.lit(mark)) if isinstance(mark, int) else ts(mark)
    return source.where(F.col(column) >= bound)


def key_chunks(source: DataFrame, key: str, *, size: int) -> DataFrame:
    """Windows of ``size`` consecutive keys from the smallest to the largest key.

    Windows without rows are listed too: they are what a range pull would ask for. The
    windows between two sparse keys can be very many, so they are made in runs: as many
    runs as a run has windows, spread over the tasks before they are opened.
    """
    wide = "decimal(20,0)"
    bounds = source.agg(F.min(key).cast("bigint").alias("low"), F.max(key).cast("bigint").alias("high"))
    count = F.expr(f"(cast(high as {wide}) - low) div {size}") + 1
    run = F.ceil(F.sqrt(F.col("windows").cast("double"))).cast("bigint")
    runs = (
        bounds.where(F.col("low").isNotNull())
        .withColumn("windows", count)
        .withColumn("run", run)
        .withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(windows - 1) div run"))))
        .repartition("at")
    )
    end = F.least(F.col("at") * F.col("run") + F.col("run"), F.col("windows")) - 1
    first_key = (F.col("low").cast(wide) + F.col("chunk") * F.lit(size).cast(wide)).cast("bigint")
    # The last window may reach beyond the largest 64-bit number.
    last_key = F.least(F.col("first_key").cast(wide) + (size - 1), F.lit(2**63 - 1).cast(wide)).cast("bigint")
    windows = (
        runs.select("low", F.explode(F.sequence(F.col("at") * F.col("run"), end)).alias("chunk"))
        .select("chunk", first_key.alias("first_key"))
        .withColumn("last_key", last_key)
    )
    low = source.agg(F.min(key).alias("_low"))
    counted = (
        source.where(F.col(key).isNotNull())
        .select((F.col(key).cast(wide) - low.scalar()).alias("_off"))
        .groupBy(F.expr(f"_off div {size}").alias("chunk"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return windows.join(counted, "chunk", "left").select(
        "chunk", "first_key", "last_key", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")
    )


# -- cleaning ----------------------------------------------------------------


def apply_contract(df: DataFrame, contract: TableContract, casts: Mapping[str, str] | None = None) -> DataFrame:
    """Drops excluded and unsupported columns and casts the named ones."""
    contract.check(df)
    casts = casts or {}
    dropped = dropped_columns(df, contract)
    kept = [c for c in df.columns if c not in dropped]
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in kept])


def dropped_columns(df: DataFrame, contract: TableContract) -> dict[str, str]:
    """The columns that ``apply_contract`` leaves out, and why."""
    out = {}
    for f in df.schema.fields:
        if f.name in contract.exclude:
            out[f.name] = "excluded"
        elif isinstance(f.dataType, UNSUPPORTED):
            out[f.name] = f"type {f.dataType.simpleString()} is not stored"
    return out


def _mask_fixed(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit("xxx"))


def _mask_email(c: Column) -> Column:
    at = F.instr(c, F.lit("@"))
    domain = F.concat(F.lit("xxx@"), F.substring(c, at + 1, F.lit(255)))
    return F.when(at > 0, domain).when(c.isNotNull(), F.lit("xxx"))


MASKS = {"xxx": _mask_fixed, "email_domain": _mask_email}


def mask_pii(df: DataFrame, mask: Mapping[str, str]) -> DataFrame:
    """Masks columns by mode. An unknown column or mode stops the run.

    A typo must not let personal data through. NULL stays NULL; of an address
    only what follows the first '@' is kept.
    """
    strangers = sorted(set(mask) - set(df.columns))
    if strangers:
        raise ContractError(f"mask names columns the table does not have: {', '.join(strangers)}")
    unknown = sorted(set(mask.values()) - set(MASKS))
    if unknown:
        raise ContractError(f"unknown mask mode: {', '.join(unknown)}; known: {', '.join(sorted(MASKS))}")
    return df.withColumns({c: MASKS[mode](F.col(c)) for c, mode in mask.items()}) if mask else df


def dedup_latest(df: DataFrame, key: Sequence[str], watermark: str | None) -> DataFrame:
    """One row per key, the newest. Equal times are decided by the other columns.

    Keeping rank 1 lets Spark limit every group before the shuffle, so a key
    repeated very often sends one row per task.
    """
    rest = [c for c in df.columns if c not in key and c != watermark]
    order = [F.col(watermark).desc_nulls_last()] if watermark else []
    order += [F.col(c).desc_nulls_last() for c in rest]
    if not order:
        return df.dropDuplicates(list(key))
    newest = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rn", newest).where(F.col("_rn") == 1).drop("_rn")


def merge_upsert(target: DataFrame, delta: DataFrame, key: Sequence[str], watermark: str | None) -> DataFrame:
    """Target after the delta: matched keys replaced, new keys added, nothing deleted.

    Rows match on the key alone, so a row that moved to another partition is
    still replaced and never doubled. The join carries no hint: a small delta is
    broadcast by its measured size, a large one is shuffled.
    """
    fresh = dedup_latest(delta.select(*target.columns), key, watermark)
    return target.join(fresh.select(*key), list(key), "left_anti").select(*target.columns).unionByName(fresh)


# -- layout and writing ------------------------------------------------------


def partition_value(contract: TableContract) -> Column:
    """Partition directory of a row: its day, month or year; one directory without a column."""
    if not contract.partition_by:
        return F.lit("all")
    unit = contract.granularity.lower()
    return F.date_trunc(unit, F.col(contract.partition_by)).cast("date").cast("string")


def laid_out(df: DataFrame, contract: TableContract) -> DataFrame:
    """Rows with their partition value, ranged and sorted for writing.

    The range covers the partition, the cluster columns and the key, so a day
    that holds a third of the rows is written by many tasks, each with a narrow
    band of cluster values that file statistics can skip. Without a key the rows of
    a partition are told apart by a hash of all their columns.
    """
    sort = [PART, *contract.cluster_by]
    spread = list(dict.fromkeys([*sort, *contract.key]))
    if not contract.key:
        spread.append(_row_hash(df))
    placed = df.withColumn(PART, partition_value(contract))
    return placed.repartitionByRange(*spread).sortWithinPartitions(*sort)


def _row_hash(df: DataFrame) -> Column:
    """A hash of the columns that Spark can hash."""
    plain = [F.col(f.name) for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.xxhash64(*plain) if plain else F.lit(0)


def write_layout(df: DataFrame, contract: TableContract, path: str, *, mode: str = "static") -> None:
    """Writes the table; ``dynamic`` replaces only the partitions that have rows."""
    (
        laid_out(df, contract)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(PART)
        .parquet(path)
    )


def read_layout(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table with its partition value as text, whatever it looks like.

    Of a table with snapshots the newest one, whatever is written meanwhile. With a
    declared schema an empty table can be read too, and a column added to the
    source later is NULL in older files.
    """
    return _read_snapshot(spark, path, snapshots.current(spark, path), schema)


def _read_snapshot(spark: SparkSession, path: str, at: snapshots.Snapshot | None, schema: T.StructType | None) -> DataFrame:
    places = snapshots.directories(path, at) if at else [path]
    part = T.StructField(PART, T.StringType())
    if not places:
        return spark.createDataFrame([], T.StructType([f for f in (schema or T.StructType()) if f.name != PART] + [part]))
    reader = spark.read.option("basePath", path)
    known = schema or reader.parquet(*places).schema
    fields = [f for f in known if f.name not in (PART, snapshots.VERSION)]
    hidden = [T.StructField(snapshots.VERSION, T.StringType())] if at else []
    return reader.schema(T.StructType([*fields, part, *hidden])).parquet(*places).drop(snapshots.VERSION)


def full_reload(
    df: DataFrame, contract: TableContract, path: str, *, allow_empty: bool = False
) -> int:
    """Replaces the whole table, one row per key. An empty source is an error unless allowed.

    The new rows are written beside the old ones and become the table by one new
    snapshot. A reader meanwhile sees the old table or the new one.
    """
    spark = df.sparkSession
    settle(spark, path)
    if not allow_empty and df.isEmpty():
        raise ContractError(f"{contract.target}: source is empty, the table was not replaced")
    rows = dedup_latest(df, contract.key, contract.watermark) if contract.key else df
    before = snapshots.current(spark, path)
    parts = snapshots.write(laid_out(rows, contract), path, PART)
    at = snapshots.switch(spark, path, before, parts)
    return _read_snapshot(spark, path, at, rows.schema).count()


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table stands there; what a first load left that never ended is none."""
    return snapshots.current(spark, path) is not None or snapshots.has_plain_files(spark, path)


def settle(spark: SparkSession, path: str) -> None:
    """Removes what no reader can need any more: rows of dead runs and of older snapshots. One writer is assumed."""
    snapshots.clean(spark, path)


def _key_range(keys: DataFrame) -> Column:
    """Smallest to largest of each whole-number or text key column, as literals that reach the scan."""
    plain = [f.name for f in keys.schema if isinstance(f.dataType, (T.IntegralType, T.StringType))]
    if not plain:
        return F.lit(True)
    ends = keys.agg(*[g(c).alias(f"{n}_{i}") for i, c in enumerate(plain) for n, g in (("low", F.min), ("high", F.max))]).first()
    cond = F.lit(True)
    for i, c in enumerate(plain):
        cond &= F.col(c).between(ends[f"low_{i}"], ends[f"high_{i}"])
    return cond


def _in_parts(values: set[str | None]) -> Column:
    named = [v for v in values if v is not None]
    cond = F.col(PART).isin(*named) if named else F.lit(False)
    return cond | F.col(PART).isNull() if None in values else cond


def upsert_into(delta: DataFrame, contract: TableContract, path: str) -> None:
    """Merges a delta into a stored table and rewrites only touched partitions.

    Touched are the partitions of the new rows and those that hold an old version
    of their keys; the latter are found from the key columns alone, within the
    range of the delta's keys. Only partition values and that range reach the
    driver. The touched partitions are written beside the old ones, and a new
    snapshot takes them in and leaves out those that lost their last row. A run
    that dies before it leaves the old table, whole.
    """
    spark = delta.sparkSession
    settle(spark, path)
    key = list(contract.key)
    before = snapshots.current(spark, path)
    target = _read_snapshot(spark, path, before, delta.schema)
    columns = [c for c in target.columns if c != PART]
    fresh = dedup_latest(delta.select(*columns), key, contract.watermark)
    keys = fresh.select(*key)
    if before is None:  # written without snapshots: all of it gets one
        kept = target.join(keys, key, "left_anti").select(*columns)
        snapshots.switch(spark, path, None, snapshots.write(laid_out(kept.unionByName(fresh), contract), path, PART))
        return
    held = target.where(_key_range(keys)).join(keys, key, "left_semi").select(PART).distinct().collect()
    arriving = fresh.select(partition_value(contract).alias(PART)).distinct().collect()
    touched = {r[PART] for r in [*held, *arriving]}
    kept = target.where(_in_parts(touched)).join(keys, key, "left_anti").select(*columns)
    written = snapshots.write(laid_out(kept.unionByName(fresh), contract), path, PART)
    names = {f"{PART}={NULL_PART if value is None else value}" for value in touched}
    snapshots.switch(spark, path, before, {p: v for p, v in before.parts.items() if p not in names} | written)


def replace_days(batch: DataFrame, path: str, *, day_column: str = "data_date", sort: Sequence[str] = ()) -> None:
    """Replaces the days present in the batch and leaves every other day alone."""
    (
        batch.repartitionByRange(day_column, *sort)
        .sortWithinPartitions(day_column, *sort)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_column)
        .parquet(path)
    )


def registry_publish(
    spark: SparkSession, contracts: Sequence[TableContract], path: str, *, written_at: When
) -> DataFrame:
    """Writes the declared contracts as a table and returns what was written."""
    registry_frame(spark, contracts).withColumn("written_at", ts(written_at)).coalesce(1).write.mode(
        "overwrite"
    ).parquet(path)
    return spark.read.parquet(path)


# -- orchestration -----------------------------------------------------------

SUMMARY = "target string, mode string, rows bigint, error string, dropped map<string,string>"


def sync_table(
    contract: TableContract,
    source: DataFrame,
    root: str,
    *,
    casts: Mapping[str, str] | None = None,
    allow_empty: bool = False,
) -> tuple[str, str, int]:
    """Brings one stored table up to date; returns (target, mode, rows pulled).

    The mode is settled before any mark is computed: a new table, a declared full
    reload, no key or no watermark means reload; anything else merges a delta.
    The delta is staged as files first, so the source is read once and a lost
    executor never makes the merge see two versions of it.
    """
    spark = source.sparkSession
    path = f"{root}/{contract.target}"
    contract.check(source)
    settle(spark, path)
    reload = (
        contract.full_reload
        or not contract.key
        or not contract.watermark
        or not table_exists(spark, path)
    )
    clean = mask_pii(apply_contract(source, contract, casts), contract.mask)
    if reload:
        return contract.target, "reload", full_reload(clean, contract, path, allow_empty=allow_empty)
    target = read_layout(spark, path, clean.schema)
    mark = stored_mark(target, contract.watermark)
    delta = delta_extract(source, contract.watermark, mark)
    clean = mask_pii(apply_contract(delta, contract, casts), contract.mask)
    staging = f"{root}/{contract.target}_staging"
    clean.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staging)
    staged = spark.read.schema(clean.schema).parquet(staging)
    pulled = staged.count()
    if pulled:
        upsert_into(staged, contract, path)
    return contract.target, "merge", pulled


def sync_all(
    jobs: Sequence[tuple[TableContract, DataFrame]], root: str, **options: object
) -> DataFrame:
    """Syncs every table; one failure is reported and does not stop the others.

    The summary also names the columns that were not stored, with the reason.
    """
    spark = jobs[0][1].sparkSession
    summary: list[tuple] = []
    for contract, source in jobs:
        try:
            summary.append((*sync_table(contract, source, root, **options), None, dropped_columns(source, contract)))
        except Exception as failure:  # every table stands alone
            summary.append((contract.target, None, None, str(failure) or type(failure).__name__, None))
    return spark.createDataFrame(summary, SUMMARY)
