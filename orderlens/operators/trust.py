"""Can the data be trusted? Keys, age, coverage and silence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.classify import first_match
from ..functions.money import pct, row_count
from ..functions.time import When, day, days_before, ts

DEFAULT_MAX_AGE_DAYS = 2

# The declared expectation of marketplace reports.
EU_MARKETS = ("AZ-DE", "AZ-UK", "AZ-FR", "AZ-IT", "AZ-ES", "AZ-NL", "AZ-BE", "AZ-SE", "AZ-PL", "AZ-IE")
REGIONS = {"EU": EU_MARKETS, "NA": ("AZ-US", "AZ-CA"), "FE": ("AZ-AU",)}
EXPECTED_REPORTS = tuple(
    (report, market, max_days)
    for report, markets, max_days in (
        ("GET_V2_SELLER_PERFORMANCE_REPORT", (*EU_MARKETS, "AZ-US", "AZ-CA", "AZ-AU"), 2),
        ("GET_SELLER_FEEDBACK_DATA", EU_MARKETS, 2),
        ("GET_FLAT_FILE_RETURNS_DATA_BY_RETURN_DATE", EU_MARKETS[:5], 4),
    )
    for market in markets
)


class Watched(NamedTuple):
    """A table to watch: its frame, its key columns and its time column."""

    frame: DataFrame
    key: Sequence[str]
    watermark: str


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def mirror_health(
    tables: Mapping[str, Watched],
    *,
    as_of: When,
    max_age_hours: int = 12,
    rarely_changed: Sequence[str] = (),
) -> DataFrame:
    """Tables with repeated keys, old data or no rows at all. A healthy set gives no rows."""
    facts = _stack(
        [
            t.frame.agg(
                F.lit(name).alias("table_name"),
                row_count().alias("rows"),
                (row_count() - F.count_distinct(*t.key)).alias("duplicate_keys"),
                F.timestamp_diff("HOUR", F.max(t.watermark), ts(as_of)).alias("age_hours"),
            )
            for name, t in tables.items()
        ]
    )
    duplicates = F.col("duplicate_keys") > 0
    old = F.col("age_hours") > max_age_hours
    empty = F.col("rows") == 0
    exempt = F.col("table_name").isin(*rarely_changed) if rarely_changed else F.lit(False)
    status = (
        F.when(duplicates & old, "duplicates and stale")
        .when(duplicates, "duplicate keys")
        .when(empty, "empty")
        .otherwise("stale")
    )
    return facts.where(duplicates | (old & ~exempt) | empty).select(
        "table_name", "rows", "duplicate_keys", "age_hours", status.alias("status")
    )


def catalog_stats(tables: Mapping[str, tuple[DataFrame, str]], *, as_of: When) -> DataFrame:
    """Per table: day of the last change, its age in days, and the row count."""
    return _stack(
        [
            frame.agg(
                F.lit(name).alias("table_name"),
                F.max(changed).cast("date").alias("modified"),
                F.date_diff(day(as_of), F.max(changed).cast("date")).cast("bigint").alias("age_days"),
                row_count().alias("rows"),
            )
            for name, (frame, changed) in tables.items()
        ]
    )


def registry_reconcile(
    registry: DataFrame,
    catalog: DataFrame,
    *,
    default_max_age: int = DEFAULT_MAX_AGE_DAYS,
    documented: Sequence[str] = (),
    own: Sequence[str] = ("etl_registry",),
) -> DataFrame:
    """Promised tables against existing ones: missing, stale, or registered nowhere.

    ``documented`` tables live legally outside the registry; ``own`` and staging
    tables are not data. ``severity_order`` sorts the worst problem first.
    """
    existing = catalog.where(
        ~F.col("table_name").endswith("_staging") & ~F.col("table_name").isin(*own)
    )
    limit = F.coalesce("max_age_days", F.lit(default_max_age))
    both = registry.join(existing, F.col("target") == F.col("table_name"), "full")
    known = F.col("table_name").isin(*documented) if documented else F.lit(False)
    order = (
        F.when(F.col("table_name").isNull(), 1)
        .when(F.col("target").isNull() & ~known, 3)
        .when(F.col("target").isNotNull() & (F.col("age_days") > limit), 2)
    )
    names = {1: "missing", 2: "stale", 3: "not registered"}
    return (
        both.withColumn("severity_order", order)
        .where(F.col("severity_order").isNotNull())
        .select(
            "severity_order",
            F.coalesce("target", "table_name").alias("table_name"),
            F.create_map(*[F.lit(x) for p in names.items() for x in p])[F.col("severity_order")].alias("problem"),
            "modified",
            "age_days",
            "rows",
            F.when(F.col("severity_order") == 2, limit).cast("bigint").alias("max_age_days"),
            "source",
        )
    )


def coverage_vs_expected(
    landings: DataFrame,
    *,
    as_of: When,
    expected: Sequence[tuple[str, str, int]] = EXPECTED_REPORTS,
    regions: Mapping[str, Sequence[str]] = REGIONS,
) -> DataFrame:
    """Declared reports that never arrived, died or are late.

    An EMPTY report is coverage: somebody looked and found nothing. A row without
    status counts when it has content. A regional label stands for its markets
    and also for itself. Landings are folded per (report, label) before labels
    are expanded, so the expansion works on a handful of rows.
    """
    status = F.col("status")
    good = status.isin("LANDED", "EMPTY") | (status.isNull() & (F.col("contentBytes") > 0))
    per_label = landings.groupBy(F.col("reportType").alias("report"), F.col("market").alias("label")).agg(
        F.max(F.when(good, F.col("fetchedOnUtc").cast("date"))).alias("last"),
        F.count_if(good).alias("successes"),
        F.count_if(status == "FAILED").alias("failures"),
    )
    expanded = F.array(F.col("label"))
    if regions:
        entries = [x for r, m in regions.items() for x in (F.lit(r), F.array(*map(F.lit, m)))]
        none = F.expr("cast(array() as array<string>)")
        expanded = F.concat(expanded, F.coalesce(F.create_map(*entries)[F.col("label")], none))
    have = (
        per_label.select("report", F.explode(expanded).alias("market"), "last", "successes", "failures")
        .groupBy("report", "market")
        .agg(F.max("last").alias("last"), F.sum("successes").alias("successes"), F.sum("failures").alias("failures"))
    )
    wanted = landings.sparkSession.createDataFrame(
        list(expected), "report string, market string, max_days int"
    )
    age = F.date_diff(day(as_of), F.col("last"))
    state = (
        F.when(F.col("last").isNull(), "1. never")
        .when(age > F.col("max_days") * 3, "2. dead")
        .when(age > F.col("max_days"), "3. late")
        .otherwise("4. ok")
    )
    return (
        wanted.join(have, ["report", "market"], "left")
        .where(F.col("last").isNull() | (age > F.col("max_days")))
        .select(
            "report",
            "market",
            F.col("last").alias("last_success"),
            age.cast("bigint").alias("days_ago"),
            F.coalesce("successes", F.lit(0)).cast("bigint").alias("successes"),
            F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
            state.alias("state"),
        )
    )


def silence_alarm(
    events: DataFrame, column: str, *, as_of: When, source: str, max_silent_days: int = 4
) -> DataFrame:
    """One row when nothing has arrived for too long; an empty table always alarms."""
    last = F.max(F.col(column).cast("date"))
    return (
        events.agg(last.alias("last"), row_count().alias("events_total"))
        .select(
            F.lit(source).alias("source"),
            F.coalesce(F.col("last").cast("string"), F.lit("NEVER")).alias("last_event"),
            F.coalesce(F.date_diff(day(as_of), F.col("last")), F.lit(9999)).cast("bigint").alias("silent_days"),
            "events_total",
        )
        .where(F.col("silent_days") > max_silent_days)
    )


def source_target_reconcile(
    source: DataFrame,
    target: DataFrame,
    *,
    key: Sequence[str],
    watermark: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Measures of a table on both sides with their difference.

    Counts, distinct keys and the newest change show missing rows; the length of
    text columns shows values that were cut without an error. Each side is one
    aggregation; the sides meet as a handful of named figures.
    """
    chosen = list(columns or [c for c in source.columns if c in target.columns])

    def figures(df: DataFrame, side: str) -> DataFrame:
        text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        measures: dict[str, Column] = {
            "rows": row_count(),
            "distinct_keys": F.count_distinct(*key),
            "max_time": F.unix_seconds(F.max(watermark).cast("timestamp")),
        }
        for c in chosen:
            measures[f"{c}: non_null"] = F.count(c)
            if c in text:
                measures[f"{c}: length"] = F.coalesce(F.sum(F.length(c)), F.lit(0))
        one = df.agg(*[m.cast("bigint").alias(f"m{i}") for i, m in enumerate(measures.values())])
        rows = [
            F.struct(F.lit(name).alias("measure"), F.col(f"m{i}").alias("value"))
            for i, name in enumerate(measures)
        ]
        return one.select(F.lit(side).alias("side"), F.inline(F.array(*rows)))

    at = lambda side: F.max(F.when(F.col("side") == side, F.col("value")))
    return (
        figures(source, "source")
        .unionByName(figures(target, "target"))
        .groupBy("measure")
        .agg(at("source").alias("source_value"), at("target").alias("target_value"))
        .withColumn("difference", F.col("source_value") - F.col("target_value"))
    )


# Bytes of one value of a fixed-width type.
WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
    T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def column_footprint(df: DataFrame) -> DataFrame:
    """Bytes held by every column and its share of the table, in one pass."""

    def size(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0))
        width = WIDTHS.get(type(f.dataType))
        if isinstance(f.dataType, T.DecimalType):
            width = 8 if f.dataType.precision <= 18 else 16
        if width is not None:
            return F.count(f.name) * width
        return F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(f.name)))), F.lit(0))

    fields = df.schema.fields
    sizes = df.agg(*[size(f).cast("bigint").alias(f"s{i}") for i, f in enumerate(fields)])
    rows = [
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"s{i}").alias("bytes"))
        for i, f in enumerate(fields)
    ]
    return sizes.select(F.inline(F.array(*rows))).select(
        "column_name",
        "bytes",
        pct("bytes", F.sum("bytes").over(Window.partitionBy()), 2).alias("share_pct"),
    )


Rule = tuple[str, Column]


def severity(df: DataFrame, rules: Sequence[Rule], *, default: str = "info") -> DataFrame:
    """Adds the level of the first rule that holds."""
    return df.withColumn("severity", first_match([(cond, level) for level, cond in rules], default))


# Thresholds of the four watched reports, by their result columns.
SEVERITY_RULES: dict[str, tuple[tuple[str, str], ...]] = {
    "weekly_losses": (("critical", "profit < -50"), ("warning", "profit < -20")),
    "problem_products": (
        ("critical", "total_loss < -200 OR losses >= 10"),
        ("warning", "losses >= 5"),
    ),
    "shipping_estimate_outliers": (
        ("critical", "difference_pct > 100"),
        ("warning", "difference_pct > 50"),
    ),
    "marketplace_cost_outliers": (
        ("critical", "marketplace_pct > 25"),
        ("warning", "marketplace_pct > 20"),
    ),
}


def rules_for(report: str) -> list[Rule]:
    return [(level, F.expr(cond)) for level, cond in SEVERITY_RULES[report]]


def watermark_profile(
    df: DataFrame, column: str, *, as_of: When, table: str, placeholder: str = "1977-06-14"
) -> DataFrame:
    """Is a column fit to be a watermark? One row.

    A column that is mostly a placeholder date, or never changes, would pull nothing.
    """
    c = F.col(column)
    on_placeholder = c.cast("date") == F.lit(placeholder).cast("date")
    return df.agg(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        row_count().alias("rows"),
        F.count_if(c.isNull()).alias("nulls"),
        F.max(c).cast("date").alias("newest"),
        pct(F.count_if(on_placeholder), row_count(), 2).alias("placeholder_pct"),
        F.count_distinct(c.cast("date")).alias("distinct_days"),
        F.count_if((c >= ts(days_before(as_of, 1))) & (c <= ts(as_of))).alias("changed_last_day"),
    )
