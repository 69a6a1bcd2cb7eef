"""Running a list of checks as one job.

A check is an operator with its settings. Its rows become JSON payloads, so checks
of different shape share one table; a summary says who spoke, who was silent and
who failed. A failing check never stops the others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROWS = "check string, row_no bigint, payload string, link string"
SUMMARY = "check string, description string, rows bigint, silent boolean, error string"


@dataclass(frozen=True)
class Check:
    """``order_by`` numbers the rows, ties by the rest of the row. A report may have any number of rows."""

    name: str
    run: Callable[[], DataFrame]
    description: str = ""
    silent_when_empty: bool = False
    order_by: tuple[str, ...] = ()
    link_column: str | None = None
    link_template: str = "{}"


@dataclass(frozen=True)
class CheckResults:
    rows: DataFrame
    summary: DataFrame
    links: DataFrame
    kept: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Frees the kept rows once the report is delivered."""
        for part in self.kept:
            part.unpersist()


def _numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with ``row_no`` by the columns ``order``, and the kept rows that it rests on.

    The rows are dealt to tasks by ranges of the order and numbered within each; a range starts behind the rows of the
    ranges before it, of which there is one count per task. The ranges are drawn once, so the dealt rows are kept.
    """
    dealt = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).persist()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = dealt.withColumn("_inside", inside).join(starts, "_range")
    return numbered.withColumn("row_no", (F.col("_start") + F.col("_inside")).cast("bigint")), dealt


def typed(rows: DataFrame, schema: str) -> DataFrame:
    """The rows with the fields of ``schema`` as columns, read from the payload; a check without a field gives NULL."""
    return rows.select("check", "row_no", F.from_json("payload", schema).alias("_p"), "link").select(
        "check", "row_no", "_p.*", "link"
    )


def _payload(check: Check) -> tuple[DataFrame, list[DataFrame]]:
    df = check.run()
    link = F.lit(None).cast("string")
    if check.link_column:
        template = check.link_template.replace("%", "%%").replace("{}", "%s")
        value = F.col(check.link_column).cast("string")
        link = F.when(value.isNotNull(), F.format_string(template, value))
    order = [F.col(c).alias(f"_o{i}") for i, c in enumerate(check.order_by)]
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("payload"), link.alias("link"), *order)
    kept: list[DataFrame] = []
    if order:
        rows, dealt = _numbered(rows, [*(f"_o{i}" for i in range(len(order))), "payload"])
        kept.append(dealt)
    else:
        rows = rows.withColumn("row_no", F.lit(None).cast("bigint"))
    return rows.select(F.lit(check.name).alias("check"), "row_no", "payload", "link"), kept


def run_checks(spark: SparkSession, checks: Sequence[Check]) -> CheckResults:
    """Rows, summary and every distinct link of all checks.

    Building a plan can fail (a missing column, say); so can running it. Both are
    caught per check: every check is counted on its own before it joins the
    union, and a silent check without rows is dropped but named. The rows of a
    report are kept from the count, so no check runs twice; spilled or lost
    blocks are recomputed.
    """
    parts: list[DataFrame] = []
    kept: list[DataFrame] = []
    summary = []
    for check in checks:
        try:
            part, dealt = _payload(check)
            kept += dealt
            part = part.persist()
            kept.append(part)
            n = part.count()
            summary.append((check.name, check.description, n, n == 0 and check.silent_when_empty, None))
            parts.append(part)
        except Exception as failure:  # one check must not stop the report
            summary.append((check.name, check.description, None, False, str(failure) or type(failure).__name__))
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], ROWS)
    links = rows.where(F.col("link").isNotNull()).select("check", "link").distinct()
    return CheckResults(rows, spark.createDataFrame(summary, SUMMARY), links, tuple(kept))


def failed(results: CheckResults) -> bool:
    """True when a check failed, for the exit code of a job."""
    return not results.summary.where(F.col("error").isNotNull()).isEmpty()
