"""Cloud billing."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import dec, pct, rounded
from ..functions.time import When, months_back

TAX_SERVICE = "Invoice"
VAT = 1.23


class Watch(NamedTuple):
    """A metric to follow: the costs whose column matches a LIKE pattern."""

    label: str
    column: str
    pattern: str


# Watched metrics of the two billing accounts.
WATCH_MAIN = (
    Watch("BigQuery queries", "sku", "Analysis%"),
    Watch("Dataplex", "sku", "Dataplex Premium Processing%"),
    Watch("Compute Engine", "service", "Compute Engine"),
    Watch("Cloud Storage", "service", "Cloud Storage"),
)
WATCH_SECOND = (
    Watch("Cloud Storage", "service", "Cloud Storage"),
    Watch("Secret Manager", "service", "Secret Manager"),
)


def net_cost(billing: DataFrame, *, months: Sequence[str] | None = None) -> DataFrame:
    """Cost plus credits per month, service and SKU.

    Credits are summed inside each row's array; an empty or NULL array is zero.
    """
    rows = billing
    if months is not None:
        rows = rows.where(F.col("invoice.month").isin(*months))
    zero = F.lit(0).cast("decimal(24,4)")
    credits = F.aggregate(
        F.coalesce("credits", F.expr("cast(array() as array<struct<amount:decimal(18,4)>>)")),
        zero,
        lambda total, c: (total + F.coalesce(c["amount"], zero)).cast("decimal(24,4)"),
    )
    return rows.groupBy(
        F.col("invoice.month").alias("month"),
        F.col("service.description").alias("service"),
        F.col("sku.description").alias("sku"),
    ).agg((F.sum("cost") + F.sum(credits)).cast("decimal(28,4)").alias("net"))


def monthly_cost_report(
    billing: DataFrame,
    *,
    as_of: When,
    watch: Sequence[Watch] = WATCH_MAIN,
    tax_service: str = TAX_SERVICE,
    top: int = 5,
) -> DataFrame:
    """The closed month against the month before and the month a year earlier.

    Sections: total with tax, the costliest services, watched metrics. While tax
    is not booked yet, the total is the net cost plus the tax rate.
    """
    closed, before, year = (months_back(as_of, n) for n in (1, 2, 13))
    costs = net_cost(billing, months=[closed, before, year])
    net, service = F.col("net"), F.col("service")
    at = lambda month, value=net: F.sum(F.when(F.col("month") == month, value))

    by_service = costs.groupBy("service").agg(
        at(closed).alias("current"), at(before).alias("previous"), at(year).alias("year_ago")
    )
    is_tax = service == tax_service

    def gross(column: str):
        tax = F.sum(F.when(is_tax, F.col(column)).otherwise(dec(0)))
        taxed = F.sum(column)
        untaxed = F.sum(F.when(~is_tax, F.col(column)))
        return F.when(tax > 0, taxed).otherwise(untaxed * dec(VAT)).cast("decimal(28,4)").alias(column)

    change = lambda now, then: pct(F.col(now) - F.col(then), then, 0)
    total = by_service.agg(gross("current"), gross("previous"), gross("year_ago")).select(
        F.lit("1. total with tax").alias("section"),
        F.lit(closed).alias("item"),
        rounded("current", 0).alias("cost"),
        rounded("previous", 0).alias("previous"),
        change("current", "previous").alias("change_pct"),
        change("current", "year_ago").alias("year_change_pct"),
    )
    best = (
        by_service.where(~is_tax & F.col("current").isNotNull())
        .orderBy(F.col("current").desc(), "service")
        .limit(top)
        .select(
            F.lit("2. top services").alias("section"),
            service.alias("item"),
            rounded("current", 0).alias("cost"),
            rounded("previous", 0).alias("previous"),
            change("current", "previous").alias("change_pct"),
        )
    )
    report = total.unionByName(best, allowMissingColumns=True)
    if not watch:
        return report
    watched = costs.agg(
        *[
            F.sum(F.when((F.col("month") == month) & F.col(w.column).like(w.pattern), net)).alias(f"{name}_{i}")
            for i, w in enumerate(watch)
            for name, month in (("current", closed), ("previous", before))
        ]
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(w.label).alias("item"),
                        F.col(f"current_{i}").alias("current"),
                        F.col(f"previous_{i}").alias("before"),
                    )
                    for i, w in enumerate(watch)
                ]
            )
        )
    ).select(
        F.lit("3. watched").alias("section"),
        "item",
        rounded("current", 0).alias("cost"),
        rounded("before", 0).alias("previous"),
        change("current", "before").alias("change_pct"),
    )
    return report.unionByName(watched, allowMissingColumns=True)
