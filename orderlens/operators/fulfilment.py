"""Fulfilment speed, and what a tag means against the base rate."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import any_like, extract, upper_band
from ..functions.money import pct, rounded, row_count
from ..functions.quantiles import exact_quantiles
from ..functions.time import When, days_before, since, ts, week_start, whole_hours
from .filters import not_cancelled, settled, settled_orders, tagged_orders, with_flag

UPGRADE_TAG = 38
SUPPLIER_TAG = 35
SETTLING_DAYS = 5

# Upper edges of the weight bands in kilograms.
WEIGHT_BANDS = ((0.10, "a"), (0.25, "b"), (0.50, "c"), (1.00, "d"))
# How notes state a deadline and a supplier.
DEADLINE_PATTERN = r"\((\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}Z)\)"
SUPPLIER_PATTERN = r"było do (.+)$"
BASE = "(base)"


def _closed(column: str, first: When, as_of: When) -> F.Column:
    """Rows from ``first`` on, old enough that late changes have arrived."""
    return (F.col(column) >= ts(first)) & (F.col(column) < ts(days_before(as_of, SETTLING_DAYS)))


def fulfilment_weekly(
    order_header: DataFrame, *, first: When, as_of: When, late_hours: int = 48
) -> DataFrame:
    """Per week from Monday: hours from payment to shipment.

    Whole hours take a bounded set of values, so the quantiles come from one
    count per (week, hour).
    """
    hours = whole_hours(F.col("PaidDateUtc"), F.col("ShippedDateUtc"))
    shipped = order_header.where(
        _closed("CreatedOnUtc", first, as_of)
        & not_cancelled()
        & F.col("ShippedDateUtc").isNotNull()
        & F.col("PaidDateUtc").isNotNull()
    ).select(week_start(F.col("CreatedOnUtc")).alias("week"), hours.alias("hours"))
    counted = shipped.groupBy("week", "hours").agg(row_count().alias("n"))
    late = F.sum(F.when(F.col("hours") > late_hours, F.col("n")).otherwise(0))
    per_week = counted.groupBy("week").agg(
        F.sum("n").cast("bigint").alias("orders"), pct(late, F.sum("n")).alias("late_pct")
    )
    spread = exact_quantiles(
        counted, ["week"], "hours", {"median_hours": 0.5, "p90_hours": 0.9}, counted_by="n"
    )
    return per_week.join(spread, "week").select(
        "week",
        "orders",
        F.col("median_hours").cast("double").alias("median_hours"),
        F.col("p90_hours").cast("double").alias("p90_hours"),
        "late_pct",
    )


def tag_share_weekly(
    order_profit: DataFrame,
    tags: DataFrame,
    *,
    first: When,
    as_of: When,
    tag: int = UPGRADE_TAG,
) -> DataFrame:
    """Weekly share of orders that carry a tag, closed weeks only."""
    orders = order_profit.where(_closed("OrderCreatedOnUtc", first, as_of) & settled()).select(
        "CustomerOrderId", week_start(F.col("OrderCreatedOnUtc")).alias("week")
    )
    flagged = with_flag(orders, tagged_orders(tags, as_of, tag), "CustomerOrderId", "tagged")
    with_tag = F.count_if("tagged")
    return flagged.groupBy("week").agg(
        row_count().alias("orders"), with_tag.alias("tagged"), pct(with_tag, row_count(), 2).alias("tagged_pct")
    )


def upgrade_counterfactual(
    order_profit: DataFrame,
    shipping_cost: DataFrame,
    tags: DataFrame,
    *,
    as_of: When,
    days: int = 60,
    cheap: Sequence[str] = ("%UNTR%", "%MINI%"),
    min_cheap: int = 20,
    min_orders: int = 30,
    tag: int = UPGRADE_TAG,
    bands: Sequence[tuple[float, str]] = WEIGHT_BANDS,
) -> DataFrame:
    """What upgraded shipments cost over a cheap one of the same country and weight.

    The upgraded side is summed per (method, country, band) before it meets the
    cheap means, so the join touches a few cells instead of orders.
    """
    weight = F.col("OrderWeight")
    orders = (
        settled_orders(order_profit, as_of, days)
        .where(weight > 0)
        .select("CustomerOrderId", upper_band(weight, bands, "e").alias("band"))
    )
    costs = shipping_cost.select(
        "CustomerOrderId",
        F.col("ShippingCountryIso2").alias("country"),
        F.col("ShipmentMethodName").alias("method"),
        F.col("fShippingCostTotal").alias("cost"),
    )
    joined = orders.join(costs, "CustomerOrderId")
    flagged = with_flag(joined, tagged_orders(tags, as_of, tag), "CustomerOrderId", "upgraded")
    cells = (
        flagged.withColumn("is_cheap", any_like(F.col("method"), cheap))
        .groupBy("country", "band", "method", "upgraded", "is_cheap")
        .agg(row_count().alias("n"), F.count("cost").alias("n_cost"), F.sum("cost").alias("cost"))
    )
    baseline = (
        cells.where(~F.col("upgraded") & F.col("is_cheap"))
        .groupBy("country", "band")
        .agg(
            F.sum("n").alias("cheap_n"),
            (F.sum("cost") / F.sum("n_cost")).cast("decimal(18,8)").alias("cheap_mean"),
        )
        .where(F.col("cheap_n") >= min_cheap)
        .drop("cheap_n")
    )
    upgraded = cells.where(F.col("upgraded") & ~F.col("is_cheap"))
    total_cheap = F.sum(F.col("cheap_mean") * F.col("n"))
    surcharge = F.sum(F.col("cost") - F.col("cheap_mean") * F.col("n_cost"))
    return (
        upgraded.join(baseline, ["country", "band"])
        .groupBy("method")
        .agg(
            F.sum("n").cast("bigint").alias("orders"),
            rounded(F.sum("cost") / F.sum("n_cost")).alias("avg_cost"),
            rounded(total_cheap / F.sum("n")).alias("counterfactual"),
            rounded(surcharge / F.sum("n_cost")).alias("surcharge"),
            rounded(surcharge, 0).alias("surcharge_total"),
        )
        .where(F.col("orders") >= min_orders)
    )


def promise_window(
    order_profit: DataFrame,
    tags: DataFrame,
    *,
    first: When,
    tag: int = UPGRADE_TAG,
    pattern: str = DEADLINE_PATTERN,
) -> DataFrame:
    """Per order month: hours from the order to the deadline quoted in the tag's note."""
    deadline = F.try_to_timestamp(extract("Note", pattern), F.lit("yyyy-MM-dd HH:mm:ssX"))
    promised = (
        tags.where(F.col("TagId") == tag)
        .select("CustomerOrderId", deadline.alias("deadline"))
        .where(F.col("deadline").isNotNull())
    )
    orders = order_profit.where((F.col("OrderCreatedOnUtc") >= ts(first)) & settled()).select(
        "CustomerOrderId", "OrderCreatedOnUtc"
    )
    hours = orders.join(promised, "CustomerOrderId").select(
        F.date_format("OrderCreatedOnUtc", "yyyy-MM").alias("month"),
        whole_hours(F.col("OrderCreatedOnUtc"), F.col("deadline")).alias("hours"),
    )
    counted = hours.groupBy("month", "hours").agg(row_count().alias("n"))
    counts = counted.groupBy("month").agg(F.sum("n").cast("bigint").alias("orders"))
    spread = exact_quantiles(
        counted, ["month"], "hours", {"median_hours": 0.5, "p10_hours": 0.1}, counted_by="n"
    )
    return counts.join(spread, "month").select(
        "month",
        "orders",
        F.col("median_hours").cast("double").alias("median_hours"),
        F.col("p10_hours").cast("double").alias("p10_hours"),
    )


def tag_base_rate(
    order_profit: DataFrame,
    tags: DataFrame,
    *,
    as_of: When,
    days: int = 90,
    tag: int = SUPPLIER_TAG,
    pattern: str = SUPPLIER_PATTERN,
    min_orders: int = 30,
    replay: bool = True,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Losses of orders with a request to a supplier, beside the orders without one.

    An order with requests to several suppliers counts for each of them. The
    joined (supplier, profit) rows are read three times (twice for the median);
    ``stage`` may store them in between. A ``replay`` sees the requests of the window and
    30 days before it, up to ``as_of``; without it every request counts, whenever it was made.
    """
    seen = tags.where(since(F.col("CreatedOnUtc"), as_of, days + 30)) if replay else tags
    requests = (
        seen.where(F.col("TagId") == tag)
        .select("CustomerOrderId", F.trim(extract("Note", pattern)).alias("supplier"))
        .distinct()
    )
    orders = (
        settled_orders(order_profit, as_of, days)
        .select("CustomerOrderId", F.col("Profit_Actual").alias("profit"))
        .join(requests, "CustomerOrderId", "left")
        .select(F.coalesce("supplier", F.lit(BASE)).alias("supplier"), "profit")
    )
    if stage is not None:
        orders = stage(orders)
    lost = F.col("profit") < 0
    rates = orders.groupBy("supplier").agg(
        row_count().alias("orders"),
        pct(F.count_if(lost), row_count()).alias("loss_pct"),
        rounded(F.avg("profit")).alias("avg_profit"),
        rounded(F.sum(F.when(lost, F.col("profit"))), 0).alias("loss"),
        rounded(F.sum("profit"), 0).alias("net_result"),
    )
    median = exact_quantiles(orders, ["supplier"], "profit", {"median": 0.5})
    return (
        rates.where(F.col("orders") >= min_orders)
        .join(median, "supplier")
        .select(
            "supplier",
            "orders",
            "loss_pct",
            "avg_profit",
            rounded("median").alias("median_profit"),
            "loss",
            "net_result",
        )
    )


def _base_rate_by(orders: DataFrame, tags: DataFrame, as_of: When, tag: int, by: str) -> DataFrame:
    flagged = with_flag(orders, tagged_orders(tags, as_of, tag), "CustomerOrderId", "tagged")
    lost = F.col("Profit_Actual") < 0
    hit = F.col("tagged")
    return flagged.groupBy(by).agg(
        F.count_if(hit).alias("tagged_orders"),
        F.count_if(hit & lost).alias("tagged_losses"),
        F.count_if(~hit).alias("base_orders"),
        F.count_if(~hit & lost).alias("base_losses"),
        F.avg(F.when(hit, F.col("Profit_Actual"))).alias("tagged_profit"),
    )


def tag_base_rate_monthly(
    order_profit: DataFrame, tags: DataFrame, *, as_of: When, days: int = 240, tag: int = SUPPLIER_TAG
) -> DataFrame:
    """Monthly loss rate of tagged orders, of the base, and the ratio of the two."""
    orders = settled_orders(order_profit, as_of, days).withColumn(
        "month", F.date_format("OrderCreatedOnUtc", "yyyy-MM")
    )
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    # (losses / orders) over (losses / orders), as one division of exact products.
    ratio = F.try_divide(
        exact("tagged_losses") * exact("base_orders"), exact("tagged_orders") * exact("base_losses")
    )
    return _base_rate_by(orders, tags, as_of, tag, "month").select(
        "month",
        "tagged_orders",
        pct("tagged_losses", "tagged_orders").alias("tagged_loss_pct"),
        pct("base_losses", "base_orders").alias("base_loss_pct"),
        rounded(ratio, 1).alias("ratio"),
        rounded("tagged_profit").alias("tagged_avg_profit"),
    )


def tag_base_rate_by_market(
    order_profit: DataFrame, tags: DataFrame, *, as_of: When, days: int = 60, tag: int = SUPPLIER_TAG
) -> DataFrame:
    """Loss rate of tagged orders and of the base, per market."""
    orders = settled_orders(order_profit, as_of, days).withColumn("market", F.col("IdBookstore"))
    return _base_rate_by(orders, tags, as_of, tag, "market").select(
        "market",
        "tagged_orders",
        pct("tagged_losses", "tagged_orders").alias("tagged_loss_pct"),
        pct("base_losses", "base_orders").alias("base_loss_pct"),
    )


def _fulfilled(fulfilment: DataFrame, tags: DataFrame, first: When, until: When, tag: int) -> DataFrame:
    rows = fulfilment.where(
        (F.col("ORDER_CREATED") >= ts(first)) & (F.col("ORDER_CREATED") < ts(until))
    )
    return with_flag(rows, tagged_orders(tags, until, tag), "CustomerOrderId", "upgraded")


def _mean_hours(column: str) -> F.Column:
    return rounded(F.avg(F.col(column).cast("decimal(18,4)")), 1)


def upgrade_vs_base(
    fulfilment: DataFrame, tags: DataFrame, *, first: When, until: When, tag: int = UPGRADE_TAG
) -> DataFrame:
    """Did upgraded orders wait longer for goods, packing or delivery?"""
    on_time = F.col("IsReceivedOnTime")
    group = F.when(F.col("upgraded"), "upgraded").otherwise("base")
    return (
        _fulfilled(fulfilment, tags, first, until, tag)
        .groupBy(group.alias("cohort"))
        .agg(
            row_count().alias("orders"),
            pct(F.count("GOODS_ORDERED"), row_count()).alias("purchase_pct"),
            _mean_hours("GOODS_RECEIVED_duration").alias("goods_hours"),
            _mean_hours("PACKING_duration").alias("packing_hours"),
            _mean_hours("Hours_late_shipped").alias("late_hours"),
            pct(F.count_if(F.col("Hours_late_shipped") > 0), row_count()).alias("shipped_late_pct"),
            pct(F.count_if(~on_time), F.count(on_time)).alias("delivered_late_pct"),
        )
    )


def deadline_source_monthly(
    fulfilment: DataFrame, tags: DataFrame, *, first: When, until: When, tag: int = UPGRADE_TAG
) -> DataFrame:
    """Per month and source of the shipping deadline: orders and upgraded orders."""
    return (
        _fulfilled(fulfilment, tags, first, until, tag)
        .groupBy(
            F.date_format("ORDER_CREATED", "yyyy-MM").alias("month"),
            F.coalesce("ShipDeadlineSource", F.lit("(none)")).alias("deadline_source"),
        )
        .agg(row_count().alias("orders"), F.count_if("upgraded").alias("upgraded"))
    )


def supplier_upgrade_rate(
    fulfilment: DataFrame,
    tags: DataFrame,
    *,
    first: When,
    until: When,
    tag: int = UPGRADE_TAG,
    min_orders: int = 200,
    k: int = 20,
    name_length: int = 22,
) -> DataFrame:
    """Upgrade rate per supplier among orders that needed a purchase; the k highest.

    Suppliers are told apart by their whole name; only the shown text is cut to ``name_length``.
    """
    supplier = F.coalesce("GOODS_RECEIVED_supplier", "GOODS_ORDERED_supplier")
    upgraded = F.count_if("upgraded")
    return (
        _fulfilled(fulfilment, tags, first, until, tag)
        .where(F.col("GOODS_ORDERED").isNotNull())
        .groupBy(supplier.alias("supplier"))
        .agg(
            row_count().alias("orders"),
            upgraded.alias("upgraded"),
            pct(upgraded, row_count()).alias("upgraded_pct"),
            _mean_hours("GOODS_RECEIVED_duration").alias("goods_hours"),
            pct(F.count_if(F.col("Hours_late_shipped") > 0), row_count()).alias("shipped_late_pct"),
        )
        .where(F.col("orders") >= min_orders)
        .orderBy(F.col("upgraded_pct").desc(), "supplier")
        .limit(k)
        .withColumn("supplier", F.left("supplier", F.lit(name_length)))
    )
