"""Estimate against actual, and drill-down into the cost of an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import dec, pct, ratio, rounded, row_count, share, zero_if_null
from ..functions.time import When, since
from .filters import not_cancelled, settled_orders, tagged_orders, with_flag

ACTUAL_SHIPPING = "fShippingCostTotal"
ESTIMATED_SHIPPING = "ShippingCostTotal_EstimatedPreShipments"


def pricing_drift(
    order_profit: DataFrame,
    shipping_cost: DataFrame,
    *,
    as_of: When,
    days: int = 7,
    step: float = 5,
) -> DataFrame:
    """Losing against profitable orders: how far costs ran over the estimate."""
    product = zero_if_null("ProductCost") - zero_if_null("ProductCost_Estimated")
    shipping = zero_if_null(ACTUAL_SHIPPING) - zero_if_null(ESTIMATED_SHIPPING)
    costs = shipping_cost.select("CustomerOrderId", ACTUAL_SHIPPING, ESTIMATED_SHIPPING)
    return (
        settled_orders(order_profit, as_of, days)
        .join(costs, "CustomerOrderId", "left")
        .groupBy(F.when(F.col("Profit_Actual") < 0, "losing").otherwise("profitable").alias("result"))
        .agg(
            row_count().alias("orders"),
            rounded(F.sum("Profit_Actual")).alias("net_profit"),
            rounded(F.sum(product)).alias("product_over_estimate"),
            rounded(F.sum(shipping)).alias("shipping_over_estimate"),
            F.count_if(product > dec(step)).alias("orders_product_over"),
            F.count_if(shipping > dec(step)).alias("orders_shipping_over"),
        )
    )


def shipping_drift_patterns(
    order_profit: DataFrame,
    shipping_cost: DataFrame,
    *,
    as_of: When,
    days: int = 7,
    min_orders: int = 5,
    step: float = 5,
) -> DataFrame:
    """Per shipment method and carrier: how far actual cost runs from the estimate."""
    costs = shipping_cost.select(
        "CustomerOrderId",
        F.coalesce("ShipmentMethodName", F.lit("(no method)")).alias("method"),
        F.coalesce("ShippingCompany", F.lit("(none)")).alias("carrier"),
        zero_if_null(ESTIMATED_SHIPPING).alias("estimate"),
        zero_if_null(ACTUAL_SHIPPING).alias("actual"),
    ).withColumn("drift", F.col("actual") - F.col("estimate"))
    return (
        settled_orders(order_profit, as_of, days)
        .select("CustomerOrderId", "Profit_Actual")
        .join(costs, "CustomerOrderId")
        .groupBy("method", "carrier")
        .agg(
            row_count().alias("orders"),
            rounded(F.sum("drift")).alias("drift"),
            rounded(F.avg("drift")).alias("avg_drift"),
            rounded(F.avg("estimate")).alias("avg_estimate"),
            rounded(F.avg("actual")).alias("avg_actual"),
            share(F.sum("actual"), F.sum("estimate")).alias("multiple"),
            F.count_if(F.col("drift") > dec(step)).alias("orders_over"),
            F.count_if(F.col("Profit_Actual") < 0).alias("losing_orders"),
        )
        .where(F.col("orders") >= min_orders)
    )


def shipping_estimate_outliers(
    order_profit: DataFrame,
    shipping_cost: DataFrame,
    *,
    as_of: When,
    days: int = 7,
    min_deviation: float = 0.50,
    k: int = 20,
) -> DataFrame:
    """The k orders whose shipping estimate missed by the largest amount."""
    estimate, actual = F.col(ESTIMATED_SHIPPING), F.col(ACTUAL_SHIPPING)
    diff = actual - estimate
    off = shipping_cost.where(
        (estimate > 0) & (ratio(F.abs(diff), estimate) > dec(min_deviation))
    ).select("CustomerOrderId", actual, estimate)
    orders = order_profit.where(
        since(F.col("OrderCreatedOnUtc"), as_of, days) & not_cancelled()
    ).select("CustomerOrderId", "Profit_Actual")
    return (
        orders.join(off, "CustomerOrderId")
        .orderBy(F.abs(diff).desc(), "CustomerOrderId")
        .limit(k)
        .select(
            F.col("CustomerOrderId").alias("order_id"),
            rounded(estimate).alias("estimate"),
            rounded(actual).alias("actual"),
            rounded(diff).alias("difference"),
            pct(diff, estimate).alias("difference_pct"),
            rounded("Profit_Actual").alias("profit"),
        )
    )


def marketplace_cost_outliers(
    order_profit: DataFrame,
    marketplace_cost: DataFrame,
    *,
    as_of: When,
    days: int = 7,
    raised: float = 0.17,
    critical: float = 0.20,
    k: int = 20,
) -> DataFrame:
    """The k orders that pay the largest part of their value to the marketplace."""
    part = ratio("fMarketplaceCost", "fOrderTotal")
    orders = order_profit.where(
        since(F.col("OrderCreatedOnUtc"), as_of, days) & not_cancelled()
    ).select("CustomerOrderId", "IdBookstore", "fOrderTotal", "Profit_Actual")
    return (
        orders.join(marketplace_cost, "CustomerOrderId")
        .withColumn("part", part)
        .where(F.col("part") > dec(raised))
        .orderBy(F.round("part", 8).desc(), "CustomerOrderId")
        .limit(k)
        .select(
            F.col("CustomerOrderId").alias("order_id"),
            F.col("IdBookstore").alias("market"),
            rounded("fOrderTotal").alias("order_value"),
            rounded("fMarketplaceCost").alias("marketplace_cost"),
            pct("fMarketplaceCost", "fOrderTotal").alias("marketplace_pct"),
            rounded("ReferralFee_Actual").alias("referral_fee"),
            rounded("ClosingFees_Actual").alias("closing_fee"),
            rounded("Profit_Actual").alias("profit"),
            F.when(F.col("part") > dec(critical), "critical").otherwise("raised").alias("grade"),
        )
    )


def cost_breakdown(
    order_profit: DataFrame,
    shipping_cost: DataFrame,
    payment_cost: DataFrame,
    marketplace_cost: DataFrame,
    *,
    order_id: int | None = None,
) -> DataFrame:
    """Per order: every indirect cost and their total. A missing row counts as zero."""
    if order_id is not None:
        order_profit = order_profit.where(F.col("CustomerOrderId") == order_id)
    shipping = zero_if_null(ACTUAL_SHIPPING)
    payment = zero_if_null("fPaymentCost")
    market = zero_if_null("fMarketplaceCost")
    handling = F.col("HandlingCost") + F.col("PackagingCost")
    return (
        order_profit.select("CustomerOrderId", "fOrderTotal", "Profit_Actual", "HandlingCost", "PackagingCost")
        .join(shipping_cost.select("CustomerOrderId", ACTUAL_SHIPPING), "CustomerOrderId", "left")
        .join(payment_cost.select("CustomerOrderId", "fPaymentCost"), "CustomerOrderId", "left")
        .join(marketplace_cost.select("CustomerOrderId", "fMarketplaceCost"), "CustomerOrderId", "left")
        .select(
            F.col("CustomerOrderId").alias("order_id"),
            rounded("fOrderTotal").alias("revenue"),
            rounded("Profit_Actual").alias("profit"),
            rounded(shipping).alias("shipping_cost"),
            rounded(payment).alias("payment_cost"),
            rounded(market).alias("marketplace_cost"),
            rounded(handling).alias("handling_cost"),
            rounded(shipping + payment + market + handling).alias("indirect_cost"),
        )
    )


def order_summary(order_profit: DataFrame, *, order_id: int | None = None) -> DataFrame:
    """Order header with the loss as a share of revenue; cancelled orders excluded."""
    if order_id is not None:
        order_profit = order_profit.where(F.col("CustomerOrderId") == order_id)
    return order_profit.where(not_cancelled()).select(
        F.col("CustomerOrderId").alias("order_id"),
        F.col("IdBookstore").alias("market"),
        F.col("OrderCreatedOnUtc").cast("date").alias("ordered_on"),
        rounded("Profit_Actual").alias("profit"),
        rounded("fOrderTotal").alias("order_value"),
        pct(F.abs("Profit_Actual"), "fOrderTotal").alias("loss_pct"),
        F.col("OrderStatusId").cast("int").alias("status"),
        F.col("LastUpdatedOnUtc").cast("date").alias("updated_on"),
    )


def order_tags(tags: DataFrame, *, order_id: int | None = None) -> DataFrame:
    """Tags with their source. Sorted newest first when one order is asked for."""
    columns = [
        F.col("CustomerOrderId").alias("order_id"),
        F.col("Source").alias("source"),
        F.col("Description").alias("description"),
        F.col("CreatedOnUtc").alias("created"),
    ]
    if order_id is None:
        return tags.select(*columns)
    one = tags.where(F.col("CustomerOrderId") == order_id)
    return one.select(*columns).orderBy(F.col("created").desc())


def profit_revisions(revisions: DataFrame, *, slice_by: str = "day") -> DataFrame:
    """Change of profit against the previous revision of the same order.

    Revisions are ordered by the time they were replaced; the creation time does
    not order them. The window runs per order and slice of time, and only the last
    revision of each slice is carried over to the next one, so an order with very
    many revisions is split over its slices instead of sorted in one task.
    ``slice_by`` is a unit of date_trunc; take a finer one where days are crowded.
    A revision without a time counts as the earliest; within a time NULL values come first.
    """
    order = ("DeletedOnUtc", "Profit_Actual", "Notes")
    dated = revisions.withColumn("slice", F.date_trunc(slice_by, "DeletedOnUtc"))
    last = dated.groupBy("CustomerOrderId", "slice").agg(F.max(F.struct(*order)).alias("last"))
    by_slice = Window.partitionBy("CustomerOrderId").orderBy("slice")
    carried = last.select(
        F.col("CustomerOrderId").alias("_order"), F.col("slice").alias("_slice"), F.lag(F.col("last")["Profit_Actual"]).over(by_slice).alias("carried")
    )
    # Null-safe on both keys: a revision without a time or an order is a row like any other.
    same = F.col("_order").eqNullSafe(F.col("CustomerOrderId")) & F.col("_slice").eqNullSafe(F.col("slice"))
    within = Window.partitionBy("CustomerOrderId", "slice").orderBy(*order)
    previous = F.when(F.col("rn") == 1, F.col("carried")).otherwise(F.col("before"))
    return (
        dated.withColumns(
            {"rn": F.row_number().over(within), "before": F.lag("Profit_Actual").over(within)}
        )
        .join(carried, same)
        .select(
            F.col("CustomerOrderId").alias("order_id"),
            F.col("DeletedOnUtc").alias("changed"),
            rounded("Profit_Actual").alias("profit"),
            rounded(F.col("Profit_Actual") - previous).alias("profit_change"),
            F.col("Notes").alias("notes"),
        )
    )


def price_history(
    offers: DataFrame, *, as_of: When, days: int = 30, k: int = 20, ean: str | None = None
) -> DataFrame:
    """The newest k offers of every product, or of one product.

    The rank filter is pushed below the shuffle, so a product with very many
    offers sends at most k rows per task.
    """
    recent = offers.where(since(F.col("CreatedOnUtc"), as_of, days))
    if ean is not None:
        recent = recent.where(F.col("OurEan") == ean)
    newest = Window.partitionBy("OurEan").orderBy(F.col("CreatedOnUtc").desc(), "Id")
    return (
        recent.withColumn("rn", F.row_number().over(newest))
        .where(F.col("rn") <= k)
        .select(
            F.col("OurEan").alias("ean"),
            F.col("CreatedOnUtc").alias("offered"),
            F.col("BookstoreId").alias("market"),
            rounded("Price").alias("price"),
            rounded("PriceMin").alias("min_price"),
            F.col("LastSubmittedOnUtc").alias("submitted"),
            F.col("LastUpdatedOnUtc").alias("updated"),
        )
    )


def product_shipment_methods(
    product_methods: DataFrame, methods: DataFrame, *, ean: str | None = None
) -> DataFrame:
    """Shipment methods mapped to a product, with the attributes of the method."""
    if ean is not None:
        product_methods = product_methods.where(F.col("EAN") == ean)
    attributes = methods.select(
        F.col("Id").alias("ShipmentMethodId"),
        F.col("ShipmentMethodName").alias("method"),
        F.col("ShipmentMethodFriendlyName").alias("friendly_name"),
        F.col("isTrackable").alias("trackable"),
        F.col("isConsolidated").alias("consolidated"),
        F.col("AllowedRegion").alias("region"),
    )
    return product_methods.join(attributes, "ShipmentMethodId", "left").select(
        F.col("EAN").alias("ean"),
        F.col("ShipmentMethodId").alias("method_id"),
        "method",
        "friendly_name",
        "trackable",
        "consolidated",
        "region",
        F.col("CreatedOnUtc").alias("mapped"),
    )


def driver_means(
    order_profit: DataFrame,
    tags: DataFrame,
    *,
    as_of: When,
    tag: int = 35,
    days: int = 60,
    market: str | None = None,
) -> DataFrame:
    """Mean cost drivers of orders with the tag against all others."""
    orders = settled_orders(order_profit, as_of, days)
    if market is not None:
        orders = orders.where(F.col("IdBookstore") == market)
    flagged = with_flag(orders, tagged_orders(tags, as_of, tag), "CustomerOrderId", "tagged")
    return flagged.groupBy(F.when(F.col("tagged"), "tagged").otherwise("base").alias("cohort")).agg(
        row_count().alias("orders"),
        rounded(F.avg("fOrderTotal")).alias("avg_revenue"),
        rounded(F.avg("ProductCost")).alias("avg_product"),
        rounded(F.avg("MarketplaceCost")).alias("avg_marketplace"),
        rounded(F.avg("ShippingCost")).alias("avg_shipping"),
        rounded(F.avg("Profit_Estimated")).alias("avg_estimated_profit"),
        rounded(F.avg("Profit_Actual")).alias("avg_profit"),
        rounded(F.avg("OrderWeight"), 3).alias("avg_weight"),
    )


