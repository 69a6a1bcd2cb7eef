"""Where orders lose money, and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import (
    OTHER_CAUSE,
    cause_label,
    country_name,
    first_match,
    loss_cause,
)
from ..functions.money import dec, pct, ratio, rounded, row_count
from ..functions.time import When, since, to_datetime
from .filters import known_tags, losing_orders, not_cancelled, settled_orders, tagged_orders, with_flag

RETURN_TAG = 22
AGED_STOCK_TAG = 33
# Tags that explain a planned loss.
HELPER_TAGS = (1, 10, 13, 16, 17, 21, 24, 35, 37, 38)


def classified_orders(order_profit: DataFrame) -> DataFrame:
    """Every order with its cause code and label."""
    return order_profit.withColumn("cause", loss_cause()).withColumn(
        "cause_label", cause_label(F.col("cause"))
    )


def loss_topk(
    order_profit: DataFrame,
    *,
    as_of: When,
    days: int = 8,
    loss_below: float = 0,
    significance: float = -10,
    k: int = 15,
) -> DataFrame:
    """The k worst losing orders of the window.

    An order is listed when its cause is diagnosed, or when its rounded loss is
    at or below ``significance``. Ties at the cut go to the lower order id.
    """
    shown = losing_orders(order_profit, as_of, days, loss_below).withColumn("cause", loss_cause())
    loss = F.round("Profit_Actual", 2)
    return (
        shown.where((F.col("cause") != OTHER_CAUSE) | (loss <= dec(significance)))
        .orderBy("Profit_Actual", "CustomerOrderId")
        .limit(k)
        .select(
            F.col("CustomerOrderId").alias("order_id"),
            F.col("IdBookstore").alias("market"),
            country_name("ShippingCountryIso2").alias("country"),
            F.date_format("OrderCreatedOnUtc", "MM-dd HH:mm").alias("created"),
            F.col("NumOfItems").cast("bigint").alias("items"),
            rounded("fOrderTotal").alias("order_value"),
            loss.cast("double").alias("loss"),
            rounded("ProfitMargin", 1).alias("margin_pct"),
            "cause",
            cause_label(F.col("cause")).alias("cause_label"),
        )
    )


def loss_topk_large(order_profit: DataFrame, *, as_of: When, days: int = 1, k: int = 15) -> DataFrame:
    """Only very large losses: the daily preset of :func:`loss_topk`."""
    return loss_topk(
        order_profit, as_of=as_of, days=days, loss_below=-100, significance=-100, k=k
    )


def threshold_sweep(
    order_profit: DataFrame,
    *,
    as_of: When,
    days: int = 30,
    thresholds: Sequence[float] = (-50, -75, -100, -150, -200),
) -> DataFrame:
    """Per threshold: losing orders per day below it, and their share of all loss.

    One pass over the losses. Each order goes to the band under its deepest
    threshold; the bands are summed, then accumulated over the few thresholds.
    """
    steps = sorted(thresholds)
    band = first_match([(F.col("Profit_Actual") < dec(t), i) for i, t in enumerate(steps)], len(steps))
    banded = (
        losing_orders(order_profit, as_of, days)
        .groupBy(band.alias("band"))
        .agg(row_count().alias("n"), F.sum("Profit_Actual").alias("loss"))
    )
    every = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(steps)])
    # A band counts towards every threshold that is not deeper than its own.
    return (
        banded.withColumn("total", F.sum("loss").over(Window.partitionBy()))
        .select("band", "n", "loss", "total", F.inline(every))
        .groupBy("threshold")
        .agg(
            F.sum(F.when(F.col("band") <= F.col("i"), F.col("n")).otherwise(0)).alias("orders"),
            F.sum(F.when(F.col("band") <= F.col("i"), F.col("loss"))).alias("loss"),
            F.max("total").alias("total"),
        )
        .select(
            "threshold",
            F.col("orders").cast("bigint").alias("orders"),
            rounded(F.col("orders").cast("decimal(24,4)") / days, 1).alias("orders_per_day"),
            pct(F.coalesce(F.col("loss"), dec(0)), "total").alias("loss_pct"),
        )
    )


def loss_patterns(
    order_profit: DataFrame, *, as_of: When, days: int = 8, max_markets: int = 6
) -> DataFrame:
    """Per cause: orders, sum, average and worst loss, and the first markets by name."""
    losses = losing_orders(order_profit, as_of, days).select(
        loss_cause().alias("cause"), F.col("IdBookstore").alias("market"), "Profit_Actual"
    )
    by_market = losses.groupBy("cause", "market").agg(
        row_count().alias("n"), F.sum("Profit_Actual").alias("loss"), F.min("Profit_Actual").alias("worst")
    )
    rank = F.row_number().over(Window.partitionBy("cause").orderBy(F.col("market").asc_nulls_last()))
    return (
        by_market.withColumn("rn", rank)
        .groupBy("cause")
        .agg(
            F.sum("n").cast("bigint").alias("orders"),
            F.sum("loss").alias("loss"),
            F.min("worst").alias("worst"),
            F.sort_array(F.collect_list(F.when(F.col("rn") <= max_markets, F.col("market")))).alias("markets"),
        )
        .select(
            "cause",
            cause_label(F.col("cause")).alias("cause_label"),
            "orders",
            rounded("loss").alias("loss"),
            rounded(F.col("loss") / F.col("orders")).alias("avg_loss"),
            rounded("worst").alias("worst_loss"),
            F.array_join("markets", ",").alias("markets"),
        )
    )


def loss_by_tag(
    order_profit: DataFrame,
    tags: DataFrame,
    *,
    as_of: When,
    days: int = 8,
    min_orders: int = 3,
    max_markets: int = 4,
    note_length: int = 80,
) -> DataFrame:
    """Per tag: the losing orders that carry it, each counted once per tag.

    Only tags of losing orders are aggregated, to the newest note per (order, tag). The
    example is the smallest of those notes, so it does not change between runs.
    """
    losses = losing_orders(order_profit, as_of, days).select(
        "CustomerOrderId", F.col("IdBookstore").alias("market"), "Profit_Actual"
    )
    losing = known_tags(tags, as_of).join(losses.select("CustomerOrderId"), "CustomerOrderId", "left_semi")
    newest = losing.groupBy("CustomerOrderId", "TagId").agg(
        F.max_by("Note", F.struct("CreatedOnUtc", "Id", "Note")).alias("note")
    )
    pairs = losses.join(newest, "CustomerOrderId")
    by_market = pairs.groupBy(F.col("TagId").alias("tag"), "market").agg(
        row_count().alias("n"), F.sum("Profit_Actual").alias("loss"), F.min("note").alias("note")
    )
    rank = F.row_number().over(Window.partitionBy("tag").orderBy(F.col("market").asc_nulls_last()))
    return (
        by_market.withColumn("rn", rank)
        .groupBy("tag")
        .agg(
            F.sum("n").cast("bigint").alias("orders"),
            F.sum("loss").alias("loss"),
            F.sort_array(F.collect_list(F.when(F.col("rn") <= max_markets, F.col("market")))).alias("markets"),
            F.min("note").alias("note"),
        )
        .where(F.col("orders") >= min_orders)
        .select(
            "tag",
            "orders",
            rounded("loss").alias("loss"),
            rounded(F.col("loss") / F.col("orders")).alias("avg_loss"),
            F.array_join("markets", ",").alias("markets"),
            F.left("note", F.lit(note_length)).alias("example"),
        )
    )


def tag_cooccurrence(
    order_profit: DataFrame,
    tags: DataFrame,
    *,
    as_of: When,
    days: int = 7,
    note_length: int = 90,
    replay: bool = True,
) -> DataFrame:
    """Per tag: distinct losing orders, and their loss repeated for every tag row.

    The contrast to :func:`loss_by_tag`: repeated tags weigh an order repeatedly.
    The repeats are counted per (order, tag) first, so the join sees each pair once.
    A ``replay`` sees the tags that stood at ``as_of``; without it every tag row counts, whenever it was set.
    """
    losses = losing_orders(order_profit, as_of, days).select("CustomerOrderId", "Profit_Actual")
    seen = known_tags(tags, as_of) if replay else tags
    losing = seen.join(losses.select("CustomerOrderId"), "CustomerOrderId", "left_semi")
    repeats = losing.groupBy("CustomerOrderId", "TagId").agg(
        row_count().alias("rows"), F.min("Note").alias("note"), F.min("Source").alias("source")
    )
    return (
        losses.join(repeats, "CustomerOrderId")
        .groupBy(F.col("TagId").alias("tag"))
        .agg(
            row_count().alias("losing_orders"),
            rounded(F.sum(F.col("Profit_Actual") * F.col("rows"))).alias("loss_per_tag_row"),
            F.left(F.min("note"), F.lit(note_length)).alias("example"),
            F.min("source").alias("source"),
        )
    )


def loss_structure(
    order_profit: DataFrame,
    tags: DataFrame,
    *,
    as_of: When,
    days: int = 30,
    report_day: int | None = 1,
) -> DataFrame:
    """Losses in five exclusive classes with their share of the total.

    Speaks only when the day of ``as_of`` is ``report_day``; None always speaks.
    """
    losses = losing_orders(order_profit, as_of, days)
    if report_day is not None and to_datetime(as_of).day != report_day:
        losses = losses.where(F.lit(False))
    marks = (
        known_tags(tags, as_of, RETURN_TAG, AGED_STOCK_TAG)
        .groupBy("CustomerOrderId")
        .agg(
            F.bool_or(F.col("TagId") == RETURN_TAG).alias("returned"),
            F.bool_or(F.col("TagId") == AGED_STOCK_TAG).alias("aged"),
        )
    )
    loss_class = (
        F.when(F.col("fOrderTotal") <= 0, "1. replacement shipment (no revenue)")
        .when(F.col("returned"), "2. return")
        .when(F.col("aged"), "3. aged stock sold off")
        .when(F.col("Profit_Estimated") <= 0, "4. loss already in the plan")
        .otherwise("5. execution error")
    )
    return (
        losses.join(marks, "CustomerOrderId", "left")
        .groupBy(loss_class.alias("loss_class"))
        .agg(row_count().alias("orders"), F.sum("Profit_Actual").alias("loss"))
        .withColumn("total", F.sum("loss").over(Window.partitionBy()))
        .select(
            "loss_class",
            "orders",
            rounded("loss", 0).alias("loss"),
            rounded(F.col("loss") / F.col("orders")).alias("avg_loss"),
            pct("loss", "total").alias("loss_pct"),
        )
    )


def loss_by_plan(
    order_profit: DataFrame,
    tags: DataFrame,
    *,
    as_of: When,
    days: int = 8,
    tolerance: float = 3.0,
    k: int = 12,
) -> DataFrame:
    """Worst losses that the plan already showed and execution did not change.

    Returns and aged stock are left out, as are mixed causes. The helper tags of
    an order form a list over ten fixed ids, so it cannot grow.
    """
    drift = F.abs(F.col("Profit_Actual") - F.col("Profit_Estimated"))
    planned = (
        losing_orders(order_profit, as_of, days)
        .where((F.col("fOrderTotal") > 0) & (F.col("Profit_Estimated") <= 0) & (drift <= dec(tolerance)))
        .withColumn("cause", loss_cause())
        .where(F.col("cause") != OTHER_CAUSE)
    )
    helpers = (
        known_tags(tags, as_of, *HELPER_TAGS)
        .groupBy("CustomerOrderId")
        .agg(F.array_join(F.sort_array(F.collect_set(F.col("TagId").cast("string"))), ",").alias("tags"))
    )
    worst = (
        planned.join(tagged_orders(tags, as_of, RETURN_TAG, AGED_STOCK_TAG), "CustomerOrderId", "left_anti")
        .orderBy("Profit_Actual", "CustomerOrderId")
        .limit(k)
    )
    return worst.join(helpers, "CustomerOrderId", "left").select(
        F.col("CustomerOrderId").alias("order_id"),
        "cause",
        F.coalesce("tags", F.lit("-")).alias("tags"),
        F.col("IdBookstore").alias("market"),
        F.coalesce("ShippingCountryIso2", F.lit("??")).alias("country"),
        rounded("fOrderTotal").alias("order_value"),
        rounded("ProductCost").alias("product_cost"),
        rounded("ShippingCost").alias("shipping_cost"),
        rounded("Profit_Actual").alias("loss"),
    )


def zero_revenue_shipments(
    order_profit: DataFrame, *, as_of: When, days: int = 8, min_orders: int = 2
) -> DataFrame:
    """Losses without revenue per market and country."""
    return (
        losing_orders(order_profit, as_of, days)
        .where(F.col("fOrderTotal") <= 0)
        .groupBy(
            F.col("IdBookstore").alias("market"),
            F.coalesce("ShippingCountryIso2", F.lit("??")).alias("country"),
        )
        .agg(
            row_count().alias("shipments"),
            rounded(F.sum("Profit_Actual"), 0).alias("cost"),
            rounded(F.avg("Profit_Actual")).alias("avg_cost"),
            rounded(F.avg("ShippingCost")).alias("avg_shipping"),
            rounded(F.avg("ProductCost")).alias("avg_product"),
        )
        .where(F.col("shipments") >= min_orders)
    )


def unprofitable_destinations(
    order_profit: DataFrame, *, as_of: When, days: int = 90, min_orders: int = 20, below: float | None = None
) -> DataFrame:
    """Countries whose rounded result over the window is negative.

    A result that rounds to zero is not reported. With ``below`` only orders of a
    smaller value count: a country that earns in all may lose on small baskets.
    """
    lost = F.col("Profit_Actual") < 0
    orders = settled_orders(order_profit, as_of, days)
    if below is not None:
        orders = orders.where(F.col("fOrderTotal") < dec(below))
    return (
        orders.groupBy(F.coalesce("ShippingCountryIso2", F.lit("??")).alias("country"))
        .agg(
            row_count().alias("orders"),
            pct(F.count_if(lost), row_count()).alias("loss_pct"),
            rounded(F.sum("Profit_Actual"), 0).alias("result"),
            rounded(F.avg("Profit_Actual")).alias("avg_per_order"),
            F.count_if(lost & (F.col("Profit_Estimated") <= 0)).alias("planned_losses"),
            F.count_if(lost).alias("losses"),
        )
        .where((F.col("orders") >= min_orders) & (F.col("result") < 0))
    )


def loss_bands(order_profit: DataFrame, *, as_of: When, days: int = 7) -> DataFrame:
    """Losses of mixed cause by size: many small ones, or a few severe ones?"""
    profit = F.col("Profit_Actual")
    band = first_match(
        [(profit > -2, "a) 0 to -2"), (profit > -5, "b) -2 to -5"), (profit > -10, "c) -5 to -10"), (profit > -25, "d) -10 to -25")],
        "e) below -25",
    )
    return (
        losing_orders(order_profit, as_of, days)
        .where(loss_cause() == OTHER_CAUSE)
        .groupBy(band.alias("band"))
        .agg(row_count().alias("orders"), F.sum(profit).alias("loss"), F.avg("fOrderTotal").alias("value"))
        .withColumn("total", F.sum("loss").over(Window.partitionBy()))
        .select(
            "band",
            "orders",
            rounded("loss").alias("loss"),
            pct("loss", "total").alias("loss_pct"),
            rounded("value").alias("avg_order_value"),
        )
    )


def loss_cost_shares(order_profit: DataFrame, *, as_of: When, days: int = 7) -> DataFrame:
    """Per cause: the mean share of every cost line in the order's revenue."""

    def mean_share(cost) -> F.Column:
        return rounded(F.avg(ratio(cost, "fOrderTotal").cast("decimal(18,8)")) * 100, 1)

    return (
        losing_orders(order_profit, as_of, days)
        .groupBy(loss_cause().alias("cause"))
        .agg(
            row_count().alias("orders"),
            rounded(F.sum("Profit_Actual")).alias("loss"),
            mean_share(F.col("ProductCost")).alias("product_pct"),
            mean_share(F.col("ShippingCost")).alias("shipping_pct"),
            mean_share(F.col("MarketplaceCost")).alias("marketplace_pct"),
            mean_share(F.col("PaymentCost")).alias("payment_pct"),
            mean_share(F.col("HandlingCost") + F.col("PackagingCost")).alias("handling_pct"),
            rounded(F.avg("fOrderTotal")).alias("avg_order_value"),
            rounded(F.avg("Profit_Actual")).alias("avg_loss"),
        )
    )


def weekly_losses(
    order_profit: DataFrame, tags: DataFrame, *, as_of: When, days: int = 7, k: int = 15
) -> DataFrame:
    """The k worst losses with a has-tags flag. Open calculations are included."""
    worst = (
        order_profit.where(
            since(F.col("OrderCreatedOnUtc"), as_of, days)
            & not_cancelled()
            & (F.col("Profit_Actual") < 0)
        )
        .orderBy("Profit_Actual", "CustomerOrderId")
        .limit(k)
    )
    return with_flag(worst, tagged_orders(tags, as_of), "CustomerOrderId", "tagged").select(
        F.col("CustomerOrderId").alias("order_id"),
        F.col("IdBookstore").alias("market"),
        F.col("OrderCreatedOnUtc").cast("date").alias("ordered_on"),
        rounded("Profit_Actual").alias("profit"),
        rounded("fOrderTotal").alias("order_value"),
        pct(F.abs("Profit_Actual"), "fOrderTotal").alias("loss_pct"),
        F.when(F.col("tagged"), "tagged").otherwise("none").alias("tags"),
    )


def item_cause(mixed: str) -> F.Column:
    """Main cause of a losing item; ``mixed`` names what no single test explains."""
    margin = F.col("UnitSalesPriceNet") - F.col("UnitPurchasePriceNet")
    return (
        F.when(F.col("UnitPurchasePriceNet") >= F.col("UnitSalesPriceNet"), "purchase price too high")
        .when(F.col("OrderCostMinusShippingChargeForUnit") > margin, "indirect costs")
        .when(F.col("ShippingChargePlnNettoForUnit") > margin, "shipping costs")
        .otherwise(mixed)
    )


def item_loss_cause(items: DataFrame, *, order_id: int | None = None) -> DataFrame:
    """Per item: its prices and main cause. All orders unless one is named."""
    if order_id is not None:
        items = items.where(F.col("CustomerOrderId") == order_id)
    then = F.coalesce("UnitPurchasePriceNet_OfferTime", "UnitPurchasePriceNet")
    return items.select(
        F.col("CustomerOrderId").alias("order_id"),
        F.col("EAN").alias("ean"),
        F.col("Quantity").cast("int").alias("quantity"),
        rounded("UnitSalesPriceNet").alias("sale_price"),
        rounded("UnitPurchasePriceNet").alias("purchase_price"),
        rounded("ItemProfit").alias("item_profit"),
        rounded("OrderCostMinusShippingChargeForUnit").alias("indirect_cost"),
        rounded("ShippingChargePlnNettoForUnit").alias("shipping_cost"),
        item_cause("mixed").alias("main_cause"),
        rounded("UnitPurchasePriceNet_OfferTime").alias("purchase_price_at_offer"),
        rounded(F.col("UnitPurchasePriceNet") - then).alias("purchase_price_change"),
    )


def problem_products(
    order_profit: DataFrame,
    items: DataFrame,
    *,
    as_of: When,
    days: int = 30,
    min_losses: int = 3,
) -> DataFrame:
    """Products that lose repeatedly, with the cause of their newest losing item.

    One aggregation: the newest cause is carried as the maximum of a struct, so
    no product's items are ever sorted or collected.
    """
    orders = order_profit.where(
        since(F.col("OrderCreatedOnUtc"), as_of, days) & not_cancelled()
    ).select("CustomerOrderId")
    newest = F.struct("LastUpdateOnUtc", "Id", item_cause("other").alias("cause"))
    return (
        items.where(F.col("ItemProfit") < 0)
        .join(orders, "CustomerOrderId")
        .groupBy(F.col("EAN").alias("ean"))
        .agg(
            row_count().alias("losses"),
            rounded(F.avg("ItemProfit")).alias("avg_loss"),
            rounded(F.sum("ItemProfit")).alias("total_loss"),
            rounded(F.avg("UnitSalesPriceNet")).alias("avg_sale_price"),
            rounded(F.avg("UnitPurchasePriceNet")).alias("avg_purchase_price"),
            F.max(newest)["cause"].alias("main_cause"),
        )
        .where(F.col("losses") >= min_losses)
    )
