"""Cohorts, price pilots and experiments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import extract
from ..functions.money import dec, pct, rounded, row_count, share, sum_when, zero_if_null
from ..functions.time import When, days_before, since, to_datetime, ts, whole_hours
from .filters import CANCELLED, not_cancelled


# Demand labels that count as demand.
DEMAND_LABELS = (">10", ">20", ">30", ">40", ">50", ">80", ">100", ">150", ">200", ">300")


def latest_per_key(
    history: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Newest row per key of a history of snapshots.

    The newest row is the maximum of a struct led by the ordering columns, so the
    aggregation combines before the shuffle and a key with a long history sends
    one row per task. Equal timestamps are decided by the remaining columns.
    """
    wanted = [c for c in (columns or history.columns) if c not in keys]
    rest = [c for c in wanted if c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_newest")
    return history.groupBy(*keys).agg(newest).select(
        *keys, *[F.col("_newest")[c].alias(c) for c in wanted]
    )


def _sales(order_profit: DataFrame, items: DataFrame, orders_where: Column, extra: Sequence[str]) -> DataFrame:
    """Items of the chosen orders with the order columns a report needs."""
    orders = order_profit.where(orders_where & not_cancelled()).select("CustomerOrderId", *extra)
    return items.join(orders, "CustomerOrderId")


def pilot_propagation(
    offer_settings: DataFrame,
    price_offer: DataFrame,
    buy_box_current: DataFrame,
    our_offers_current: DataFrame,
    order_profit: DataFrame,
    items: DataFrame,
    *,
    as_of: When,
    market: str,
    group: str,
    our_retailer: str,
    sales_market: str | None = None,
    step: float = 0.02,
    days: int = 30,
) -> DataFrame:
    """One row: did the pilot's forced prices reach the market, and did they sell?

    Every side is reduced to one row per product before the joins, so a product
    counts once however many offers it has. An offer belongs to a product by its
    SKU, whatever its own EAN. ``sales_market`` is a LIKE pattern, by default the
    pilot's own market.
    """
    sellable = (
        price_offer.where(
            (F.col("BookstoreId") == market)
            & ~F.coalesce("IsBlocked", F.lit(False))
            & (F.col("Quantity") > 0)
        )
        .select("OurEan")
        .distinct()
    )
    pilot = (
        offer_settings.where(
            (F.col("BookstoreId") == market)
            & (F.col("TestGroupName") == group)
            & (F.col("fIsActive") == 1)
        )
        .groupBy("OurEan")
        .agg(F.round(F.max("Price"), 2).alias("forced"))
        .join(sellable, "OurEan", "left_semi")
    )
    box = latest_per_key(
        buy_box_current.where(F.col("MarketplaceId") == market),
        ["Ean"],
        ["LastCheckedUtc"],
        ["RetailerId", "FulfilmentMethod", "BestOfferPrice", "HasOffer", "LastCheckedUtc"],
    ).withColumnRenamed("Ean", "OurEan")
    listed = latest_per_key(
        price_offer.where(F.col("BookstoreId") == market)
        .withColumn("OurEan", F.col("SKU"))
        .join(pilot, "OurEan", "left_semi"),
        ["OurEan"],
        ["LastUpdatedOnUtc", "Id"],
        ["Price", "PriceMin"],
    )
    live = (
        our_offers_current.where(F.col("MarketplaceId") == market)
        .groupBy(F.col("Ean").alias("OurEan"))
        .agg(F.min("BundlePrice").alias("live_price"))
    )
    in_market = F.col("IdBookstore").like(sales_market) if sales_market else F.col("IdBookstore") == market
    piloted = items.join(pilot.select(F.col("OurEan").alias("EAN")), "EAN", "left_semi")
    sold = (
        _sales(order_profit, piloted, since(F.col("OrderCreatedOnUtc"), as_of, days) & in_market, [])
        .groupBy(F.col("EAN").alias("OurEan"))
        .agg(F.sum("Quantity").alias("units"), F.sum("ItemProfit").alias("profit"))
    )
    joined = (
        pilot.join(box, "OurEan", "left")
        .join(listed, "OurEan", "left")
        .join(live, "OurEan", "left")
        .join(sold, "OurEan", "left")
    )
    ours = F.col("RetailerId") == our_retailer
    theirs = F.col("RetailerId") != our_retailer
    forced, best = F.col("forced"), F.col("BestOfferPrice")
    undercut = theirs & (best < forced)
    return joined.agg(
        row_count().alias("pilot_products"),
        F.count_if(ours).alias("buy_box_ours"),
        F.count_if(theirs & (F.col("FulfilmentMethod") == "FBR")).alias("competitor_fbr"),
        F.count_if(theirs & (F.col("FulfilmentMethod") == "FBB")).alias("competitor_fbb"),
        F.count_if(F.col("RetailerId").isNull() | ~F.col("HasOffer")).alias("no_snapshot"),
        F.count_if(F.abs(F.col("Price") - forced) < dec("0.01")).alias("forced_in_offer"),
        F.count_if(F.abs(F.col("live_price") - forced) < dec("0.02")).alias("forced_in_live_offer"),
        F.count_if(undercut).alias("competitor_undercut"),
        F.count_if(undercut & F.col("HasOffer") & (best - dec(step) >= F.col("PriceMin"))).alias(
            "re_undercut_feasible"
        ),
        F.count_if(F.col("units") > 0).alias("products_sold"),
        F.coalesce(F.sum("units"), F.lit(0)).cast("bigint").alias("units"),
        rounded(F.coalesce(F.sum("profit"), dec(0)), 0).alias("profit"),
        F.count_if(ours & (F.coalesce("units", F.lit(0)) == 0)).alias("buy_box_without_sales"),
        F.date_format(F.max("LastCheckedUtc"), "yyyy-MM-dd HH:mm").alias("last_check"),
    )


def sale_cohort_profitability(
    cohort: DataFrame,
    price_offer: DataFrame,
    buy_box: DataFrame,
    order_profit: DataFrame,
    items: DataFrame,
    *,
    sale_start: When,
    baseline_days: int = 14,
    sku_pattern: str = r"^([0-9]+)",
) -> DataFrame:
    """Per market: buy-box wins and sales of a discounted cohort against a baseline.

    Both windows become columns of one row per (market, product) before the
    join, so neither buy-box counts nor discounts are repeated per window.
    Sales belong to the product: of several SKUs of one product in a market the
    smallest carries them, so they count once.
    """
    skus = cohort.withColumn("ean", extract("sku", sku_pattern)).where(F.col("ean").isNotNull())
    asin = (
        price_offer.where(F.col("Asin").isNotNull())
        .groupBy("BookstoreId", "SKU")
        .agg(F.max(F.struct("LastUpdatedOnUtc", "Id", "Asin"))["Asin"].alias("asin"))
        .select(F.col("BookstoreId").alias("market"), F.col("SKU").alias("sku"), "asin")
    )
    box = buy_box.select(
        F.col("ASIN").alias("asin"),
        F.col("MarketplaceID").alias("marketplace_id"),
        F.exists("OurOffer", lambda o: o["IsBuyBoxWinner"]).alias("wins"),
    )
    won = (
        skus.join(asin, ["market", "sku"])
        .join(box, ["asin", "marketplace_id"])
        .groupBy("market", "sku")
        .agg(F.bool_or("wins").alias("wins"), F.lit(True).alias("seen"))
    )
    start = to_datetime(sale_start)
    lines = _sales(
        order_profit,
        items.join(skus.select(F.col("ean").alias("EAN")), "EAN", "left_semi"),
        F.col("OrderCreatedOnUtc") >= ts(days_before(start, baseline_days)),
        ["IdBookstore", "OrderCreatedOnUtc"],
    )
    in_sale = F.col("OrderCreatedOnUtc") >= ts(start)
    revenue = F.col("UnitSalesPriceNet") * F.col("Quantity")
    units = lambda cond: F.sum(F.when(cond, F.col("Quantity")).otherwise(0))
    # Lines of one order are folded first, so distinct orders are a plain count.
    per_order = lines.groupBy(
        F.col("IdBookstore").alias("market"), F.col("EAN").alias("ean"), "CustomerOrderId"
    ).agg(
        F.bool_or(in_sale).alias("in_sale"),
        units(in_sale).alias("sale_units"),
        sum_when(in_sale, "ItemProfit").alias("sale_profit"),
        sum_when(in_sale, revenue).alias("sale_revenue"),
        units(~in_sale).alias("base_units"),
        sum_when(~in_sale, "ItemProfit").alias("base_profit"),
        sum_when(~in_sale, revenue).alias("base_revenue"),
    )
    sums = ("sale_units", "sale_profit", "sale_revenue", "base_units", "base_profit", "base_revenue")
    sold = per_order.groupBy("market", "ean").agg(
        F.count_if("in_sale").alias("sale_orders"), *[F.sum(c).alias(c) for c in sums]
    )
    discount = F.try_divide(F.col("our_price") - F.col("sale_price"), F.col("our_price"))
    carrier = skus.groupBy("market", "ean").agg(F.min("sku").alias("sku")).join(sold, ["market", "ean"])
    joined = skus.join(won, ["market", "sku"], "left").join(carrier.drop("ean"), ["market", "sku"], "left")
    total = lambda c: F.sum(zero_if_null(c))
    return joined.groupBy("market").agg(
        F.count_distinct("sku").alias("skus"),
        F.count_if("wins").alias("buy_box_wins"),
        pct(F.count_if("wins"), F.count("seen")).alias("buy_box_win_pct"),
        rounded(F.avg(discount.cast("decimal(18,8)")) * 100, 1).alias("avg_discount_pct"),
        F.coalesce(F.sum("sale_orders"), F.lit(0)).cast("bigint").alias("sale_orders"),
        total("sale_units").cast("bigint").alias("sale_units"),
        rounded(total("sale_profit")).alias("sale_profit"),
        pct(F.sum("sale_profit"), F.sum("sale_revenue")).alias("sale_margin_pct"),
        total("base_units").cast("bigint").alias("baseline_units"),
        rounded(total("base_profit")).alias("baseline_profit"),
        pct(F.sum("base_profit"), F.sum("base_revenue")).alias("baseline_margin_pct"),
    )


def ab_diff_in_diff(
    cohort: DataFrame,
    order_profit: DataFrame,
    items: DataFrame,
    buy_box_current: DataFrame,
    *,
    baseline_start: When,
    test_start: When,
    as_of: When,
    market: str,
    our_retailer: str,
) -> DataFrame:
    """Control against test, each per day and against its own baseline.

    The windows differ in length, so totals are divided by their days.
    ``did_pct`` is the test group's change minus the control group's.
    """
    base_days = (to_datetime(test_start) - to_datetime(baseline_start)).days
    test_days = (to_datetime(as_of) - to_datetime(test_start)).days
    lines = _sales(
        order_profit,
        items.join(cohort.select("EAN"), "EAN", "left_semi"),
        (F.col("IdBookstore") == market)
        & (F.col("OrderCreatedOnUtc") >= ts(baseline_start))
        & (F.col("OrderCreatedOnUtc") < ts(as_of)),
        ["OrderCreatedOnUtc"],
    )
    test = F.col("OrderCreatedOnUtc") >= ts(test_start)
    sold = lines.groupBy("EAN").agg(
        sum_when(test, "Quantity").alias("test_units"),
        sum_when(test, "ItemProfit").alias("test_profit"),
        sum_when(test, F.col("UnitSalesPriceNet") * F.col("Quantity")).alias("test_revenue"),
        sum_when(~test, "Quantity").alias("base_units"),
        sum_when(~test, "ItemProfit").alias("base_profit"),
    )
    held = (
        buy_box_current.where(
            (F.col("MarketplaceId") == market)
            & F.col("HasOffer")
            & (F.col("RetailerId") == our_retailer)
        )
        .select(F.col("Ean").alias("EAN"))
        .distinct()
        .withColumn("held", F.lit(True))
    )

    def per_day(total: Column, days: int) -> Column:
        return F.try_divide(total.cast("decimal(24,4)"), F.lit(days)).cast("decimal(24,8)")

    change = F.try_divide(
        per_day(F.col("test_profit"), test_days), per_day(F.col("base_profit"), base_days)
    ).cast("decimal(18,8)") * 100 - 100
    groups = (
        cohort.join(sold, "EAN", "left")
        .join(held, "EAN", "left")
        .groupBy("grp")
        .agg(
            row_count().alias("products"),
            F.count("held").alias("buy_boxes_held"),
            *[
                F.sum(zero_if_null(c)).alias(c)
                for c in ("test_units", "test_profit", "test_revenue", "base_units", "base_profit")
            ],
        )
        .withColumn("change", change)
    )
    # Two rows from here on: the window sees only the finished groups.
    both = Window.partitionBy()
    did = F.max(F.when(F.col("grp") == 1, F.col("change"))).over(both) - F.max(
        F.when(F.col("grp") != 1, F.col("change"))
    ).over(both)
    return groups.select(
        F.when(F.col("grp") == 1, "test").otherwise("control").alias("cohort"),
        "products",
        rounded(per_day(F.col("base_units"), base_days)).alias("units_per_day_baseline"),
        rounded(per_day(F.col("test_units"), test_days)).alias("units_per_day_test"),
        rounded(per_day(F.col("base_profit"), base_days)).alias("profit_per_day_baseline"),
        rounded(per_day(F.col("test_profit"), test_days)).alias("profit_per_day_test"),
        rounded("change", 1).alias("profit_change_pct"),
        pct("test_profit", "test_revenue").alias("margin_pct"),
        "buy_boxes_held",
        F.col("test_units").cast("bigint").alias("test_units"),
        rounded(did, 1).alias("did_pct"),
    )


def feed_format_sentinel(supplier_stock: DataFrame) -> DataFrame:
    """Distinct positive stock values per supplier; about five mean a bucketed feed."""
    return (
        supplier_stock.where(F.col("iloscDostepna") > 0)
        .groupBy(F.col("SupplierId").alias("supplier_id"))
        .agg(F.count_distinct("iloscDostepna").alias("distinct_values"))
    )


def cohort_exposure_bands(
    cohort: DataFrame,
    supplier_stock: DataFrame,
    own_stock: DataFrame,
    *,
    supplier_id: int,
    demand_labels: Sequence[str] = DEMAND_LABELS,
) -> DataFrame:
    """How much of a listed cohort is on sale, by the stock its supplier reports.

    Negative stock counts as none. Stock is reduced to one row per product
    before the joins; the sentinel is a single figure repeated per row.
    """
    offered = (
        supplier_stock.where(F.col("SupplierId") == supplier_id)
        .groupBy("EAN")
        .agg(F.max("iloscDostepna").alias("offered"))
    )
    owned = own_stock.groupBy("EAN").agg(F.max("fAll_StockQuantity").alias("owned"))
    products = cohort.groupBy("EAN").agg(
        F.coalesce(F.bool_or(F.col("demand_label").isin(*demand_labels)), F.lit(False)).alias("wanted")
    )
    stock = F.coalesce("offered", F.lit(0))
    band = (
        F.when(stock <= 0, "0. none at the supplier")
        .when(stock == 1, "1. exactly 1")
        .when(stock == 2, "2. 2")
        .when(stock <= 5, "3. 3-5")
        .when(stock <= 20, "4. 6-20")
        .otherwise("5. 21+")
    )
    exposed = F.coalesce("owned", F.lit(0)) > 0
    hidden = F.coalesce("owned", F.lit(0)) == 0
    wanted = F.col("wanted")
    sentinel = feed_format_sentinel(supplier_stock.where(F.col("SupplierId") == supplier_id))
    return (
        products.join(offered, "EAN", "left")
        .join(owned, "EAN", "left")
        .groupBy(band.alias("supplier_stock"))
        .agg(
            row_count().alias("products"),
            F.count_if(exposed).alias("exposed"),
            pct(F.count_if(exposed), row_count()).alias("exposed_pct"),
            F.count_if(wanted).alias("with_demand"),
            F.count_if(wanted & hidden).alias("with_demand_not_exposed"),
        )
        .withColumn("supplier_id", F.lit(supplier_id).cast("bigint"))
        .join(sentinel, "supplier_id", "left")
        .select(
            "supplier_stock",
            "products",
            "exposed",
            "exposed_pct",
            "with_demand",
            "with_demand_not_exposed",
            F.coalesce("distinct_values", F.lit(0)).cast("bigint").alias("feed_distinct_values"),
        )
    )


def cohort_vs_rest(
    order_profit: DataFrame,
    items: DataFrame,
    listed: DataFrame,
    order_header: DataFrame,
    *,
    baseline_start: When,
    baseline_end: When,
    as_of: When,
    recent_days: int = 7,
) -> DataFrame:
    """A product list against the rest of the catalogue, in three windows.

    Cancellations are measured over all orders; money and units leave cancelled
    orders out. The earlier window never reaches back into the baseline.
    """
    recent = days_before(as_of, recent_days)
    earlier = max(days_before(as_of, 2 * recent_days), to_datetime(baseline_end))
    created = F.col("OrderCreatedOnUtc")
    window = (
        F.when((created >= ts(baseline_start)) & (created < ts(baseline_end)), "A. baseline")
        .when(created >= ts(recent), "C. recent")
        .when(created >= ts(earlier), "B. earlier")
    )
    spans = {
        "A. baseline": (to_datetime(baseline_end) - to_datetime(baseline_start)).days,
        "B. earlier": (recent - earlier).days,
        "C. recent": recent_days,
    }
    days = F.create_map(*[F.lit(x) for pair in spans.items() for x in pair])[F.col("period")]
    orders = (
        order_profit.where((created >= ts(baseline_start)) & (created < ts(as_of)))
        .withColumn("period", window)
        .where(F.col("period").isNotNull())
        .select("CustomerOrderId", "period", "OrderStatusId", "IsDoneCalculating")
    )
    shipping = order_header.select(
        F.col("Id").alias("CustomerOrderId"),
        F.col("ShippedDateUtc").isNotNull().alias("shipped"),
        (whole_hours(F.col("PaidDateUtc"), F.col("ShippedDateUtc")) / dec(24))
        .cast("decimal(18,8)")
        .alias("ship_days"),
    )
    in_list = listed.select("EAN").distinct().withColumn("listed", F.lit(True))
    valid = F.col("OrderStatusId") != CANCELLED
    closed = valid & F.col("IsDoneCalculating")
    lines = items.select(
        "CustomerOrderId", "EAN", "Quantity", "ItemProfit", "UnitSalesPriceNet"
    ).join(orders.join(shipping, "CustomerOrderId", "left"), "CustomerOrderId")
    # Summed per product and window first: the list is then matched once per
    # product, and a best-seller is not shuffled line by line.
    per_product = lines.groupBy("EAN", "period").agg(
        row_count().alias("items"),
        F.sum(F.when(valid, F.col("Quantity")).otherwise(0)).alias("units"),
        sum_when(closed, "ItemProfit").alias("profit"),
        sum_when(closed, F.col("UnitSalesPriceNet") * F.col("Quantity")).alias("revenue"),
        F.count_if("IsDoneCalculating").alias("closed"),
        F.count_if(F.col("OrderStatusId") == CANCELLED).alias("cancelled"),
        F.count_if("shipped").alias("shipped"),
        F.sum("ship_days").alias("ship_days"),
        F.count("ship_days").alias("ship_n"),
    )
    totals = ("items", "units", "profit", "revenue", "closed", "cancelled", "shipped", "ship_days", "ship_n")
    return (
        per_product.join(in_list, "EAN", "left")
        .groupBy("period", F.when(F.col("listed"), "1. listed").otherwise("2. rest").alias("cohort"))
        .agg(*[F.sum(c).alias(c) for c in totals])
        .select(
            "period",
            "cohort",
            "items",
            share("units", days, 1).alias("units_per_day"),
            share("profit", days).alias("profit_per_day"),
            pct("profit", "revenue", 2).alias("margin_pct"),
            pct("closed", "items").alias("closed_pct"),
            pct("cancelled", "items", 2).alias("cancelled_pct"),
            pct("shipped", "items").alias("shipped_pct"),
            rounded(F.try_divide("ship_days", "ship_n")).alias("avg_days_to_ship"),
        )
    )


def coverage_diff(
    left: DataFrame, right: DataFrame, keys: Sequence[str], *, placeholder: Column | None = None
) -> DataFrame:
    """Keys in both sets, only left, only right; how many only-left rows are placeholders.

    One aggregation over both key sets instead of three joins; NULL keys compare
    as equal. ``placeholder`` is a condition on the left rows.
    """
    mark = placeholder if placeholder is not None else F.lit(False)
    no = F.lit(False)
    tagged = left.select(
        *keys, F.lit(True).alias("l"), no.alias("r"), F.coalesce(mark, no).alias("p")
    ).unionByName(right.select(*keys, no.alias("l"), F.lit(True).alias("r"), no.alias("p")))
    sides = tagged.groupBy(*keys).agg(
        F.bool_or("l").alias("l"), F.bool_or("r").alias("r"), F.bool_or("p").alias("p")
    )
    only_left = F.col("l") & ~F.col("r")
    return sides.agg(
        F.count_if(F.col("l") & F.col("r")).alias("in_both"),
        F.count_if(only_left).alias("only_left"),
        F.count_if(F.col("r") & ~F.col("l")).alias("only_right"),
        F.count_if(only_left & F.col("p")).alias("only_left_placeholder"),
    )
