from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from orderlens.operators import cohorts

T0 = dt.datetime(2026, 3, 10)
ORDER = (
    "CustomerOrderId bigint, IdBookstore string, OrderCreatedOnUtc timestamp, OrderStatusId int, IsDoneCalculating boolean"
)
ITEM = "CustomerOrderId bigint, EAN string, Quantity int, ItemProfit decimal(18,4), UnitSalesPriceNet decimal(18,4)"
OFFER = (
    "Id bigint, BookstoreId string, OurEan string, SKU string, Asin string, Price decimal(18,4), PriceMin decimal(18,4), "
    "Quantity int, IsBlocked boolean, LastUpdatedOnUtc timestamp"
)
BOX = (
    "Ean string, MarketplaceId string, RetailerId string, FulfilmentMethod string, BestOfferPrice decimal(18,4), "
    "HasOffer boolean, LastCheckedUtc timestamp"
)


def offer(k, ean, price, market="NL", sku=None, asin="A1", low=5, qty=1, blocked=False, at=T0):
    return (k, market, ean, sku or ean, asin, D(str(price)), D(str(low)), qty, blocked, at)


def sales(spark, rows):
    """rows: (order, market, days ago, status, ean, units, profit, price)"""
    orders = {r[0]: (r[0], r[1], T0 - dt.timedelta(days=r[2]), r[3], True) for r in rows}
    return (
        spark.createDataFrame(list(orders.values()), ORDER),
        spark.createDataFrame([(r[0], r[4], r[5], D(str(r[6])), D(str(r[7]))) for r in rows], ITEM),
    )


def test_pilot_counts_a_product_once(spark):
    settings = spark.createDataFrame(
        [(i, e, "NL", "G", D("9.994"), 1) for i, e in enumerate("abcde")] + [(9, "off", "NL", "G", D(9), 0)],
        "Id bigint, OurEan string, BookstoreId string, TestGroupName string, Price decimal(18,4), fIsActive int",
    )
    old = T0 - dt.timedelta(days=1)
    offers = spark.createDataFrame(
        [offer(1, "a", 9.99), offer(2, "a", 5, at=old), offer(3, "a", 7, sku="a-U"), offer(4, "b", 20), offer(5, "c", 9.99),
         offer(6, "d", 9.99), offer(7, "e", 9.99, blocked=True), offer(8, "off", 9.99)],
        OFFER,
    )
    box = spark.createDataFrame(
        [("a", "NL", "me", "FBR", D(9), True, T0), ("b", "NL", "you", "FBR", D("9.5"), True, T0),
         ("c", "NL", "you", "FBB", D("5.01"), True, T0), ("d", "DE", "me", "FBR", D(9), True, T0)],
        BOX,
    )
    live = spark.createDataFrame(
        [("a", "NL", D("10.00")), ("a", "NL", D(12)), ("b", "NL", D("9.9"))], "Ean string, MarketplaceId string, BundlePrice decimal(18,4)"
    )
    orders, items = sales(
        spark,
        [(1, "WEB-NL", 1, 30, "b", 2, 7.5, 1), (2, "WEB-NL", 1, 40, "b", 9, 99, 1), (3, "AZ", 1, 30, "b", 9, 99, 1),
         (4, "WEB-BE", 2, 30, "b", 1, 1, 1), (5, "WEB-NL", 31, 30, "b", 9, 99, 1)],
    )
    got = cohorts.pilot_propagation(
        settings, offers, box, live, orders, items, as_of=T0, market="NL", group="G", our_retailer="me", sales_market="WEB%"
    ).collect()
    assert [tuple(r) for r in got] == [
        # products, ours, fbr, fbb, no snapshot, in offer, live, undercut, feasible, sold, units, profit, unsold
        (4, 1, 1, 1, 1, 3, 1, 2, 1, 1, 3, 9.0, 1, "2026-03-10 00:00")
    ]


def test_sale_cohort_does_not_repeat_per_window(spark):
    cohort = spark.createDataFrame(
        [("M", "M", "100-A", D(10), D(8)), ("M", "M", "100-B", D(10), D(9)), ("M", "M", "x1", D(1), D(1))],
        "market string, marketplace_id string, sku string, our_price decimal(18,4), sale_price decimal(18,4)",
    )
    offers = spark.createDataFrame(
        [offer(1, "100", 1, "M", "100-A", "old", at=T0 - dt.timedelta(days=9)), offer(2, "100", 1, "M", "100-A", "new"),
         offer(3, "100", 1, "M", "100-B", "lost")],
        OFFER,
    )
    box = spark.sql(
        "SELECT 'new' AS ASIN, 'M' AS MarketplaceID, array(named_struct('IsBuyBoxWinner', false), named_struct('IsBuyBoxWinner', true)) AS OurOffer"
        " UNION ALL SELECT 'lost', 'M', array() UNION ALL SELECT 'old', 'M', array(named_struct('IsBuyBoxWinner', false))"
    )
    orders, items = sales(
        spark,
        [(1, "M", 1, 30, "100", 2, 4, 10), (1, "M", 1, 30, "100", 1, 2, 10), (2, "M", 9, 30, "100", 5, 5, 10),
         (3, "M", 30, 30, "100", 5, 5, 10)],
    )
    got = cohorts.sale_cohort_profitability(
        cohort, offers, box, orders, items, sale_start=T0 - dt.timedelta(days=5)
    ).collect()
    row = got[0].asDict()
    assert len(got) == 1 and (row["skus"], row["buy_box_wins"], row["buy_box_win_pct"]) == (2, 1, 50.0)
    assert (row["avg_discount_pct"], row["sale_orders"], row["sale_units"], row["baseline_units"]) == (15.0, 1, 3, 5)
    assert (row["sale_margin_pct"], row["baseline_margin_pct"]) == (20.0, 10.0)


def test_difference_in_differences(spark):
    cohort = spark.createDataFrame([("c", 0), ("t", 1), ("u", 1)], "EAN string, grp int")
    rows = [(1, "NL", 30, 30, "c", 10, 100, 20), (2, "NL", 5, 30, "c", 10, 100, 20),
            (3, "NL", 30, 30, "t", 10, 100, 20), (4, "NL", 5, 30, "t", 10, 25, 20)]
    orders, items = sales(spark, rows)
    box = spark.createDataFrame([("t", "NL", "me", "F", D(1), True, T0)] * 2, BOX)
    got = {
        r.cohort: r
        for r in cohorts.ab_diff_in_diff(
            cohort, orders, items, box, baseline_start=T0 - dt.timedelta(days=30), test_start=T0 - dt.timedelta(days=10),
            as_of=T0, market="NL", our_retailer="me",
        ).collect()
    }
    assert (got["control"].profit_change_pct, got["test"].profit_change_pct, got["test"].did_pct) == (100.0, -50.0, -150.0)
    assert (got["test"].products, got["test"].buy_boxes_held, got["test"].units_per_day_baseline) == (2, 1, 0.5)


def test_negative_stock_is_none(spark):
    cohort = spark.createDataFrame([(e, ">10" if e in "ab" else None) for e in "abcd"], "EAN string, demand_label string")
    stock = spark.createDataFrame(
        [("a", 1, -5), ("b", 1, 1), ("b", 1, 21), ("c", 2, 9)], "EAN string, SupplierId bigint, iloscDostepna int"
    )
    own = spark.createDataFrame([("b", 1), ("c", 0)], "EAN string, fAll_StockQuantity int")
    got = {r.supplier_stock[0]: r for r in cohorts.cohort_exposure_bands(cohort, stock, own, supplier_id=1).collect()}
    assert got["0"].products == 3 and got["0"].with_demand_not_exposed == 1
    assert got["5"].exposed_pct == 100.0 and got["5"].feed_distinct_values == 2


def test_windows_do_not_overlap(spark):
    orders, items = sales(
        spark,
        [(1, "M", 100, 30, "l", 1, 1, 10), (2, "M", 3, 30, "l", 7, 14, 10), (3, "M", 3, 40, "r", 9, 9, 10),
         (4, "M", 10, 30, "r", 3, 3, 10), (5, "M", 30, 30, "r", 3, 3, 10)],
    )
    header = spark.createDataFrame(
        [(2, T0, T0 + dt.timedelta(hours=36))], "Id bigint, PaidDateUtc timestamp, ShippedDateUtc timestamp"
    )
    listed = spark.createDataFrame([("l",), ("l",)], "EAN string")
    got = {
        (r.period[0], r.cohort[0]): r
        for r in cohorts.cohort_vs_rest(
            orders, items, listed, header, baseline_start=T0 - dt.timedelta(days=100),
            baseline_end=T0 - dt.timedelta(days=12), as_of=T0,
        ).collect()
    }
    assert set(got) == {("A", "1"), ("A", "2"), ("B", "2"), ("C", "1"), ("C", "2")}
    assert got["C", "1"].items == 1 and got["C", "1"].units_per_day == 1.0 and got["C", "1"].avg_days_to_ship == 1.5
    assert got["C", "2"].cancelled_pct == 100.0 and got["C", "2"].units_per_day == 0.0 and got["C", "2"].margin_pct is None
    assert got["B", "2"].units_per_day == 0.6, "five days, not seven"


def test_coverage_parts_sum(spark):
    left = spark.createDataFrame([(1, "x"), (1, "y"), (2, "0001"), (None, "z")], "k bigint, d string")
    right = spark.createDataFrame([(1,), (3,), (None,)], "k bigint")
    got = cohorts.coverage_diff(left, right, ["k"], placeholder=F.col("d") == "0001").first()
    assert tuple(got) == (2, 1, 1, 1)


def test_latest_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("a", T0, 1, "x"), ("a", T0, 2, "w"), ("b", T0, 9, None)], "k string, at timestamp, v int, n string")
    got = {r.k: (r.v, r.n) for r in cohorts.latest_per_key(df, ["k"], ["at"]).collect()}
    assert got == {"a": (2, "w"), "b": (9, None)}
