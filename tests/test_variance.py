from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from orderlens.operators import fulfilment, variance

T0 = dt.datetime(2026, 3, 1)
ORDER = (
    "CustomerOrderId bigint, OrderCreatedOnUtc timestamp, OrderStatusId int, IsDoneCalculating boolean, "
    "IdBookstore string, fOrderTotal decimal(18,4), Profit_Actual decimal(18,4), ProductCost decimal(18,4), "
    "ProductCost_Estimated decimal(18,4), HandlingCost decimal(18,4), PackagingCost decimal(18,4), "
    "OrderWeight decimal(18,4), LastUpdatedOnUtc timestamp"
)
SHIP = (
    "CustomerOrderId bigint, fShippingCostTotal decimal(18,4), ShippingCostTotal_EstimatedPreShipments "
    "decimal(18,4), ShipmentMethodName string, ShippingCompany string, ShippingCountryIso2 string"
)
TAG = "Id bigint, CustomerOrderId bigint, TagId int, Note string, CreatedOnUtc timestamp"


def order(k, profit=1, total=100, product=50, est=45, status=30, done=True, weight="0.2", at=T0):
    return (k, at, status, done, "M", D(total), D(profit), None if product is None else D(product), D(est),
            D(3), D(2), D(weight), at)


def test_drift_counts_missing_rows_as_zero(spark):
    orders = spark.createDataFrame([order(1), order(2, -1, product=None), order(3)], ORDER)
    ship = spark.createDataFrame([(1, D(20), D(10), "A", "C", "DE"), (3, D(9), None, None, None, "DE")], SHIP)
    got = {r.result: r for r in variance.pricing_drift(orders, ship, as_of=T0).collect()}
    assert (got["losing"].orders, got["losing"].product_over_estimate, got["losing"].shipping_over_estimate) == (1, -45.0, 0.0)
    assert (got["profitable"].orders_shipping_over, got["profitable"].orders_product_over) == (2, 0)
    patterns = {r.method: r for r in variance.shipping_drift_patterns(orders, ship, as_of=T0, min_orders=1).collect()}
    assert patterns["A"].multiple == 2.0
    assert patterns["(no method)"].carrier == "(none)" and patterns["(no method)"].multiple is None


def test_outliers(spark):
    orders = spark.createDataFrame([order(k) for k in (1, 2, 3)] + [order(4, total=0)], ORDER)
    ship = spark.createDataFrame(
        [(1, D(16), D(10), "A", "C", "DE"), (2, D(15), D(10), "A", "C", "DE"), (3, D(9), D(0), "A", "C", "DE")], SHIP
    )
    got = variance.shipping_estimate_outliers(orders, ship, as_of=T0).collect()
    assert [(r.order_id, r.difference_pct) for r in got] == [(1, 60.0)]
    fees = spark.createDataFrame(
        [(1, D(21), D(15), D(6)), (2, D(18), D(15), D(3)), (3, D(17), D(15), D(2)), (4, D(5), D(5), D(0))],
        "CustomerOrderId bigint, fMarketplaceCost decimal(18,4), ReferralFee_Actual decimal(18,4), "
        "ClosingFees_Actual decimal(18,4)",
    )
    got = variance.marketplace_cost_outliers(orders, fees, as_of=T0).collect()
    assert [(r.order_id, r.grade) for r in got] == [(1, "critical"), (2, "raised")]


def test_breakdown_of_one_order(spark):
    orders = spark.createDataFrame([order(1), order(2)], ORDER)
    ship = spark.createDataFrame([(1, D(20), D(10), "A", "C", "DE")], SHIP)
    none = spark.createDataFrame([], "CustomerOrderId bigint, fPaymentCost decimal(18,4)")
    fees = spark.createDataFrame([], "CustomerOrderId bigint, fMarketplaceCost decimal(18,4)")
    got = variance.cost_breakdown(orders, ship, none, fees, order_id=1).collect()
    assert [(r.shipping_cost, r.payment_cost, r.handling_cost, r.indirect_cost) for r in got] == [(20.0, 0.0, 5.0, 25.0)]


def test_revisions_carry_over_days_in_order(spark):
    at = lambda d, h: T0 + dt.timedelta(days=d, hours=h)
    rows = [(1, D(5), "c", at(3, 1)), (1, D(1), "a", at(0, 1)), (1, D(3), "b", at(0, 9)), (2, D(7), "x", at(1, 0))]
    rows += [(9, D(i), "hot", at(i // 100, 0) + dt.timedelta(seconds=i % 100)) for i in range(1000)]
    df = spark.createDataFrame(
        rows, "CustomerOrderId bigint, Profit_Actual decimal(18,4), Notes string, DeletedOnUtc timestamp"
    )
    got = variance.profit_revisions(df).collect()
    assert sorted(map(str, got)) == sorted(map(str, variance.profit_revisions(df, slice_by="hour").collect()))
    change = {(r.order_id, r.notes): r.profit_change for r in got if r.order_id != 9}
    assert change == {(1, "a"): None, (1, "b"): 2.0, (1, "c"): 2.0, (2, "x"): None}
    hot = [r.profit_change for r in got if r.order_id == 9]
    assert len(hot) == 1000 and sorted(hot, key=lambda v: v is None)[-1] is None
    assert set(hot) == {None, 1.0} and hot.count(None) == 1


def test_price_history_keeps_k_per_product(spark):
    rows = [(i, "hot", "M", D(1), D(1), T0 - dt.timedelta(minutes=i)) for i in range(500)]
    rows += [(900, "cold", "M", D(1), D(1), T0), (901, "old", "M", D(1), D(1), T0 - dt.timedelta(days=31))]
    df = spark.createDataFrame(
        [(*r, r[-1], r[-1]) for r in rows],
        "Id bigint, OurEan string, BookstoreId string, Price decimal(18,4), PriceMin decimal(18,4), "
        "CreatedOnUtc timestamp, LastSubmittedOnUtc timestamp, LastUpdatedOnUtc timestamp",
    )
    got = variance.price_history(df, as_of=T0).collect()
    assert sum(r.ean == "hot" for r in got) == 20 and sum(r.ean == "cold" for r in got) == 1
    assert min(r.offered for r in got if r.ean == "hot") == T0 - dt.timedelta(minutes=19)


def test_tags_of_an_order_newest_first(spark):
    df = spark.createDataFrame(
        [(1, "A", "old", T0), (1, "B", "new", T0 + dt.timedelta(hours=1)), (2, "C", "other", T0)],
        "CustomerOrderId bigint, Source string, Description string, CreatedOnUtc timestamp",
    )
    assert [r.description for r in variance.order_tags(df, order_id=1).collect()] == ["new", "old"]


def test_weekly_speed_counts_whole_hours_of_closed_weeks(spark):
    paid = dt.datetime(2026, 2, 23)
    hours = [10, 20, 48, 49, 100]
    rows = [(i, 30, paid, paid, paid + dt.timedelta(hours=h, minutes=59)) for i, h in enumerate(hours)]
    rows += [(8, 30, paid, paid, None), (9, 40, paid, paid, paid), (10, 30, T0, T0, T0)]
    df = spark.createDataFrame(
        rows, "Id bigint, OrderStatusId int, CreatedOnUtc timestamp, PaidDateUtc timestamp, ShippedDateUtc timestamp"
    )
    got = fulfilment.fulfilment_weekly(df, first="2026-01-01", as_of="2026-03-02").collect()
    assert [tuple(r) for r in got] == [(dt.date(2026, 2, 23), 5, 48.0, 100.0, 40.0)]


def test_base_rate_of_a_supplier(spark):
    orders = spark.createDataFrame([order(k, p) for k, p in ((1, -5), (2, 3), (3, 9), (4, -1), (5, 2))], ORDER)
    tags = spark.createDataFrame(
        [(1, 1, 35, "było do Alpha ", T0), (2, 1, 35, "było do Alpha", T0), (3, 2, 35, "było do Alpha", T0),
         (4, 2, 35, "było do Other", T0), (5, 3, 35, "no supplier here", T0)],
        TAG,
    )
    got = {r.supplier: r for r in fulfilment.tag_base_rate(orders, tags, as_of=T0, min_orders=1).collect()}
    assert set(got) == {"Alpha", "Other", "(base)"}
    assert (got["Alpha"].orders, got["Alpha"].loss_pct, got["Alpha"].median_profit) == (2, 50.0, -5.0)
    assert (got["(base)"].orders, got["(base)"].median_profit, got["(base)"].net_result) == (3, 2.0, 10.0)


def test_promise_window_skips_notes_without_a_date(spark):
    orders = spark.createDataFrame([order(1), order(2)], ORDER)
    tags = spark.createDataFrame(
        [(1, 1, 38, "do (2026-03-02 05:30:00Z)", T0), (2, 2, 38, "soon", T0), (3, 2, 38, "(2026-99-02 05:30:00Z)", T0)], TAG
    )
    got = fulfilment.promise_window(orders, tags, first="2026-01-01").collect()
    assert [tuple(r) for r in got] == [("2026-03", 1, 29.0, 29.0)]


def test_counterfactual_needs_the_same_country_and_weight(spark):
    orders = spark.createDataFrame([order(k) for k in range(1, 7)] + [order(7, weight="0.9")], ORDER)
    ship = spark.createDataFrame(
        [(1, D(2), D(1), "X UNTR", "C", "DE"), (2, D(4), D(1), "X MINI", "C", "DE"), (3, D(50), D(1), "FAST", "C", "DE"),
         (4, D(10), D(1), "FAST", "C", "DE"), (5, D(20), D(1), "FAST", "C", "FR"), (6, D(9), D(1), "X UNTR", "C", "DE"),
         (7, D(30), D(1), "FAST", "C", "DE")],
        SHIP,
    )
    tags = spark.createDataFrame([(k, k, 38, "", T0) for k in (4, 5, 6, 7)] + [(9, 4, 38, "", T0)], TAG)
    got = fulfilment.upgrade_counterfactual(orders, ship, tags, as_of=T0, min_cheap=2, min_orders=1).collect()
    assert [tuple(r) for r in got] == [("FAST", 1, 10.0, 3.0, 7.0, 7.0)]


def test_flag_join_does_not_multiply(spark):
    orders = spark.createDataFrame([order(1), order(2)], ORDER)
    tags = spark.createDataFrame([(i, 1, 38, "", T0) for i in range(100)], TAG)
    got = fulfilment.tag_share_weekly(orders, tags, first="2026-01-01", as_of="2026-03-20").collect()
    assert [(r.orders, r.tagged, r.tagged_pct) for r in got] == [(2, 1, 50.0)]
