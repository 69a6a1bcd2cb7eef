from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.operators import loss

AS_OF = "2026-03-10"
COLUMNS = (
    "CustomerOrderId bigint, IdBookstore string, ShippingCountryIso2 string, OrderCreatedOnUtc timestamp, "
    "OrderStatusId int, IsDoneCalculating boolean, NumOfItems bigint, fOrderTotal decimal(18,4), "
    "ProductCost decimal(18,4), ShippingCost decimal(18,4), MarketplaceCost decimal(18,4), "
    "PaymentCost decimal(18,4), HandlingCost decimal(18,4), PackagingCost decimal(18,4), "
    "Profit_Actual decimal(18,4), Profit_Estimated decimal(18,4), ProfitMargin decimal(18,4)"
)


def order(key, profit, total=100, product=50, shipping=10, market=10, payment=2, *, days=1, status=30,
          done=True, estimated=None, shop="AZ-DE", country="DE"):
    d = lambda x: None if x is None else Decimal(str(x))
    return (
        key, shop, country, dt.datetime(2026, 3, 10) - dt.timedelta(days=days), status, done, 1, d(total),
        d(product), d(shipping), d(market), d(payment), d(1), d(1), d(profit),
        d(profit if estimated is None else estimated), None,
    )


ORDERS = [
    order(1, -60, total=40, product=50),
    order(2, -20, shipping=60),
    order(3, -30, market=26, shop="AZ-FR"),
    order(4, -5, payment=11),
    order(5, -9.99),
    order(6, -10, shop="AZ-IT", country=None),
    order(7, -500, total=0, product=0, shipping=0),
    order(8, 25),
    order(9, 0),
    order(10, -99, status=40),
    order(11, -99, done=False),
    order(12, -99, days=9),
    order(13, -40, total=None, product=None, shipping=None, country="XX"),
]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(ORDERS, COLUMNS)


@pytest.fixture(scope="module")
def tags(spark):
    at = dt.datetime(2026, 3, 9, 12)
    rows = [
        (1, 1, 35, "old", "A", at), (2, 1, 35, "new", "A", at + dt.timedelta(hours=1)),
        (3, 2, 35, "tie 1", "B", at), (4, 2, 35, "tie 2", "B", at),
        (5, 3, 35, "x" * 200, "C", at), (6, 4, 22, "return", "C", at), (7, 5, 33, "aged", "C", at),
        (8, 8, 35, "profitable", "C", at), (9, 1, 1, "drift", "A", at), (10, 1, 10, "drift", "A", at),
    ]
    return spark.createDataFrame(
        rows, "Id bigint, CustomerOrderId bigint, TagId int, Note string, Source string, CreatedOnUtc timestamp"
    )


def rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_cause_takes_the_first_test_that_holds(orders):
    causes = {r.CustomerOrderId: r.cause for r in loss.classified_orders(orders).collect()}
    assert [causes[k] for k in (1, 2, 3, 4, 5)] == [1, 2, 3, 4, 5]
    assert causes[7] == 5, "no revenue, no ratio"
    assert causes[13] == 5, "unknown costs fall through"


def test_topk_filters_and_orders(orders):
    got = loss.loss_topk(orders, as_of=AS_OF).collect()
    assert [r.order_id for r in got] == [7, 1, 13, 3, 2, 6, 4], "-9.99 without a cause is noise"
    assert {r.order_id: r.country for r in got}[6] == "??"
    assert got[1].country == "Niemcy" and got[2].country == "XX"


def test_topk_ties_go_to_the_lower_id(spark):
    df = spark.createDataFrame([order(k, -50) for k in (5, 3, 9)], COLUMNS)
    assert [r.order_id for r in loss.loss_topk(df, as_of=AS_OF, k=2).collect()] == [3, 5]


def test_large_losses(orders):
    assert [r.order_id for r in loss.loss_topk_large(orders, as_of=AS_OF, days=8).collect()] == [7]


def test_sweep_counts_every_threshold(orders):
    got = rows(loss.threshold_sweep(orders, as_of=AS_OF, days=8, thresholds=(-10, -50, -1000)), "threshold")
    assert (got[-10.0].orders, got[-50.0].orders, got[-1000.0].orders) == (5, 2, 0)
    assert got[-1000.0].loss_pct == 0.0


def test_patterns_keep_the_first_markets(spark):
    df = spark.createDataFrame([order(i, -1, shop=f"M{i}") for i in range(9, 0, -1)], COLUMNS)
    got = loss.loss_patterns(df, as_of=AS_OF, max_markets=3).collect()[0]
    assert (got.orders, got.markets) == (9, "M1,M2,M3")


def test_patterns_partition_the_losses(orders):
    got = loss.loss_patterns(orders, as_of=AS_OF).collect()
    assert sum(r.orders for r in got) == 8


def test_tag_counts_an_order_once_and_shows_the_newest_note(orders, tags):
    got = rows(loss.loss_by_tag(orders, tags, as_of=AS_OF), "tag")
    assert list(got) == [35]
    assert (got[35].orders, got[35].loss, got[35].example) == (3, -110.0, "new")


def test_cooccurrence_repeats_the_loss(orders, tags):
    got = rows(loss.tag_cooccurrence(orders, tags, as_of=AS_OF), "tag")
    assert (got[35].losing_orders, got[35].loss_per_tag_row) == (3, -190.0)


def test_structure_speaks_on_its_day(orders, tags):
    got = rows(loss.loss_structure(orders, tags, as_of="2026-03-10", report_day=10), "loss_class")
    assert got["1. replacement shipment (no revenue)"].orders == 1
    assert got["2. return"].orders == 1 and got["3. aged stock sold off"].orders == 1
    assert sum(r.orders for r in got.values()) == 9, "the 30-day window also holds order 12"
    assert loss.loss_structure(orders, tags, as_of="2026-03-10").count() == 0


def test_plan_leaves_out_returns_and_mixed_causes(orders, tags):
    got = rows(loss.loss_by_plan(orders, tags, as_of=AS_OF), "order_id")
    assert sorted(got) == [1, 2, 3]
    assert got[1].tags == "1,10,35" and got[2].tags == "35"


def test_zero_result_is_not_unprofitable(spark):
    df = spark.createDataFrame([order(1, -0.4), order(2, 0), order(3, -30, country="FR")], COLUMNS)
    got = loss.unprofitable_destinations(df, as_of=AS_OF, min_orders=1).collect()
    assert [r.country for r in got] == ["FR"]


def test_small_baskets_may_lose_where_all_orders_earn(spark):
    df = spark.createDataFrame([order(1, -9), order(2, 50), order(3, -4)], COLUMNS)
    df = df.withColumn("fOrderTotal", F.when(F.col("CustomerOrderId") == 2, 500).otherwise(20).cast("decimal(18,4)"))
    assert loss.unprofitable_destinations(df, as_of=AS_OF, min_orders=1).count() == 0
    (got,) = loss.unprofitable_destinations(df, as_of=AS_OF, min_orders=1, below=20.01).collect()
    assert (got.orders, got.losses, got.result) == (2, 2, -13)
    assert loss.unprofitable_destinations(df, as_of=AS_OF, min_orders=1, below=20).count() == 0


def test_bands_and_shares_cover_their_input(orders):
    bands = loss.loss_bands(orders, as_of=AS_OF).collect()
    assert sum(r.orders for r in bands) == 4
    assert round(sum(r.loss_pct for r in bands)) == 100
    assert sum(r.orders for r in loss.loss_cost_shares(orders, as_of=AS_OF).collect()) == 8


def test_weekly_losses_flag_tags(orders, tags):
    got = rows(loss.weekly_losses(orders, tags, as_of=AS_OF), "order_id")
    assert got[11].tags == "none" and got[1].tags == "tagged", "open calculations are listed here"
    assert got[7].loss_pct is None


ITEM = (
    "Id bigint, CustomerOrderId bigint, EAN string, Quantity int, ItemProfit decimal(18,4), "
    "UnitSalesPriceNet decimal(18,4), UnitPurchasePriceNet decimal(18,4), "
    "UnitPurchasePriceNet_OfferTime decimal(18,4), OrderCostMinusShippingChargeForUnit decimal(18,4), "
    "ShippingChargePlnNettoForUnit decimal(18,4), LastUpdateOnUtc timestamp"
)


def item(key, order_id, profit, sale, purchase, indirect, ship, hour, then=None, ean="E"):
    d = lambda x: None if x is None else Decimal(str(x))
    return (key, order_id, ean, 1, d(profit), d(sale), d(purchase), d(then), d(indirect), d(ship),
            dt.datetime(2026, 3, 9, hour))


def test_problem_product_names_the_newest_cause(spark, orders):
    items = spark.createDataFrame(
        [
            item(1, 1, -1, 10, 12, 0, 0, 1), item(2, 2, -2, 10, 5, 6, 0, 5), item(3, 3, -3, 10, 5, 1, 6, 5),
            item(4, 10, -9, 10, 5, 1, 6, 9), item(5, 1, -1, 10, 5, 1, 1, 1, ean="F"),
        ],
        ITEM,
    )
    got = loss.problem_products(orders, items, as_of=AS_OF).collect()
    assert [(r.ean, r.losses, r.total_loss, r.main_cause) for r in got] == [("E", 3, -6.0, "shipping costs")]


def test_item_cause(spark):
    items = spark.createDataFrame(
        [
            item(1, 1, 0, 10, 10, 0, 0, 1), item(2, 1, 0, 10, 5, 6, 0, 1), item(3, 1, 0, 10, 5, 5, 6, 1),
            item(4, 1, 0, 10, 5, 5, 5, 1, then=4),
        ],
        ITEM,
    )
    got = loss.item_loss_cause(items, order_id=1).collect()
    assert [r.main_cause for r in got] == ["purchase price too high", "indirect costs", "shipping costs", "mixed"]
    assert [r.purchase_price_change for r in got] == [0.0, 0.0, 0.0, 1.0]
