"""The queries that count every tag see those set after the report's moment, and those without a time."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

from orderlens.plans.reports import AS_OF, REPORTS

MOMENT = dt.datetime.fromisoformat(AS_OF)
ORDERS = "CustomerOrderId bigint, OrderCreatedOnUtc timestamp, OrderStatusId int, IsDoneCalculating boolean, Profit_Actual decimal(18,4)"
TAGS = "Id bigint, CustomerOrderId bigint, TagId int, Note string, Source string, CreatedOnUtc timestamp"


def entities(spark):
    day = MOMENT - dt.timedelta(days=40)
    orders = [(k, day, 30, True, Decimal(-k)) for k in range(1, 25)]
    moments = [MOMENT, MOMENT + dt.timedelta(days=9), None, MOMENT - dt.timedelta(days=5000)]
    tags = [(k, k, 35, "request to Alpha", f"S{k % 4}", moments[k % 4]) for k in range(1, 13)]
    return SimpleNamespace(
        order_profit=spark.createDataFrame(orders, ORDERS), order_profit_tag=spark.createDataFrame(tags, TAGS)
    )


def test_cooccurrence_counts_every_tag(spark):
    got = REPORTS["tag_cooccurrence"](entities(spark)).collect()
    assert [tuple(r) for r in got] == [(35, 12, -78.0, "request to Alpha", "S0")]


def test_base_rate_counts_every_tag(spark):
    got = {r.supplier: (r.orders, r.net_result) for r in REPORTS["tag_base_rate"](entities(spark)).collect()}
    assert got == {"Alpha": (12, -78.0), "(base)": (12, -222.0)}
