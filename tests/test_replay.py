"""A replay of a past moment sees no tag that was set later, in any report that looks at tags."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderlens.operators import fulfilment, loss, variance
from orderlens.operators.filters import known_tags
from orderlens.plans.reports import BANDS, START, SUPPLIER_NOTE
from orderlens.sources.entities import Entities
from orderlens.sources.tables import Tables

THEN, DAYS = "1997-06-01", 900
AT = {"as_of": THEN, "days": DAYS}

REPORTS = {
    "loss_by_tag": lambda e, t: loss.loss_by_tag(e.order_profit, t, **AT),
    "tag_cooccurrence": lambda e, t: loss.tag_cooccurrence(e.order_profit, t, **AT),
    "loss_structure": lambda e, t: loss.loss_structure(e.order_profit, t, report_day=None, **AT),
    "loss_by_plan": lambda e, t: loss.loss_by_plan(e.order_profit, t, tolerance=1e6, k=1000, **AT),
    "weekly_losses": lambda e, t: loss.weekly_losses(e.order_profit, t, k=1000, **AT),
    "driver_means": lambda e, t: variance.driver_means(e.order_profit, t, **AT),
    "tag_share_weekly": lambda e, t: fulfilment.tag_share_weekly(e.order_profit, t, first=START, as_of=THEN),
    "upgrade_counterfactual": lambda e, t: fulfilment.upgrade_counterfactual(
        e.order_profit, e.shipping_cost, t, cheap=("AF%",), min_cheap=1, min_orders=1, bands=BANDS, **AT
    ),
    "tag_base_rate": lambda e, t: fulfilment.tag_base_rate(e.order_profit, t, pattern=SUPPLIER_NOTE, min_orders=1, **AT),
    "tag_base_rate_monthly": lambda e, t: fulfilment.tag_base_rate_monthly(e.order_profit, t, **AT),
    "tag_base_rate_by_market": lambda e, t: fulfilment.tag_base_rate_by_market(e.order_profit, t, **AT),
    "upgrade_vs_base": lambda e, t: fulfilment.upgrade_vs_base(e.order_fulfilment, t, first=START, until=THEN),
    "deadline_source_monthly": lambda e, t: fulfilment.deadline_source_monthly(
        e.order_fulfilment, t, first=START, until=THEN
    ),
    "supplier_upgrade_rate": lambda e, t: fulfilment.supplier_upgrade_rate(
        e.order_fulfilment, t, first=START, until=THEN, min_orders=1, k=1000
    ),
}


@pytest.fixture(scope="module")
def entities(spark):
    return Entities(Tables(spark, "/root/testdata/sf0.001"))


@pytest.fixture(scope="module")
def tags(entities):
    """All tags, and as many again that every order gets after the moment of the report."""
    real = entities.order_profit_tag
    later = F.to_timestamp(F.lit(THEN)) + F.expr("INTERVAL 1 MICROSECOND")
    orders = entities.order_profit.select(F.col("CustomerOrderId").alias("o"))
    more = real.drop("CustomerOrderId").limit(40).crossJoin(orders).withColumn("CreatedOnUtc", later)
    return real.unionByName(more.withColumnRenamed("o", "CustomerOrderId")).cache()


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_later_tags_change_nothing(entities, tags, name):
    past = entities.order_profit_tag.where(F.col("CreatedOnUtc") <= F.to_timestamp(F.lit(THEN)))
    want = sorted(map(str, REPORTS[name](entities, past).collect()))
    assert want and sorted(map(str, REPORTS[name](entities, tags).collect())) == want


def test_a_tag_counts_from_its_moment_on(spark):
    at = spark.sql("SELECT timestamp'2026-01-01 10:00:00' AS CreatedOnUtc, 1 AS TagId UNION ALL SELECT NULL, 1")
    assert known_tags(at, "2026-01-01 10:00:00").count() == 1
    assert known_tags(at, "2026-01-01 09:59:59.999999").count() == 0
    assert known_tags(at, "2026-01-02", 2).count() == 0
