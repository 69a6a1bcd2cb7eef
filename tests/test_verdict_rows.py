"""Rows that earlier versions lost, and a watermark that does not depend on the driver's zone."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest

from orderlens.operators import baskets, ingest, variance
from orderlens.sources.scratch import shared_folder


def test_revision_without_a_time_stays(spark):
    rows = [(1, 10, "a", None), (1, 12, "b", dt.datetime(2026, 1, 1)), (None, 5, "c", None)]
    frame = spark.createDataFrame(rows, "CustomerOrderId bigint, p int, Notes string, DeletedOnUtc timestamp")
    frame = frame.selectExpr("CustomerOrderId", "cast(p AS decimal(18,4)) AS Profit_Actual", "Notes", "DeletedOnUtc")
    got = {r.notes: r.profit_change for r in variance.profit_revisions(frame).collect()}
    assert got["a"] is None and float(got["b"]) == 2 and got["c"] is None


def test_invoice_without_a_number_stays(spark):
    rows = [(1, None, "x", "t", 1.0), (2, "7/W", "x", "t", 1.0), (3, "8", "x", "t", 1.0)]
    frame = spark.createDataFrame(rows, "InvoiceId int, NumerFaktury string, counterparty string, text string, amount double")
    assert {r.InvoiceId for r in baskets.rule_categorise(frame, []).collect()} == {1, 3}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_mark_is_the_same_in_every_zone(spark, zone, monkeypatch):
    frame = spark.sql("SELECT timestamp_micros(1767268800000000) AS at UNION ALL SELECT timestamp_micros(1767270600000000)")
    before = os.environ.get("TZ")
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        mark = ingest.stored_mark(frame.where("at < timestamp_micros(1767270000000000)"), "at")
        assert mark == 1767268800000000 - 600_000_000
        assert ingest.delta_extract(frame, "at", mark).count() == 2
    finally:
        monkeypatch.undo()
        assert os.environ.get("TZ") == before
        time.tzset()


def test_local_cluster_needs_a_shared_folder():
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"master": "local-cluster[2,1,1024]"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session, "x")
