"""A driver that dies, or runs in another time zone, loses and doubles nothing."""

from __future__ import annotations

import datetime as dt
import time

import pytest

from orderlens.contracts import TableContract
from orderlens.operators import cohorts, ingest, trust
from orderlens.sources import snapshots

from test_cohorts import OFFER, D, offer, sales
from test_baskets import hits

JAN, FEB, MAR = (dt.datetime(2026, m, 5) for m in (1, 2, 3))
T0 = dt.datetime(2026, 3, 10)
TABLE = TableContract("t", key=("id",), watermark="at", partition_by="day", granularity="MONTH")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, day timestamp, at timestamp, name string")


def stored(spark, root):
    return sorted((r.id, r.name, r[ingest.PART]) for r in ingest.read_layout(spark, f"{root}/t").collect())


class Death(BaseException):
    pass


def dies_in(monkeypatch, step: str, *, after: bool):
    """The run ends before or after it has written rows, or has switched the snapshot."""
    real = getattr(snapshots, step)

    def die(*args):
        if after:
            real(*args)
        raise Death

    monkeypatch.setattr(snapshots, step, die)


STEPS = [("write", False), ("write", True), ("switch", False), ("switch", True)]


@pytest.mark.parametrize("step, after", STEPS)
def test_killed_merge_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step, after):
    root = str(tmp_path)
    ingest.sync_table(TABLE, frame(spark, (1, JAN, T0, "a"), (2, MAR, T0, "b"), (3, FEB, T0, "c")), root)
    later = T0 + dt.timedelta(hours=1)
    delta = frame(spark, (1, FEB, later, "a2"), (2, MAR, later, "b2"))  # January loses its last row
    with monkeypatch.context() as patch:
        dies_in(patch, step, after=after)
        with pytest.raises(Death):
            ingest.sync_table(TABLE, delta, root)
    old = [(1, "a", "2026-01-01"), (2, "b", "2026-03-01"), (3, "c", "2026-02-01")]
    new = [(1, "a2", "2026-02-01"), (2, "b2", "2026-03-01"), (3, "c", "2026-02-01")]
    assert stored(spark, root) == (new if (step, after) == ("switch", True) else old)
    ingest.sync_table(TABLE, delta, root)
    ingest.sync_table(TABLE, delta, root)
    ingest.settle(spark, f"{root}/t")
    assert stored(spark, root) == new
    versions = [p for p in (tmp_path / "t").glob("*/*") if p.is_dir()]
    assert len(versions) <= 2 * 3, "what two snapshots do not name is gone"


@pytest.mark.parametrize("step, after", STEPS)
def test_killed_reload_leaves_a_whole_table(spark, tmp_path, monkeypatch, step, after):
    path = str(tmp_path / "t")
    for first in (True, False):
        with monkeypatch.context() as patch:
            dies_in(patch, step, after=after)
            with pytest.raises(Death):
                ingest.full_reload(frame(spark, (2, JAN, T0, "new")), TABLE, path)
        done = (step, after) == ("switch", True)
        if first:
            assert ingest.table_exists(spark, path) == done
            ingest.full_reload(frame(spark, (1, JAN, T0, "old")), TABLE, path)
        else:
            assert stored(spark, str(tmp_path)) == ([(2, "new", "2026-01-01")] if done else [(1, "old", "2026-01-01")])


@pytest.mark.parametrize("write", ["reload", "merge"])
def test_a_reader_sees_the_old_or_the_new_table_but_never_neither(spark, tmp_path, monkeypatch, write):
    """A reader looks before, during and after every step of a write, and keeps what it has found until the end."""
    path = str(tmp_path / "t")
    days = [(i, dt.datetime(2026, 1 + i % 6, 5), T0, "old") for i in range(60)]
    ingest.full_reload(frame(spark, *days), TABLE, path)
    later = T0 + dt.timedelta(hours=1)
    new = frame(spark, *[(i, dt.datetime(2026, 1 + i % 6, 5), later, "new") for i in range(60)])
    readers, seen = [], []

    def look():
        df = ingest.read_layout(spark, path)
        readers.append(df)
        seen.append({r.name: r["count"] for r in df.groupBy("name").count().collect()})

    for step in ("write", "switch"):
        real = getattr(snapshots, step)

        def watched(*args, real=real):
            look()
            out = real(*args)
            look()
            return out

        monkeypatch.setattr(snapshots, step, watched)
    look()
    if write == "reload":
        ingest.full_reload(new, TABLE, path)
    else:
        ingest.upsert_into(new, TABLE, path)
    look()
    assert seen == [{"old": 60}] * 4 + [{"new": 60}] * 2
    late = [{r.name: r["count"] for r in df.groupBy("name").count().collect()} for df in readers]
    assert late == seen, "a reader keeps its snapshot after the switch"


def test_a_second_writer_is_told(spark, tmp_path):
    path = str(tmp_path / "t")
    ingest.full_reload(frame(spark, (1, JAN, T0, "a")), TABLE, path)
    before = snapshots.current(spark, path)
    ingest.full_reload(frame(spark, (2, JAN, T0, "b")), TABLE, path)
    with pytest.raises(snapshots.WriterConflict):
        snapshots.switch(spark, path, before, {})
    assert [r.id for r in ingest.read_layout(spark, path).collect()] == [2]


def test_a_table_without_snapshots_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    ingest.write_layout(frame(spark, (1, JAN, T0, "a"), (2, None, T0, "b")), TABLE, path)
    assert ingest.table_exists(spark, path)
    ingest.upsert_into(frame(spark, (1, FEB, T0, "a2"), (3, JAN, T0, "c")), TABLE, path)
    want = [(1, "a2", "2026-02-01"), (2, "b", None), (3, "c", "2026-01-01")]
    assert stored(spark, str(tmp_path)) == want
    ingest.upsert_into(frame(spark, (2, None, T0, "b2")), TABLE, path)
    ingest.settle(spark, path)
    assert stored(spark, str(tmp_path)) == [want[0], (2, "b2", None), want[2]]


def test_mark_does_not_depend_on_the_drivers_zone(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    noon = dt.datetime(2026, 3, 10, 12)
    spark.sql("SELECT 1L id, TIMESTAMP '2026-03-10 12:00:00' day, TIMESTAMP '2026-03-10 12:00:00' at, 'a' name").write.parquet(f"{root}/one")
    spark.sql("SELECT 2L id, TIMESTAMP '2026-03-10 12:30:00' day, TIMESTAMP '2026-03-10 12:30:00' at, 'b' name").write.parquet(f"{root}/two")
    monkeypatch.setenv("TZ", "Asia/Tokyo")
    time.tzset()
    try:
        ingest.sync_table(TABLE, spark.read.parquet(f"{root}/one"), root)
        assert ingest.sync_table(TABLE, spark.read.parquet(f"{root}/two"), root) == ("t", "merge", 1)
    finally:
        monkeypatch.undo()
        time.tzset()
    assert [r[:2] for r in stored(spark, root)] == [(1, "a"), (2, "b")], noon


def test_replay_of_a_past_day_sees_nothing_later(spark):
    orders, items = sales(
        spark, [(1, "NL", 1, 30, "b", 2, 5, 1), (2, "NL", 20, 30, "b", 1, 1, 1)]
    )
    settings = spark.createDataFrame([("b", "NL", "G", 1, D(9))], "OurEan string, BookstoreId string, TestGroupName string, fIsActive int, Price decimal(18,4)")
    offers = spark.createDataFrame([offer(1, "b", 9), offer(2, "other", 9, sku="b", at=T0 + dt.timedelta(days=1))], OFFER)
    none = spark.createDataFrame([], "Ean string, MarketplaceId string, RetailerId string, FulfilmentMethod string, BestOfferPrice decimal(18,4), HasOffer boolean, LastCheckedUtc timestamp")
    live = spark.createDataFrame([], "Ean string, MarketplaceId string, BundlePrice decimal(18,4)")
    run = lambda as_of: cohorts.pilot_propagation(
        settings, offers, none, live, orders, items, as_of=as_of, market="NL", group="G", our_retailer="me"
    ).first()
    assert (run(T0).units, run(T0 - dt.timedelta(days=10)).units) == (3, 1)
    assert run(T0).forced_in_offer == 1, "an offer is found by its SKU, whatever its own product"


def test_bundle_of_one_product_twice(spark):
    lines = [(1, "a", 0.9), (1, "a", 1.0), (1, "c", 1.0)]
    assert hits(spark, lines, (("a", 1), ("a", 1)))["2"] == (1, 1)


def test_empty_table_speaks(spark):
    df = frame(spark).where("false")
    got = trust.mirror_health({"t": trust.Watched(df, ["id"], "at")}, as_of=T0).collect()
    assert [(r.table_name, r.status) for r in got] == [("t", "empty")]
