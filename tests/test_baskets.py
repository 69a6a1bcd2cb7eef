from __future__ import annotations

import datetime as dt
import itertools
import random
from decimal import Decimal as D

import pytest

from orderlens.operators import baskets, cost, crawl

FEED = "Id bigint, isbn13 string, own_ean string, name string, SupplierId string"
LINK = "EAN string, ReplacementEAN string"


def brute_force(feed, links, min_suppliers):
    """All unlinked confirmed pairs as {(isbn, a, b): confirmations}."""
    sup = {}
    for _, isbn, ean, _, s in feed:
        if isbn and len(isbn) == 13 and ean not in (None, "", "-1"):
            sup.setdefault(isbn, {}).setdefault(ean, set()).add(s)
    known = {tuple(sorted(p)) for p in links}
    out = {}
    for isbn, codes in sup.items():
        for a, b in itertools.combinations(sorted(codes), 2):
            n = min(len(codes[a]), len(codes[b]))
            if n >= min_suppliers and (a, b) not in known:
                out[isbn, a, b] = n
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_missing_pairs_with_a_hot_isbn(spark, seed):
    rng = random.Random(seed)
    isbns = ["H" * 13] * 5 + [f"{i:013d}" for i in range(10)]
    feed = [
        (i, rng.choice(isbns), rng.choice(["-1", "", None] + [f"c{j:02d}" for j in range(60)]), f"n{i}", f"s{rng.randint(0, 5)}")
        for i in range(1500)
    ]
    codes = [f"c{j:02d}" for j in range(60)]
    links = [tuple(rng.sample(codes, 2)) for _ in range(700)]
    want = brute_force(feed, links, 2)
    got = baskets.missing_pairs(
        spark.createDataFrame(feed, FEED), spark.createDataFrame(links, LINK), k=40, spread=4
    ).collect()
    found = {(r.isbn13, r.code_a, r.code_b): r.confirmations for r in got}
    assert len(found) == min(40, len(want)) == len(got)
    assert all(want[k] == n for k, n in found.items())
    assert sorted(found.values(), reverse=True) == sorted(want.values(), reverse=True)[:40]


def test_pairs_grow_with_k_and_links_not_with_the_group(spark):
    feed = spark.createDataFrame(
        [(i, "H" * 13, f"c{i:05d}", "n", s) for i in range(3000) for s in ("a", "b")], FEED
    )
    links = spark.createDataFrame([("c00001", "c00000")], LINK)
    got = baskets.missing_pairs(feed, links, k=10).collect()
    assert len(got) == 10 and ("c00000", "c00001") not in {(r.code_a, r.code_b) for r in got}


def test_pairs_name_the_author_and_publisher_of_their_first_code(spark):
    feed = [
        (1, "c1", "Title b", None, "House", "s1"), (2, "c1", "Title a", "Author", None, "s2"),
        (3, "c2", "Other", "Else", "Where", "s1"), (4, "c2", "Other", "Else", "Where", "s2"),
        (5, "c0", "x" * 70, None, None, "s1"), (6, "c0", None, None, None, "s2"),
    ]
    frame = spark.createDataFrame([(i, "H" * 13, *rest) for i, *rest in feed], "Id bigint, isbn13 string, own_ean string, "
                                  "name string, autor string, wydawnictwo string, SupplierId string")  # fmt: skip
    got = baskets.missing_pairs(frame, spark.createDataFrame([("c2", "c0")], LINK)).collect()
    assert sorted(tuple(r)[1:] for r in got) == [
        ("c0", "c1", "x" * 60, None, None, 2), ("c1", "c2", "Title a", "Author", "House", 2),
    ]


REL = "order_id bigint, ean string, rel decimal(18,6)"


def hits(spark, lines, components=(("a", 1), ("b", 1))):
    rel = spark.createDataFrame([(o, e, D(str(r))) for o, e, r in lines], REL)
    bundle = spark.createDataFrame(
        [(1, 7, True), (2, None, True), (3, 7, False)], "Id bigint, SellySetId bigint, Visible boolean"
    )
    parts = spark.createDataFrame([(b, e) for e, b in components], "BundleId bigint, Ean string")
    return {r.section[0]: (r.orders, r.bundles) for r in baskets.bundle_attribution(rel, bundle, parts).collect()}


def test_bundles_need_contrast(spark):
    got = hits(
        spark,
        [
            (1, "a", 0.9), (1, "b", 0.9), (1, "c", 1.0),   # certain
            (2, "a", 0.9), (2, "b", 0.9), (2, "c", 0.9),   # everything is cheaper
            (3, "a", 0.9), (3, "b", 1.0), (3, "c", 1.0),   # pair not discounted
            (4, "a", 0.9),                                 # half a pair
            (5, "a", 0.9), (5, "a", 1.0), (5, "b", 0.9),   # full-price line belongs to the pair
        ],
    )
    assert got["2"] == (1, 1) and got["3"] == (2, 1) and got["4"] == (2, 1)


def test_bundle_of_three_products_is_ignored(spark):
    lines = [(1, "a", 0.9), (1, "b", 0.9), (1, "c", 1.0)]
    assert hits(spark, lines, (("a", 1), ("b", 1), ("c", 1)))["2"] == (0, 0)


def test_first_parameter_value_and_absent_key(spark):
    df = spark.sql(
        "SELECT 'x' AS event_name, array(named_struct('key', 'k', 'value', '1'), named_struct('key', 'k', 'value', '2')) AS event_params"
        " UNION ALL SELECT 'x', array() UNION ALL SELECT 'x', NULL"
    )
    got = [r[0] for r in df.select(baskets.event_param("event_params", "k")).collect()]
    assert got == ["1", None, None]


def test_rules_apply_in_order(spark):
    df = spark.createDataFrame(
        [(1, "FV/1", "ACME Ads", "x", D(1)), (1, "FV/1", "ACME Ads", "x", D(1)), (2, "FV/2/W", "ACME", "x", D(1)),
         (3, "FV/3", "Zed", "cloud bill", D(2))],
        "InvoiceId bigint, NumerFaktury string, counterparty string, text string, amount decimal(18,4)",
    )
    rules = [("ACME%", None, "ads"), (None, "cloud%", "it"), ("%", None, "rest")]
    got = sorted((r.InvoiceId, r.category) for r in baskets.rule_categorise(df, rules).collect())
    assert got == [(1, "ads"), (3, "it")]


BILL = (
    "invoice struct<month:string>, service struct<description:string>, sku struct<description:string>, "
    "cost decimal(18,4), credits array<struct<amount:decimal(18,4)>>"
)


def bill(month, service, amount, credits=()):
    return ((month,), (service,), ("s",), D(amount), None if credits is None else [(D(c),) for c in credits])


def test_credits_may_be_missing(spark):
    df = spark.createDataFrame([bill("202602", "A", 10, (-1, -2)), bill("202602", "A", 5, None), bill("202602", "A", 1)], BILL)
    assert [float(r.net) for r in cost.net_cost(df).collect()] == [13.0]


def test_total_without_tax_line_adds_the_rate(spark):
    rows = [bill("202602", "A", 100), bill("202601", "A", 50), bill("202601", "Invoice", 12)]
    got = {r.section[0]: r for r in cost.monthly_cost_report(spark.createDataFrame(rows, BILL), as_of="2026-03-03", watch=()).collect()}
    assert (got["1"].cost, got["1"].previous, got["1"].change_pct, got["1"].year_change_pct) == (123.0, 62.0, 98.0, None)
    assert (got["2"].item, got["2"].cost, got["2"].change_pct) == ("A", 100.0, 100.0)


def test_bots_and_all_traffic(spark):
    at = dt.datetime(2026, 3, 1, 10)
    agents = ["Googlebot/2.1", "Googlebot-Image/1.0", "Firefox", None]
    df = spark.createDataFrame(
        [(at, "z", a, 200, "miss", 5, 1.5) for a in agents],
        "ts timestamp, zone string, user_agent string, edge_status int, cache_status string, bytes bigint, origin_ms double",
    )
    daily = crawl.crawl_daily(df)
    got = {r.bot: (r.requests, r.bytes) for r in daily.collect()}
    assert got == {"__ALL__": (4, 20), "Googlebot": (1, 5), "Googlebot-Image": (1, 5)}
    exact = spark.createDataFrame([(at.date(), "z", 8)], "data_date date, zone string, requests bigint")
    scaled = {r.bot: (r.factor, r.scaled, r.share_pct) for r in crawl.sampled_calibration(daily, exact).collect()}
    assert scaled == {"Googlebot": (2.0, 2.0, 25.0), "Googlebot-Image": (2.0, 2.0, 25.0)}
    assert {r.bot for r in crawl.origin_share(daily).collect()} == {"Googlebot", "Googlebot-Image"}
    assert {r.collected_at for r in daily.collect()} == {None}
    later = crawl.crawl_daily(df, collected_at="2026-03-02 04:00:00")
    both = later.unionByName(crawl.exact_rows(exact, collected_at="2026-03-02 04:00:00"))
    assert {r.collected_at for r in both.collect()} == {dt.datetime(2026, 3, 2, 4)}
