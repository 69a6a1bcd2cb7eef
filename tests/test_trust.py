from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from orderlens.operators import trust
from orderlens.plans.checks import Check, failed, run_checks, typed

T0 = dt.datetime(2026, 3, 10)


def test_health_speaks_only_about_the_sick(spark):
    make = lambda rows: spark.createDataFrame(rows, "k bigint, at timestamp")
    old = T0 - dt.timedelta(hours=13)
    tables = {
        "fine": trust.Watched(make([(1, T0), (2, T0)]), ["k"], "at"),
        "double": trust.Watched(make([(1, T0), (1, T0)]), ["k"], "at"),
        "old": trust.Watched(make([(1, old)]), ["k"], "at"),
        "settings": trust.Watched(make([(1, old)]), ["k"], "at"),
        "both": trust.Watched(make([(1, old), (1, old)]), ["k"], "at"),
    }
    got = {r.table_name: r.status for r in trust.mirror_health(tables, as_of=T0, rarely_changed=["settings"]).collect()}
    assert got == {"double": "duplicate keys", "old": "stale", "both": "duplicates and stale"}


def test_registry_finds_missing_stale_and_unknown(spark):
    registry = spark.createDataFrame(
        [("gone", "s", None, 2), ("late", "s", None, None), ("frozen", "s", None, 9999), ("ok", "s", None, 2)],
        "target string, source string, watermark string, max_age_days int",
    )
    day = T0.date()
    catalog = spark.createDataFrame(
        [("late", day, 3, 1), ("frozen", day, 500, 1), ("ok", day, 2, 1), ("extra", day, 0, 1), ("known", day, 0, 1),
         ("ok_staging", day, 0, 1), ("etl_registry", day, 0, 1)],
        "table_name string, modified date, age_days bigint, rows bigint",
    )
    got = trust.registry_reconcile(registry, catalog, documented=["known"]).orderBy("severity_order").collect()
    assert [(r.table_name, r.problem) for r in got] == [("gone", "missing"), ("late", "stale"), ("extra", "not registered")]


def test_coverage_states(spark):
    at = lambda days: T0 - dt.timedelta(days=days)
    rows = [
        ("R", "DE", at(1), "LANDED", 0), ("R", "FR", at(1), "EMPTY", 0), ("R", "IT", at(1), None, 5),
        ("R", "ES", at(1), None, 0), ("R", "NL", at(3), "LANDED", 1), ("R", "BE", at(7), "LANDED", 1),
        ("R", "PL", at(1), "FAILED", 9), ("R", "NA", at(1), "LANDED", 1),
    ]
    df = spark.createDataFrame(rows, "reportType string, market string, fetchedOnUtc timestamp, status string, contentBytes bigint")
    expected = [("R", m, 2) for m in ("DE", "FR", "IT", "ES", "NL", "BE", "PL", "US", "NA", "XX")]
    got = {
        r.market: (r.state[0], r.failures)
        for r in trust.coverage_vs_expected(df, as_of=T0, expected=expected, regions={"NA": ["US"]}).collect()
    }
    assert got == {"ES": ("1", 0), "PL": ("1", 1), "XX": ("1", 0), "NL": ("3", 0), "BE": ("2", 0)}


def test_silence(spark):
    df = spark.createDataFrame([(T0 - dt.timedelta(days=5),)], "at timestamp")
    alarm = lambda d, **kw: [tuple(r) for r in trust.silence_alarm(d, "at", as_of=T0, source="s", **kw).collect()]
    assert alarm(df) == [("s", "2026-03-05", 5, 1)]
    assert alarm(df, max_silent_days=5) == []
    assert alarm(df.where("false")) == [("s", "NEVER", 9999, 0)]


def test_reconcile_sees_cut_text_and_lost_rows(spark):
    schema = "k bigint, at timestamp, t string"
    source = spark.createDataFrame([(1, T0, "Artykuły szkolne"), (2, T0, None)], schema)
    target = spark.createDataFrame([(1, T0, "Artyku")], schema)
    got = {r.measure: r.difference for r in trust.source_target_reconcile(source, target, key=["k"], watermark="at").collect()}
    assert got["rows"] == 1 and got["t: length"] == 10 and got["t: non_null"] == 0 and got["max_time"] == 0


def test_footprint(spark):
    df = spark.createDataFrame([("żó", 1, None), (None, 2, T0)], "s string, i int, t timestamp")
    got = {r.column_name: (r.bytes, r.share_pct) for r in trust.column_footprint(df).collect()}
    assert got == {"s": (4, 20.0), "i": (8, 40.0), "t": (8, 40.0)}


def test_severity_takes_the_first_rule(spark):
    df = spark.createDataFrame([(-60.0,), (-50.0,), (-20.0,)], "profit double")
    got = [r.severity for r in trust.severity(df, trust.rules_for("weekly_losses")).collect()]
    assert got == ["critical", "warning", "info"]


def test_placeholder_watermark(spark):
    df = spark.createDataFrame([(dt.datetime(1977, 6, 14),)] * 3 + [(T0,), (None,)], "at timestamp")
    r = trust.watermark_profile(df, "at", as_of=T0, table="t").first()
    assert (r.rows, r.nulls, r.placeholder_pct, r.distinct_days, r.changed_last_day) == (5, 1, 60.0, 2, 1)


def test_no_link_of_a_check_is_left_out(spark):
    many = spark.range(40).selectExpr("id", "id % 20 AS page")
    results = run_checks(spark, [Check("many", lambda: many, link_column="page", link_template="https://x/{}")])
    assert sorted(r.link for r in results.links.collect()) == sorted(f"https://x/{i}" for i in range(20))
    results.release()


def test_checks_are_isolated(spark):
    two = spark.createDataFrame([(1, 2.5), (2, None)], "id bigint, v double")
    boom = two.select(F.raise_error(F.lit("run time")).alias("x"))
    results = run_checks(
        spark,
        [
            Check("talks", lambda: two, order_by=("id",), link_column="id", link_template="https://x/{}?p=100%"),
            Check("quiet", lambda: two.where("false"), silent_when_empty=True),
            Check("empty", lambda: two.where("false")),
            Check("plan", lambda: two.select("nope")),
            Check("run", lambda: boom),
        ],
    )
    summary = {r.check: (r.rows, r.silent, r.error is not None) for r in results.summary.collect()}
    assert summary == {
        "talks": (2, False, False), "quiet": (0, True, False), "empty": (0, False, False),
        "plan": (None, False, True), "run": (None, False, True),
    }
    got = [tuple(r) for r in results.rows.orderBy("row_no").collect()]
    assert got[0] == ("talks", 1, '{"id":1,"v":2.5}', "https://x/1?p=100%")
    assert failed(results)
    assert [r.link for r in results.links.orderBy("link").collect()] == ["https://x/1?p=100%", "https://x/2?p=100%"]
    results.release()


def test_rows_of_long_reports_are_numbered_by_ranges(spark):
    many = spark.range(5000).selectExpr("id", "id % 7 AS g", "xxhash64(id) AS x").repartition(5)
    results = run_checks(spark, [Check("many", lambda: many, order_by=("g", "x"))])
    rows = typed(results.rows, "g int, x bigint").orderBy("row_no").collect()
    assert [r.row_no for r in rows] == list(range(1, 5001))
    assert [(r.g, r.x) for r in rows] == sorted((r.g, r.x) for r in rows)
    plan = results.rows._jdf.queryExecution().toString()
    assert "SinglePartition" not in [line for line in plan.splitlines() if "payload" in line and "Exchange" in line]
    results.release()
