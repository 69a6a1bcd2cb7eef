from __future__ import annotations

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlens.contracts import ContractError, TableContract, load_registry, registry_frame
from orderlens.operators import ingest
from orderlens.sources import snapshots
from orderlens.sources.jdbc import jdbc_options, source_select
from orderlens.sources.tables import read_date_shards, read_ndjson
from orderlens.streaming.incremental import stream_sync

T0 = dt.datetime(2026, 3, 10)
SCHEMA = "id bigint, day timestamp, at timestamp, name string, mail string"
ORDERS = TableContract(
    "orders", "db.dbo.orders", ("id",), "at", partition_by="day", granularity="MONTH", cluster_by=("name",),
    mask={"mail": "email_domain"},
)


def row(key, name="n", day=T0, at=T0, mail="a@b.c"):
    return (key, day, at, name, mail)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def stored(spark, root):
    df = ingest.read_layout(spark, f"{root}/orders")
    return sorted((r.id, r.name, r[ingest.PART]) for r in df.collect())


def test_mark_and_delta(spark):
    df = frame(spark, row(1, at=T0), row(2, at=T0 - dt.timedelta(minutes=10)), row(3, at=T0 - dt.timedelta(minutes=11)), row(4, at=None))
    mark = ingest.high_watermark(df, "at").first()["mark"]
    assert mark == T0 - dt.timedelta(minutes=10)
    assert sorted(r.id for r in ingest.delta_extract(df, "at", mark).collect()) == [1, 2]
    assert ingest.high_watermark(df.where("false"), "at").first()["mark"] is None
    assert ingest.delta_extract(df, "at", None).count() == 4


def test_delta_bound_reaches_the_scan(spark, tmp_path):
    frame(spark, row(1)).write.parquet(str(tmp_path / "t"))
    plan = ingest.delta_extract(spark.read.parquet(str(tmp_path / "t")), "at", T0)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(at), GreaterThanOrEqual(at," in plan


def test_chunks_cover_all_keys(spark):
    df = frame(spark, row(5), row(6), row(25), row(14))
    got = [tuple(r) for r in ingest.key_chunks(df, "id", size=10).orderBy("chunk").collect()]
    assert got == [(0, 5, 14, 3), (1, 15, 24, 0), (2, 25, 34, 1)]
    assert ingest.key_chunks(df.where("false"), "id", size=10).count() == 0


def test_contract_drops_and_casts(spark):
    df = spark.sql("SELECT 1L AS id, X'01' AS blob, array(1) AS arr, 2.5D AS price, 'x' AS secret")
    contract = TableContract("t", key=("id",), exclude=("secret",))
    got = ingest.apply_contract(df, contract, {"price": "decimal(18,4)"})
    assert got.dtypes == [("id", "bigint"), ("price", "decimal(18,4)")]
    with pytest.raises(ContractError):
        ingest.apply_contract(df, TableContract("t", cluster_by=("absent",)))
    with pytest.raises(ContractError):
        TableContract("t", granularity="HOUR")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab@.ł", max_size=12)), min_size=1, max_size=20))
def test_mask_keeps_only_the_domain(spark, values):
    df = spark.createDataFrame([(v, v) for v in values], "name string, mail string")
    for r, v in zip(ingest.mask_pii(df, {"name": "xxx", "mail": "email_domain"}).collect(), values):
        if v is None:
            assert r.name is None and r.mail is None
        else:
            assert r.name == "xxx" and r.mail == ("xxx@" + v.split("@", 1)[1] if "@" in v else "xxx")


def test_mask_typos_stop_the_run(spark):
    df = frame(spark, row(1))
    with pytest.raises(ContractError, match="does not have"):
        ingest.mask_pii(df, {"mial": "xxx"})
    with pytest.raises(ContractError, match="unknown mask mode"):
        ingest.mask_pii(df, {"mail": "hash"})


def test_dedup_is_deterministic(spark):
    df = frame(spark, row(1, "a"), row(1, "b"), row(1, "z", at=T0 - dt.timedelta(days=1)), row(2, "c", at=None))
    assert sorted((r.id, r.name) for r in ingest.dedup_latest(df, ["id"], "at").collect()) == [(1, "b"), (2, "c")]


def test_moved_row_is_never_doubled(spark, tmp_path):
    root = str(tmp_path)
    march, april = T0, dt.datetime(2026, 4, 1)
    later = T0 + dt.timedelta(hours=1)
    first = frame(spark, row(1, "a", march), row(2, "b", march), row(3, "c", None), row(4, "d", dt.datetime(2025, 1, 1)))
    assert ingest.sync_table(ORDERS, first, root) == ("orders", "reload", 4)
    delta = frame(
        spark, row(1, "a2", april, later), row(3, "c2", march, later), row(4, "d2", april, later), row(5, "e", None, later),
        row(9, "old", march, T0 - dt.timedelta(days=1)),
    )
    want = [(1, "a2", "2026-04-01"), (2, "b", "2026-03-01"), (3, "c2", "2026-03-01"), (4, "d2", "2026-04-01"), (5, "e", None)]
    for _ in range(2):  # the same delta again changes nothing
        assert ingest.sync_table(ORDERS, delta, root) == ("orders", "merge", 4)
        assert stored(spark, root) == want
    assert "_part=2025-01-01" not in snapshots.current(spark, f"{root}/orders").parts
    assert {r.mail for r in ingest.read_layout(spark, f"{root}/orders").collect()} == {"xxx@b.c"}


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    root = str(tmp_path)
    ingest.sync_table(ORDERS, frame(spark, row(1, day=dt.datetime(2026, 1, 5)), row(2)), root)
    files = lambda: {p.name for p in (tmp_path / "orders" / "_part=2026-01-01").glob("*.parquet")}
    before = files()
    ingest.sync_table(ORDERS, frame(spark, row(2, "x", at=T0 + dt.timedelta(hours=1))), root)
    assert files() == before


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.integers(0, 8), st.text("ab", max_size=2), max_size=6),
    st.lists(st.tuples(st.integers(0, 8), st.text("xy", max_size=2), st.integers(0, 3)), max_size=8),
)
def test_merge_is_idempotent_and_unique(spark, target, delta):
    t = frame(spark, *[row(k, v) for k, v in target.items()])
    d = frame(spark, *[row(k, v, at=T0 + dt.timedelta(hours=h)) for k, v, h in delta])
    merge = lambda base: ingest.merge_upsert(base, d, ["id"], "at")
    once = sorted(tuple(r) for r in merge(t).collect())
    assert once == sorted(tuple(r) for r in merge(merge(t)).collect())
    want = dict(target)
    for k, v, _ in sorted(delta, key=lambda x: (x[2], x[1])):
        want[k] = v
    assert {r[0]: r[3] for r in once} == want and len(once) == len(want)


def test_reload_replaces_dedups_and_refuses_empty(spark, tmp_path):
    path = str(tmp_path / "orders")
    ingest.full_reload(frame(spark, row(1), row(1, "z"), row(7, day=dt.datetime(2025, 1, 1))), ORDERS, path)
    assert ingest.full_reload(frame(spark, row(2)), ORDERS, path) == 1
    assert [r.id for r in ingest.read_layout(spark, path).collect()] == [2]
    with pytest.raises(ContractError, match="empty"):
        ingest.full_reload(frame(spark, row(2)).where("false"), ORDERS, path)
    assert ingest.full_reload(frame(spark, row(2)).where("false"), ORDERS, path, allow_empty=True) == 0
    later = frame(spark, row(3))
    assert ingest.sync_table(ORDERS, later, str(tmp_path)) == ("orders", "merge", 1), "an emptied table fills again"


def test_hot_day_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id", "TIMESTAMP '2026-03-10' AS day", "TIMESTAMP '2026-03-10' AS at", "'n' AS name", "'m' AS mail")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ingest.write_layout(df, ORDERS, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "t" / "_part=2026-03-01").glob("*.parquet"))) > 4


def test_replace_days_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "d")
    make = lambda rows: spark.createDataFrame(rows, "data_date date, n int")
    d1, d2 = dt.date(2026, 3, 1), dt.date(2026, 3, 2)
    ingest.replace_days(make([(d1, 1), (d2, 2)]), path)
    for _ in range(2):
        ingest.replace_days(make([(d2, 5), (d2, 6)]), path)
        assert sorted((r.data_date, r.n) for r in spark.read.parquet(path).collect()) == [(d1, 1), (d2, 5), (d2, 6)]


def test_mode_is_chosen_before_any_mark(spark, tmp_path):
    root = str(tmp_path)
    no_mark = TableContract("orders", key=("id",))
    no_key = TableContract("plain", watermark="at")
    for n in (2, 1):  # the second run must reload, not fail on a missing mark
        df = frame(spark, *[row(i) for i in range(n)])
        assert ingest.sync_table(no_mark, df, root) == ("orders", "reload", n)
        assert ingest.sync_table(no_key, df, root) == ("plain", "reload", n)


def test_one_failure_does_not_stop_the_others(spark, tmp_path):
    df = frame(spark, row(1))
    bad = TableContract("bad", key=("id",), mask={"mial": "xxx"})
    got = ingest.sync_all([(bad, df), (ORDERS, df)], str(tmp_path)).collect()
    assert [(r.target, r.mode, r.rows) for r in got] == [("bad", None, None), ("orders", "reload", 1)]
    assert "mial" in got[0].error


def test_registry_file(spark, tmp_path):
    text = json.dumps(
        {"tables": [
            {"target": "a", "db": "d", "schema": "s", "table": "t", "watermark": "at", "partition_granularity": "MONTH",
             "chunk_by": "id", "chunk_size": 100, "pelny_reload": True, "prog_wieku_dni": 9999, "mask": {"m": "xxx"}},
            {"target": "b", "watermark": None},
        ]}
    )
    a, b = load_registry(text, {"a": ["id"]})
    assert (a.source, a.granularity, a.full_reload, a.max_age_days, a.key) == ("d.s.t", "MONTH", True, 9999, ("id",))
    assert (b.max_age_days, b.key) == (2, ())
    assert registry_frame(spark, [a, b]).count() == 2
    published = ingest.registry_publish(spark, [a, b], str(tmp_path / "r"), written_at=T0)
    assert {(r.target, r.max_age_days, r.written_at) for r in published.collect()} == {("a", 9999, T0), ("b", 2, T0)}
    options = jdbc_options(a, "jdbc:x", mark=T0, bounds=(1, 250), columns=["id", "at"])
    assert options["dbtable"] == "(SELECT id, at FROM d.s.t WHERE at >= '2026-03-10 00:00:00') src"
    assert (options["numPartitions"], options["upperBound"], options["fetchsize"]) == ("3", "251", "20000")


def test_ndjson_and_date_shards(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id": 1, "price": "1.10"}\n{"id": 2}\n')
    got = read_ndjson(spark, str(tmp_path / "x.json"), "id bigint, price decimal(18,4)").collect()
    assert [(r.id, None if r.price is None else str(r.price)) for r in got] == [(1, "1.1000"), (2, None)]
    days = [(i, dt.date(2026, 3, i)) for i in range(1, 6)]
    spark.createDataFrame(days, "id int, event_date date").write.partitionBy("event_date").parquet(str(tmp_path / "ev"))
    shards = read_date_shards(spark, str(tmp_path / "ev"), "id int, event_date date", "2026-03-02", "2026-03-03")
    assert sorted(r.id for r in shards.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(event_date" in shards._jdf.queryExecution().toString()


def test_stream_merges_what_arrives(spark, tmp_path):
    root, landing = str(tmp_path / "root"), str(tmp_path / "landing")
    run = lambda: stream_sync(
        spark.readStream.schema(SCHEMA).parquet(landing), ORDERS, root, checkpoint=str(tmp_path / "cp")
    ).awaitTermination()
    frame(spark, row(1, "a"), row(2, "b")).write.parquet(landing)
    run()
    frame(spark, row(2, "b2", at=T0 + dt.timedelta(hours=1)), row(3, "c")).write.mode("append").parquet(landing)
    run()
    run()
    assert [(k, n) for k, n, _ in stored(spark, root)] == [(1, "a"), (2, "b2"), (3, "c")]


def test_windows_between_sparse_and_extreme_keys(spark):
    ids = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,), (None,)], "id bigint")
    got = [tuple(r) for r in ingest.key_chunks(ids, "id", size=2**61).orderBy("chunk").collect()]
    assert [(r[0], r[3]) for r in got] == [(i, int(i in (0, 4, 7))) for i in range(8)]
    assert got[0][1:3] == (-(2**63), -(2**63) + 2**61 - 1) and got[7][2] == 2**63 - 1
    wide = spark.createDataFrame([(7,), (7 + 20_000_000,)], "id bigint")
    found = ingest.key_chunks(wide, "id", size=10)
    assert found.agg(F.count("*"), F.sum("rows"), F.max("last_key"), F.countDistinct("chunk")).first()[:] == (
        2_000_001, 2, 7 + 20_000_009, 2_000_001,
    )


COLUMNS_OF_SOURCE = {
    "id": "bigint", "mail": "nvarchar(200)", "name": "nvarchar(50)", "sum": "money", "at": "datetime2(7)", "note]s": "varchar(10)",
    "photo": "varbinary(max)", "secret": "nvarchar(9)", "guid": "uniqueidentifier",
}


def test_source_is_asked_for_stored_and_masked_columns_only():
    contract = TableContract(
        "t", "shop.dbo.t", ("id",), "at", exclude=("secret",), mask={"mail": "email_domain", "name": "xxx"}, chunk_by="id", chunk_size=100
    )
    select = source_select(contract, COLUMNS_OF_SOURCE)
    assert select.text == (
        "[id], CASE WHEN CHARINDEX('@', [mail]) > 0 THEN STUFF([mail], 1, CHARINDEX('@', [mail]) - 1, 'xxx') "
        "WHEN [mail] IS NOT NULL THEN 'xxx' END AS [mail], CASE WHEN [name] IS NOT NULL THEN 'xxx' END AS [name], "
        "[sum], [at], [note]]s], [guid]"
    )
    assert select.types == {
        "id": "bigint", "mail": "string", "name": "string", "sum": "decimal(38,9)", "at": "timestamp", "note]s": "string", "guid": "string",
    }
    assert select.dropped == {"photo": "type varbinary is not stored", "secret": "excluded"}
    options = jdbc_options(contract, "jdbc:x", mark=T0, bounds=(1, 250), select=select)
    assert options["dbtable"].startswith(f"(SELECT {select.text} FROM shop.dbo.t WHERE at >= '") and options["numPartitions"] == "3"
    assert "secret" not in options["dbtable"] and "`sum` decimal(38,9)" in options["customSchema"]


def test_a_typo_in_the_contract_stops_the_pull():
    for wrong in ({"exclude": ("secrte",)}, {"mask": {"mial": "xxx"}}, {"mask": {"mail": "half"}}, {"key": ("di",)}):
        with pytest.raises(ContractError):
            source_select(TableContract("t", "s", **wrong), COLUMNS_OF_SOURCE)
    with pytest.raises(ContractError):
        jdbc_options(TableContract("t", "s", mask={"mail": "xxx"}), "jdbc:x")


def test_summary_names_columns_that_are_not_stored(spark, tmp_path):
    df = spark.sql("SELECT 1L AS id, array(1) AS list, binary('x') AS raw, 'a' AS secret")
    done = ingest.sync_all([(TableContract("t", key=("id",), exclude=("secret",)), df), (TableContract("u", exclude=("x",)), df)], str(tmp_path))
    got = {r.target: r for r in done.collect()}
    assert got["t"].dropped == {"list": "type array<int> is not stored", "raw": "type binary is not stored", "secret": "excluded"}
    assert got["t"].rows == 1 and "no such column: x" in got["u"].error
    assert ingest.read_layout(spark, f"{tmp_path}/t").columns == ["id", ingest.PART]


def test_a_table_without_key_or_partition_is_dealt_to_many_tasks(spark):
    rows = spark.range(0, 40_000, 1, 4).select("id", F.expr("uuid()").alias("name"), F.expr("map(1, id)").alias("more"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        dealt = ingest.laid_out(rows, TableContract("lines")).groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in dealt.collect()]
    finally:
        spark.conf.set(setting, "true")
    assert sum(sizes) == 40_000 and max(sizes) < 20_000
