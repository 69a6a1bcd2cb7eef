from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.functions.quantiles import exact_quantiles


def disc(values, p):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(Decimal(str(p)) * len(ordered))) - 1]


def cont(values):
    ordered = sorted(values)
    n = len(ordered)
    return (ordered[(n - 1) // 2] + ordered[n // 2]) / 2


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    rows = [("hot", rng.randint(-10**6, 10**6)) for _ in range(30_001)]
    rows += [("ties", rng.choice([1, 1, 1, 5, 9])) for _ in range(500)]
    rows += [(None, v) for v in (4, 2, 8, 6)]
    rows += [("one", 3), ("nothing", None)]
    return rows


def groups(data):
    out = {}
    for k, v in data:
        if v is not None:
            out.setdefault(k, []).append(v)
    return out


def test_discrete_quantiles_are_exact(spark, data):
    df = spark.createDataFrame(data, "k string, v bigint").repartition(8)
    probs = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p99": 0.99}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    expected = groups(data)
    assert set(got) == set(expected)
    for k, values in expected.items():
        for name, p in probs.items():
            assert got[k][name] == disc(values, p), (k, name)


def test_median_interpolates(spark, data):
    df = spark.createDataFrame(data, "k string, v bigint").withColumn("v", F.col("v").cast("decimal(18,4)"))
    got = {r.k: float(r.m) for r in exact_quantiles(df, ["k"], "v", {"m": 0.5}, interpolate=True).collect()}
    assert got == {k: cont(v) for k, v in groups(data).items()}


def test_counted_input_gives_the_same(spark, data):
    df = spark.createDataFrame(data, "k string, v bigint")
    counted = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    probs = {"p50": 0.5, "p90": 0.9}
    plain = {tuple(r) for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    assert plain == {tuple(r) for r in exact_quantiles(counted, ["k"], "v", probs, counted_by="n").collect()}


def test_no_keys(spark):
    df = spark.range(1, 102).withColumnRenamed("id", "v")
    assert exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == 51


def test_interpolation_needs_the_median(spark):
    with pytest.raises(ValueError):
        exact_quantiles(spark.range(3), [], "id", {"p": 0.9}, interpolate=True)


def test_ranks_of_very_many_distinct_values(spark, monkeypatch):
    """Cells split the bracket, whatever the values' kind and spread."""
    from orderlens.functions import quantiles

    monkeypatch.setattr(quantiles, "MARGIN", 0.2)
    monkeypatch.setattr(quantiles, "CELLS", 7)
    rng = random.Random(3)
    for kind, make in (
        ("double", lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300)),
        ("decimal(18,4)", lambda: Decimal(rng.randint(-(10**9), 10**9)) / 10_000),
        ("bigint", lambda: rng.choice([0, 0, 0, rng.randint(-5, 5), rng.randint(-(2**62), 2**62)])),
    ):
        rows = [("a" if i % 3 else None, make()) for i in range(3000)]
        frame = spark.createDataFrame(rows, f"k string, v {kind}")
        probs = {"p1": 0.01, "p10": 0.1, "half": 0.5, "p60": 0.6, "p99": 0.99}
        found = {r.k: r for r in quantiles.exact_quantiles(frame, ["k"], "v", probs).collect()}
        for key in ("a", None):
            values = [v for k, v in rows if k == key]
            assert [found[key][p] for p in probs] == [disc(values, p) for p in probs.values()], kind


def test_no_task_ranks_a_whole_group(spark):
    frame = spark.range(200_000).selectExpr("'hot' AS k", "xxhash64(id) AS v")
    plan = exact_quantiles(frame, ["k"], "v", {"half": 0.5})._jdf.queryExecution().executedPlan().toString()
    ranking = [line for line in plan.splitlines() if "Window" in line and "_v" in line]
    assert ranking and all("_cell" in line for line in ranking)
