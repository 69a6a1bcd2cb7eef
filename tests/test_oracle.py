"""Every registered query against its SQL on the same files."""

from __future__ import annotations

import os
import re

import pytest
from compare import differences, duck

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The training-data queries have tests of their own.
OTHERS = re.compile(r"op\d+_|pipeline$")
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if not OTHERS.match(name)}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, ORACLE[name]) == []


def test_every_query_has_sql():
    assert {name for name in entry.queries() if not OTHERS.match(name)} == set(ORACLE)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["cause", "cause_label", "orders", "loss", "avg_loss", "worst_loss", "markets"]
    worst = {r.cause: r for r in df.collect()}[1]
    assert (worst.orders, worst.loss, worst.worst_loss) == (44, -2210615.02, -168913.88)
