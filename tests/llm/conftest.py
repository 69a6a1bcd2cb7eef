from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import odd_rows  # noqa: E402

from orderlens.llm.common import ship  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns that carry names used inside the operators."""
    frame = spark.createDataFrame(odd_rows(), DOCS).repartition(3)
    extra = {c: "lit" for c in ("key", "name", "size", "start", "block", "m", "s", "n", "row_key", "digest", "bucket", "edits_")}
    return frame.selectExpr("*", *[f"'{v}' as `{c}`" for c, v in extra.items()])


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
