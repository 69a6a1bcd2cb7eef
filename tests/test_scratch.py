from __future__ import annotations

import pytest

from orderlens.sources.scratch import shared_folder, staged


class Session:
    """A cluster session with the given launch settings."""

    def __init__(self, **settings):
        self.conf = type("Conf", (), {"get": lambda _, key, default=None: settings.get(key, default)})()
        self.sparkContext = type("Context", (), {"master": "spark://host:7077"})()


def test_folder_comes_from_the_session():
    session = Session(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = shared_folder(session, "x"), shared_folder(session, "x")
    assert first.startswith("hdfs:///shared/orderlens/x-") and first != second


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(), "x")


def test_staged_rows_are_read_back_from_files(spark):
    df = staged(spark.range(5).selectExpr("id", "cast(id AS decimal(18,4)) AS amount"), "t")
    assert df.dtypes == [("id", "bigint"), ("amount", "decimal(18,4)")]
    assert df.count() == 5 and all(f.endswith(".parquet") for f in df.inputFiles())
