"""A folder every executor can reach, for tables an operation has to write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Only where that is unset and the session is one process, as in local tests, a
    machine-local folder serves; any other session without the setting is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/orderlens/{name}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return tempfile.mkdtemp(prefix=f"orderlens-{name}-")


def removed_at_exit(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For a costly intermediate result that several branches of a plan read: they
    scan the columns they need instead of repeating its joins, and its lineage
    ends at files that outlive any executor.
    """
    path = shared_folder(df.sparkSession, name)
    removed_at_exit(df.sparkSession, path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
