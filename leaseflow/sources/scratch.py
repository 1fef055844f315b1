"""Intermediate results written once to the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from leaseflow.session import checkpoint_root

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """This application's folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/leaseflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name for this application's intermediate results."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside are deleted when each write ends, not when the
    driver happens to collect its garbage; what is written stays."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def store(rows: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """Write an intermediate result as a table and read it back, with its folder."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        rows.write.options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def materialize(rows: DataFrame, name: str, **options: str) -> DataFrame:
    """Write an intermediate result as a table and read it back.

    Used where several consumers would otherwise recompute it. The files cut the
    lineage and survive the loss of executors. ``options`` are those of the writer.
    """
    return store(rows, name, **options)[0]


def _delete(spark: SparkSession, folder: str) -> bool:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(conf).delete(path, True)


def discard(spark: SparkSession, path: str) -> bool:
    """Delete one intermediate result that nothing reads any more."""
    if not path.startswith(f"{scratch_root(spark)}/"):
        raise ValueError(f"{path} is no intermediate result of this application")
    return _delete(spark, path)


def remove_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediate results, once nothing reads them any more."""
    return _delete(spark, scratch_root(spark))
