"""Staged copies in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from candlewick.session import shared_dir


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back. Cuts a lineage that several consumers
    would repeat, survives lost executors, and lets a table be replaced by what was read from it.
    The copy goes when the application ends, as the result may be read until then."""
    path = _staging(df.sparkSession, name)
    folder = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _staging(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/staging/{name}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stage`` for as long as it is needed: the copy is removed at the end, also after an error."""
    spark, path = df.sparkSession, _staging(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders wherever they are, with what is in them."""
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
