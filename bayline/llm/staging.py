"""Intermediate tables in the cluster's shared folder.

Iterative jobs cut their lineage by writing a table below the folder named in
``spark.checkpoint.dir`` and reading it back: a lost executor loses nothing,
and no step is computed twice. The folder may be emptied once a query's result
has been written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from bayline.plans.runtime import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back (schema kept)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def small_batches(df: DataFrame, n_bytes: int = 8 << 20) -> DataFrame:
    """``df``, its session sending rows to Python in Arrow batches of about
    ``n_bytes``: a batch of long texts then fits in a task's memory. A limit
    that is lower already stays; results don't depend on it."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", conf.get(key).strip().lower()).groups()
    if int(number) << 10 * " kmgt".index(unit or " ") > n_bytes:
        conf.set(key, str(n_bytes))
    return df


@contextmanager
def within_small_batches(spark: SparkSession, n_bytes: int = 8 << 20) -> Iterator[None]:
    """Jobs run inside send rows to Python in Arrow batches of about ``n_bytes``;
    the session's own setting is put back at the end."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    small_batches(spark.range(0), n_bytes)
    try:
        yield
    finally:
        spark.conf.set(key, before)
