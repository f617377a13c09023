"""Tables kept as folders of epochs, and the manifest that says which count.

A job writes ``<root>/<table>/epoch_id=<n>`` (overwrite, so a retried batch
replaces its own folder) and, last of all, one small row
``<root>/manifest/epoch_id=<n>`` that names the folders a reader needs. The row
is one file, put in place at once by the output committer: a reader sees the
state before a batch or after it, never between. Folders that none of the
newest ``keep`` manifests names are removed, so a reader that opened one has
until ``keep`` more batches are written to finish.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def epoch_path(root: str, table: str, epoch_id: int) -> str:
    return f"{root}/{table}/epoch_id={epoch_id}"


def drop_epochs(spark: SparkSession, path: str, unwanted) -> None:
    """Delete the folders ``path/epoch_id=<k>`` with ``unwanted(k)``, through
    the Hadoop file system of the path (PySpark has no call for it)."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no JVM handle here: keep old epochs
        return
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    if not fs.exists(folder):
        return
    for st in fs.listStatus(folder):
        name = st.getPath().getName()
        if name.startswith("epoch_id=") and unwanted(int(name.split("=", 1)[1])):
            fs.delete(st.getPath(), True)


def manifests(spark: SparkSession, root: str) -> dict[int, dict]:
    """The manifests kept, by epoch (``keep`` small rows)."""
    try:
        rows = spark.read.schema("body string, epoch_id long").parquet(f"{root}/manifest").collect()
    except AnalysisException:  # nothing written yet
        return {}
    return {r.epoch_id: json.loads(r.body) for r in rows}


def write_manifest(spark: SparkSession, root: str, epoch_id: int, body: dict) -> None:
    (spark.range(1).select(F.lit(json.dumps(body)).alias("body")).coalesce(1)
     .write.mode("overwrite").parquet(epoch_path(root, "manifest", epoch_id)))


def read_epochs(spark: SparkSession, root: str, table: str, epochs: list[int], schema) -> DataFrame | None:
    """The rows of the named epochs with their ``epoch_id``, or None."""
    paths = [epoch_path(root, table, e) for e in epochs]
    if not paths:
        return None
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths)
