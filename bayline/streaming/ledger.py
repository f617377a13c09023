"""Several sinks fed by one query, each written once a batch.

When a batch fails after some of its sinks have been written, Spark runs it
again for all of them. The ledger holds a mark for each sink and epoch, written
after the sink: a retry leaves out the sinks that are marked and writes only the
others. A sink that overwrites its epoch is so exactly once even if the job dies
between the sink and its mark; one that appends (a topic) may then repeat that
one batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.streaming.epochs import drop_epochs, epoch_path


def is_marked(spark: SparkSession, ledger: str, sink: str, epoch_id: int) -> bool:
    try:
        marks = spark.read.schema("done boolean, epoch_id long").parquet(f"{ledger}/{sink}")
    except AnalysisException:  # no mark yet
        return False
    return not marks.where(F.col("epoch_id") == epoch_id).isEmpty()


def ledgered(ledger: str, keep: int = 10, **sinks):
    """One ``foreachBatch`` function for the named sinks, which are written in
    the order given from one computed batch. The marks of the last ``keep``
    epochs stay; only the newest can be asked for."""
    ledger = ledger.rstrip("/")
    if keep < 1:
        raise ValueError("keep must be 1 or more")

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        due = {name: sink for name, sink in sinks.items() if not is_marked(spark, ledger, name, epoch_id)}
        if not due:
            return
        batch.persist()
        try:
            for name, sink in due.items():
                sink(batch, epoch_id)
                (spark.range(1).select(F.lit(True).alias("done")).coalesce(1)
                 .write.mode("overwrite").parquet(epoch_path(ledger, name, epoch_id)))
                drop_epochs(spark, f"{ledger}/{name}", lambda e: e <= epoch_id - keep)
        finally:
            batch.unpersist()
    return write
