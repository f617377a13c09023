"""Test adapter: the driver's ``events`` table as raw camera messages.

A known share of rows is damaged by a rule on the table's ``value`` column,
so that the expected decode and quarantine sets follow from the table:

* ``value < 0.5``: the message is not JSON;
* ``0.5 <= value < 1.0``: the plate is missing;
* ``1.0 <= value < 1.5``: the time is missing;
* otherwise the message is whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.sources.fixture import parking_events
from bayline.sources.raw import EVENT_FIELDS

# Thresholds of the damage rule above.
NOT_JSON_BELOW, NO_PLATE_BELOW, NO_TIME_BELOW = 0.5, 1.0, 1.5


def raw_messages(events: DataFrame) -> DataFrame:
    pe = parking_events(events.withColumnRenamed("value", "v"), keep=("v",))
    plate = F.when(F.col("v") < NO_PLATE_BELOW, F.lit(None).cast("string")).otherwise(F.col("license_plate"))
    t = F.when((F.col("v") >= NO_PLATE_BELOW) & (F.col("v") < NO_TIME_BELOW),
               F.lit(None).cast("long")).otherwise(F.col("timestamp_unix"))
    body = F.to_json(F.struct(
        F.col("timestamp"), t.alias("timestamp_unix"), plate.alias("license_plate"),
        F.col("location"), F.col("status_code")))
    value = F.when(F.col("v") < NOT_JSON_BELOW, F.lit("not json")).otherwise(body)
    return pe.select(
        F.col("license_plate").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("raw-data").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
    )


__all__ = ["raw_messages", "EVENT_FIELDS"]
