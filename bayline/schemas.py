"""Declared schemas; nothing is inferred.

Fixed values: the field names, types and nullability are the wire contract of
the event and session messages and must match it.
"""

from pyspark.sql.types import LongType, StringType, StructField, StructType

# wire format of one camera event (JSON object on the raw stream)
EVENT = StructType([
    StructField("timestamp", StringType(), True),
    StructField("timestamp_unix", LongType(), True),
    StructField("license_plate", StringType(), True),
    StructField("location", StringType(), True),
    StructField("status_code", StringType(), True),
])

# the session row: one per session change (changelog) or per session
SESSION = StructType([
    StructField("license_plate", StringType(), False),
    StructField("location", StringType(), False),
    StructField("start_time", LongType(), True),
    StructField("end_time", LongType(), True),
    StructField("duration", LongType(), True),
    StructField("cost", LongType(), True),
    StructField("status", StringType(), True),
    StructField("last_updated", LongType(), True),
])

KEY = ("license_plate", "location")
