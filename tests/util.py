"""Small frames for hand-worked cases."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

EV = StructType([
    StructField("event_id", LongType()),
    StructField("timestamp_unix", LongType()),
    StructField("license_plate", StringType()),
    StructField("location", StringType()),
    StructField("status_code", StringType()),
])
PLATE, SPOT = "29A-12345", "A1"


def events(spark, rows, plate=PLATE, spot=SPOT, offset=0):
    """rows: (time, status) or (time, status, spot) or (time, status, spot, plate)."""
    out = []
    for i, r in enumerate(rows):
        t, st = r[0] + offset, r[1]
        loc = r[2] if len(r) > 2 else spot
        pl = r[3] if len(r) > 3 else plate
        out.append((i, t, pl, loc, st))
    return spark.createDataFrame(out, EV)


def sessions_list(df, offset=0):
    cols = ["license_plate", "location", "start_time", "end_time", "duration", "cost", "status"]
    return sorted((r[0], r[1], r[2] - offset, r[3] - offset, *r[4:])
                  for r in (tuple(x[c] for c in cols) for x in df.collect()))
