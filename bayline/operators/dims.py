"""Location dimension, zones and membership of requested ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.params import Settings


def location_dim(spark: SparkSession, s: Settings) -> DataFrame:
    """All spots ``row + col`` (rows ``s.rows``, columns 1..``s.n_cols``),
    with their row-major index and zone. Zones are ``n_zones`` even slices of
    the index, the remainder going to the last zone."""
    n_rows, n_cols = len(s.rows), s.n_cols
    per_zone = max(s.n_locations // max(s.n_zones, 1), 1)
    # a rows x cols grid generated in parallel: one range row per spot
    grid = spark.range(0, n_rows * n_cols, numPartitions=max(1, min(n_rows * n_cols // 100_000, 1000)))
    r = (F.col("id") / n_cols).cast("long")
    c = (F.col("id") % n_cols + 1).cast("long")
    letter = F.substr(F.lit(s.rows), (r + 1).cast("int"), F.lit(1))
    return grid.select(
        F.concat(letter, c.cast("string")).alias("location"),
        letter.alias("row"),
        c.alias("col"),
        F.col("id").cast("long").alias("idx"),
        F.least(F.floor(F.col("id") / per_zone), F.lit(s.n_zones - 1)).cast("long").alias("zone"),
    )


def dim_for_join(dim: DataFrame, s: Settings) -> DataFrame:
    """Broadcast the dimension only when its size, known from the settings,
    is under the limit; otherwise leave the choice to the planner."""
    return F.broadcast(dim) if s.n_locations <= s.broadcast_max_rows else dim


def valid_locations(requests: DataFrame, dim: DataFrame, s: Settings,
                    col: str = "location_id") -> DataFrame:
    """Each distinct requested id, upper-cased, with ``valid`` = it names a
    spot of the dimension."""
    req = requests.select(F.col(col).alias("location_id")).distinct() \
        .withColumn("location", F.upper(F.col("location_id")))
    known = dim_for_join(dim.select("location").withColumn("valid", F.lit(True)), s)
    return (req.join(known, "location", "left")
            .select("location_id", "location",
                    F.coalesce(F.col("valid"), F.lit(False)).alias("valid")))
