"""Generated records: any number of rows, the same for any partitioning."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside import contract as C
from kerbside.functions import columns as X
from kerbside.streaming.events import _fine_for


def synthetic_records(spark: SparkSession, n=100_000, start="2024-01-01", missing=0.05, partitions=None) -> DataFrame:
    """``n`` raw records, five minutes apart, a share of them without a fine."""
    ids = spark.range(1, n + 1, numPartitions=partitions) if partitions else spark.range(1, n + 1)
    k = F.col("id")
    speed = F.when(F.col("violation_type") == C.SPEEDING, X.draw("fast", 5, 80, k)).otherwise(X.draw("slow", 0, 25, k))
    dropped = X.draw("gap", 0, 10_000, k) < int(missing * 10_000)
    return (
        ids.withColumns({
            "violation_type": X.pick("type", C.VIOLATION_TYPES, k),
            "zone": X.pick("zone", C.ZONES, k),
        })
        .withColumn("speed_kmh", speed.cast("double"))
        .select(
            k.alias("row_seq"),
            F.concat(F.lit("TRF-"), X.padded(k, 6)).alias("violation_id"),
            F.timestamp_seconds(F.unix_timestamp(F.lit(start).cast("timestamp")) + (k - 1) * 300).cast("string")
            .alias("timestamp"),
            "violation_type", "zone", "speed_kmh",
            F.when(~dropped, _fine_for(F.col("zone"), X.severity(F.col("violation_type"), F.col("speed_kmh"))))
            .alias("fine_amount"),
            X.pick("vehicle", C.VEHICLES, k).alias("vehicle_type"),
            F.format_string("OFF-%03d", X.draw("officer", 1, 50, k)).alias("officer_id"),
            (X.draw("lat", 28_400_000, 28_900_000, k) / 1e6).alias("latitude"),
            (X.draw("lon", 77_000_000, 77_400_000, k) / 1e6).alias("longitude"),
            F.lit("synthetic_data.csv").alias("source_file"),
            F.lit("synthetic").alias("pipeline_run"),
        )
    )
