"""Raw incident records as a projection of an ``events`` table.

The shape of the records, and the defects planted in them (unparseable dates,
odd spellings, nulls, out-of-range values, repeated rows), are functions of the
event's own columns. One scan gives the whole relation.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.functions import columns as X


def read_table(spark: SparkSession, folder, name) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def incident_columns():
    """Select list over an ``events`` table, batch or streaming."""
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    kind = F.pmod(event, F.lit(10))
    place = F.pmod(user, F.lit(8))
    carrier = F.pmod(user, F.lit(6))
    return [
        event.alias("row_seq"),
        F.concat(F.lit("TRF-"), X.padded(event, 6)).alias("violation_id"),
        F.when(event % 101 == 0, "not-a-date").otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(kind == 0, "Speeding").when(kind == 1, " speeding").when(kind == 2, "RED-LIGHT").when(kind == 3, "DUI")
        .when(kind == 4, "illegal park").when(kind == 5, "Reckless").when(kind == 6, "Mobile Use")
        .when(kind == 7, "No Seatbelt").when(kind == 8, "Jaywalking").when(event % 70 == 9, None)
        .otherwise("Speeding").alias("violation_type"),
        F.when(place == 0, "Downtown").when(place == 1, " highway ").when(place == 2, "SCHOOL")
        .when(place == 3, "School Zone").when(place == 4, "Residential").when(place == 5, "industrial")
        .when(place == 6, "Airport").when(event % 33 == 0, None).otherwise("Downtown").alias("zone"),
        F.when(event % 17 == 0, None).when(event % 97 == 0, -value).otherwise(value).alias("speed_kmh"),
        F.when(event % 20 == 0, None).when(event % 499 == 0, 9000.0)
        .otherwise((F.lit(75) + F.lit(25) * (event % 37)).cast("double")).alias("fine_amount"),
        F.when(carrier == 0, "car").when(carrier == 1, "Truck").when(carrier == 2, "Motorcycle")
        .when(carrier == 3, " bus").when(carrier == 4, "VAN").alias("vehicle_type"),
        F.when(event % 50 != 7, F.concat(F.lit("OFF-"), X.padded(user % 49 + 1, 3)))
        .alias("officer_id"),
        F.when(event % 61 != 0, (F.lit(28400) + event % 500).cast("double") / 1000).alias("latitude"),
        ((F.lit(77000) + user % 400).cast("double") / 1000).alias("longitude"),
    ]


def raw_incidents(spark: SparkSession, folder) -> DataFrame:
    """Every event once, and every fortieth a second time as an exact copy."""
    copies = F.when(F.col("event_id") % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    events = read_table(spark, folder, "events")
    return events.withColumn("__copy", F.explode(copies)).select(*incident_columns())
