"""Log-shaped data: envelopes, partitions, offsets, lag, batches."""

from pyspark.sql import DataFrame, functions as F

from kerbside import contract as C
from kerbside.functions import columns as X
from kerbside.functions.ordered import SLAB_ROWS, attach, number_rows


def envelope(df: DataFrame, key="zone", topic=C.TOPIC, columns=None) -> DataFrame:
    """Rows as keyed JSON messages, ready for a Kafka write."""
    columns = columns or df.columns
    return df.select(
        F.lit(topic).alias("topic"),
        F.coalesce(F.col(key), F.lit("unknown")).alias("key"),
        F.to_json(F.struct(*columns)).alias("value"),
    )


def with_partition(df: DataFrame, key="zone", n=C.PARTITIONS) -> DataFrame:
    """One key always goes to one partition."""
    return df.withColumn("partition", X.log_partition(F.coalesce(F.col(key), F.lit("unknown")), n))


def with_offset(df: DataFrame, order, slab_rows=SLAB_ROWS) -> DataFrame:
    """Contiguous offsets from 0 in each partition."""
    return number_rows(df, order, "offset", by=["partition"], start=0, slab_rows=slab_rows)


def partition_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("partition").agg(F.count("*").alias("messages"))


def end_offsets(df: DataFrame) -> DataFrame:
    """Next offset of each partition."""
    return df.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """End offset minus committed offset; nothing committed counts as 0."""
    return ends.join(committed, "partition", "left").select(
        "partition", "end_offset",
        F.coalesce("committed", F.lit(0)).cast("long").alias("committed"),
        (F.col("end_offset") - F.coalesce("committed", F.lit(0))).cast("long").alias("lag"),
    )


def fair_batch(df: DataFrame, max_messages, n=C.PARTITIONS, committed: DataFrame | None = None) -> DataFrame:
    """The next batch: an equal share of ``max_messages`` per partition, from
    its committed offset or, without one, from its first.

    Offsets are contiguous, so a range of offsets is a number of messages and
    no partition has to be sorted.
    """
    starts = df.groupBy("partition").agg(F.min("offset").alias("__start"))
    if committed is not None:
        starts = starts.join(committed, "partition", "left").select(
            "partition", F.coalesce("committed", "__start").alias("__start"))
    # The log has ``n`` partitions, hence so many rows.
    return attach(df, starts, ["partition"], rows=n).filter(
        (F.col("offset") >= F.col("__start")) & (F.col("offset") < F.col("__start") + max_messages // n)).drop("__start")


def json_field(df: DataFrame, column, schema, *fields) -> DataFrame:
    """Parse a JSON column and lift its fields to the top level."""
    parsed = df.withColumn("__j", F.from_json(F.col(column), schema))
    return parsed.select(*df.columns, *[F.col(f"__j.{f}").alias(f) for f in fields])
