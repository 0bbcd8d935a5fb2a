"""An upsert sink for update-mode aggregates over plain parquet.

Each micro-batch writes its changed rows into a folder of its own, named by
batch id; a replayed batch overwrites the same folder, so delivery is exactly
once. Readers take the newest row per key. Nothing already written is
rewritten until ``compact``.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F


class UpsertTable:
    def __init__(self, path, keys):
        self.path, self.keys = path, list(keys)

    def write_batch(self, changed: DataFrame, batch_id: int):
        # Rebalanced, so that a small batch makes one file, not one per task.
        changed.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def start(self, stream: DataFrame, checkpoint, every="30 seconds", drain=False, name=None):
        """Start the query; ``drain`` processes what is there and stops."""
        writer = stream.writeStream.outputMode("update").foreachBatch(self.write_batch).option(
            "checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)
        return writer.start()

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row of each key."""
        rows = spark.read.parquet(self.path)
        rest = [c for c in rows.columns if c not in self.keys and c != "batch_id"]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("r"))
        return newest.select(*self.keys, *[F.col(f"r.{c}").alias(c) for c in rest])

    def compact(self, spark: SparkSession, path) -> "UpsertTable":
        """The newest rows as a new table with one batch, at ``path``.

        Run it on a stopped query; later batches may go to either table. The
        path is the caller's: staged folders are deleted with the application.
        """
        target = UpsertTable(path, self.keys)
        last = spark.read.parquet(self.path).agg(F.max("batch_id")).first()[0]
        target.write_batch(self.read(spark), last)
        return target


def append_sink(stream: DataFrame, path, checkpoint, every="30 seconds", drain=False, fmt="parquet"):
    """Append-only file sink with a checkpoint."""
    writer = stream.writeStream.outputMode("append").format(fmt).option("path", path).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)).start()


def kafka_sink(stream: DataFrame, options: dict, checkpoint):
    """Append keyed messages to a topic; needs the Kafka connector."""
    return stream.select("key", "value").writeStream.outputMode("append").format("kafka").options(**options).option(
        "checkpointLocation", checkpoint).start()


def console_sink(stream: DataFrame, every="30 seconds"):
    """Print updates, for debugging."""
    return stream.writeStream.outputMode("update").format("console").trigger(processingTime=every).start()


def for_each_batch(stream: DataFrame, handle, checkpoint, drain=False, every="30 seconds"):
    """Call ``handle(df, batch_id)`` per micro-batch, then commit its offsets.

    Delivery is at least once; make ``handle`` idempotent by batch id.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)).start()
