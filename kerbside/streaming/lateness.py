"""What a watermark drops, kept."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside import contract as C


class LateRows:
    """A sink of raw micro-batches that keeps the window rows which an aggregate under the same watermark drops.

    Run it beside the aggregate, over the same source with the same limit per
    trigger. An aggregate judges the rows of a batch by the watermark that the
    batch before ran under, so batch ``n`` is judged by the newest event of
    the batches up to ``n - 2``, less the delay. The newest event of every
    batch is written by batch id, like the late rows; a replayed batch writes
    the same again. Rows without a time belong to no window and are not late.
    """

    def __init__(self, path, time="event_time", late=C.WATERMARK, window=C.WINDOW, slide=C.SLIDE):
        self.path, self.time, self.late, self.window, self.slide = path, time, late, window, slide

    def watermark(self, spark: SparkSession, batch_id: int):
        """The instant that the rows of a batch are judged by; None as long as there is none."""
        if batch_id < 2:
            return None
        marks = spark.read.parquet(f"{self.path}/newest").where(F.col("batch_id") <= batch_id - 2)
        return marks.agg(F.max("newest") - F.expr(f"INTERVAL {self.late}")).first()[0]

    def write_batch(self, rows: DataFrame, batch_id: int):
        spark = rows.sparkSession
        rows.agg(F.max(self.time).alias("newest")).write.mode("overwrite").parquet(f"{self.path}/newest/batch_id={batch_id}")
        mark = self.watermark(spark, batch_id)
        # Window ends are whole minutes, and a driver's timestamp is exact to the microsecond.
        late = F.lit(False) if mark is None else F.col("window.end") <= F.lit(mark)
        windowed = rows.select("*", F.window(self.time, self.window, self.slide).alias("window")).where(late)
        kept = windowed.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rows.columns)
        kept.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/late/batch_id={batch_id}")

    def start(self, stream: DataFrame, checkpoint, every="30 seconds", drain=False):
        writer = stream.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)).start()

    def read(self, spark: SparkSession) -> DataFrame:
        """Late window rows with their ``batch_id``: a row of the source once per window that it came too late for."""
        return spark.read.parquet(f"{self.path}/late")
