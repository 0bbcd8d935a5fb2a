"""Callbacks on stream progress."""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class BatchListener(StreamingQueryListener):
    """Calls ``on_batch(name, batch_id, rows)`` after every micro-batch."""

    def __init__(self, on_batch):
        self.on_batch = on_batch

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.on_batch(p.name, p.batchId, p.numInputRows)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


class ProgressTable(BatchListener):
    """The progress of all named queries as a table: one row per query and micro-batch, whatever restarts there were.

    A row is written when its batch is done, into a folder of its name and
    batch id, so a batch that a restart repeats replaces its row. Use it as a
    context; the table outlives it.
    """

    SCHEMA = "run_id string, at string, input_rows long, watermark string, state_rows long, dropped_rows long, millis long"

    def __init__(self, spark: SparkSession, path):
        self.spark, self.path = spark, path

    def onQueryProgress(self, event):
        p = event.progress
        if p.name:
            row = (str(p.runId), p.timestamp, p.numInputRows, p.eventTime.get("watermark"),
                   sum(o.numRowsTotal for o in p.stateOperators), sum(o.numRowsDroppedByWatermark for o in p.stateOperators), p.batchDuration)
            done = self.spark.createDataFrame([row], self.SCHEMA)
            done.coalesce(1).write.mode("overwrite").json(f"{self.path}/name={p.name}/batch_id={p.batchId}")

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error):
        self.spark.streams.removeListener(self)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{self.SCHEMA}, name string, batch_id long").json(self.path)

    def wait_for(self, name, batches, seconds=60):
        """Events come after their batch: wait until ``batches`` micro-batches of a query have a row."""
        deadline = time.monotonic() + seconds
        while time.monotonic() < deadline:
            try:
                if self.read(self.spark).where(f"name = '{name}'").count() >= batches:
                    return
            except Exception as error:  # noqa: BLE001 - the folder may not be there, or a row of it be half replaced
                last = error
            time.sleep(0.2)
        raise TimeoutError(f"progress of {name} has not come") from locals().get("last")
