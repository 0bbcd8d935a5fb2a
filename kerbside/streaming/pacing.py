"""Admission to a stream at a rate that follows its backlog."""

from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.session import exists


@dataclass(frozen=True)
class Pace:
    """Files per trigger: one part in ``share`` of what is waiting, rounded up to ``unit``, within bounds."""

    least: int = 1
    most: int = 1000
    share: int = 4
    unit: int = 1

    def cap(self, waiting: int) -> int:
        part = -(-waiting // (self.share * self.unit)) * self.unit
        return max(self.least, min(self.most, part))


class _NewPace(Exception):
    pass


class PacedRun:
    """Runs ``handle(rows, batch_id)`` over a folder's files, few at a time when few are waiting, more when many are.

    ``stream_of(cap)`` is the stream with at most ``cap`` files per trigger. A
    file stream has one cap for its whole run, so a new pace needs a restart:
    the batch at whose end the backlog asks for another cap is not committed,
    comes again with the same files after the restart, and is handled again.
    ``handle`` must be idempotent by batch id. What each batch took is written
    by batch id, too, and backlogs are counted by Spark from a listing.
    """

    def __init__(self, stream_of, folder, handle, path, pace=Pace(), every="30 seconds"):
        self.stream_of, self.folder, self.handle, self.path, self.pace, self.every = stream_of, folder, handle, path, pace, every
        self.cap, self.wanted, self.asked_at = None, None, None

    def waiting(self, spark: SparkSession) -> DataFrame:
        """``path`` and ``length`` of the files that no batch has taken."""
        # Listed, not read: only the content column would open a file.
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.folder).select(_plain("path").alias("file"), "length")
        taken = f"{self.path}/taken"
        return files.join(spark.read.parquet(taken).select("file"), "file", "left_anti") if exists(spark, taken) else files

    def _batch(self, rows: DataFrame, batch_id: int):
        spark = rows.sparkSession
        self.handle(rows.drop("__file"), batch_id)
        took = rows.groupBy(_plain("__file").alias("file")).agg(F.count("*").alias("rows"))
        took.write.mode("overwrite").parquet(f"{self.path}/taken/batch_id={batch_id}")
        left, size = self.waiting(spark).agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        log = spark.range(1).select(F.lit(self.cap).cast("long").alias("cap"), F.lit(left).cast("long").alias("waiting_files"), F.lit(size).cast("long").alias("waiting_bytes"))
        # A replay keeps the cap that the batch was planned under: the old one.
        if self.asked_at != batch_id:
            log.write.mode("overwrite").parquet(f"{self.path}/log/batch_id={batch_id}")
            wanted = self.pace.cap(left)
            if left and wanted != self.cap:
                self.wanted, self.asked_at = wanted, batch_id
                raise _NewPace

    def run(self, spark: SparkSession) -> int:
        """Take all there is under a processing-time trigger; the number of restarts."""
        restarts = 0
        self.wanted = self.pace.cap(self.waiting(spark).count())
        while True:
            self.cap, self.wanted = self.wanted, None
            stream = self.stream_of(self.cap).select("*", F.col("_metadata.file_path").alias("__file"))
            query = stream.writeStream.foreachBatch(self._batch).option("checkpointLocation", f"{self.path}/offsets").trigger(
                processingTime=self.every).start()
            try:
                query.processAllAvailable()
                return restarts
            except StreamingQueryException:
                if self.wanted is None:
                    raise
                restarts += 1
            finally:
                query.stop()

    def read(self, spark: SparkSession) -> DataFrame:
        """Per micro-batch: ``cap``, files and rows taken, and what was waiting when it was done."""
        took = spark.read.parquet(f"{self.path}/taken").groupBy("batch_id").agg(
            F.count("*").alias("taken_files"), F.sum("rows").alias("taken_rows"))
        return spark.read.parquet(f"{self.path}/log").join(took, "batch_id")


def _plain(path):
    """A path without its scheme, which listings and rows may spell differently."""
    return F.regexp_replace(path, "^[a-z0-9]+:/*", "/")
