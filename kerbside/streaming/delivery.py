"""Micro-batches delivered exactly once, across failures."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from kerbside.session import exists, names_in, settings

#: For a query that starts again and again: a RocksDB store is loaded as it was, without every change since it began made again.
STATE = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false"}


class BatchTable:
    """Rows of micro-batches, one folder per batch id: a batch that is delivered again replaces itself."""

    def __init__(self, path):
        self.path = path

    def write_batch(self, rows: DataFrame, batch_id: int):
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows with their ``batch_id``."""
        return spark.read.parquet(self.path)


def last_commit(spark: SparkSession, checkpoint) -> int:
    """The last batch whose delivery is committed in a checkpoint; -1 before the first."""
    folder = f"{checkpoint}/commits"
    return max((int(n) for n in names_in(spark, folder) if n.isdigit()), default=-1) if exists(spark, folder) else -1


def run_to_end(start, spark: SparkSession, checkpoint, attempts=3) -> int:
    """Handle all that a stream has, starting again from its checkpoint after a failure; the number of restarts.

    ``start()`` starts the query over ``checkpoint``, draining. A handler may
    fail at any point. Between its write and the commit of its batch the batch
    comes again with the same rows, whatever else has arrived, so a sink that
    keys by batch id ends with every row once. A batch that fails ``attempts``
    times is an error; other batches have attempts of their own. Every restart
    loads the state, so ``STATE`` holds for the query.
    """
    restarts, failed, at = 0, 0, None
    while True:
        with settings(spark, STATE):
            query = start()
        try:
            query.awaitTermination()
            return restarts
        except StreamingQueryException:
            done = last_commit(spark, checkpoint)
            failed, at = (failed + 1 if at == done else 1), done
            if failed >= attempts:
                raise
            restarts += 1
        finally:
            query.stop()
