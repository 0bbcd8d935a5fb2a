"""Session settings, and the shared folder that staged tables go to."""

import functools
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10mb",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Building a plan asks the JVM once per column instead of three times.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(app="kerbside", master=None, shuffle_partitions=None, **extra):
    """A configured session.

    Shuffle partitions are left to the cluster unless given: AQE merges small
    ones, so a high setting is the safe side at scale.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark, values):
    """Settings of the session while the block runs."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark):
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a folder of its
    own. A cluster without it is an error, never a machine-local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


@functools.cache
def _local_dir():
    return tempfile.mkdtemp(prefix="kerbside-")


def _own_dir(spark):
    return f"{shared_dir(spark).rstrip('/')}/kerbside/{spark.sparkContext.applicationId}"


def shared_path(spark, label):
    """A fresh path below this application's part of the shared folder."""
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark, path) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def names_in(spark, path) -> list:
    """Names of what is directly in a folder."""
    fs, target = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)]


def drop_stages(spark) -> bool:
    """Delete all that this application staged; call it when results are out."""
    fs, target = _file_system(spark, _own_dir(spark))
    return fs.delete(target, True)


def write_stage(df: DataFrame, label="stage") -> str:
    """Write ``df`` as a parquet table in the shared folder; its path."""
    path = shared_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return path


def stage(df: DataFrame, label="stage") -> DataFrame:
    """Cut the lineage: write ``df`` as a parquet table and read it back.

    Unlike ``checkpoint()`` the table keeps column pruning and filter
    pushdown, so later passes read only the columns that they use. The table
    survives the loss of any executor.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_stage(df, label))
