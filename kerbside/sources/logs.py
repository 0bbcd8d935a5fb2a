"""Run logs as a table."""

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kerbside.functions.ordered import attach
from kerbside.session import stage

# Fixed value: "<time> [<level>] <logger>: <message>".
LINE = r"^(\S+ \S+) \[(\w+)\] ([^:]+): (.*)$"


def _lines(spark, folder, glob="*.log"):
    return spark.read.option("pathGlobFilter", glob).text(folder)


def _fields(text, fits, message):
    return [
        F.when(fits, F.try_to_timestamp(F.regexp_replace(F.regexp_extract(text, LINE, 1), ",", "."))).alias("ts"),
        F.when(fits, F.regexp_extract(text, LINE, 2)).alias("level"),
        F.when(fits, F.regexp_extract(text, LINE, 3)).alias("logger"),
        message.alias("message"),
    ]


def read_logs(spark: SparkSession, folder) -> DataFrame:
    """(source_file, ts, level, logger, message), a row per line; other lines keep only the message."""
    text = F.col("value")
    fits = text.rlike(LINE)
    return _lines(spark, folder).select(
        F.col("_metadata.file_name").alias("source_file"),
        *_fields(text, fits, F.when(fits, F.regexp_extract(text, LINE, 4)).otherwise(text)))


@contextmanager
def split_size(spark: SparkSession, size):
    """Scans that run inside split files at ``size`` bytes; None leaves the session's setting."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        if size:
            spark.conf.set(key, str(size))
        yield
    finally:
        spark.conf.set(key, before)


def read_records(spark: SparkSession, folder, split_bytes=None, glob="*.log") -> DataFrame:
    """(source_file, line_no, ts, level, logger, message, n_lines), a row per record of one or more lines.

    A line that is no header belongs to the header before it in the same file
    and follows it in ``message`` after a line break. Lines before the first
    header of a file, which belong to none, are records of their own.
    ``line_no`` counts from 1 in the file.

    Files are read in splits. Inside a split the last header is a running
    maximum; across splits it is carried from one to the next, as are the line
    numbers, by a table with one row per split. No file need fit into a task,
    only a record.
    """
    split = F.col("split")
    with split_size(spark, split_bytes):
        # The write fixes the order of lines: ids grow with the position inside a split.
        lines = stage(_lines(spark, folder, glob).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("source_file"),
            F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"),
            F.col("value"), F.col("value").rlike(LINE).alias("header")), "lines")
    inside = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # Positions inside the split, and that of the last header up to each line.
    numbered = lines.withColumn("pos", F.count(F.lit(1)).over(inside)).withColumn("near", F.max(F.when(F.col("header"), F.col("pos"))).over(inside))
    # Ids are contiguous inside a split, so the position of its last header follows from its id.
    splits = lines.groupBy("file", "split").agg(
        F.count("*").alias("n"), (F.max(F.when(F.col("header"), F.col("at"))) - F.min("at") + 1).alias("last"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = stage(splits.select(
        "file", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.last(F.when(F.col("last").isNotNull(), F.struct(split.alias("split"), F.col("last").alias("pos"))), ignorenulls=True)
        .over(earlier).alias("far")), "splits")
    placed = attach(numbered, carried, ["file", "split"], rows=carried.count())
    here = lambda c: F.struct(split.alias("split"), F.col(c).alias("pos"))
    owned = placed.withColumn("owner", F.coalesce(F.when(F.col("near").isNotNull(), here("near")), F.col("far"), here("pos")))
    records = owned.groupBy("file", "owner").agg(
        F.first("source_file").alias("source_file"), F.min(F.col("before") + F.col("pos")).alias("line_no"), F.count("*").alias("n_lines"),
        F.array_sort(F.collect_list(F.struct((F.col("before") + F.col("pos")).alias("no"), "value"))).alias("held"))
    text = F.col("held")[0]["value"]
    fits = text.rlike(LINE)
    first = F.when(fits, F.regexp_extract(text, LINE, 4)).otherwise(text)
    rest = F.transform(F.slice("held", 2, F.greatest(F.size("held") - 1, F.lit(0))), lambda line: line["value"])
    return records.select("source_file", "line_no", *_fields(text, fits, F.array_join(F.concat(F.array(first), rest), "\n")), "n_lines")
