"""File exports."""

from pyspark.sql import DataFrame, functions as F

from kerbside.operators.analytics import zone_type_severity_summary


def export_parquet(df: DataFrame, path, partition_by=None, mode="overwrite"):
    """Snappy parquet, Hive-partitioned if all the columns are there."""
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by and all(c in df.columns for c in partition_by):
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def export_csv(df: DataFrame, path, chunk_rows=None, mode="overwrite"):
    """CSV with header; ``chunk_rows`` caps the rows per file."""
    writer = df.write.mode(mode).option("header", True)
    if chunk_rows:
        writer = writer.option("maxRecordsPerFile", chunk_rows)
    writer.csv(path)


def export_partitioned(df: DataFrame, path, keys=("zone", "severity"), only_written=False):
    """Partitioned parquet, replacing what was there, or with ``only_written``
    only the partitions that ``df`` has rows for.

    The rebalance hint brings a partition's rows together without putting a
    hot one into one task: AQE splits it into files of the advised size.
    """
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_written else "static")
        .option("compression", "snappy")
        .partitionBy(*keys)
        .parquet(path)
    )


def export_zone_summary(df: DataFrame, path):
    """One CSV file; the result has at most zones x types x severities rows."""
    zone_type_severity_summary(df).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report(lines: DataFrame, path):
    """Report lines in order as one text file; a report is small."""
    lines.orderBy("line_no").coalesce(1).select("text").write.mode("overwrite").text(path)


def send_messages(df: DataFrame, options: dict):
    """Batch-write keyed messages to a topic; needs the Kafka connector."""
    df.select(F.col("key"), F.col("value")).write.format("kafka").options(**options).save()
