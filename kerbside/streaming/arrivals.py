"""Rows that arrive in a known order, as files of a folder that a stream reads."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.session import shared_path


def deliver(rows: DataFrame, arrival, path, files=2) -> int:
    """Write ``rows`` in the order of their whole number ``arrival``; the number of arrivals.

    Every arrival becomes the same number of files, so a stream that takes
    ``files`` of them per trigger has one arrival per micro-batch. The file
    source orders by modification time, and arrivals are written one after
    the other. The column itself is not written.
    """
    spark = rows.sparkSession
    kept = shared_path(spark, "arrivals")
    rows.withColumn("__arrival", arrival).write.partitionBy("__arrival").parquet(kept)
    staged = spark.read.parquet(kept)
    known = [r[0] for r in staged.select("__arrival").distinct().orderBy("__arrival").collect()]
    for at in known:
        staged.where(F.col("__arrival") == at).drop("__arrival").repartition(files).write.mode("append").parquet(path)
    written = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").count()
    if written != files * len(known):
        raise ValueError(f"{written} files for {len(known)} arrivals of {files}: an arrival has too few rows")
    return len(known)


def arriving(spark: SparkSession, path, schema, per_trigger=None) -> DataFrame:
    """The folder as a stream, at most ``per_trigger`` files per micro-batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).parquet(path)
