"""File and block accounting, and tables laid out by later grouping keys."""

from pyspark.sql import DataFrame, functions as F

BLOCK_BYTES = 128 * 1024 * 1024


def block_layout(files: DataFrame, block_bytes=BLOCK_BYTES) -> DataFrame:
    """One row per block of each (path, size_bytes); empty files keep one."""
    size = F.col("size_bytes")
    blocks = F.greatest(F.lit(1), F.ceil(size / F.lit(block_bytes))).cast("int")
    return files.select("path", "size_bytes", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block_no")).select(
        "path", "block_no",
        F.substring(F.md5(F.concat_ws(":", "path", F.col("block_no").cast("string"))), 1, 12).alias("block_id"),
        F.least(F.lit(block_bytes), size - F.col("block_no").cast("long") * F.lit(block_bytes)).cast("long")
        .alias("block_bytes"),
    )


def block_report(files: DataFrame, block_bytes=BLOCK_BYTES) -> DataFrame:
    """Files, bytes and blocks as one row, without listing the blocks."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size_bytes") / F.lit(block_bytes)))
    return files.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum(blocks), F.lit(0)).alias("blocks"),
    )


def bucketed(df: DataFrame, table, keys, buckets, path) -> DataFrame:
    """Write ``df`` as a table in ``buckets`` by ``keys``, sorted by them, and read it.

    Groupings and joins by columns that include the keys then need no
    exchange, with any other table of the same keys and buckets. Each bucket
    is one file and one task, so take keys of many values, and as many buckets
    as the data has partitions: a value that holds a large share of the rows
    is better grouped through a shuffle, after partial sums.
    """
    laid = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    laid.write.bucketBy(buckets, *keys).sortBy(*keys).mode("errorifexists").option("path", path).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)
