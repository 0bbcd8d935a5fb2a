"""CSV folders: mixed headers, mixed encodings, malformed rows.

One text scan profiles every file (its header, and whether it is valid UTF-8).
Files that agree are then read together, so the number of Spark reads depends
on the number of distinct headers, not on the number of files.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kerbside.operators import conform

CORRUPT = "__corrupt"
UTF8, LATIN1 = "UTF-8", "ISO-8859-1"


def profile_files(spark: SparkSession, folder) -> DataFrame:
    """(path, header, latin1) per CSV file. Partial aggregation runs in the
    scan, so one row per file and task is shuffled."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start") == 0).alias("head"),
        F.monotonically_increasing_id().alias("at"),
    )
    return lines.groupBy("path").agg(
        F.min_by("value", F.when(F.col("head"), F.col("at"))).alias("header"),
        F.max(~F.is_valid_utf8("value")).alias("latin1"),
    )


def _field_count(line, sep):
    """Fields of a CSV line: separators outside quotes, plus one."""
    bare = F.regexp_replace(line, '"([^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _read_group(spark, paths, encoding, sep, multiline):
    """Good and rejected rows of files that share a header."""
    def reader():
        return spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option(
            "multiLine", multiline)

    names = reader().csv(paths[0]).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    rows = reader().schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(
        paths).select(
        *[F.col(f"`{n}`") for n in names], CORRUPT,
        F.col("_metadata.file_name").alias("source_file"),
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at")).alias("row_seq"),
    )
    # Short rows are only padded with nulls; too many fields is an error.
    # Spark refuses scans of the corrupt column alone, so the test also reads
    # the data columns; a hash is never below the smallest integer.
    reads_all = F.hash(*[F.col(f"`{n}`") for n in names]) >= F.lit(-2**31)
    excess = F.coalesce((_field_count(F.col(CORRUPT), sep) > len(names)) & reads_all, F.lit(False))
    rejected = rows.filter(excess).select("source_file", F.col(CORRUPT).alias("line"))
    good = rows.filter(~excess).drop(CORRUPT)
    good = conform.drop_empty(good, [f"`{n}`" for n in names])
    return conform.normalise_headers(good), rejected


def read_csv_folder(spark: SparkSession, folder, sep=",", multiline=False):
    """All CSV files of a folder as ``(good, rejected)``.

    Columns are united by canonical name and still text. ``row_seq`` orders
    rows by file name, then by place in the file. ``rejected`` has the file
    and the line of each row with too many fields.
    """
    groups = {}
    # One row per file: no longer than the file listing the driver holds anyway.
    for path, header, latin1 in profile_files(spark, folder).collect():
        if header:
            groups.setdefault((header, bool(latin1)), []).append(path)
    if not groups:
        raise FileNotFoundError(f"no readable CSV files in {folder}")
    parts = [
        _read_group(spark, sorted(paths), LATIN1 if latin1 else UTF8, sep, multiline)
        for (_, latin1), paths in sorted(groups.items())
    ]
    good = conform.union_all(*[g for g, _ in parts])
    return good, reduce(DataFrame.unionByName, [r for _, r in parts])


def ingest(spark: SparkSession, folder, run_at, **kw):
    """CSV folder -> contract columns with provenance; also the rejected rows."""
    good, rejected = read_csv_folder(spark, folder, **kw)
    return good.transform(lambda d: conform.add_provenance(d, run_at)).transform(conform.cast_contract), rejected
