"""Reads of already conformed records, by format or with fallbacks."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

PROCESSED_SCHEMA = T.StructType([
    T.StructField("violation_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("violation_type", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("fine_amount", T.DoubleType()),
    T.StructField("vehicle_type", T.StringType()),
    T.StructField("officer_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("is_peak", T.BooleanType()),
    T.StructField("severity", T.StringType()),
    T.StructField("risk_score", T.DoubleType()),
])


_BAD = "__unreadable"


def _format(path, fmt):
    return fmt or ("csv" if str(path).rstrip("/").endswith(".csv") else "parquet")


def _csv(spark, path, schema):
    """Typed CSV rows; the text of a malformed one is kept in a column."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(T.StructType([*schema, T.StructField(_BAD, T.StringType())])).option("header", True).option(
        "enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).option(
        "nullValue", "").csv(path)


def read_records(spark: SparkSession, path, fmt=None, schema=PROCESSED_SCHEMA) -> DataFrame:
    """Processed records. The format follows the path unless given; CSV is read
    under the declared schema, and its malformed rows are in
    :func:`rejected_records`."""
    if _format(path, fmt) == "csv":
        return _csv(spark, path, schema).where(F.col(_BAD).isNull()).drop(_BAD)
    return spark.read.format(_format(path, fmt)).load(path)


def rejected_records(spark: SparkSession, path, fmt=None, schema=PROCESSED_SCHEMA) -> DataFrame:
    """The malformed rows that :func:`read_records` leaves out, as text; none but in CSV."""
    if _format(path, fmt) == "csv":
        rows = _csv(spark, path, schema)
        # Spark refuses a read of the text column alone, so the others are read along.
        read_all = F.hash(*[c for c in rows.columns if c != _BAD]) >= F.lit(-2**31)
        return rows.where(F.col(_BAD).isNotNull() & read_all).select(F.col(_BAD).alias("text"), F.input_file_name().alias("source_file"))
    return spark.createDataFrame([], "text string, source_file string")


def read_first(spark: SparkSession, table=None, path=None, rows=None) -> DataFrame:
    """The warehouse table if it exists, else the file.

    A source that is named and missing is an error when there is no other; an
    empty one is an answer. ``rows`` caps a preview; without it all is read.
    """
    if table is not None and (path is None or spark.catalog.tableExists(table)):
        df = spark.table(table)
    elif path is not None:
        df = read_records(spark, path)
    else:
        raise ValueError("name a table or a path")
    return df if rows is None else df.limit(rows)
