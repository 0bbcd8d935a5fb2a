"""Warehouse tables and run logs."""

from pyspark.sql import DataFrame, Observation, functions as F

# Load modes and what they mean to Spark.
MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def warehouse_types(df: DataFrame) -> DataFrame:
    """Types that any warehouse takes: flags as 0/1, timestamps as text."""
    out = []
    for name, kind in df.dtypes:
        if kind == "boolean":
            out.append(F.col(name).cast("int").alias(name))
        elif kind.startswith("timestamp"):
            out.append(F.col(name).cast("string").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def load_table(df: DataFrame, table, if_exists="replace", path=None, evolve=False) -> int:
    """Write a managed table; the row count comes from the write itself.

    With ``path`` the files go there. With ``evolve`` an append may have other
    columns than the table: new ones are added to it and null in the rows that
    it had, absent ones are null in the new rows, and values take the type
    that the table has (one that does not fit is an error). ``fail`` leaves
    an existing table as it is.
    """
    spark = df.sparkSession
    ready = warehouse_types(df)
    if evolve and if_exists == "append" and spark.catalog.tableExists(table):
        ready = _fitted(spark, ready, table)
    seen = Observation()
    counted = ready.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(MODES[if_exists]).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return seen.get["rows"]


def _fitted(spark, df, table):
    """``df`` in the columns of ``table``, which gets those that it lacks."""
    held = {f.name.lower(): f for f in spark.table(table).schema}
    new = [f for f in df.schema if f.name.lower() not in held]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    given = {f.name.lower() for f in df.schema}
    return df.select(*[(F.col(f"`{f.name}`") if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in spark.table(table).schema])


def load_jdbc(df: DataFrame, url, table, if_exists="replace", batch=10_000, **properties):
    """Write to a database over JDBC; needs its driver on the class path."""
    warehouse_types(df).write.mode(MODES[if_exists]).option("batchsize", batch).jdbc(url, table, properties=properties)


def load_star(tables: dict, prefix="", if_exists="replace") -> dict:
    """Write the star schema's tables; rows written per table."""
    return {name: load_table(table, f"{prefix}{name}", if_exists) for name, table in tables.items()}


class Written:
    """Rows of several writes, each counted while it is written: a log of a run that reads nothing again.

    Watch a frame right before its write. What a failed task has counted is
    not taken, and the tasks of a write do not run again once they are done.
    """

    def __init__(self):
        self._seen = {}

    def watch(self, name, df: DataFrame) -> DataFrame:
        self._seen[name] = Observation()
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("rows"))

    def rows(self, name) -> int:
        """Waits for the first write of the frame; a write without any task has no rows."""
        return self._seen[name].get.get("rows", 0)


def append_record(df: DataFrame, path):
    """Append a small record, such as an alert or a run summary, to a log."""
    df.coalesce(1).write.mode("append").json(path)
