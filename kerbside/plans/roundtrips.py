"""Queries that write a projection of ``events`` to the shared folder and read it back, and stream it in parts."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kerbside.functions.ordered import number_rows
from kerbside.operators import features, impute, layout, windows
from kerbside.session import shared_path
from kerbside.sinks import files, tables as loads
from kerbside.sources import csv_files, logs, manifest, tables
from kerbside.sources.incidents import read_table
from kerbside.streaming import events, jobs, runs
from kerbside.streaming.upsert import UpsertTable

QUERIES, ORACLES = {}, {}


def query(sql):
    def register(fn):
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn
    return register


def _mixed_folder(spark, folder):
    """CSV files of one folder under two headers, in two encodings, some lines with too many fields."""
    rows = read_table(spark, folder, "events").select(F.col("event_id").cast("string").alias("violation_id"), "event_type", "event_id")
    named = F.concat("event_type", F.lit("-é"))
    path = shared_path(spark, "csv")
    plain = rows.where("event_id % 2 = 0").select("violation_id", named.alias("zone"))
    plain.write.option("header", True).csv(path)
    old = rows.where("event_id % 2 = 1 AND event_id % 10 <> 7").select(F.col("violation_id").alias("id"), named.alias("Zone"))
    old.write.mode("append").option("header", True).option("encoding", csv_files.LATIN1).csv(path)
    broken = rows.where("event_id % 10 = 7").select(F.concat_ws(",", "violation_id", "event_type", F.lit("1,2")).alias("violation_id,zone"))
    broken.write.mode("append").option("header", True).option("sep", "|").csv(path)
    return path


@query("""SELECT CAST(event_id AS VARCHAR) AS violation_id, event_type || '-é' AS zone FROM events WHERE event_id % 10 <> 7""")
def csv_ingest(spark, folder):
    good, _ = csv_files.read_csv_folder(spark, _mixed_folder(spark, folder))
    return good.select("violation_id", "zone")


@query("""SELECT CAST(event_id AS VARCHAR) || ',' || event_type || ',1,2' AS line FROM events WHERE event_id % 10 = 7""")
def csv_rejected(spark, folder):
    _, rejected = csv_files.read_csv_folder(spark, _mixed_folder(spark, folder))
    return rejected.select("line")


@query("SELECT event_id, event_type, value FROM events")
def csv_typed(spark, folder):
    """Written as CSV in files of bounded length, read under a schema."""
    path = shared_path(spark, "typed") + ".csv"
    files.export_csv(read_table(spark, folder, "events").select("event_id", "event_type", "value"), path, chunk_rows=1000)
    return tables.read_records(spark, path, schema="event_id long, event_type string, value double")


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type = (SELECT min(event_type) FROM events)")
def parquet_partitioned(spark, folder):
    """Written by event type; one partition is read back, and only that."""
    path = shared_path(spark, "by-type")
    rows = read_table(spark, folder, "events").select("event_id", "user_id", "event_type")
    files.export_partitioned(rows, path, keys=["event_type"])
    first = rows.agg(F.min("event_type")).first()[0]
    return spark.read.parquet(path).where(F.col("event_type") == first).select("event_id", "user_id", "event_type")


@query("""SELECT CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS INTEGER) AS user_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM events""")
def narrow_numbers(spark, folder):
    narrow = impute.narrow_numbers(read_table(spark, folder, "events").select("event_id", "user_id", "value"))
    return narrow.withColumn("value", F.col("value").cast("double"))


@query("""SELECT event_id, coalesce(hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19, false) AS is_peak FROM events""")
def tiers_without_peak(spark, folder):
    """The peak flag is derived where the records have none."""
    rows = read_table(spark, folder, "events").select("event_id", F.hour("ts").alias("hour"), F.lit("Speeding").alias("violation_type"), F.lit("Highway").alias("zone"), F.lit("Low").alias("severity"), F.lit(40.0).alias("speed_kmh"), F.lit(100.0).alias("fine_amount"))
    return features.add_tiers(rows).select("event_id", "is_peak")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders")
def order_numbers(spark, folder):
    """Places of all orders by price, whatever their number."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return number_rows(orders, [F.desc("o_totalprice"), F.col("o_orderkey")], "place", slab_rows=5000).select("o_orderkey", "place")


@query("""SELECT user_id, CASE WHEN count(*) FILTER (event_id % 2 = 1) > 0 THEN count(*) FILTER (event_id % 2 = 1) ELSE count(*) END AS n
FROM events GROUP BY user_id""")
def stream_replay(spark, folder):
    """Two micro-batches, the second delivered twice: the newest row per key counts, once."""
    table = UpsertTable(shared_path(spark, "replay"), ["user_id"])
    rows = read_table(spark, folder, "events")
    for batch, half in ((0, 0), (1, 1), (1, 1)):
        table.write_batch(rows.where(F.col("event_id") % 2 == half).groupBy("user_id").agg(F.count("*").alias("n")), batch)
    return table.read(spark)


@query("SELECT event_id, 'not readable' AS reason FROM events WHERE event_id % 7 = 0")
def stream_rejected(spark, folder):
    """Messages of which every seventh cannot be read."""
    rows = read_table(spark, folder, "events")
    payload = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("string").alias("timestamp")))
    messages = rows.select("event_id", F.when(F.col("event_id") % 7 == 0, "{broken").otherwise(payload).alias("value"))
    return events.rejected_events(messages).select("event_id", "reason")


def _in_two_parts(spark, folder, work):
    """``work(folder of the stream)`` after the first half of the events, by time, and again when the rest has come.

    Each half is written as spread as the table is; a drained run takes all files that came since its checkpoint.
    """
    rows = read_table(spark, folder, "events")
    middle = rows.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).first()[0]
    early = F.unix_micros(F.col("ts").cast("timestamp")) <= F.lit(middle)
    path = shared_path(spark, "halves")
    for part in (early, ~early):
        rows.where(part).write.mode("append").parquet(f"{path}/events.parquet")
        work(path)


def stream_restart(spark, folder):
    """Sliding totals of a query that stops half-way and starts again from its checkpoint."""
    table = UpsertTable(shared_path(spark, "restart"), [*runs.WINDOW_KEYS, "zone"])
    offsets = shared_path(spark, "restart-offsets")
    _in_two_parts(spark, folder, lambda path: table.start(
        jobs.sliding_totals_by_zone(events.event_files(spark, path)), offsets, drain=True).awaitTermination())
    return table.read(spark)


QUERIES["stream_restart"] = stream_restart


# --- logs and manifests -------------------------------------------------------


@query("""SELECT date_trunc('second', ts) AS ts, CASE event_id % 3 WHEN 0 THEN 'ERROR' ELSE 'INFO' END AS level, event_type AS logger,
    'event ' || event_id || ' of ' || user_id || array_to_string(list_transform(range(event_id % 4), lambda k: chr(10) || '  at frame ' || k || ': ' || event_type), '') AS message,
    1 + event_id % 4 AS n_lines FROM events""")
def log_records(spark, folder):
    """Log records of one to four lines, over files read in many splits."""
    events_ = read_table(spark, folder, "events")
    frames = F.transform(F.sequence(F.lit(0).cast("long"), F.col("event_id") % 4), lambda k: F.concat(
        F.lit("\n  at frame "), (k - 1).cast("string"), F.lit(": "), "event_type"))
    head = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(",000 ["), F.when(F.col("event_id") % 3 == 0, "ERROR").otherwise("INFO"),
                    F.lit("] "), "event_type", F.lit(": event "), F.col("event_id").cast("string"), F.lit(" of "), F.col("user_id").cast("string"))
    path = shared_path(spark, "logs")
    lines = events_.select(F.concat(head, F.array_join(F.slice(frames, 2, 3), "")).alias("value"))
    lines.write.text(path)
    # About a hundred splits, whatever the size, until they have the usual one.
    split = min(128 << 20, max(1 << 16, events_.count()))
    return logs.read_records(spark, path, split, glob="*.txt").select("ts", "level", "logger", "message", "n_lines")


@query("""WITH line AS (SELECT event_id // 1000 AS part, event_id, event_id || '|' || user_id || '|' || event_type || '|' || props || chr(10) AS t FROM events),
file AS (SELECT part, string_agg(t, '' ORDER BY event_id) AS t FROM line GROUP BY part),
leaf AS (SELECT part, length(t) AS size_bytes, i, md5(substr(t, 1024 * i + 1, 1024)) AS h FROM file, range(1000) AS r(i) WHERE 1024 * i < length(t))
SELECT part, size_bytes, CASE WHEN count(*) = 1 THEN min(h) ELSE md5(unhex(string_agg(h, '' ORDER BY i))) END AS checksum FROM leaf GROUP BY part, size_bytes""")
def manifest_tree(spark, folder):
    """Tree checksums of files of a thousand events each, read in splits of 16 KB."""
    rows = read_table(spark, folder, "events").select(
        F.expr("event_id div 1000").alias("part"), "event_id", F.concat_ws("|", F.col("event_id").cast("string"), F.col("user_id").cast("string"), "event_type", "props").alias("value"))
    path = shared_path(spark, "files")
    rows.repartition("part").sortWithinPartitions("part", "event_id").drop("event_id").write.partitionBy("part").text(path)
    found = manifest.tree_checksums(spark, path, "*.txt", split_bytes=16 << 10)
    return found.select(F.regexp_extract("path", "part=([0-9]+)", 1).cast("long").alias("part"), "size_bytes", "checksum")


# --- tables -------------------------------------------------------------------


def _fresh(name):
    return f"{name}_{uuid.uuid4().hex}"


@query("""SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type, CASE WHEN event_id % 3 <> 1 THEN user_id END AS user_id, 'append' AS last_mode,
    (SELECT count(*) FROM events WHERE event_id % 3 = event_id_.event_id % 3) AS loaded FROM events AS event_id_""")
def table_load_modes(spark, folder):
    """A table replaced, appended to with fewer and with more columns, and left alone by a load that must not find one."""
    events_ = read_table(spark, folder, "events")
    part = lambda k: events_.where(F.col("event_id") % 3 == k)
    table, path = _fresh("load"), shared_path(spark, "load")
    load = lambda df, mode: loads.load_table(df, table, mode, path, evolve=True)
    load(events_.select("event_id", "value"), "fail")
    counts = {0: load(part(0).select("event_id", "user_id"), "replace")}
    counts[1] = load(part(1).select("event_type", F.col("event_id").cast("int").alias("EVENT_ID")), "append")
    try:
        load(part(2), "fail")
        raise AssertionError("a load that must not find a table has found one")
    except AnalysisException:
        counts[2] = load(part(2).select("user_id", "event_id", "event_type"), "append")
    loaded = F.coalesce(*[F.when(F.col("event_id") % 3 == k, F.lit(n)) for k, n in counts.items()])
    return spark.table(table).select("event_id", "event_type", "user_id", F.lit("append").alias("last_mode"), loaded.alias("loaded"))


@query("""SELECT o_orderkey, o_custkey, count(*) AS n_lines, sum(CAST(l_quantity AS DECIMAL(18, 2)))::DOUBLE AS quantity, max(l_shipdate) AS last_shipped
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey""")
def bucketed_orders(spark, folder):
    """Orders with their lines, from tables in buckets of the order: joined and grouped without an exchange."""
    tables_ = {name: read_table(spark, folder, name) for name in ("orders", "lineitem")}
    buckets = max(4, tables_["lineitem"].count() // 1_000_000)
    orders = layout.bucketed(tables_["orders"].select("o_orderkey", "o_custkey"), _fresh("orders"), ["o_orderkey"], buckets, shared_path(spark, "orders"))
    lines = layout.bucketed(tables_["lineitem"].select("l_orderkey", "l_quantity", "l_shipdate"), _fresh("lines"), ["l_orderkey"], buckets, shared_path(spark, "lines"))
    joined = orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_custkey").agg(
        F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"), F.max("l_shipdate").alias("last_shipped"))


@query("SELECT count(*) AS n_rows, true AS named, 1::BIGINT AS kinds FROM events WHERE event_id % 10 <> 7")
def csv_source_files(spark, folder):
    """Every row names the file it came from: under each name there is one kind of file only."""
    good, _ = csv_files.read_csv_folder(spark, _mixed_folder(spark, folder))
    files_ = good.groupBy("source_file").agg(F.count("*").alias("n"), F.count_distinct(F.col("violation_id").cast("long") % 2).alias("kinds"))
    return files_.agg(F.sum("n").alias("n_rows"), F.min(F.col("source_file").endswith(".csv")).alias("named"), F.max("kinds").alias("kinds"))


@query("""SELECT event_id, 'file' AS origin FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, 'table' FROM events WHERE event_id % 2 = 1""")
def read_chain(spark, folder):
    """The file as long as there is no table, then the table."""
    rows = read_table(spark, folder, "events").select("event_id")
    table, path = _fresh("chain"), shared_path(spark, "chain") + ".parquet"
    files.export_parquet(rows.where("event_id % 2 = 0"), path)
    first = tables.read_first(spark, table, path).withColumn("origin", F.lit("file"))
    loads.load_table(rows.where("event_id % 2 = 1"), table, path=shared_path(spark, "chain-table"))
    return first.unionByName(tables.read_first(spark, table, path).withColumn("origin", F.lit("table")))


@query("SELECT event_id, event_type, value FROM events WHERE event_id % 3 = 1")
def parquet_exported(spark, folder):
    """Exported twice: the second export, in folders of a column, replaces the first."""
    rows, path = read_table(spark, folder, "events").select("event_id", "event_type", "value"), shared_path(spark, "exported")
    files.export_parquet(rows, path)
    files.export_parquet(rows.where("event_id % 3 = 1"), path, partition_by=["event_type"])
    return spark.read.parquet(path).select("event_id", "event_type", "value")


@query("SELECT event_id % 4 AS run, count(*) AS n_rows, max(value) AS most FROM events GROUP BY ALL")
def run_log(spark, folder):
    """A log that four runs have appended a record to."""
    rows, path = read_table(spark, folder, "events"), shared_path(spark, "log")
    for run in range(4):
        own = rows.where(F.col("event_id") % 4 == run)
        loads.append_record(own.agg(F.lit(run).cast("long").alias("run"), F.count("*").alias("n_rows"), F.max("value").alias("most")), path)
    return spark.read.schema("run long, n_rows long, most double").json(path)


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE event_id % 97 = 0 GROUP BY ALL),
grid AS (SELECT unnest(generate_series((SELECT min(hour) FROM h), (SELECT max(hour) FROM h), INTERVAL 1 HOUR)) AS hour)
SELECT g.hour, coalesce(h.n, 0) AS count FROM grid g LEFT JOIN h ON h.hour = g.hour""")
def hour_series(spark, folder):
    """Rows per hour of a thin series, hours without any among them."""
    rows = read_table(spark, folder, "events").where("event_id % 97 = 0").select(F.col("ts").cast("timestamp").alias("timestamp"))
    return windows.filled_hours(windows.hourly_counts(rows, timeline=True))
