"""Queries that deliver ``events`` in arrivals and stream them: late rows, pace, failures, progress."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.plans.oracles import _EVENTS, _with
from kerbside.session import shared_path
from kerbside.sources.incidents import read_table
from kerbside.streaming import jobs, runs
from kerbside.streaming.arrivals import arriving, deliver
from kerbside.streaming.delivery import BatchTable, run_to_end
from kerbside.streaming.lateness import LateRows
from kerbside.streaming.listeners import ProgressTable
from kerbside.streaming.pacing import Pace, PacedRun
from kerbside.streaming.upsert import UpsertTable

QUERIES, ORACLES = {}, {}

FILES = 2
#: Rows that make one more file of an arrival where the number of files is free, and rows that the smallest arrival has for each.
FILE_ROWS, LEAST_ROWS = 50_000, 1000


def _files(rows, arrival):
    """Files of each arrival: micro-batches have as many tasks, so they grow with the rows."""
    sizes = [r[1] for r in rows.groupBy(arrival).count().collect()] or [0]
    return max(FILES, min(max(sizes) // FILE_ROWS, min(sizes) // LEAST_ROWS))


def query(sql):
    def register(fn):
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn
    return register


# --- lateness -----------------------------------------------------------------

# Four stretches of time arrive one by one; every 13th event comes two arrivals late.
_LATE = """arrived AS (
    SELECT s.*, 4 * (epoch_us(event_time) - min(epoch_us(event_time)) OVER ()) // (max(epoch_us(event_time)) OVER () - min(epoch_us(event_time)) OVER () + 1)
        + CASE WHEN CAST(substr(s.event_id, 5) AS BIGINT) % 13 = 0 THEN 2 ELSE 0 END AS batch_id
    FROM stream s
), batch AS (SELECT batch_id, count(*) AS input_rows, max(event_time) AS newest FROM arrived GROUP BY batch_id
), mark AS (
    SELECT b.batch_id, b.input_rows, max(o.newest) - INTERVAL 2 MINUTE AS mark
    FROM batch b LEFT JOIN batch o ON o.batch_id <= b.batch_id - 2 GROUP BY b.batch_id, b.input_rows
), judged AS (
    SELECT a.*, a.s0 - i * INTERVAL 1 MINUTE AS window_start, a.s0 + (5 - i) * INTERVAL 1 MINUTE AS window_end, m.mark
    FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, event_time) AS s0 FROM arrived) a JOIN mark m USING (batch_id), (SELECT unnest(range(5)) AS i)
), dropped AS (SELECT * FROM judged WHERE window_end <= mark)
"""


def _late_sql(rest):
    return _with(_EVENTS).rstrip().rstrip(",") + ",\n" + _LATE + rest


def _late_arrivals(spark: SparkSession, folder):
    rows = runs.event_files_batch(spark, folder)
    low, high = rows.agg(F.min(F.unix_micros("event_time")), F.max(F.unix_micros("event_time"))).first()
    stretch = F.expr(f"4 * (unix_micros(event_time) - {low}L) div {high - low + 1}L")
    late = F.substring("event_id", 5, 20).cast("long") % 13 == 0
    arrival, path = (stretch + F.when(late, 2).otherwise(0)).cast("int"), shared_path(spark, "late-arrivals")
    files = _files(rows, arrival)
    deliver(rows, arrival, path, files)
    return path, files


def _late_stream(spark, folder):
    path, files = _late_arrivals(spark, folder)
    return arriving(spark, path, runs.event_files_batch(spark, folder).schema, files)


@query(_late_sql("""SELECT batch_id, window_start, window_end, zone, count(*) AS late_rows FROM dropped GROUP BY ALL"""))
def stream_late_rows(spark: SparkSession, folder) -> DataFrame:
    """What the sliding totals of six arrivals drop, per micro-batch, window and zone."""
    sink = LateRows(shared_path(spark, "late"))
    runs.drained(sink.start(_late_stream(spark, folder), shared_path(spark, "late-offsets"), drain=True))
    return sink.read(spark).groupBy(F.col("batch_id").cast("long").alias("batch_id"), "window_start", "window_end", "zone").agg(
        F.count("*").alias("late_rows"))


@query(_late_sql("""SELECT window_start, window_end, zone, count(*) AS violation_count,
    CAST(round(CAST(avg(fine_amount) AS DECIMAL(38,12)), 2) AS DOUBLE) AS avg_fine FROM judged WHERE mark IS NULL OR window_end > mark GROUP BY ALL"""))
def stream_on_time(spark: SparkSession, folder) -> DataFrame:
    """The sliding totals of the same arrivals: all but the late rows, across the state that watermarks evict."""
    table = UpsertTable(shared_path(spark, "on-time"), [*runs.WINDOW_KEYS, "zone"])
    totals = jobs.sliding_totals_by_zone(_late_stream(spark, folder))
    runs.drained(table.start(totals, shared_path(spark, "on-time-offsets"), drain=True))
    return table.read(spark)


# --- failures and progress ----------------------------------------------------


class _Crash(RuntimeError):
    pass


def _crashing(handle, calls=None):
    """``handle``, then a failure between its write and the commit, once for every batch."""
    failed = set()

    def run(rows, batch_id):
        handle(rows, batch_id)
        if calls is not None:
            calls.append(batch_id)
        if batch_id not in failed:
            failed.add(batch_id)
            raise _Crash(f"batch {batch_id} is written and not committed")
    return run


@query(_late_sql("""SELECT batch_id, input_rows, coalesce(n, 0) AS dropped_rows FROM mark
LEFT JOIN (SELECT batch_id, count(DISTINCT (window_start, zone)) AS n FROM dropped GROUP BY batch_id) USING (batch_id)"""))
def stream_progress(spark: SparkSession, folder) -> DataFrame:
    """Progress as a table, of windowed totals that fail once in every micro-batch: rows taken and groups dropped as late."""
    table = UpsertTable(shared_path(spark, "progress-totals"), [*runs.WINDOW_KEYS, "zone"])
    totals = jobs.sliding_totals_by_zone(_late_stream(spark, folder))
    name, offsets, handle = f"totals-{spark.sparkContext.applicationId}", shared_path(spark, "progress-offsets"), _crashing(table.write_batch)
    start = lambda: totals.writeStream.queryName(name).outputMode("update").foreachBatch(handle).option(
        "checkpointLocation", offsets).trigger(availableNow=True).start()
    with ProgressTable(spark, shared_path(spark, "progress")) as progress:
        run_to_end(start, spark, offsets)
        progress.wait_for(name, runs.batches(spark, offsets))
    # A last micro-batch without rows only moves the watermark on.
    return progress.read(spark).where(F.col("name") == name).where("input_rows > 0").select("batch_id", "input_rows", "dropped_rows")


@query("""SELECT event_id % 5 AS batch_id, count(*) AS n_rows, sum(event_id)::BIGINT AS id_sum, count(DISTINCT user_id) AS users, 2::BIGINT AS deliveries
FROM events GROUP BY ALL""")
def stream_crash(spark: SparkSession, folder) -> DataFrame:
    """Five arrivals, each of whose deliveries fails once between write and commit: every row is there once."""
    rows = read_table(spark, folder, "events").select("event_id", "user_id")
    path, offsets, arrival = shared_path(spark, "crash-arrivals"), shared_path(spark, "crash-offsets"), (F.col("event_id") % 5).cast("int")
    files = _files(rows, arrival)
    deliver(rows, arrival, path, files)
    table, calls = BatchTable(shared_path(spark, "crash")), []
    handle = _crashing(table.write_batch, calls)
    start = lambda: arriving(spark, path, rows.schema, files).writeStream.foreachBatch(handle).option(
        "checkpointLocation", offsets).trigger(availableNow=True).start()
    run_to_end(start, spark, offsets)
    # One literal per arrival.
    times = F.coalesce(*[F.when(F.col("batch_id") == b, F.lit(calls.count(b)).cast("long")) for b in sorted(set(calls))])
    return table.read(spark).groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.count("*").alias("n_rows"), F.sum("event_id").alias("id_sum"), F.count_distinct("user_id").alias("users"), F.max(times).alias("deliveries"))


# --- pace ---------------------------------------------------------------------

_ARRIVALS = 12

# A quarter of what is waiting, rounded up to whole arrivals.
_PACED = f"""WITH RECURSIVE pace(batch_id, first, n) AS (
    SELECT 0, 0, ({_ARRIVALS} + 3) // 4
    UNION ALL
    SELECT batch_id + 1, first + n, ({_ARRIVALS} - first - n + 3) // 4 FROM pace WHERE first + n < {_ARRIVALS}
)"""


def _paced(spark, folder):
    rows = read_table(spark, folder, "events").select("event_id", "event_type", "value")
    path = shared_path(spark, "paced-arrivals")
    deliver(rows, (F.col("event_id") % _ARRIVALS).cast("int"), path, FILES)
    table = BatchTable(shared_path(spark, "paced"))
    run = PacedRun(lambda cap: arriving(spark, path, rows.schema, cap), path, table.write_batch, shared_path(spark, "pace"),
                   Pace(least=FILES, most=6 * FILES, share=4, unit=FILES), every="0 seconds")
    run.run(spark)
    return run, table


@query(_PACED + f"""SELECT p.batch_id::BIGINT AS batch_id, ({FILES} * n)::BIGINT AS cap, ({FILES} * n)::BIGINT AS taken_files, count(*) AS taken_rows,
    ({FILES} * ({_ARRIVALS} - first - n))::BIGINT AS waiting_files, (SELECT count(*) FROM events WHERE event_id % {_ARRIVALS} >= first + n) AS waiting_rows
FROM pace p JOIN events e ON e.event_id % {_ARRIVALS} >= first AND e.event_id % {_ARRIVALS} < first + n GROUP BY ALL""")
def stream_paced(spark: SparkSession, folder) -> DataFrame:
    """Per micro-batch what was taken under which cap, and what was left waiting."""
    run, table = _paced(spark, folder)
    taken = run.read(spark).select(F.col("batch_id").cast("long").alias("batch_id"), "cap", "taken_files", "taken_rows", "waiting_files")
    rows = taken.select(F.col("batch_id").alias("later"), F.col("taken_rows").alias("__rows"))
    # As many rows as micro-batches.
    waiting = taken.join(rows, F.col("later") > F.col("batch_id"), "left").groupBy(*taken.columns).agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("waiting_rows"))
    return waiting


@query("SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS id_sum, min(value) AS least, max(value) AS most FROM events GROUP BY event_type")
def stream_paced_totals(spark: SparkSession, folder) -> DataFrame:
    """Totals over a paced run: the same as of one batch, whatever the split."""
    _, table = _paced(spark, folder)
    return table.read(spark).groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("id_sum"), F.min("value").alias("least"), F.max("value").alias("most"))
