"""Arrivals in order, what watermarks drop, failures between write and commit, pace, progress."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from kerbside.plans import streams
from kerbside.streaming import jobs, runs
from kerbside.streaming.arrivals import arriving, deliver
from kerbside.streaming.delivery import BatchTable, last_commit, run_to_end
from kerbside.streaming.lateness import LateRows
from kerbside.streaming.listeners import ProgressTable
from kerbside.streaming.pacing import Pace, PacedRun
from kerbside.streaming.upsert import UpsertTable

EVENTS = "event_id string, event_time timestamp, zone string, fine_amount double"


def at(spark, rows):
    return spark.createDataFrame(rows, "batch int, event_id string, event_time string, zone string, fine_amount double").withColumn(
        "event_time", F.col("event_time").cast("timestamp"))


def numbered(spark, n=40, arrivals=4):
    return spark.range(n, numPartitions=3).select((F.col("id") % arrivals).cast("int").alias("batch"), F.col("id").alias("event_id"))


def test_arrivals_are_micro_batches(spark, tmp_path):
    rows = numbered(spark)
    assert deliver(rows.drop("batch"), (F.col("event_id") % 4).cast("int"), str(tmp_path / "in"), files=3) == 4
    sink = BatchTable(str(tmp_path / "out"))
    query = arriving(spark, str(tmp_path / "in"), "event_id long", 3).writeStream.foreachBatch(sink.write_batch).option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    runs.drained(query)
    found = sink.read(spark).collect()
    assert len(found) == 40 and all(r.event_id % 4 == r.batch_id for r in found) and last_commit(spark, str(tmp_path / "ck")) == 3


def test_an_arrival_of_too_few_rows_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        deliver(spark.range(3), F.col("id").cast("int"), str(tmp_path / "in"), files=4)


def test_late_rows_are_what_the_aggregate_drops(spark, tmp_path):
    day = "2024-01-01 "
    rows = at(spark, [
        (0, "a0", day + "00:30:00", "x", 1.0), (0, "a1", day + "00:20:00", "x", 1.0),
        (1, "b0", day + "00:31:00", "x", 1.0), (1, "b1", day + "00:00:10", "x", 1.0),  # nothing is late before the third
        (2, "c0", day + "00:00:30", "x", 1.0), (2, "c1", day + "00:27:30", "y", 1.0), (2, "c2", None, "y", 1.0),
        (3, "d0", day + "00:40:00", "x", 1.0), (3, "d1", day + "00:29:00", "x", 1.0), (3, "d2", day + "00:28:59", "x", 1.0)])
    src = str(tmp_path / "in")
    deliver(rows.drop("batch"), F.expr("array_position(array('a', 'b', 'c', 'd'), substring(event_id, 1, 1)) - 1").cast("int"), src, files=2)
    sink = LateRows(str(tmp_path / "late"))
    runs.drained(sink.start(arriving(spark, src, EVENTS, 2), str(tmp_path / "ck1"), drain=True))
    late = sink.read(spark)
    found = {(r.batch_id, r.event_id, str(r.window_end)[11:16]) for r in late.collect()}
    # The third batch is judged by the first's newest event less two minutes, 00:28; the fourth by 00:29.
    want = {(2, "c0", f"00:0{m}") for m in range(1, 6)} | {(2, "c1", "00:28")} | {(3, "d2", "00:29")}
    assert found == want
    table = UpsertTable(str(tmp_path / "out"), ["window_start", "window_end", "zone"])
    query = runs.drained(table.start(jobs.sliding_totals_by_zone(arriving(spark, src, EVENTS, 2)), str(tmp_path / "ck2"), drain=True))
    dropped = {p["batchId"]: sum(op.get("numRowsDroppedByWatermark", 0) for op in p["stateOperators"]) for p in query.recentProgress}
    groups = late.select("batch_id", "window_start", "zone").distinct().groupBy("batch_id").count().collect()
    assert {b: n for b, n in dropped.items() if n} == {r.batch_id: r["count"] for r in groups}
    # A batch that is delivered again changes nothing.
    sink.write_batch(rows.where("batch = 2").drop("batch"), 2)
    assert {(r.batch_id, r.event_id, str(r.window_end)[11:16]) for r in sink.read(spark).collect()} == want


def test_every_row_comes_once_whatever_fails(spark, tmp_path):
    """A failure after the write of every batch, and for one batch in the middle of it, too."""
    rows = numbered(spark)
    deliver(rows.drop("batch"), (F.col("event_id") % 4).cast("int"), str(tmp_path / "in"))
    once, each, calls = BatchTable(str(tmp_path / "once")), [], []

    def handle(df, batch_id):
        calls.append(batch_id)
        if calls.count(2) == 1 and batch_id == 2:
            raise RuntimeError("before anything is written")
        once.write_batch(df, batch_id)
        df.write.mode("append").parquet(str(tmp_path / "naive"))
        if batch_id not in each:
            each.append(batch_id)
            raise RuntimeError("between write and commit")

    ck = str(tmp_path / "ck")
    start = lambda: arriving(spark, str(tmp_path / "in"), "event_id long", 2).writeStream.foreachBatch(handle).option(
        "checkpointLocation", ck).trigger(availableNow=True).start()
    assert run_to_end(start, spark, ck) == 5 and calls == [0, 0, 1, 1, 2, 2, 2, 3, 3]
    found = [r.event_id for r in once.read(spark).collect()]
    assert sorted(found) == list(range(40))
    assert spark.read.parquet(str(tmp_path / "naive")).count() == 80  # without a batch id every row is there twice
    assert run_to_end(start, spark, ck) == 0 and last_commit(spark, ck) == 3


def test_a_batch_that_always_fails_is_an_error(spark, tmp_path):
    numbered(spark).drop("batch").write.parquet(str(tmp_path / "in"))
    tries = []

    def handle(df, batch_id):
        tries.append(batch_id)
        raise RuntimeError("never")

    start = lambda: arriving(spark, str(tmp_path / "in"), "event_id long").writeStream.foreachBatch(handle).option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    with pytest.raises(StreamingQueryException):
        run_to_end(start, spark, str(tmp_path / "ck"), attempts=3)
    assert tries == [0, 0, 0]


def test_pace():
    pace = Pace(least=2, most=10, share=4, unit=2)
    assert [pace.cap(n) for n in (0, 1, 8, 9, 33, 1000)] == [2, 2, 2, 4, 10, 10]


@pytest.mark.parametrize("share,most", [(4, 100), (1, 2), (1, 100)])
def test_paced_runs_agree(spark, tmp_path, share, most):
    """Different paces split differently, keep their caps and give the same rows; what is waiting falls to nothing."""
    rows = numbered(spark, 60, 6)
    src = str(tmp_path / "in")
    deliver(rows.drop("batch"), (F.col("event_id") % 6).cast("int"), src)
    sink = BatchTable(str(tmp_path / "out"))
    run = PacedRun(lambda cap: arriving(spark, src, "event_id long", cap), src, sink.write_batch, str(tmp_path / "pace"),
                   Pace(least=2, most=most, share=share, unit=2), every="0 seconds")
    run.run(spark)
    log = run.read(spark).orderBy("batch_id").collect()
    assert all(r.taken_files <= r.cap for r in log) and sum(r.taken_rows for r in log) == 60
    left = 12
    for r in log:
        left -= r.taken_files
        assert r.waiting_files == left and (r.waiting_bytes > 0) == (left > 0)
    assert len(log) == {4: 5, 1: 6 if most == 2 else 1}[share] and left == 0
    assert sorted(r.event_id for r in sink.read(spark).collect()) == list(range(60))


def test_a_paced_handler_may_fail(spark, tmp_path):
    numbered(spark).drop("batch").write.parquet(str(tmp_path / "in"))

    def handle(df, batch_id):
        raise RuntimeError("not the pace")

    run = PacedRun(lambda cap: arriving(spark, str(tmp_path / "in"), "event_id long", cap), str(tmp_path / "in"), handle, str(tmp_path / "pace"), every="0 seconds")
    with pytest.raises(StreamingQueryException):
        run.run(spark)


def test_progress_has_one_row_per_batch(spark, tmp_path):
    rows = numbered(spark)
    deliver(rows.drop("batch"), (F.col("event_id") % 4).cast("int"), str(tmp_path / "in"))
    ck, sink = str(tmp_path / "ck"), BatchTable(str(tmp_path / "out"))
    handle = streams._crashing(sink.write_batch)
    start = lambda: arriving(spark, str(tmp_path / "in"), "event_id long", 2).writeStream.queryName("numbered").foreachBatch(handle).option(
        "checkpointLocation", ck).trigger(availableNow=True).start()
    with ProgressTable(spark, str(tmp_path / "progress")) as progress:
        assert run_to_end(start, spark, ck) == 4
        progress.wait_for("numbered", 4)
    found = progress.read(spark).orderBy("at").collect()
    assert [(r.batch_id, r.input_rows) for r in found] == [(b, 10) for b in range(4)]
    assert len({r.run_id for r in found}) == 4 and all(r.millis >= 0 for r in found)
    with pytest.raises(TimeoutError):
        progress.wait_for("numbered", 5, seconds=1)


def test_files_of_arrivals_grow_with_their_rows(spark, folder, monkeypatch):
    """As many as the largest arrival asks for, unless the smallest cannot fill them; the progress is the same."""
    monkeypatch.setattr(streams, "FILE_ROWS", 40)
    monkeypatch.setattr(streams, "LEAST_ROWS", 4)
    path, files = streams._late_arrivals(spark, folder)
    written = spark.read.parquet(path).select("_metadata.file_path").distinct().count()
    assert files > streams.FILES and written == 6 * files
    rows = spark.range(1000)
    assert streams._files(rows, F.col("id") % 5) == 5 and streams._files(rows, F.when(F.col("id") == 7, 1).otherwise(0)) == streams.FILES
    got = {tuple(r) for r in streams.QUERIES["stream_progress"](spark, folder).collect()}
    monkeypatch.undo()
    assert got == {tuple(r) for r in streams.QUERIES["stream_progress"](spark, folder).collect()} and len(got) == 6


def test_restarts_load_the_state_as_it_was(spark, tmp_path):
    """The query runs without a changelog; the session keeps its setting."""
    key, seen = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", []
    before = spark.conf.get(key)

    def start():
        seen.append(spark.conf.get(key))
        spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "in"))
        return spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.foreachBatch(lambda rows, n: rows.count()).option(
            "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()

    assert run_to_end(start, spark, str(tmp_path / "ck")) == 0 and seen == ["false"] and before == "true" == spark.conf.get(key)
