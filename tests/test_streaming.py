"""Streams over small files: lateness, restarts, replays, sources."""

import time

from pyspark.sql import functions as F

from kerbside import contract as C
from kerbside.operators import messages
from kerbside.session import drop_stages
from kerbside.streaming import events as E, jobs, runs
from kerbside.streaming.upsert import UpsertTable, append_sink, for_each_batch

SCHEMA = "event_id string, event_time timestamp, violation_type string, zone string, speed_kmh double, fine_amount double"


def put(spark, folder, name, times):
    rows = [(f"{name}-{i}", t, "DUI", "Highway", 10.0, 100.0) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp", "string")).withColumn(
        "event_time", F.col("event_time").cast("timestamp")).select(*[c.split()[0] for c in SCHEMA.split(", ")])
    df.coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder, per=1):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per).parquet(str(folder))


def test_stream_equals_batch(spark, folder):
    got = runs.sliding_totals(spark, folder)
    batch = jobs.sliding_totals(runs.event_files_batch(spark, folder))
    assert got.exceptAll(batch.select(*got.columns)).isEmpty() and got.count() == batch.count()


def test_late_rows_are_dropped(spark, tmp_path):
    src = tmp_path / "in"
    for name, times in (("a", ["2024-01-01 00:30:00"]), ("b", ["2024-01-01 00:31:00"]),
                        ("c", ["2024-01-01 00:00:30", "2024-01-01 00:27:30"])):
        put(spark, src, name, times)
        time.sleep(1.1)
    table = UpsertTable(str(tmp_path / "out"), ["window_start", "window_end", "zone", "violation_type"])
    query = table.start(jobs.sliding_totals(stream(spark, src)), str(tmp_path / "ck"), drain=True)
    query.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 6
    starts = {str(r.window_start)[11:16] for r in table.read(spark).collect()}
    assert "00:24" in starts and "00:00" not in starts and "23:56" not in starts


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    table = UpsertTable(out, ["window_start", "window_end", "zone"])
    for name, at in (("a", "2024-01-01 00:30:10"), ("b", "2024-01-01 00:30:50")):
        put(spark, src, name, [at])
        table.start(jobs.sliding_totals_by_zone(stream(spark, src)), ck, drain=True).awaitTermination()
        time.sleep(1.1)
    got = {r.violation_count for r in table.read(spark).collect()}
    assert got == {2} and table.read(spark).count() == 5


def test_replay_and_compaction_change_nothing(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ["k"])
    one = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    two = spark.createDataFrame([(2, 21), (3, 30)], "k int, v int")
    table.write_batch(one, 0)
    table.write_batch(two, 1)
    table.write_batch(two, 1)
    want = [(1, 10), (2, 21), (3, 30)]
    assert sorted(map(tuple, table.read(spark).collect())) == want
    compacted = table.compact(spark, str(tmp_path / "compacted"))
    drop_stages(spark)
    assert sorted(map(tuple, compacted.read(spark).collect())) == want
    compacted.write_batch(spark.createDataFrame([(1, 11)], "k int, v int"), 2)
    assert sorted(map(tuple, compacted.read(spark).collect())) == [(1, 11), (2, 21), (3, 30)]


def test_back_pressure_limits_each_batch(spark, tmp_path):
    src = tmp_path / "in"
    for name in "abc":
        put(spark, src, name, ["2024-01-01 00:30:00"])
    sizes = []
    query = for_each_batch(stream(spark, src), lambda df, i: sizes.append((i, df.count())), str(tmp_path / "ck"), drain=True)
    query.awaitTermination()
    assert sizes == [(0, 1), (1, 1), (2, 1)]


def test_alert_messages_have_a_value(spark, tmp_path):
    put(spark, tmp_path / "in", "a", ["2024-01-01 00:30:00"])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    append_sink(jobs.alert_messages(stream(spark, tmp_path / "in")), out, ck, drain=True).awaitTermination()
    row = spark.read.parquet(out).first()
    assert row.topic == C.ALERT_TOPIC and row.key == "Highway" and '"event_id":"a-0"' in row.value


def test_parse_events(spark):
    raw = spark.createDataFrame(
        [(b'{"event_id":"E1","timestamp":"2024-01-01T08:00:00Z","zone":"Highway","speed_kmh":61.5,"extra":1}',),
         (b"not json",)], "value binary")
    rows = E.parse_events(raw).collect()
    assert rows[0].event_id == "E1" and str(rows[0].event_time) == "2024-01-01 08:00:00" and rows[0].speed_kmh == 61.5
    assert rows[1].event_id is None and rows[1].event_time is None


def test_unreadable_payloads_are_rejected(spark):
    raw = spark.createDataFrame([(b'{"event_id":"E1","timestamp":"2024-01-01T08:00:00Z"}', 1), (b"not json", 2), (None, 3), (b'{"event_id":"E4"}', 4)], "value binary, offset int")
    rows = E.rejected_events(raw).collect()
    assert {r.offset: r.reason for r in rows} == {2: "not readable", 3: "no payload", 4: "no event time"} and bytes(rows[0].value) == b"not json"


def test_kafka_options_pass_through():
    assert "maxOffsetsPerTrigger" not in E.kafka_source_options(per_trigger=None)
    assert E.kafka_source_options(per_trigger=5, starting="earliest")["maxOffsetsPerTrigger"] == "5"


def test_envelope_round_trip(spark):
    df = E.as_events(spark.range(50).select(F.col("id").alias("value"), F.lit("2024-01-01").cast("timestamp").alias("timestamp")))
    sent = messages.with_partition(messages.envelope(df), "key")
    back = E.parse_events(sent)
    names = [f.name for f in C.EVENT_SCHEMA]
    assert back.select(*names).exceptAll(df.select(*names)).isEmpty()
    assert sent.groupBy("key").agg(F.count_distinct("partition").alias("n")).filter("n > 1").isEmpty()
    assert df.filter("fine_amount IS NULL").isEmpty()


def test_paced_generator(spark, tmp_path):
    query = append_sink(E.generated_events(spark, 10), str(tmp_path / "o"), str(tmp_path / "c"), every="0 seconds")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and len([p for p in query.recentProgress if p["numInputRows"]]) < 3:
            time.sleep(0.2)
    finally:
        query.stop()
    rows = spark.read.parquet(str(tmp_path / "o"))
    assert rows.count() >= 20 and rows.select("event_id").distinct().count() == rows.count()


def test_kafka_options():
    source = E.kafka_source_options("b:1", "t")
    assert source == {"kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "latest",
                      "maxOffsetsPerTrigger": "1000"}
    assert E.kafka_batch_options()["startingOffsets"] == "earliest"
    sink = E.kafka_sink_options()
    assert sink["kafka.acks"] == "all" and sink["kafka.compression.type"] == "gzip"


def test_progress_lag():
    class Query:
        lastProgress = {"sources": [{"latestOffset": {"t": {"0": 9, "1": 4}}, "endOffset": '{"t": {"0": 7}}'}]}
    assert runs.progress_lag(Query()) == {("t", 0): 2, ("t", 1): 4}


def test_listener_and_console(spark, tmp_path):
    from kerbside.streaming.listeners import BatchListener
    from kerbside.streaming.upsert import console_sink
    seen = []
    listener = BatchListener(lambda name, batch, rows: seen.append((batch, rows)))
    spark.streams.addListener(listener)
    try:
        put(spark, tmp_path / "in", "a", ["2024-01-01 00:30:00", "2024-01-01 00:31:00"])
        query = console_sink(jobs.sliding_totals_by_zone(stream(spark, tmp_path / "in")), every="0 seconds")
        query.processAllAvailable()
        query.stop()
        deadline = time.time() + 30
        while time.time() < deadline and (0, 2) not in seen:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert (0, 2) in seen


def test_restart_on_several_files(spark, folder, monkeypatch):
    """Each half of the events comes in as many files as the table has parts, and the totals are those of one run."""
    import glob
    from kerbside.plans import roundtrips
    from kerbside.streaming import runs
    plain, files = roundtrips.read_table, []
    monkeypatch.setattr(roundtrips, "read_table", lambda *a: plain(*a).repartition(3))
    roundtrips._in_two_parts(spark, folder, lambda path: files.append(len(glob.glob(f"{path.removeprefix('file:')}/events.parquet/*.parquet"))))
    assert files == [3, 6]
    found = roundtrips.stream_restart(spark, folder)
    want = runs.sliding_totals_by_zone(spark, folder)
    assert found.count() > 0 and sorted(map(str, found.select(want.columns).collect())) == sorted(map(str, want.collect()))
