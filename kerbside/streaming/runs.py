"""Streams over a folder's ``events`` table, drained and read back."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.functions import columns as X
from kerbside.operators.messages import with_partition
from kerbside.session import shared_path
from kerbside.streaming import jobs
from kerbside.streaming.delivery import last_commit
from kerbside.streaming.events import event_files, kafka_sink_options, parse_events, read_kafka_stream, rejected_events
from kerbside.streaming.upsert import UpsertTable, append_sink, kafka_sink

WINDOW_KEYS = ("window_start", "window_end")


def drained(query):
    """The query once it has handled all there is; its failure is an error."""
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    return query


def _upserted(spark, stream, keys, label) -> DataFrame:
    table = UpsertTable(shared_path(spark, label), keys)
    drained(table.start(stream, shared_path(spark, f"{label}-offsets"), drain=True))
    return table.read(spark)


def sliding_totals(spark: SparkSession, folder) -> DataFrame:
    stream = jobs.sliding_totals(event_files(spark, folder))
    return _upserted(spark, stream, [*WINDOW_KEYS, "zone", "violation_type"], "sliding")


def sliding_totals_by_zone(spark: SparkSession, folder) -> DataFrame:
    stream = jobs.sliding_totals_by_zone(event_files(spark, folder))
    return _upserted(spark, stream, [*WINDOW_KEYS, "zone"], "sliding-zone")


def _appended(spark, stream, label):
    path = shared_path(spark, label)
    query = drained(append_sink(stream, path, shared_path(spark, f"{label}-offsets"), drain=True))
    return spark.read.schema(stream.schema).parquet(path), query


def alerts(spark: SparkSession, folder) -> DataFrame:
    return _appended(spark, jobs.alerts(event_files(spark, folder)), "alerts")[0]


def run_summary(spark: SparkSession, folder) -> DataFrame:
    """Per partition: events produced, events consumed by a drained stream,
    and the lag left."""
    produced = with_partition(event_files_batch(spark, folder)).groupBy("partition").agg(
        F.count("*").alias("produced"))
    stream = with_partition(event_files(spark, folder)).select("partition", "event_id")
    consumed, _ = _appended(spark, stream, "consumed")
    done = consumed.groupBy("partition").agg(F.count("*").alias("consumed"))
    return produced.join(done, "partition", "left").select(
        "partition", "produced", F.coalesce("consumed", F.lit(0)).alias("consumed"),
        (F.col("produced") - F.coalesce("consumed", F.lit(0))).alias("lag"))


def event_files_batch(spark: SparkSession, folder) -> DataFrame:
    """The same events read as a batch, to compare with."""
    from kerbside.sources.incidents import incident_columns, read_table
    named = read_table(spark, folder, "events").select(*incident_columns(), F.col("ts").cast("timestamp").alias("event_time"))
    return named.select(
        F.col("violation_id").alias("event_id"), "event_time",
        X.canonical_type(F.col("violation_type")).alias("violation_type"),
        X.canonical_zone(F.col("zone")).alias("zone"),
        "speed_kmh", "fine_amount",
    )


def run_kafka_job(spark: SparkSession, servers, out, every="30 seconds", **source):
    """The deployed job: a topic of events -> sliding totals as an upsert table
    and alerts as another topic; messages that hold no event go to files beside
    them. Returns when a query stops. ``source`` are options of
    ``kafka_source_options``, such as the topic, where to start and
    ``per_trigger``; without the last, a trigger takes all there is.

    Needs the Kafka connector on the class path.
    """
    messages = read_kafka_stream(spark, servers=servers, **({"per_trigger": None} | source))
    events = parse_events(messages)
    append_sink(rejected_events(messages), f"{out}/rejected", f"{out}/checkpoints/rejected", every)
    table = UpsertTable(f"{out}/sliding", [*WINDOW_KEYS, "zone", "violation_type"])
    table.start(jobs.sliding_totals(events), f"{out}/checkpoints/sliding", every, name="sliding")
    kafka_sink(jobs.alert_messages(events), kafka_sink_options(servers), f"{out}/checkpoints/alerts")
    spark.streams.awaitAnyTermination()


def batches(spark: SparkSession, checkpoint) -> int:
    """Micro-batches committed in a checkpoint."""
    return last_commit(spark, checkpoint) + 1


def progress_lag(query) -> dict:
    """Rows still to come, from the last progress of a running Kafka query:
    latest offset minus end offset by topic and partition."""
    import json
    lag = {}
    for source in (query.lastProgress or {}).get("sources", []):
        latest, end = source.get("latestOffset"), source.get("endOffset")
        latest = json.loads(latest) if isinstance(latest, str) else latest
        end = json.loads(end) if isinstance(end, str) else end
        if isinstance(latest, dict) and isinstance(end, dict):
            for topic, parts in latest.items():
                for part, offset in parts.items():
                    lag[(topic, int(part))] = offset - end.get(topic, {}).get(part, 0)
    return lag
