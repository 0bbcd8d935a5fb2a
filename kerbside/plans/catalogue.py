"""Every registered query: name -> (spark, folder) -> DataFrame."""

from pyspark.sql import DataFrame, functions as F

from kerbside import contract as C
from kerbside.functions import columns as X
from kerbside.functions.ordered import quantiles
from kerbside.operators import (
    analytics, anomalies, conform, features, impute, layout, messages, quality, star, windows)
from kerbside.plans import cleaning
from kerbside.plans.enriching import enrich
from kerbside.session import exists, stage, write_stage
from kerbside.sinks.tables import Written
from kerbside.sources.incidents import raw_incidents, read_table

# Fixed clock: the events end on the evening before.
AS_OF = "2024-01-31"
RUN_AT = "2024-01-31T00:00:00"

_tables = {}


def _once(spark, folder, name, build):
    """Stage tables: built once per session and input, then read back.

    The batch plan works the same way: each stage writes its table and later
    stages and reports read it.
    """
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _tables or not exists(spark, _tables[key][0]):
        df = build()
        _tables[key] = (write_stage(df, name), df.schema)
    path, schema = _tables[key]
    return spark.read.schema(schema).parquet(path)


def raw(spark, folder) -> DataFrame:
    return raw_incidents(spark, folder)


def prepared(spark, folder) -> DataFrame:
    return cleaning.prepare(raw(spark, folder))


def clean_table(spark, folder) -> DataFrame:
    return _once(spark, folder, "clean", lambda: cleaning.clean(raw(spark, folder)))


def enriched_table(spark, folder) -> DataFrame:
    return _once(spark, folder, "enriched", lambda: enrich(clean_table(spark, folder)))


QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- conform ------------------------------------------------------------------


@query
def drop_all_null(spark, folder):
    """Rows with nothing but null in the optional fields go."""
    df = raw(spark, folder).select("row_seq", "speed_kmh", "fine_amount", "vehicle_type")
    return conform.drop_empty(df, ["speed_kmh", "fine_amount", "vehicle_type"])


@query
def header_normalise(spark, folder):
    old = raw(spark, folder).select(
        F.col("violation_id").alias("id"), F.col("violation_type").alias("Type"), "zone",
        F.col("speed_kmh").alias("Speed"), F.col("fine_amount").alias("fine"),
        F.col("latitude").alias("lat"), F.col("longitude").alias("lng"))
    return conform.normalise_headers(old)


@query
def cast_contract(spark, folder):
    """Text numbers, some unreadable, and two absent columns."""
    df = raw(spark, folder)
    text = df.select(
        "row_seq", "violation_id", "timestamp", "violation_type", "zone",
        F.when(F.col("row_seq") % 13 == 0, "n/a").when(F.col("row_seq") % 29 == 0, "NaN")
        .otherwise(F.col("speed_kmh").cast("string")).alias("speed_kmh"),
        "fine_amount", "vehicle_type")
    return conform.cast_contract(text)


@query
def provenance(spark, folder):
    return conform.add_provenance(raw(spark, folder).select("violation_id", "zone"), RUN_AT)


@query
def union_by_name(spark, folder):
    """Two layouts of the same records, the second without a fine."""
    df = raw(spark, folder)
    return conform.union_all(
        df.select("violation_id", "zone", "fine_amount"), df.select("zone", "violation_id"))


@query
def dedup_exact(spark, folder):
    return conform.drop_exact_duplicates(raw(spark, folder))


@query
def dedup_keep_first(spark, folder):
    """First record of each officer: heavy groups."""
    df = raw(spark, folder).select("officer_id", "row_seq", "violation_id", "zone")
    return conform.keep_first(df, "officer_id", ["row_seq", "violation_id"])


@query
def drop_required_nulls(spark, folder):
    return conform.drop_required_nulls(raw(spark, folder))


@query
def standardise_categories(spark, folder):
    df = raw(spark, folder).select("row_seq", "violation_type", "zone", "vehicle_type")
    return conform.standardise_categories(df)


@query
def time_features(spark, folder):
    return conform.add_time_features(raw(spark, folder).select("row_seq", "timestamp"))


@query
def json_props(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "props")
    return messages.json_field(events, "props", "k bigint", "k").select("event_id", "k")


@query
def partition_by_key(spark, folder):
    df = cleaning.prepare(raw(spark, folder)).select("row_seq", "violation_id", "zone")
    return messages.with_partition(df)


# --- clean ---------------------------------------------------------------------


@query
def derive_severity(spark, folder):
    df = conform.standardise_categories(raw(spark, folder)).select("row_seq", "violation_type", "speed_kmh")
    return conform.add_severity(df)


@query
def impute_group_median(spark, folder):
    df = prepared(spark, folder).select("row_seq", "violation_id", "zone", "violation_type", "fine_amount", "speed_kmh")
    return impute.impute(df)


@query
def impute_mode(spark, folder):
    df = prepared(spark, folder).select("row_seq", "vehicle_type", "officer_id", "latitude", "longitude")
    return impute.impute(df)


@query
def cap_outliers(spark, folder):
    df = raw(spark, folder).select("row_seq", "speed_kmh", "fine_amount")
    return impute.flag_fine_outliers(impute.cap_values(df))


@query
def exact_quantiles(spark, folder):
    """Quartiles of the fine by zone."""
    df = prepared(spark, folder).select("zone", "fine_amount")
    return quantiles(df, "fine_amount", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, ["zone"]).select(
        "zone", *[X.rounded(q, 6).alias(q) for q in ("q1", "q2", "q3")])


@query
def price_quantiles(spark, folder):
    """Exact outer deciles and median of the line price by return flag, on the widest table."""
    df = read_table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    found = quantiles(df, "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, ["l_returnflag"])
    return found.select("l_returnflag", *[X.rounded(q, 4).alias(q) for q in ("p10", "p50", "p90")])


@query
def clean_records(spark, folder):
    """The whole cleaning plan, from raw records."""
    return cleaning.clean(raw(spark, folder))


# --- features --------------------------------------------------------------------


def _scaled(method):
    def run(spark, folder):
        df = clean_table(spark, folder).select("violation_id", "speed_kmh")
        return features.normalise(df, "speed_kmh", method, "scaled").withColumn("scaled", X.rounded("scaled", 6))
    return run


QUERIES["normalise_minmax"] = _scaled("minmax")
QUERIES["normalise_zscore"] = _scaled("zscore")
QUERIES["normalise_robust"] = _scaled("robust")


@query
def risk_score(spark, folder):
    df = clean_table(spark, folder).select("violation_id", "severity", "speed_kmh", "fine_amount")
    return features.add_risk_score(df)


@query
def price_rank(spark, folder):
    """Average percentile rank of every order's total."""
    df = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return features.percent_rank_average(df, "o_totalprice", "pct_rank").withColumn("pct_rank", X.rounded("pct_rank", 8))


@query
def speed_fine_tiers(spark, folder):
    df = clean_table(spark, folder).select("violation_id", "violation_type", "zone", "severity", "speed_kmh",
                                           "fine_amount", "hour")
    return features.add_tiers(df)


@query
def encode_ordinal_onehot(spark, folder):
    df = clean_table(spark, folder).select("violation_id", "zone", "severity", "is_peak", "is_weekend")
    return features.encode(df)


# --- analytics -------------------------------------------------------------------

@query
def zone_type_summary(spark, folder):
    return analytics.zone_type_summary(clean_table(spark, folder))


@query
def hourly_summary(spark, folder):
    return analytics.hourly_summary(clean_table(spark, folder))


@query
def zone_type_report(spark, folder):
    return analytics.zone_type_report(clean_table(spark, folder))


@query
def hourly_trend(spark, folder):
    return analytics.hourly_trend(clean_table(spark, folder))


@query
def severity_share(spark, folder):
    return analytics.severity_share(clean_table(spark, folder))


@query
def zone_type_severity_summary(spark, folder):
    return analytics.zone_type_severity_summary(clean_table(spark, folder))


@query
def zone_revenue_recent(spark, folder):
    """A ten-day window, so that the filter bites on a month of events."""
    return analytics.zone_revenue_recent(clean_table(spark, folder), AS_OF, 10)


@query
def hour_zone_counts(spark, folder):
    return analytics.hour_zone_counts(clean_table(spark, folder))


@query
def officer_top20(spark, folder):
    return analytics.officer_top(clean_table(spark, folder))


@query
def type_counts(spark, folder):
    return analytics.frequencies(clean_table(spark, folder), "violation_type")


@query
def severity_counts(spark, folder):
    return analytics.frequencies(clean_table(spark, folder), "severity")


@query
def kpi_cards(spark, folder):
    return analytics.kpi_cards(clean_table(spark, folder))


@query
def zone_revenue(spark, folder):
    return analytics.zone_revenue(clean_table(spark, folder))


@query
def day_hour_pivot(spark, folder):
    return analytics.day_hour_pivot(clean_table(spark, folder))


@query
def zone_windows(spark, folder):
    return windows.zone_windows(clean_table(spark, folder), zones=windows.ZONE_BOUND)


@query
def top5_per_zone(spark, folder):
    return windows.top_per_zone(clean_table(spark, folder), zones=windows.ZONE_BOUND)


@query
def rolling_hourly(spark, folder):
    hourly = windows.hourly_counts(clean_table(spark, folder), timeline=True)
    return windows.rolling(hourly, 9).select(
        "hour", "count", X.rounded("rolling_mean", 6).alias("rolling_mean"), X.rounded("rolling_std", 6).alias("rolling_std"))


@query
def zone_share(spark, folder):
    return windows.zone_share(clean_table(spark, folder), zones=windows.ZONE_BOUND).withColumn("pct_of_zone", X.rounded("pct_of_zone", 8))


@query
def raw_explorer(spark, folder):
    """The report's own page size, under two filters."""
    return analytics.explore(clean_table(spark, folder), zone="Downtown", severity="High")


@query
def hash_sample(spark, folder):
    df = clean_table(spark, folder).select("violation_id", "zone", "fine_amount")
    return analytics.hash_sample(df, "violation_id", 100)


@query
def hash_fraction(spark, folder):
    df = clean_table(spark, folder).select("violation_id", "zone")
    return analytics.hash_fraction(df, "violation_id", 0.25)


# --- quality -----------------------------------------------------------------------


@query
def dq_checks(spark, folder):
    """On uncleaned records, so that checks fail."""
    return quality.dq_checks(prepared(spark, folder), AS_OF).withColumn("metric", X.rounded("metric", 8))


@query
def dq_checks_dashboard(spark, folder):
    """The dashboard's smaller suite, on clean records."""
    few = {c: C.COMPLETENESS[c] for c in ("violation_type", "zone", "severity", "fine_amount")}
    checks = quality.dq_checks(
        clean_table(spark, folder), AS_OF, few, ["speed_kmh", "fine_amount"], freshness=False)
    return checks.withColumn("metric", X.rounded("metric", 8))


@query
def dq_score(spark, folder):
    return quality.dq_score(quality.dq_checks(prepared(spark, folder), AS_OF), RUN_AT)


@query
def schema_report(spark, folder):
    return quality.schema_report(prepared(spark, folder)).withColumn("n", X.rounded("n", 6))


@query
def schema_score(spark, folder):
    return quality.schema_score(prepared(spark, folder))


@query
def unexpected_values(spark, folder):
    """Raw spellings against the contract."""
    return quality.unexpected_values(raw(spark, folder))


def _anomalous(method, z=3.0):
    def run(spark, folder):
        df = clean_table(spark, folder).select("violation_id", "zone", "violation_type", "speed_kmh", "fine_amount")
        return anomalies.detect(df, "speed_kmh", method, z)
    return run


QUERIES["anomalies_zscore"] = _anomalous("zscore")
QUERIES["anomalies_iqr"] = _anomalous("iqr")
QUERIES["anomalies_combined"] = _anomalous("combined")


@query
def anomaly_mark(spark, folder):
    df = clean_table(spark, folder).select("violation_id", "speed_kmh")
    return anomalies.mark(df, "speed_kmh")


@query
def non_anomalous_anti(spark, folder):
    df = clean_table(spark, folder).select("violation_id", "zone", "speed_kmh")
    return anomalies.exclude_by_key(df, anomalies.detect(df, "speed_kmh", "iqr"))


@query
def anomalous_semi(spark, folder):
    df = clean_table(spark, folder).select("violation_id", "zone", "speed_kmh")
    return anomalies.keep_by_key(df, anomalies.detect(df, "speed_kmh", "zscore"))


@query
def temporal_spikes(spark, folder):
    return anomalies.temporal_spikes(clean_table(spark, folder), window=9, timeline=True)


@query
def temporal_spikes_by_hour(spark, folder):
    return anomalies.temporal_spikes(clean_table(spark, folder), window=9)


@query
def temporal_spikes_neighbours(spark, folder):
    """Each hour of the timeline against its eight neighbours only."""
    return anomalies.temporal_spikes(clean_table(spark, folder), window=9, timeline=True, exclude_current=True)


@query
def dq_report_rows(spark, folder):
    # A few rows each, which several parts of the report use.
    checks = stage(quality.dq_checks(prepared(spark, folder), AS_OF), "checks")
    found = anomalies.detect(clean_table(spark, folder).select("violation_id", "fine_amount", "speed_kmh"), "speed_kmh")
    return quality.report_lines(checks, stage(quality.dq_score(checks, RUN_AT), "score"), found)


@query
def dq_gate_quarantine(spark, folder):
    """Which rows a gate at the reached score quarantines, and why."""
    df = prepared(spark, folder)
    score = quality.dq_score(quality.dq_checks(df, AS_OF), RUN_AT)
    _, quarantined, _ = quality.gate(df, score)
    return quarantined.groupBy("gate_reason").agg(F.count("*").alias("rows"))


@query
def dq_gate_route(spark, folder):
    """Rows accepted, rows quarantined and alerts raised, on clean records."""
    df = clean_table(spark, folder)
    score = stage(quality.dq_score(stage(quality.dq_checks(df, AS_OF), "checks"), RUN_AT), "score")
    return quality.gate_counts(df, score)


@query
def run_summary(spark, folder):
    """A run that writes raw, clean and anomalous records, and its log, from what the writes have counted."""
    written = Written()
    step = lambda name, df: stage(written.watch(name, df), name)
    clean = step("clean", cleaning.clean(step("raw", raw(spark, folder))))
    step("anomalies", anomalies.detect(clean, "fine_amount"))
    score = stage(quality.dq_score(stage(quality.dq_checks(clean, AS_OF), "checks")), "score")
    return quality.run_summary(score, *[written.rows(name) for name in ("raw", "clean", "anomalies")])


# --- warehouse, layout ----------------------------------------------------------------


@query
def warehouse_coerce(spark, folder):
    from kerbside.sinks.tables import warehouse_types
    df = clean_table(spark, folder).select("violation_id", "timestamp", "is_peak", "fine_is_outlier", "fine_amount")
    return warehouse_types(df)


@query
def star_dims(spark, folder):
    return star.row_counts(star.star_schema(enriched_table(spark, folder)))


@query
def star_dim_time(spark, folder):
    return star.dimension(enriched_table(spark, folder), "dim_time")[0]


@query
def star_dim_location(spark, folder):
    return star.dimension(enriched_table(spark, folder), "dim_location")[0]


@query
def star_dim_vehicle(spark, folder):
    return star.dimension(enriched_table(spark, folder), "dim_vehicle")[0]


@query
def star_fact(spark, folder):
    fact = star.star_schema(enriched_table(spark, folder))["fact_violation"]
    return fact.select("violation_id", "violation_type", "severity", "fine_amount", "risk_score",
                       "time_id", "loc_id", "veh_id")


def _object_keys(spark, folder):
    df = clean_table(spark, folder).filter(F.col("timestamp").isNotNull())
    return df.select(F.concat(
        F.lit("raw/"), F.date_format("timestamp", "yyyy/MM/dd"), F.lit("/"), "violation_id").alias("key"))


@query
def prefix_filter(spark, folder):
    return conform.prefix_filter(_object_keys(spark, folder), "key", "raw/2024/01/1")


def _files(spark, folder):
    return read_table(spark, folder, "documents").select(
        F.concat(F.lit("/docs/"), F.col("doc_id").cast("string")).alias("path"),
        F.col("n_chars").cast("long").alias("size_bytes"))


@query
def block_layout(spark, folder):
    return layout.block_layout(_files(spark, folder), 1024)


@query
def block_report(spark, folder):
    return layout.block_report(_files(spark, folder), 1024)


# --- log-shaped -------------------------------------------------------------------------


def _log(spark, folder):
    df = conform.standardise_categories(raw(spark, folder)).select("row_seq", "violation_id", "zone", "fine_amount")
    return messages.with_partition(conform.keep_first(df))


@query
def kafka_envelope(spark, folder):
    df = clean_table(spark, folder).select("violation_id", "violation_type", "zone")
    return messages.envelope(df)


@query
def partition_offsets(spark, folder):
    return messages.with_offset(_log(spark, folder), ["row_seq"]).select("partition", "offset", "violation_id")


@query
def partition_distribution(spark, folder):
    return messages.partition_distribution(_log(spark, folder))


@query
def consumer_lag(spark, folder):
    """Committed: the offsets of the records up to the middle of the log."""
    log = messages.with_offset(_log(spark, folder), ["row_seq"])
    half = log.agg(F.floor(F.max("row_seq") / 2).alias("half"))
    done = log.crossJoin(F.broadcast(half)).filter("row_seq <= half").groupBy("partition").agg(
        (F.max("offset") + 1).alias("committed"))
    return messages.consumer_lag(messages.end_offsets(log), done)


@query
def fair_batch(spark, folder):
    log = messages.with_offset(_log(spark, folder), ["row_seq"])
    return messages.fair_batch(log, 100).select("partition", "offset", "violation_id")


# --- streams, run to the end of a file source ----------------------------------------------


@query
def stream_sliding_agg(spark, folder):
    from kerbside.streaming import runs
    return runs.sliding_totals(spark, folder)


@query
def stream_sliding_zone(spark, folder):
    from kerbside.streaming import runs
    return runs.sliding_totals_by_zone(spark, folder)


@query
def stream_alerts(spark, folder):
    from kerbside.streaming import runs
    return runs.alerts(spark, folder)


@query
def stream_run_summary(spark, folder):
    from kerbside.streaming import runs
    return runs.run_summary(spark, folder)
