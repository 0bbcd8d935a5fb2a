"""The batch run: ingest, clean, enrich, report, check, load, export.

Every stage writes its table once and the next one reads it, so no stage
repeats the work of another and a lost executor costs one stage at most.
"""

import time

from pyspark.sql import SparkSession, functions as F

from kerbside import contract as C
from kerbside.functions.ordered import spreads
from kerbside.operators import analytics, anomalies, conform, features, quality, star, windows
from kerbside.plans import cleaning
from kerbside.plans.enriching import enrich
from kerbside.session import stage
from kerbside.sinks import files, tables
from kerbside.sources.csv_files import ingest
from kerbside.sources.synthetic import synthetic_records


def reports(records) -> dict:
    """The standing reports over processed records, all lazy."""
    tiered = features.add_tiers(records)
    return {
        "zone_type_report": analytics.zone_type_report(tiered),
        "hourly_trend": analytics.hourly_trend(tiered),
        "severity_share": analytics.severity_share(tiered),
        "zone_type_severity_summary": analytics.zone_type_severity_summary(tiered),
        "top_per_zone": windows.top_per_zone(tiered, zones=windows.ZONE_BOUND),
        "kpi_cards": analytics.kpi_cards(tiered),
        "day_hour_pivot": analytics.day_hour_pivot(tiered),
    }


def run(spark: SparkSession, source, out, run_at, as_of=None, table_prefix="", synthetic_rows=100_000) -> dict:
    """Run all stages; returns the paths, the score and the row counts.

    ``source`` is a CSV folder, a DataFrame of raw records, or None for
    generated ones. The warehouse is loaded only if the quality gate opens.
    """
    started = time.monotonic()
    as_of = as_of or run_at
    rejected = None
    if source is None:
        raw = synthetic_records(spark, synthetic_rows)
    elif isinstance(source, str):
        raw, rejected = ingest(spark, source, run_at)
    else:
        raw = source
    paths = {name: f"{out}/{name}" for name in (
        "raw", "violations", "zone_aggregates", "zone_summary", "partitioned", "anomalies", "dq_report", "log",
        "quarantine", "rejected")}
    written = tables.Written()
    files.export_parquet(written.watch("raw", raw), paths["raw"])
    raw = spark.read.parquet(paths["raw"])
    if rejected is not None:
        files.export_csv(rejected, paths["rejected"])

    cleaned = cleaning.clean(raw)
    enriched = enrich(cleaned, spreads(conform.cast_contract(raw), ["fine_amount"])["fine_amount"])
    files.export_parquet(written.watch("clean", enriched), paths["violations"])
    records = spark.read.parquet(paths["violations"])

    # A few rows each, used by everything that follows: worked out once.
    checks = stage(quality.dq_checks(records, as_of), "checks")
    score = stage(quality.dq_score(checks, run_at), "score")
    found = anomalies.detect(records, "fine_amount")
    files.export_parquet(analytics.zone_type_summary(records), paths["zone_aggregates"])
    files.export_parquet(written.watch("anomalies", found), paths["anomalies"])
    files.write_report(quality.report_lines(checks, score, spark.read.parquet(paths["anomalies"])), paths["dq_report"])

    accepted, quarantined, alert = quality.gate(records, score)
    files.export_parquet(quarantined, paths["quarantine"])
    tables.append_record(alert, paths["log"] + "/alerts")
    summary = quality.run_summary(score, *[written.rows(name) for name in ("raw", "clean", "anomalies")]).withColumns({
        "run_at": F.lit(run_at), "elapsed_sec": F.lit(round(time.monotonic() - started, 1))})
    tables.append_record(summary, paths["log"] + "/runs")
    verdict = score.first()
    result = {"paths": paths, "score": verdict["score"], "passed": verdict["passed"], "tables": {}}
    if verdict["score"] >= C.GATE_SCORE:
        # The gate is open for the whole load, so the records need no further test of the score.
        files.export_partitioned(records, paths["partitioned"])
        files.export_zone_summary(records, paths["zone_summary"])
        result["tables"]["violations"] = tables.load_table(records, f"{table_prefix}violations")
        result["tables"] |= tables.load_star(star.star_schema(records), table_prefix)
    return result
