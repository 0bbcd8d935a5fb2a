"""Streaming transformations. Each also runs unchanged on a batch."""

from pyspark.sql import DataFrame, functions as F

from kerbside import contract as C
from kerbside.functions import columns as X
from kerbside.operators.messages import envelope


#: What windows can measure, by the names that the contract gives them.
MEASURES = {
    "violation_count": lambda: F.count("*"),
    "avg_fine": lambda: X.rounded(X.mean("fine_amount"), 2),
    "revenue": lambda: X.rounded(X.total("fine_amount"), 2),
    "avg_speed": lambda: X.rounded(X.mean("speed_kmh"), 2),
}


def sliding_totals(events: DataFrame, by=("zone", "violation_type"), measures=tuple(MEASURES),
                   late=C.WATERMARK, window=C.WINDOW, slide=C.SLIDE) -> DataFrame:
    """Measures per sliding window and key, late rows bounded by a watermark.

    Partial aggregation runs before the shuffle, so a hot zone adds one row
    per window and task.
    """
    windows = events.withWatermark("event_time", late).groupBy(F.window("event_time", window, slide), *by)
    totals = windows.agg(*[MEASURES[name]().alias(name) for name in measures])
    return totals.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, *measures)


def sliding_totals_by_zone(events: DataFrame, **kw) -> DataFrame:
    """Count and average fine per sliding window and zone."""
    return sliding_totals(events, by=("zone",), measures=("violation_count", "avg_fine"), **kw)


def alerts(events: DataFrame) -> DataFrame:
    """Dangerous types, or any event above the alert speed."""
    return events.filter(X.is_alert(F.col("violation_type"), F.col("speed_kmh"))).select(
        "event_id", "violation_type", "zone", "speed_kmh", "fine_amount", "event_time")


def alert_messages(events: DataFrame) -> DataFrame:
    """Alerts as keyed JSON for the alerts topic."""
    return envelope(alerts(events), topic=C.ALERT_TOPIC)
