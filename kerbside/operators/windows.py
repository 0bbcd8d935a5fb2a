"""Ranks, running sums, lags and rolling statistics."""

from pyspark.sql import DataFrame, Window, functions as F

from kerbside import contract as C
from kerbside.functions import columns as X
from kerbside.functions.ordered import (
    SLAB_ROWS, Spread, attach, cumulate, previous_value, spreads, value_counts)

# Zones after standardisation, and one group for null.
ZONE_BOUND = len(C.ZONES) + 2


def zone_ranks(df: DataFrame, spread: Spread) -> DataFrame:
    """Rank and dense rank of each distinct fine in its zone, highest first.

    Worked out from value counts: equal fines share a rank, so rows need no
    window of their own and a zone may be any share of the data.
    """
    table = cumulate(value_counts(df, "fine_amount", ["zone"]), "fine_amount", ["zone"], spread)
    return table.select(
        "zone", "fine_amount",
        (F.col("total") - F.col("below") - F.col("n") + 1).cast("int").alias("rank_in_zone"),
        (F.col("distinct_total") - F.col("distinct_below")).cast("int").alias("dense_rank_zone"),
    )


def running_revenue(df: DataFrame) -> DataFrame:
    """Fines of each zone up to and including each hour (peers share)."""
    hours = df.groupBy("zone", "hour").agg(X.total("fine_amount").alias("__fine"))
    w = Window.partitionBy("zone").orderBy("hour").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return hours.select("zone", "hour", F.sum("__fine").over(w).alias("running_revenue"))


def _times(bound, factor):
    return None if bound is None else bound * factor


def zone_windows(df: DataFrame, spread: Spread | None = None, slab_rows=SLAB_ROWS, zones=None) -> DataFrame:
    """Per row: ranks by fine in the zone, the fine of the row before it by
    hour, and the running revenue by hour.

    ``zones`` is a proven bound of the number of zones, such as ``ZONE_BOUND``
    for standardised ones; None stands for unknown and rules broadcasts out.
    """
    spread = spread or spreads(df, ["fine_amount"], slab_rows)["fine_amount"]
    base = df.select("violation_id", "zone", "violation_type", "fine_amount", "severity", "hour")
    out = previous_value(base, "fine_amount", ["hour", "violation_id"], "prev_hour_fine", ["zone"], slab_rows)
    out = attach(out, running_revenue(df), ["zone", "hour"], "left", rows=_times(zones, 25))
    return attach(out, zone_ranks(df, spread), ["zone", "fine_amount"], "left", rows=_times(zones, spread.distinct))


def top_per_zone(df: DataFrame, k=5, spread: Spread | None = None, slab_rows=SLAB_ROWS,
                 zones=None) -> DataFrame:
    """Rows whose fine ranks in the top ``k`` of their zone, ties included.

    At most ``k`` distinct fines per zone qualify; they are broadcast if
    ``zones`` bounds the zones.
    """
    spread = spread or spreads(df, ["fine_amount"], slab_rows)["fine_amount"]
    best = zone_ranks(df, spread).filter(F.col("rank_in_zone") <= k)
    windows = previous_value(
        df.select("violation_id", "zone", "violation_type", "fine_amount", "severity", "hour"),
        "fine_amount", ["hour", "violation_id"], "prev_hour_fine", ["zone"], slab_rows)
    top = attach(windows, best, ["zone", "fine_amount"], "inner", rows=_times(zones, k))
    return attach(top, running_revenue(df), ["zone", "hour"], "left", rows=_times(zones, 25))


def zone_share(df: DataFrame, zones=None) -> DataFrame:
    """Each fine as a percentage of its zone's total."""
    totals = df.groupBy("zone").agg(X.total("fine_amount").alias("__zone_total"))
    return attach(df, totals, ["zone"], "left", rows=zones).select(
        "violation_id", "zone", "fine_amount",
        F.try_divide(F.col("fine_amount") * 100.0, F.col("__zone_total")).alias("pct_of_zone"),
    )


def hourly_counts(df: DataFrame, timeline=False) -> DataFrame:
    """Rows per hour of day, or per hour on the timeline."""
    at = F.date_trunc("hour", "timestamp").alias("hour") if timeline else F.col("hour")
    return df.select(at).na.drop().groupBy("hour").agg(F.count("*").alias("count"))


def filled_hours(hourly: DataFrame) -> DataFrame:
    """A series at a fixed step: every hour from the first to the last, those without rows with 0."""
    ends = hourly.agg(F.min("hour").alias("first"), F.max("hour").alias("last")).where("first IS NOT NULL")
    grid = ends.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    return grid.join(hourly, "hour", "left").select("hour", F.coalesce("count", F.lit(0)).alias("count"))


def centred(window):
    """Frame of ``window`` rows around the current one."""
    return Window.orderBy("hour").rowsBetween(-(window // 2), (window - 1) // 2)


def rolling(hourly: DataFrame, window=3) -> DataFrame:
    """Centred rolling mean and sample deviation over hourly counts.

    The input has one row per hour, so its one ordered window stays small.
    """
    w = centred(window)
    return hourly.select(
        "hour", "count",
        F.avg("count").over(w).alias("rolling_mean"),
        F.coalesce(F.stddev_samp("count").over(w), F.lit(0.0)).alias("rolling_std"),
    )
