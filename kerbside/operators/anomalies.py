"""Anomalous rows and temporal spikes."""

from pyspark.sql import DataFrame, functions as F

from kerbside.functions import columns as X
from kerbside.functions.ordered import Spread, quantiles
from kerbside.operators.windows import centred, hourly_counts, rolling

METHODS = ("combined", "zscore", "iqr")


def _flags(df, column, method, z_threshold, reach, spread):
    """Rows with ``__value``, ``__z`` and the two flags; null values flag false."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, choose from {', '.join(METHODS)}")
    rows = df.withColumn("__value", X.number(F.col(column)))
    no = F.lit(False)
    by_z = by_iqr = no
    drops = ["__value"]
    if method != "iqr":
        stats = rows.agg(F.avg("__value").alias("__mean"), F.stddev_samp("__value").alias("__std"))
        rows = rows.crossJoin(F.broadcast(stats)).withColumn(
            "__z", F.abs(F.try_divide(F.col("__value") - F.col("__mean"), F.col("__std"))))
        by_z = F.coalesce(F.col("__z") > z_threshold, no)
        drops += ["__mean", "__std", "__z"]
    if method != "zscore":
        q = quantiles(rows.select("__value"), "__value", {"__q1": 0.25, "__q3": 0.75}, spread=spread)
        width = (F.col("__q3") - F.col("__q1")) * reach
        rows = rows.crossJoin(F.broadcast(q))
        by_iqr = F.coalesce(
            (F.col("__value") < F.col("__q1") - width) | (F.col("__value") > F.col("__q3") + width), no)
        drops += ["__q1", "__q3"]
    return rows, by_z, by_iqr, drops


def detect(df: DataFrame, column="fine_amount", method="combined", z_threshold=3.0, reach=1.5,
           spread: Spread | None = None) -> DataFrame:
    """Rows flagged by z-score, by IQR fences, or by either, with reasons."""
    rows, by_z, by_iqr, drops = _flags(df, column, method, z_threshold, reach, spread)
    z_text = F.format_string("Z-score=%.2f; ", F.col("__z")) if method != "iqr" else F.lit("")
    return (
        rows.filter(by_z | by_iqr)
        .withColumns({
            "anomaly_reason": F.concat(
                F.when(by_z, z_text).otherwise(""), F.when(by_iqr, "IQR outlier; ").otherwise("")),
            "anomaly_col": F.lit(column),
            "anomaly_value": F.col("__value"),
        })
        .drop(*drops)
    )


def mark(df: DataFrame, column="fine_amount", method="combined", z_threshold=3.0, reach=1.5,
         spread: Spread | None = None) -> DataFrame:
    """Every row with ``is_anomaly``; no join, the flag needs only the row."""
    rows, by_z, by_iqr, drops = _flags(df, column, method, z_threshold, reach, spread)
    return rows.withColumn("is_anomaly", by_z | by_iqr).drop(*drops)


def exclude_by_key(df: DataFrame, members: DataFrame, key="violation_id") -> DataFrame:
    """Rows whose key is not among the members (anti-join).

    Members are made distinct first, so a hot key does not pile up.
    """
    return df.join(members.select(key).distinct(), key, "left_anti")


def keep_by_key(df: DataFrame, members: DataFrame, key="violation_id") -> DataFrame:
    """Rows whose key is among the members (semi-join)."""
    return df.join(members.select(key).distinct(), key, "left_semi")


def temporal_spikes(df: DataFrame, window=3, k=2.0, timeline=False, exclude_current=False) -> DataFrame:
    """Hours whose count exceeds rolling mean + k deviations.

    A window that includes the tested hour cannot exceed k = 2 below six rows;
    ``exclude_current`` tests each hour against its neighbours only.
    """
    hourly = hourly_counts(df, timeline)
    if exclude_current:
        w = centred(window)
        n, total = F.count("count").over(w) - 1, F.sum("count").over(w) - F.col("count")
        squares = F.sum(F.col("count") * F.col("count")).over(w) - F.col("count") * F.col("count")
        mean = F.try_divide(total, n)
        variance = F.try_divide(squares - total * mean, n - 1)
        stats = hourly.select(
            "hour", "count",
            mean.alias("rolling_mean"),
            F.coalesce(F.sqrt(F.greatest(variance, F.lit(0.0))), F.lit(0.0)).alias("rolling_std"),
        )
    else:
        stats = rolling(hourly, window)
    mean, std = F.col("rolling_mean"), F.col("rolling_std")
    low = F.round(F.greatest(mean - std, F.lit(0.0))).cast("long").cast("string")
    high = F.round(mean + std).cast("long").cast("string")
    return stats.filter(F.col("count") > mean + std * k).select(
        "hour", "count", F.concat(low, F.lit("–"), high).alias("expected_range"))
