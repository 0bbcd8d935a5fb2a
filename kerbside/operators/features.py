"""Derived columns: normalised values, risk score, buckets, encodings."""

from pyspark.sql import DataFrame, functions as F

from kerbside import contract as C
from kerbside.functions import columns as X
from kerbside.functions.ordered import Spread, attach, cumulate, quantiles, spreads, value_counts

METHODS = ("minmax", "zscore", "robust")


def normalise(df: DataFrame, column, method="minmax", alias=None, spread: Spread | None = None) -> DataFrame:
    """Append a scaled copy of a numeric column.

    The statistics are one broadcast row, not an unpartitioned window. A
    constant column scales to 0.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, choose from {', '.join(METHODS)}")
    if column not in df.columns:
        return df
    out = alias or f"{column}_norm"
    value = F.col(column).cast("double")
    if method == "minmax":
        stats = df.agg(F.min(value).alias("__mid"), (F.max(value) - F.min(value)).alias("__width"))
    elif method == "zscore":
        stats = df.agg(F.avg(value).alias("__mid"), F.stddev_samp(value).alias("__width"))
    else:
        stats = quantiles(df, column, {"__mid": 0.5, "__q1": 0.25, "__q3": 0.75}, spread=spread).select("__mid", (F.col("__q3") - F.col("__q1")).alias("__width"))
    scaled = (value - F.col("__mid")) / F.when(F.col("__width") > 0, F.col("__width"))
    return (
        df.crossJoin(F.broadcast(stats))
        .withColumn(out, F.when(F.col("__width") > 0, scaled).otherwise(F.lit(0.0)))
        .drop("__mid", "__width")
    )


def normalise_minmax(df: DataFrame, names: dict) -> DataFrame:
    """Min-max scale several columns (column -> alias) with one statistics pass."""
    names = {c: alias for c, alias in names.items() if c in df.columns}
    stats = df.agg(*[
        agg for c in names for agg in (
            F.min(F.col(c).cast("double")).alias(f"__lo_{c}"), F.max(F.col(c).cast("double")).alias(f"__hi_{c}"))])
    out = {}
    for c, alias in names.items():
        width = F.col(f"__hi_{c}") - F.col(f"__lo_{c}")
        scaled = (F.col(c).cast("double") - F.col(f"__lo_{c}")) / F.when(width > 0, width)
        out[alias] = F.when(width > 0, scaled).otherwise(F.lit(0.0))
    return df.crossJoin(F.broadcast(stats)).withColumns(out).drop(*stats.columns)


def percent_rank_average(df: DataFrame, column, name, spread: Spread | None = None) -> DataFrame:
    """Average rank over the non-null count, ties sharing their mean rank.

    Ranks are worked out per distinct value and joined back to the rows.
    """
    spread = spread or spreads(df, [column])[column]
    counts = value_counts(df.filter(F.col(column).isNotNull()), column)
    ranks = cumulate(counts, column, [], spread).select(
        column, ((F.col("below") + (F.col("n") + 1) / 2) / F.col("total")).alias(name))
    return attach(df, ranks, [column], "left", rows=spread.distinct)


def add_risk_score(df: DataFrame, spread: Spread | None = None) -> DataFrame:
    """0-100: severity weight, speed against the maximum, rank of the fine."""
    severity = X.lookup(F.col("severity"), C.SEVERITY_WEIGHTS, 0.0)
    speed = fine = F.lit(0.0)
    drops = []
    if "fine_amount" in df.columns:
        df = percent_rank_average(df, "fine_amount", "__rank", spread)
        fine = F.col("__rank")
        drops.append("__rank")
    if "speed_kmh" in df.columns:
        top = df.agg(F.max("speed_kmh").alias("__top")).select(
            F.when(F.col("__top") == 0, 1.0).otherwise(F.col("__top")).alias("__top"))
        df = df.crossJoin(F.broadcast(top))
        speed = F.col("speed_kmh") / F.col("__top")
        drops.append("__top")
    mix = C.RISK_MIX
    score = severity * mix["severity"] + speed * mix["speed"] + fine * mix["fine"]
    return df.withColumn("risk_score", X.rounded(score, 1)).drop(*drops)


def add_tiers(df: DataFrame) -> DataFrame:
    """Speed category, fine tier and the fixed-bounds speed scale."""
    df = df.na.drop(subset=["violation_type", "zone", "severity"])
    if "is_peak" not in df.columns:
        df = df.withColumn("is_peak", X.is_peak(F.col("hour")))
    low, high = C.BOUNDS["speed_kmh"]
    return df.withColumns({
        "speed_category": X.speed_category(F.col("speed_kmh")),
        "fine_tier": X.fine_tier(F.col("fine_amount")),
        "speed_norm_spark": (F.col("speed_kmh") - low) / (high - low),
    })


def encode(df: DataFrame, zones=None) -> DataFrame:
    """Ordinal codes and one flag per zone.

    The zone list comes from the contract, so the schema is known without
    looking at the data; pass another list for other data.
    """
    zones = sorted([*C.ZONES, C.UNKNOWN]) if zones is None else zones
    out = {}
    if "severity" in df.columns:
        out["severity_code"] = X.lookup(F.col("severity"), C.SEVERITY_CODES)
    for flag in ("is_peak", "is_weekend"):
        if flag in df.columns:
            out[f"{flag}_code"] = F.col(flag).cast("int")
    if "zone" in df.columns:
        for z in zones:
            out[f"zone_{z}"] = F.col("zone").eqNullSafe(F.lit(z))
    return df.withColumns(out)
