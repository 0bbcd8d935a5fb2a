"""Flat table -> star schema."""

from pyspark.sql import DataFrame, functions as F

from kerbside.functions.ordered import SLAB_ROWS, attach, number_rows
from kerbside.session import stage

# Dimension -> (surrogate key, natural key columns).
DIMENSIONS = {
    "dim_time": ("time_id", ["hour", "day_of_week", "is_weekend", "is_peak"]),
    "dim_location": ("loc_id", ["zone", "latitude", "longitude"]),
    "dim_vehicle": ("veh_id", ["vehicle_type"]),
}
FACT_COLUMNS = ["violation_id", "violation_type", "severity", "speed_kmh", "fine_amount", "fine_is_outlier",
                "risk_score", "speed_norm", "fine_norm", "ingested_at", "pipeline_run"]


def dimension(df: DataFrame, name, cut=stage, slab_rows=SLAB_ROWS):
    """Distinct natural keys, numbered 1..n in key order, and their count."""
    key, natural = DIMENSIONS[name]
    natural = [c for c in natural if c in df.columns]
    if not natural:
        spark = df.sparkSession
        if name == "dim_location":
            return spark.createDataFrame([], f"{key} long"), 0
        row = (1, 0) if name == "dim_time" else (1, "Unknown")
        return spark.createDataFrame([row], f"{key} long, {DIMENSIONS[name][1][0]} {'int' if row[1] == 0 else 'string'}"), 1
    keys = cut(df.select(*natural).distinct())
    size = keys.count()
    return number_rows(keys, natural, key, slab_rows=slab_rows, rows=size).select(key, *natural), size


def star_schema(df: DataFrame, cut=stage, slab_rows=SLAB_ROWS) -> dict:
    """All dimensions and the fact table.

    Natural keys are matched null-safely and stay in the fact. A dimension is
    broadcast only if its counted size allows; the location dimension may be as
    large as the facts and is then joined by shuffle.
    """
    built = {name: dimension(df, name, cut, slab_rows) for name in DIMENSIONS}
    present = [c for c in FACT_COLUMNS if c in df.columns]
    natural = [c for _, cols in DIMENSIONS.values() for c in cols if c in df.columns]
    fact = df.select(*present, *[c for c in natural if c not in present])
    for name, (table, size) in built.items():
        cols = [c for c in DIMENSIONS[name][1] if c in df.columns]
        if cols:
            fact = attach(fact, table, cols, "left", rows=size)
    return {name: table for name, (table, _) in built.items()} | {"fact_violation": fact}


def row_counts(tables: dict) -> DataFrame:
    """(table, rows) for each non-empty table."""
    parts = [t.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, t in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter("rows > 0")
