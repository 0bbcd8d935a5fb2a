"""From loosely shaped input to the contract: headers, types, keys, categories."""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from kerbside import contract as C
from kerbside.functions import columns as X


def normalise_headers(df: DataFrame, aliases=None) -> DataFrame:
    """Rename known spellings; several spellings of one column are coalesced,
    the canonical one first."""
    aliases = C.HEADER_ALIASES if aliases is None else aliases
    sources = {}
    for name in df.columns:
        sources.setdefault(aliases.get(name, name), []).append(name)
    out = []
    for target, names in sources.items():
        names = sorted(names, key=lambda n: n != target)
        out.append((F.coalesce(*[F.col(f"`{n}`") for n in names]) if len(names) > 1 else F.col(f"`{names[0]}`"))
                   .alias(target))
    return df.select(*out)


def cast_contract(df: DataFrame, types=None) -> DataFrame:
    """Contract columns in contract types: text trimmed, bad numbers null,
    absent columns null. Other columns pass through."""
    types = C.RAW_TYPES if types is None else types
    out = []
    for name in df.columns:
        kind = types.get(name)
        if kind is None:
            out.append(F.col(name))
        elif kind == "double":
            out.append(X.number(F.col(name)).alias(name))
        else:
            out.append(F.trim(F.col(name).cast("string")).alias(name))
    out += [F.lit(None).cast(kind).alias(name) for name, kind in types.items() if name not in df.columns]
    return df.select(*out)


def drop_empty(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows in which every column is null."""
    return df.na.drop("all", subset=subset or df.columns)


def add_provenance(df: DataFrame, run_at: str) -> DataFrame:
    """Load time and run id. Both come from ``run_at``, so a rerun repeats."""
    return df.withColumns({
        "ingested_at": F.lit(run_at),
        "pipeline_run": F.substring(F.md5(F.lit(run_at)), 1, 8),
    })


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def keep_first(df: DataFrame, key="violation_id", order=("row_seq",)) -> DataFrame:
    """First row per key in an explicit order; null keys are one group.

    The filter on ``row_number`` lets Spark cut each group to one row before
    the shuffle, so a key that holds a third of the rows costs no more than
    any other.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__first", F.row_number().over(first)).filter("__first = 1").drop("__first")


def drop_required_nulls(df: DataFrame, required=None) -> DataFrame:
    required = [c for c in (required or C.REQUIRED) if c in df.columns]
    return df.na.drop(subset=required)


def standardise_categories(df: DataFrame) -> DataFrame:
    """Canonical spellings; values outside the contract become 'Unknown'."""
    rules = {
        "violation_type": X.canonical_type,
        "zone": X.canonical_zone,
        "vehicle_type": X.title_case,
    }
    return df.withColumns({c: rule(F.col(c)) for c, rule in rules.items() if c in df.columns})


def add_time_features(df: DataFrame) -> DataFrame:
    """Parse ``timestamp`` and derive hour, day name, weekend and peak flags."""
    if "timestamp" not in df.columns:
        return df
    df = df.withColumn("timestamp", X.moment(F.col("timestamp")))
    return df.withColumns({
        "hour": F.hour("timestamp"),
        "day_of_week": X.day_name(F.col("timestamp")),
        "is_weekend": X.is_weekend(F.col("timestamp")),
        "is_peak": X.is_peak(F.hour("timestamp")),
    })


def add_severity(df: DataFrame) -> DataFrame:
    return df.withColumn("severity", X.severity(F.col("violation_type"), F.col("speed_kmh")))


def prefix_filter(df: DataFrame, column, prefix) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))
