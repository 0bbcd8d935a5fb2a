"""Filling gaps, capping, and flagging outliers.

All statistics come from value counts near the wanted ranks, which are small
next to the rows.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kerbside import contract as C
from kerbside.functions import columns as X
from kerbside.functions.brackets import Wanted, bracketed
from kerbside.functions.ordered import SLAB_ROWS, Spread, attach, quantiles, value_counts
from kerbside.session import stage

COORDINATES = ("latitude", "longitude")
_PAIR = ["zone", "violation_type"]


def _one_row(df, row):
    return df.crossJoin(F.broadcast(row))


def _fine_statistics(of, spread, pairs):
    """From value counts (zone, type, value, n): the median per (zone, type);
    the overall median of the column so filled; its quartiles once capped.

    ``of`` has the counts for each of these; outside their brackets they may
    be folded.
    """
    medians = quantiles(of["fine"], "value", {"__fine": 0.5}, _PAIR, spread, "n")
    # What each pair's nulls are filled with; null where it has no value either.
    gaps = attach(of["fine"].where("value IS NULL").select(*_PAIR, "n"), medians, _PAIR, "left", pairs).select(F.col("__fine").alias("value"), "n")

    def with_gaps(name):
        known = of[name].where("value IS NOT NULL").select("value", "n").unionByName(gaps)
        return known.groupBy("value").agg(F.sum("n").alias("n"))

    overall = quantiles(with_gaps("fine_half"), "value", {"__fine_all": 0.5}, [], spread, "n")
    low, high = C.BOUNDS["fine_amount"]

    def capped(name, *probs):
        values = _one_row(with_gaps(name), overall).select(X.clip(F.coalesce("value", "__fine_all"), low, high).alias("value"), "n")
        return quantiles(values, "value", dict(probs), [], spread, "n")

    first, third = ("fine_q1", 0.25), ("fine_q3", 0.75)
    if of["fine_q1"] is of["fine_q3"]:
        return medians, overall.crossJoin(capped("fine_q1", first, third))
    return medians, overall.crossJoin(capped("fine_q1", first)).crossJoin(capped("fine_q3", third))


def most_common(df: DataFrame, column, name, weight=None) -> DataFrame:
    """The most frequent value, the smallest on a tie, as one row."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg((F.sum(weight) if weight else F.count("*")).alias("n"))
    return counts.agg(F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias(name))


def statistics(df: DataFrame, spread=None, pairs=None):
    """What filling needs: a table per (zone, type) and a table of one row.

    A count settles small inputs, whose value counts are small whatever they
    hold. Larger ones take two scans: one sketches, one counts the values near
    the wanted ranks. Both give the same statistics. ``spread`` (by column)
    forces the second with those cuts. ``pairs`` is a proven bound of the
    (zone, type) pairs, such as the contract's for standardised categories;
    None stands for unknown. Either table is None if its columns are absent.
    """
    have = set(df.columns)
    fine, speed = {"fine_amount", *_PAIR} <= have, {"speed_kmh", "violation_type"} <= have
    coordinates = [c for c in COORDINATES if c in have]
    if not (fine or speed or coordinates or "vehicle_type" in have):
        return None, None
    rows = df.count() if spread is None else None
    if rows is not None and rows <= SLAB_ROWS:
        whole = Spread(rows, rows)
        # Written once, because five statistics come from them.
        counted = stage(value_counts(df, "fine_amount", _PAIR).withColumnRenamed("fine_amount", "value"), "fines") if fine else None
        of = {name: counted for name in ("fine", "fine_half", "fine_q1", "fine_q3")}
        of |= {"speed": df.select("violation_type", F.col("speed_kmh").alias("value")) if speed else None}
        of |= {c: df.select(F.col(c).alias("value")) for c in coordinates}
        vehicles, weight, text = df, None, "vehicle_type"
        spread = dict.fromkeys(("fine_amount", "speed_kmh", *COORDINATES), whole)
    else:
        wanted = [
            *([Wanted("fine", "fine_amount", 0.5, tuple(_PAIR)), *[Wanted(name, "fine_amount", p, filled=True) for name, p in (("fine_half", 0.5), ("fine_q1", 0.25), ("fine_q3", 0.75))]] if fine else []),
            *([Wanted("speed", "speed_kmh", 0.5, ("violation_type",))] if speed else []),
            *[Wanted(c, c, 0.5) for c in coordinates]]
        counts = bracketed(df, wanted, ["vehicle_type"] if "vehicle_type" in have else [], pairs)
        of = {w.name: counts.where(F.col("stat") == w.name) for w in wanted}
        vehicles, weight, text = counts.where("stat = 'vehicle_type'"), "n", "text"
        if spread is None:
            held = counts.count()
            spread = dict.fromkeys(("fine_amount", "speed_kmh", *COORDINATES), Spread(held, held) if held <= SLAB_ROWS else None)
    groups, singles = None, []
    if fine:
        groups, fine_row = _fine_statistics(of, spread["fine_amount"], pairs)
        singles.append(fine_row)
    if speed:
        speeds = quantiles(of["speed"], "value", {"__speed": 0.5}, ["violation_type"], spread["speed_kmh"], weight)
        groups = speeds if groups is None else attach(groups, speeds, ["violation_type"], "left", pairs)
    if "vehicle_type" in have:
        singles.append(most_common(vehicles, text, "__vehicle", weight))
    singles += [quantiles(of[c], "value", {f"__{c}": 0.5}, [], spread[c], weight) for c in coordinates]
    return groups, reduce(DataFrame.crossJoin, singles) if singles else None


def impute(df: DataFrame, spread=None, keep_quartiles=False, pairs=None) -> DataFrame:
    """Fill the gaps of whichever columns are present.

    Fine: median of the (zone, type) group, else of the filled column. Speed:
    median of the type, else 0. Officer: 'UNKNOWN'. Vehicle: most common.
    Coordinates: median. With ``pairs``, a proven bound of the (zone, type)
    pairs, the rows meet two broadcast tables and nothing more; without it the
    table per pair is joined by shuffle.
    """
    have = set(df.columns)
    groups, single = statistics(df, spread, pairs)
    names = list(df.columns)
    if groups is not None:
        on = [c for c in _PAIR if c in groups.columns]
        df = attach(df, groups, on, "left", pairs)
    if single is not None:
        df = _one_row(df, single)
    fills = {
        "fine_amount": ["__fine", "__fine_all"] if _PAIR[0] in have else None,
        "speed_kmh": ["__speed", F.lit(0.0)],
        "officer_id": [F.lit(C.UNKNOWN_OFFICER)],
        "vehicle_type": ["__vehicle", F.lit(C.UNKNOWN)],
        "latitude": ["__latitude"],
        "longitude": ["__longitude"],
    }
    out = [F.coalesce(c, *fills[c]).alias(c) if fills.get(c) else F.col(c) for c in names]
    return df.select(*out, *(["fine_q1", "fine_q3"] if keep_quartiles else []))


def cap_values(df: DataFrame) -> DataFrame:
    """Clip speed and fine to their domains."""
    return df.withColumns({
        c: X.clip(F.col(c), *C.BOUNDS[c]) for c in ("speed_kmh", "fine_amount") if c in df.columns})


def flag_fine_outliers(df: DataFrame, spread=None) -> DataFrame:
    """True when the capped fine is outside Q1 - 3 IQR .. Q3 + 3 IQR, or null.

    Quartiles already at hand as ``fine_q1`` and ``fine_q3`` are used up.
    """
    if "fine_q1" not in df.columns:
        df = _one_row(df, quantiles(df, "fine_amount", {"fine_q1": 0.25, "fine_q3": 0.75}, spread=spread))
    reach = (F.col("fine_q3") - F.col("fine_q1")) * 3
    inside = X.within(F.col("fine_amount"), F.col("fine_q1") - reach, F.col("fine_q3") + reach)
    return df.withColumn("fine_is_outlier", ~inside).drop("fine_q1", "fine_q3")


def narrow_numbers(df: DataFrame) -> DataFrame:
    """Optional: double -> float and long -> int where all values fit.

    Floats lose digits, so pipelines leave this off.
    """
    longs = [name for name, kind in df.dtypes if kind == "bigint"]
    bounds = df.agg(*[F.min(c).alias(f"lo_{c}") for c in longs], *[F.max(c).alias(f"hi_{c}") for c in longs]).first() \
        if longs else {}
    fits = [c for c in longs if bounds[f"lo_{c}"] is not None
            and -2**31 <= bounds[f"lo_{c}"] and bounds[f"hi_{c}"] < 2**31]
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.col(c).cast("float") for c in doubles} | {c: F.col(c).cast("int") for c in fits})
