"""Ordered computations that never put an unbounded group into one task.

Two families:

* by value  - ranks and exact quantiles. Rows are first folded to one row per
  distinct value (map-side combine, so a hot value costs one row), then the
  distinct values are cut into slabs of bounded size and counts are carried
  from slab to slab.
* by row    - numbering and lag. Rows are range-partitioned on their total
  order and written once; slab totals then carry positions across slabs.

Each has a size check first. Below ``slab_rows`` one window per group is the
cheaper plan and is used instead; both give the same result.
"""

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from kerbside.session import stage

SLAB_ROWS = 1_000_000
# Distinct values that cut points are taken from.
SKETCH_VALUES = 1_000_000
# Lookup tables up to this many rows are broadcast; larger ones are joined by
# shuffle, where AQE splits skewed partitions.
BROADCAST_ROWS = 100_000

_SLAB = "__slab"


@dataclass(frozen=True)
class Spread:
    """How a numeric column spreads: its rows, an upper bound of its distinct
    values, and cut points that split them evenly (none if one slab will do)."""

    rows: int
    distinct: int
    cuts: tuple = ()


def spreads(df: DataFrame, columns, slab_rows=SLAB_ROWS) -> dict:
    """``Spread`` of each column.

    A count settles small inputs. Larger ones get a distinct-count sketch, and
    only columns with more distinct values than a slab holds get cut points.
    Slabs hold distinct values, so the cuts are taken from those, however often
    each occurs: a sample by the hash of the value, folded before it is ranked.
    Cuts are finite; NaN and the infinities lie beyond all of them, as they do
    in the order of values. Any cut points give the same results.
    """
    rows = df.count()
    if rows <= slab_rows:
        return {c: Spread(rows, rows) for c in columns}
    sketch = df.agg(*[F.approx_count_distinct(c, 0.05).alias(c) for c in columns]).first()
    # 5 % standard error: 1.5 covers ten standard errors.
    distinct = {c: min(rows, math.ceil(sketch[c] * 1.5) + 1) for c in columns}
    slabs = {c: math.ceil(distinct[c] / slab_rows) for c in columns}
    cuts = {}
    for c in (c for c in columns if slabs[c] > 1):
        number = F.col(c).try_cast("double")
        share = F.lit(max(1, distinct[c] // max(SKETCH_VALUES, 20 * slabs[c])))
        values = df.select(number.alias("v")).where(F.pmod(F.xxhash64("v"), share) == 0).distinct()
        finite = values.where(F.abs("v") < math.inf)
        marks = F.array(*[F.lit(i / slabs[c]) for i in range(1, slabs[c])])
        cuts[c] = finite.agg(F.percentile_approx("v", marks, F.lit(max(10_000, 20 * slabs[c])))).first()[0]
    return {c: Spread(rows, distinct[c], tuple(sorted(set(cuts.get(c) or ())))) for c in columns}


def attach(df: DataFrame, small: DataFrame, on, how="inner", rows=None) -> DataFrame:
    """Equi-join null-safely on same-named columns.

    ``rows`` is a proven upper bound of ``small``. It is broadcast when the
    bound is low enough; otherwise Spark shuffles both sides and splits skew.
    """
    if rows is not None and rows <= BROADCAST_ROWS:
        small = F.broadcast(small)
    right = small.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in small.columns])
    test = F.lit(True)
    for c in on:
        test = test & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return df.join(right, test, how).drop(*[f"__r_{c}" for c in on])


def value_counts(df: DataFrame, value, by=()) -> DataFrame:
    """One row per distinct (by..., value) with its count ``n``."""
    return df.groupBy(*by, value).agg(F.count("*").alias("n"))


def cumulate(counts: DataFrame, value, by, spread: Spread) -> DataFrame:
    """Per distinct value: rows and distinct values below it, and group totals.

    ``counts`` has columns (by..., value, n). Adds ``below``, ``distinct_below``,
    ``total`` and ``distinct_total``. A null value sorts lowest.
    """
    by = list(by)
    if not spread.cuts:
        group = Window.partitionBy(*[F.col(c) for c in by])
        running = group.orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        return counts.select(
            "*",
            F.coalesce(F.sum("n").over(running), F.lit(0)).alias("below"),
            F.coalesce(F.count(F.lit(1)).over(running), F.lit(0)).alias("distinct_below"),
            F.sum("n").over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
            F.count(F.lit(1)).over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            .alias("distinct_total"),
        )
    slabbed = _with_slab(counts, value, spread.cuts)
    local = Window.partitionBy(*by, _SLAB).orderBy(F.col(value).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    inside = slabbed.select(
        "*",
        F.coalesce(F.sum("n").over(local), F.lit(0)).alias("__below"),
        F.coalesce(F.count(F.lit(1)).over(local), F.lit(0)).alias("__distinct_below"),
    )
    # One row per slab and group from here on.
    totals = slabbed.groupBy(*by, _SLAB).agg(F.sum("n").alias("__n"), F.count("*").alias("__d"))
    group = Window.partitionBy(*[F.col(c) for c in by])
    before = group.orderBy(_SLAB).rowsBetween(Window.unboundedPreceding, -1)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = totals.select(
        *by, _SLAB,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__carry"),
        F.coalesce(F.sum("__d").over(before), F.lit(0)).alias("__carry_d"),
        F.sum("__n").over(whole).alias("total"),
        F.sum("__d").over(whole).alias("distinct_total"),
    )
    return attach(inside, carried, [*by, _SLAB]).select(
        *counts.columns,
        (F.col("__below") + F.col("__carry")).alias("below"),
        (F.col("__distinct_below") + F.col("__carry_d")).alias("distinct_below"),
        "total", "distinct_total",
    )


def _with_slab(counts, value, cuts):
    """Slab number by binary search over the cut points, on the JVM."""
    helper = "__as_double"
    finder = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=helper, outputCol=_SLAB, handleInvalid="keep")
    ready = counts.withColumn(helper, F.coalesce(F.col(value).try_cast("double"), F.lit(-math.inf)))
    return finder.transform(ready).drop(helper).withColumn(_SLAB, F.col(_SLAB).cast("int"))


def quantiles(df: DataFrame, value, probs: dict, by=(), spread: Spread | None = None, weight=None,
              slab_rows=SLAB_ROWS, accuracy=None) -> DataFrame:
    """Exact quantiles with linear interpolation; nulls are ignored.

    ``probs`` maps output column -> probability; ``weight`` names a count
    column. One row per group (one row in all without ``by``). Few rows go
    through the built-in aggregate; more are folded to value counts first.
    With ``accuracy`` the answer is Spark's sketch instead: one pass, an
    element of the data whose rank is off by at most 1/accuracy.
    """
    by = list(by)
    if accuracy:
        rough = F.percentile_approx(F.col(value).try_cast("double"), [float(p) for p in probs.values()], accuracy)
        return df.groupBy(*by).agg(rough.alias("__q")).select(
            *by, *[F.col("__q")[i].alias(name) for i, name in enumerate(probs)])
    spread = spread or spreads(df, [value], slab_rows)[value]
    marks = [float(p) for p in probs.values()]
    if not spread.cuts and spread.rows <= slab_rows:
        all_marks = F.array(*[F.lit(p) for p in marks])
        found = df.groupBy(*by).agg(F.percentile(
            F.col(value).try_cast("double"), all_marks, F.col(weight) if weight else F.lit(1)).alias("__q"))
        return found.select(*by, *[F.col("__q")[i].alias(name) for i, name in enumerate(probs)])
    known = df.withColumn(value, F.col(value).try_cast("double")).filter(F.col(value).isNotNull())
    counts = known.groupBy(*by, value).agg((F.sum(weight) if weight else F.count("*")).alias("n"))
    table = cumulate(counts, value, by, spread)
    picks = []
    for i, p in enumerate(marks):
        position = F.lit(p) * (F.col("total") - 1)
        for suffix, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("below") <= at) & (at < F.col("below") + F.col("n"))
            picks.append(F.max(F.when(here, F.col(value).cast("double"))).alias(f"__{suffix}{i}"))
    found = table.groupBy(*by).agg(*picks, F.max("total").alias("__total"))
    if by:
        # Groups with nothing but nulls keep their row.
        found = attach(df.select(*by).distinct(), found, by, "left")
    out = []
    for i, (name, p) in enumerate(zip(probs, marks)):
        position = F.lit(p) * (F.col("__total") - 1)
        low, high, floor, ceil = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.floor(position), F.ceil(position)
        between = (ceil - position) * low + (position - floor) * high
        out.append(F.when((floor == ceil) | (low == high), low).otherwise(between).alias(name))
    return found.select(*by, *out)


def values_at(df: DataFrame, value, parts, slab_rows=SLAB_ROWS) -> list:
    """The values at positions ``rows * k // parts``, ``k`` from 1 to ``parts - 1``, of a column of any type in its order.

    Exact, from the counts of all values; nulls are ignored. Each value once and ascending, none for no rows. Value
    counts are cut into slabs by the value itself, of which no task holds more than one.
    """
    counts = stage(value_counts(df.select(F.col(value).alias("value")).where(F.col("value").isNotNull()), "value"), "value-counts")
    distinct, rows = counts.agg(F.count("*"), F.sum("n")).first()
    if not distinct:
        return []
    up_to = lambda *slab: F.sum("n").over(Window.partitionBy(*slab).orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    if distinct <= slab_rows:
        placed = counts.withColumn("__up_to", up_to())
    else:
        slabbed = _slabs_of(counts, [], ["value"], slab_rows, distinct)
        before = Window.orderBy(_SLAB).rowsBetween(Window.unboundedPreceding, -1)
        # One row per slab.
        carried = slabbed.groupBy(_SLAB).agg(F.sum("n").alias("__n")).select(
            _SLAB, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__carry"))
        placed = _carry_over(slabbed, carried, [_SLAB]).withColumn("__up_to", up_to(_SLAB) + F.col("__carry"))
    hit = F.lit(False)
    for at in sorted({rows * k // parts for k in range(1, parts)}):
        hit = hit | ((F.col("__up_to") > at) & (F.col("__up_to") - F.col("n") <= at))
    return [r[0] for r in placed.where(hit).select("value").orderBy("value").collect()]


# --- by row -----------------------------------------------------------------


def _slabs_of(df, by, order, slab_rows, rows):
    """Rows range-partitioned on (by, order), written once, with their slab
    and their position inside it. The write fixes the slab of every row, so
    that totals and rows agree even if tasks are run again."""
    parts = math.ceil(rows / slab_rows)
    placed = (
        df.repartitionByRange(parts, *by, *order)
        .sortWithinPartitions(*by, *order)
        .withColumn("__mark", F.monotonically_increasing_id())
    )
    # Spark's ids are (partition number << 33) + row number in the partition.
    placed = placed.select(
        *df.columns,
        F.shiftright("__mark", 33).alias(_SLAB),
        F.col("__mark").bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"),
    )
    return stage(placed, "slabs")


def _carry_over(rows, carried, on):
    """Join slab carries back; they are few, so their true count is checked."""
    carried = stage(carried, "carries")
    return attach(rows, carried, on, rows=carried.count())


def number_rows(df: DataFrame, order, name, by=(), start=1, slab_rows=SLAB_ROWS, rows=None) -> DataFrame:
    """Contiguous numbers per group in a total order, from ``start``."""
    by, order = list(by), list(order)
    rows = df.count() if rows is None else rows
    if rows <= slab_rows:
        w = Window.partitionBy(*[F.col(c) for c in by]).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("long") + F.lit(start - 1))
    placed = _slabs_of(df, by, order, slab_rows, rows)
    sizes = placed.groupBy(*by, _SLAB).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy(*[F.col(c) for c in by]).orderBy(_SLAB).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *by, _SLAB, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__carry"))
    numbered = _carry_over(placed, offsets, [*by, _SLAB])
    return numbered.select(*df.columns, (F.col("__at") + F.col("__carry") + F.lit(start)).alias(name))


def previous_value(df: DataFrame, value, order, name, by=(), slab_rows=SLAB_ROWS, rows=None) -> DataFrame:
    """Value of the row before, per group in a total order."""
    by, order = list(by), list(order)
    rows = df.count() if rows is None else rows
    if rows <= slab_rows:
        return df.withColumn(name, F.lag(value, 1).over(Window.partitionBy(*by).orderBy(*order)))
    placed = _slabs_of(df, by, order, slab_rows, rows)
    inside = placed.select(
        "*",
        F.lag(F.struct(F.col(value).alias("v")), 1).over(Window.partitionBy(*by, _SLAB).orderBy("__at")).alias("__near"),
    )
    tails = placed.groupBy(*by, _SLAB).agg(F.max_by(F.struct(F.col(value).alias("v")), "__at").alias("__tail"))
    carried = tails.select(
        *by, _SLAB, F.lag("__tail", 1).over(Window.partitionBy(*by).orderBy(_SLAB)).alias("__far"))
    joined = _carry_over(inside, carried, [*by, _SLAB])
    return joined.select(*df.columns, F.coalesce("__near", "__far")["v"].alias(name))
