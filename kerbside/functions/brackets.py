"""Exact order statistics of several columns in two scans of the rows.

The first scan sketches a grid of quantiles for every statistic. The second
folds rows to value counts, but only inside a bracket of ranks around what is
asked for: all that lies below it folds to minus infinity, all above it to
plus infinity. The order statistics of what is left are those of the column.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kerbside.functions.ordered import attach
from kerbside.session import stage

# Steps of the grid, and the inverse of the sketch's error in rank: a tenth of a step.
STEPS, ACCURACY = 200, 2000


@dataclass(frozen=True)
class Wanted:
    """An order statistic: the quantile ``prob`` of ``value`` per group of ``by``.

    With ``filled`` it is wanted of the column with its nulls filled by values
    that are not known yet, which may move it by as many ranks as there are
    nulls.
    """

    name: str
    value: str
    prob: float
    by: tuple = ()
    filled: bool = False


def _entries(wanted, keys, value_of):
    """One struct per statistic: its name, its group, its value."""
    key = lambda w, k: (F.col(k) if k in w.by else F.lit(None)).cast("string").alias(k)
    return F.array(*[F.struct(F.lit(w.name).alias("stat"), *[key(w, k) for k in keys], value_of(w).alias("value")) for w in wanted])


def _number(w):
    return F.col(w.value).try_cast("double")


def _limits(df, wanted, keys):
    """Per statistic and group the ``low`` and ``high`` end of its bracket; null where it has none."""
    grid = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    sketched = df.select(F.inline(_entries(wanted, keys, _number))).groupBy("stat", *keys).agg(
        F.percentile_approx("value", grid, F.lit(ACCURACY)).alias("grid"),
        F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("nulls"))
    prob = reduce(lambda c, w: c.when(F.col("stat") == w.name, w.prob), wanted, F.when(F.lit(False), 0.0))
    loose = F.when(F.col("stat").isin(*[w.name for w in wanted if w.filled]), F.col("nulls")).otherwise(0)
    # Ranks among the values alone, a step of the grid further out on either side.
    step = lambda rank: F.try_divide(rank * STEPS, F.col("n"))
    low = F.floor(step(prob * (F.col("n") - 1) - loose - 1)) - 1
    high = F.ceil(step(prob * (F.col("n") + loose) + 1)) + 1
    at = lambda i: F.when(i.between(0, STEPS), F.get("grid", i.cast("int")))
    return sketched.select("stat", *keys, at(low).alias("low"), at(high).alias("high"))


def bracketed(df: DataFrame, wanted, texts=(), groups=None) -> DataFrame:
    """A staged table (stat, by columns as text, value, text, n) of folded value counts; nulls are counted, too.

    ``texts`` names text columns that are counted beside, under their own
    names as ``stat``. ``groups`` is a proven bound of the number of groups.
    """
    keys = list(dict.fromkeys(k for w in wanted for k in w.by))
    limits = stage(_limits(df, wanted, keys), "brackets") if wanted else None
    rows = df
    for by in dict.fromkeys(w.by for w in wanted):
        own = [w for w in wanted if w.by == by]
        ends = limits.where(F.col("stat").isin(*[w.name for w in own])).groupBy(*[F.col(k).alias(f"__k_{k}") for k in by]).agg(*[
            F.max(F.when(F.col("stat") == w.name, F.col(end))).alias(f"__{end}_{w.name}") for w in own for end in ("low", "high")])
        if by:
            rows = rows.withColumns({f"__k_{k}": F.col(k).cast("string") for k in by})
            rows = attach(rows, ends, [f"__k_{k}" for k in by], "left", rows=groups).drop(*[f"__k_{k}" for k in by])
        else:
            rows = rows.crossJoin(F.broadcast(ends))

    def folded(w):
        value = _number(w)
        return F.when(value < F.col(f"__low_{w.name}"), float("-inf")).when(value > F.col(f"__high_{w.name}"), float("inf")).otherwise(value)

    none = F.lit(None).cast("string")
    parts = [F.transform(_entries(wanted, keys, folded), lambda e: F.struct(e["stat"].alias("stat"), *[e[k].alias(k) for k in keys], e["value"].alias("value"), none.alias("text")))] if wanted else []
    if texts:
        parts.append(F.array(*[F.struct(F.lit(c).alias("stat"), *[none.alias(k) for k in keys], F.lit(None).cast("double").alias("value"), F.col(c).cast("string").alias("text")) for c in texts]))
    counted = rows.select(F.inline(F.concat(*parts))).groupBy("stat", *keys, "value", "text").agg(F.count("*").alias("n"))
    return stage(counted, "bracketed")
