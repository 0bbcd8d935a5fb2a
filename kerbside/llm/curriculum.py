"""Mix sources to target weights that change over training: a time-varying curriculum.

Every source has a schedule, its weight as a piecewise linear function of training time from 0 to 1. The integral of
the schedule is the source's share of the mix; shares above a number of repeats of what the source has stop there, and
the rest is shared anew. The same integral, taken up to a time, is the cumulative demand for the source's words. Its
inverse gives every copy of a document the time at which its first word is due, and sorting by that time is the order
of training.

Documents of a source stand in the order of a digest of id and text, so a rerun gives the same mix. The last document
that a source needs is cut where the demand ends, so that every source gives its target to the word.

Everything is built-in functions. A running sum over a source is taken in runs of bounded size, which follow the
digest, so that a source with any share of the rows is spread over tasks. Sources are a table and may be many.

Defined results: a null text has no words, its document takes none; nulls are a source of their own, the last; rows
of equal id and text are rows of their own, next to each other in order; an empty table has no rows; other columns are
not read.
"""

import math
from decimal import Decimal

from pyspark.sql import Window, functions as F

from kerbside.functions.ordered import attach, number_rows
from kerbside.session import stage

#: Rows that a running sum covers in one task.
RUN_ROWS = 20_000

BLANKS = " \t\n\x0b\f\r"


def count_words(text):
    """The number of maximal runs of other than blanks, without a list of them."""
    runs = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.translate(runs, BLANKS, "")).cast("long")


def sized(docs, id_col="doc_id", text_col="text", source_col="source"):
    """``doc_id``, ``source``, ``size`` in words and ``place``, the digest that documents are ordered by."""
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    place = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return docs.select(key.alias("doc_id"), F.col(f"`{source_col}`").alias("source"), count_words(text).alias("size"), place.alias("place"))


def alternating(sources, weights=(1, 2, 3), swing=0.5):
    """``sources`` with ``knots``: weights in turn, by code point with null last, that fall and rise in turn by ``swing``.

    Each schedule's mean over training is its weight.
    """
    numbered = number_rows(sources, [F.col("source").asc_nulls_last()], "__k", start=0)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("__k", F.lit(len(weights))).cast("int"))
    tilt = F.when(F.col("__k") % 2 == 0, F.lit(swing)).otherwise(F.lit(-swing))
    knot = lambda t, by: F.struct(F.lit(float(t)).alias("t"), (weight * by).alias("w"))
    return numbered.withColumn("knots", F.array(knot(0, 1 + tilt), knot(1, 1 - tilt))).drop("__k")


def integrated(schedules):
    """``segments`` of the schedules in ``knots`` (an array of ``t`` and ``w``, from 0 to 1) and their integral ``weight``.

    A segment has its first time and weight, its slope, and the integral ``before`` it.
    """
    area = "(knots[j].t - knots[j - 1].t) * (knots[j].w + knots[j - 1].w) / 2"
    before = f"aggregate(sequence(0, i), 0D, (a, j) -> a + if(j = 0, 0D, {area}))"
    return schedules.withColumns({
        "segments": F.expr(f"""transform(sequence(0, size(knots) - 2), i -> named_struct('t', knots[i].t, 'w', knots[i].w,
            'slope', (knots[i + 1].w - knots[i].w) / (knots[i + 1].t - knots[i].t), 'before', {before}))"""),
        "weight": F.expr(before.replace("sequence(0, i)", "sequence(0, size(knots) - 1)")),
    })


def due(segments, demand):
    """The time at which the integral of a schedule reaches ``demand``: the inverse, in closed form on each segment."""
    found = F.element_at(F.filter(segments, lambda s: s["before"] <= demand), -1)
    rest = demand - found["before"]
    root = F.sqrt(F.greatest(F.lit(0.0), found["w"] * found["w"] + 2 * found["slope"] * rest))
    return F.when(rest > 0, found["t"] + 2 * rest / (found["w"] + root)).otherwise(found["t"])


def targets(sources, repeats=3):
    """``target`` of every row of ``sources`` (``source_size`` in words, ``weight``): shares of the sum of all sizes.

    A share above ``repeats`` times its source stops there and the excess is shared by weight among the others, until
    none is above. A round is one aggregate; rounds end when no further source has been stopped.
    """
    exact = "decimal(38,12)"
    cap = (F.col("source_size") * F.lit(repeats)).cast("double")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    rest, weights, stopped = total, sources.agg(F.sum(F.col("weight").cast(exact))).first()[0] or Decimal(0), 0
    share = F.lit(0.0)
    while weights > 0:
        share = F.lit(float(rest)) * F.col("weight") / F.lit(float(weights))
        over = cap <= share
        # Whole numbers and decimals, so that no sum depends on the order of rows.
        capped, left, now = sources.agg(
            F.sum(F.when(over, F.col("source_size") * F.lit(repeats))), F.sum(F.when(~over, F.col("weight").cast(exact))),
            F.count(F.when(over, 1))).first()
        if now <= stopped:
            break
        rest, weights, stopped = total - capped, left or Decimal(0), now
    # With all of them stopped, every target is its cap.
    return sources.withColumn("target", F.least(cap, share) if weights > 0 else cap)


def _starts(docs, run_rows):
    """``docs`` with ``start``: the words of the source's documents that stand before."""
    rows = docs.count()
    runs = max(1, math.ceil(rows / run_rows))
    # Runs are cut by the digest, so they follow each other in the order of documents.
    dealt = docs.withColumn("__run", F.expr(f"cast(conv(substring(place, 1, 8), 16, 10) as long) * {runs}L div 4294967296L"))
    within = Window.partitionBy("source", "__run").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("__inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    before = Window.partitionBy("source").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage(dealt.groupBy("source", "__run").agg(F.sum("size").alias("__n")).select(
        "source", "__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")), "runs")
    return attach(inside, sums, ["source", "__run"], rows=sums.count()).withColumn(
        "start", F.col("__before") + F.col("__inside")).drop("__run", "__inside", "__before")


def mix(docs, schedules=alternating, repeats=3, id_col="doc_id", text_col="text", source_col="source", run_rows=RUN_ROWS):
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``, ``copies``, ``place``.

    ``schedules`` turns a table of ``source`` into one with ``knots``. ``copies`` is a list of ``position`` (the time at
    which the copy is due) and ``words`` (less than the size only where the demand ends), ``taken`` their sum.
    """
    rows = stage(sized(docs, id_col, text_col, source_col), "sizes")
    sources = stage(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    plan = schedules(sources.select("source"))
    planned = stage(integrated(attach(sources, plan, ["source"])), "schedules")
    known = stage(targets(planned, repeats), "targets")
    laid = attach(_starts(rows, run_rows), known, ["source"], rows=known.count())
    budget = F.floor(F.col("target") + 0.5)
    begins = lambda e: e * F.col("source_size") + F.col("start")
    words = lambda e: F.greatest(F.lit(0), F.least(F.col("size"), F.col("__budget") - begins(e)))
    copy = lambda e: F.struct(due(F.col("segments"), begins(e) / F.col("__budget") * F.col("weight")).alias("position"), words(e).alias("words"))
    taken = laid.withColumn("__budget", budget).withColumn("copies", F.when(F.col("__budget") > 0, F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), F.lit(repeats - 1).cast("long")), lambda e: words(e) > 0), copy))
        .otherwise(F.array().cast("array<struct<position:double,words:bigint>>")))
    total = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return taken.select("doc_id", "source", "size", "source_size", "target", total.alias("taken"), "copies", "place")


def ordered_by_due(mixed):
    """``mixed`` with ``first_position``, the time of a document's first copy, range-sorted by it; untaken ones at the end."""
    # Sorting samples its input, which must not be worked out twice.
    known = stage(mixed.withColumn("first_position", F.get("copies", F.lit(0))["position"]), "mix")
    return known.orderBy(F.col("first_position").asc_nulls_last(), "place", "doc_id")


def training_order(mixed, run_rows=RUN_ROWS):
    """One row per copy: ``slot`` (its place in training, from 0), ``position``, ``doc_id``, ``source``, ``words``."""
    copies = stage(mixed.select("doc_id", "source", "place", F.inline("copies")), "copies")
    numbered = number_rows(copies, ["position", "place", "doc_id", "words"], "slot", start=0, slab_rows=run_rows)
    return numbered.select("slot", "position", "doc_id", "source", "words")
