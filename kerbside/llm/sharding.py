"""Shards along a Hilbert curve over several metadata columns.

Each column is quantised by cut points that split all its rows evenly, found from the counts of its values. Rows are sorted by the index of their cell on the curve, numbered, and cut into runs of equal length, so that
every shard covers a compact box of all columns at once and a filter on any of them skips shards. Built-in functions
only: the transform of the coordinates is a fold over arrays.
"""

from pyspark.sql import functions as F

from kerbside.functions.ordered import number_rows, values_at
from kerbside.session import stage

#: Rows that one sort task numbers, and values that one task counts up.
RUN_ROWS = 20_000


def cut_points(df, columns, cells, slab_rows=RUN_ROWS):
    """For each column up to ``cells - 1`` increasing values that split all its rows evenly; nulls do not count."""
    return {c: values_at(df, c, cells, slab_rows) for c in columns}


def cell(column, cuts):
    """How many cut points a value has reached; a null is in the first cell."""
    return sum((F.coalesce((F.col(column) >= F.lit(c)).cast("int"), F.lit(0)) for c in cuts), F.lit(0))


def hilbert_index(cells, bits):
    """The index on the curve of an array column of coordinates below ``2 ** bits``: Skilling's transform.

    The array must have a column name; the result is a SQL expression over it.
    """
    n = "size(" + cells + ")"
    q = f"shiftleft(1, int({bits - 1} - s div {n}))"
    turned = f"""aggregate(sequence(0, {bits - 1} * {n} - 1), {cells}, (x, s) -> transform(x, (v, j) ->
        case when (x[int(s % {n})] & {q}) <> 0 then if(j = 0, v ^ ({q} - 1), v)
             when j = 0 or j = s % {n} then v ^ ((x[0] ^ x[int(s % {n})]) & ({q} - 1)) else v end))""" if bits > 1 else cells
    gray = f"transform({turned}, (v, j) -> v)"
    summed = "transform(g, (v, j) -> aggregate(slice(g, 1, j + 1), 0, (a, c) -> a ^ c))"
    flip = f"""aggregate(sequence(0, {bits - 2}), 0, (t, s) ->
        if((element_at(g, -1) & shiftleft(1, {bits - 1} - s)) <> 0, t ^ (shiftleft(1, {bits - 1} - s) - 1), t))""" if bits > 1 else "0"
    joined = f"""aggregate(sequence(0, {bits} * {n} - 1), 0L, (a, k) ->
        a * 2L + (shiftright(g[int(k % {n})], int({bits - 1} - k div {n})) & 1))"""
    named = lambda value, body: f"transform(array({value}), g -> {body})[0]"
    return F.expr(named(gray, named(summed, named(f"transform(g, v -> v ^ {flip})", joined))))


def place(df, shards, columns, bits=5, keep=(), run_rows=RUN_ROWS):
    """Shard and slot of every row: ``keep`` columns, ``curve``, ``shard`` (from 0) and ``slot`` (gapless from 0).

    Rows are ordered by the curve, then by ``columns`` and ``keep``; rows equal in all of these may change places.
    Shard counts differ by one row at most. Sorting is spread over runs of ``run_rows`` rows, so no task holds more
    whatever share of the rows lies in one cell. Nulls go to the first cell and sort first; an empty table has no
    rows. Only ``columns`` and ``keep`` are read and moved.
    """
    names = list(dict.fromkeys([*columns, *keep]))
    narrow = stage(df.select(*names), "shard-keys")
    cuts = cut_points(narrow, columns, 1 << bits, run_rows)
    rows = narrow.count()
    placed = narrow.withColumn("__cells", F.array(*[cell(c, cuts[c]) for c in columns])) \
        .withColumn("curve", hilbert_index("__cells", bits)).drop("__cells")
    numbered = number_rows(placed, ["curve", *names], "__at", start=0, slab_rows=run_rows, rows=rows)
    # Exact in whole numbers: the shard of position p is floor(p * shards / rows).
    shard = F.expr(f"__at * {shards}L div {max(rows, 1)}L")
    first = F.expr(f"(__shard * {rows}L + {shards - 1}L) div {shards}L")
    return numbered.withColumn("__shard", shard).select(
        *names, "curve", F.col("__shard").cast("int").alias("shard"), (F.col("__at") - first).alias("slot"))


def ranges(placed, columns):
    """Rows and the least and greatest value of each column per shard: what a reader needs to skip shards."""
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def write(df, path, shards, columns, key, bits=5, run_rows=RUN_ROWS):
    """Write ``df`` as parquet, one folder per shard, sorted along the curve; the name of the folders' column.

    ``key`` names the columns that identify a row; rows equal in ``columns`` and ``key`` go to the first shard of any
    of them. The folders' column is ``shard``, with as many underscores before it as make it none of ``df``'s, whose
    columns may have any names. Nulls are placed as in :func:`place`; an empty table gives an empty folder. Each folder
    has several files of a run of the curve; rows never gather in one task.
    """
    names = list(dict.fromkeys([*columns, *key]))
    own = {c.lower() for c in df.columns}
    fresh = lambda name: next(n for n in ("_" * k + name for k in range(len(own) + 1)) if n not in own)
    shard, slot, keys = fresh("shard"), fresh("slot"), [fresh(f"key{i}") for i in range(len(names))]
    # Under names of their own from the start: the columns may be called what the curve's are.
    narrow = df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(names, keys)])
    placed = place(narrow, shards, keys[:len(dict.fromkeys(columns))], bits, keys, run_rows)
    first = placed.groupBy(*keys).agg(F.min(F.struct("shard", "slot")).alias("first"))
    where = first.select(*keys, F.col("first.shard").alias(shard), F.col("first.slot").alias(slot))
    match = None
    for c, k in zip(names, keys):
        same = F.col(f"`{c}`").eqNullSafe(F.col(k))
        match = same if match is None else match & same
    rows = df.join(where, match).drop(*keys)
    rows.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).drop(slot).write.partitionBy(shard).parquet(path)
    return shard
