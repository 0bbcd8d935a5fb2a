"""Short codes for vectors: each part of a vector becomes the index of its nearest codebook entry.

Vectors are turned into integers, ``floor(scale * x)``, and cut into equal consecutive parts, each position with a
codebook of its own. Codebooks are improved in rounds: every part goes to its nearest entry, and an entry becomes the
floored mean of what came to it. A round is one scan; tasks add up their parts per entry, so that what moves between
machines is bounded by the codebooks, whatever the number of rows.

The nearest entry is found by an equal-average search. Entries are sorted by the sum of their components. By
Cauchy's inequality the squared distance of two parts is at least the squared gap of their sums over the dimension, so
the search goes outward from a part's own sum and ends once that bound is strictly above the best distance: entries
at the same distance are all seen, and the lowest index wins. All arithmetic is in whole numbers, so results do not
depend on how rows are dealt to tasks.

Defined results: a vector that is null or holds a null or non-finite component is dropped. Vectors shorter than the
longest, or of a length that the parts do not divide, are filled up with zeros. Rows of equal ids are coded each; of
their vectors the least counts as a codebook's first entry. A null id sorts last, a null label is a label of its own.
Fewer ids than entries give shorter codebooks; without vectors there are no rows. Other columns are not read. An error
too large for 64 bits is an error of the job.
"""

import hashlib
import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType

from kerbside.functions.ordered import attach
from kerbside.session import stage

#: Parts searched at once.
CHUNK_PARTS = 8192


@dataclass(frozen=True)
class Codebooks:
    """One integer matrix of entries per part position; ``width`` components per part."""

    books: tuple
    width: int
    scale: int = 1024

    @property
    def sha256(self):
        """Digest of all components as decimal numbers, by part, entry and position, joined by commas."""
        flat = (str(int(v)) for book in self.books for entry in book for v in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def _kept(df, id_col, vector_col, label_col=None):
    """``vec_id``, ``label`` and ``vector`` (doubles) of the rows whose vector is whole."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    label = F.col(f"`{label_col}`") if label_col else F.lit(None).cast("int")
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), label.alias("label"), vector.alias("vector"))
    # NaN is above all numbers in Spark's order.
    return rows.where(F.forall("vector", lambda x: F.coalesce(F.abs(x) < math.inf, F.lit(False))))


def _whole(values, scale):
    """``floor(scale * x)`` of doubles: 64-bit integers where sums and squares fit, else Python's."""
    scaled = np.floor(values * scale)
    # A gap of sums is at most 2 * width * |component|, and it is squared.
    if not scaled.size or np.abs(scaled).max() * 2 * max(1, values.shape[-1]) < 2 ** 31:
        return scaled.astype(np.int64)
    out = np.empty(values.shape, object)
    for at, x in np.ndenumerate(values):
        n, d = float(x).as_integer_ratio()
        out[at] = scale * n // d
    return out


def _parts(column, books):
    """The vectors of an Arrow list column as whole numbers, ``rows x parts x width``, filled up with zeros."""
    rows, dim = len(column), len(books.books) * books.width
    lengths = np.asarray(pc.list_value_length(column).to_numpy(zero_copy_only=False), np.int64)
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    padded = np.zeros((rows, dim))
    padded[np.arange(dim) < lengths[:, None]] = values
    return _whole(padded.reshape(rows, len(books.books), books.width), books.scale)


def nearest(points, entries):
    """``(index, squared distance)`` of the entry nearest to each row of ``points``; ties go to the lower index.

    ``points`` and ``entries`` are integer matrices; there is at least one entry.
    """
    if entries.dtype == object or points.dtype == object:
        points, entries = points.astype(object), entries.astype(object)
    width = points.shape[1]
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, last = sums[order], len(order) - 1
    own = points.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    index = np.full(len(points), -1, np.int64)
    best = np.zeros(len(points), points.dtype)
    rows = np.arange(len(points))
    while len(rows):
        l, r, o = left[rows], right[rows], own[rows]
        below, above = o - sums[np.maximum(l, 0)], sums[np.minimum(r, last)] - o
        down = (l >= 0) & ((r > last) | (below <= above))
        gap = np.where(down, below, above)
        # The nearer side alone decides: beyond it the other side is further still.
        going = ((l >= 0) | (r <= last)) & ((index[rows] < 0) | (gap * gap <= best[rows] * width))
        rows, down, l, r = rows[going], down[going], l[going], r[going]
        seen = order[np.where(down, l, r)]
        difference = points[rows] - entries[seen]
        distance = (difference * difference).sum(axis=1)
        better = (index[rows] < 0) | (distance < best[rows]) | ((distance == best[rows]) & (seen < index[rows]))
        best[rows[better]], index[rows[better]] = distance[better], seen[better]
        left[rows] -= down
        right[rows] += ~down
    return index, best


def _assigned(column, books):
    """``(parts, codes, squared distances)`` of an Arrow list column, the last two ``rows x parts``."""
    parts = _parts(column, books)
    found = [nearest(parts[:, p], book) for p, book in enumerate(books.books)]
    return parts, np.stack([i for i, _ in found], 1), np.stack([d for _, d in found], 1)


def _chunks(batches, parts):
    step = max(1, CHUNK_PARTS // parts)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def start(df, parts=4, entries=256, scale=1024, id_col="vec_id", vector_col="embedding"):
    """The first codebooks: the parts of the vectors with the ``entries`` smallest ids; None without vectors.

    Ids alone are sorted; the vectors of the chosen ones come to the driver, at most ``entries``.
    """
    rows = _kept(df, id_col, vector_col)
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return None
    chosen = rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries)
    first = attach(rows, stage(chosen, "first-ids"), ["vec_id"], rows=entries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    vectors = [r.vector for r in first.orderBy(F.col("vec_id").asc_nulls_last()).collect()]
    width = -(-longest // parts)
    empty = Codebooks((np.zeros((0, width), np.int64),) * parts, width, scale)
    cut = _parts(pa.array(vectors, pa.list_(pa.float64())), empty)
    return Codebooks(tuple(cut[:, p] for p in range(parts)), width, scale)


def improve(df, books, id_col="vec_id", vector_col="embedding"):
    """One round: every part goes to its nearest entry, which becomes the floored mean of its parts; unused ones stay."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0)))])

    def gather(batches):
        counts = [np.zeros(len(book), np.int64) for book in books.books]
        # Python's numbers at the end of a chunk, so that no sum can wrap.
        sums = [np.zeros(book.shape, object) for book in books.books]
        for batch in _chunks(batches, len(books.books)):
            cut, codes, _ = _assigned(batch.column(0), books)
            for p in range(len(books.books)):
                used, at = np.unique(codes[:, p], return_inverse=True)
                total = np.zeros((len(used), books.width), cut.dtype)
                np.add.at(total, at, cut[:, p])
                sums[p][used] += total.astype(object)
                counts[p] += np.bincount(codes[:, p], minlength=len(counts[p]))
        for p, n in enumerate(counts):
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(used), p), pa.int32()), pa.array(used, pa.int32()), pa.array(n[used], pa.int64()),
                pa.array([[Decimal(int(v)) for v in sums[p][e]] for e in used], schema.field("sums").type)], schema=schema)

    partial = _kept(df, id_col, vector_col).select("vector").mapInArrow(
        gather, "part int, entry int, n long, sums array<decimal(38,0)>")
    added = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(books.width)])
    after = [book.astype(object) for book in books.books]
    # One row per entry: bounded by the codebooks.
    for row in added.collect():
        after[row.part][row.entry] = [int(row[f"s{i}"]) // row.n for i in range(books.width)]
    return Codebooks(tuple(_narrow(book) for book in after), books.width, books.scale)


def _narrow(book):
    """Back to 64-bit integers where sums and squares fit."""
    largest = max((abs(v) for v in book.flat), default=0)
    return book.astype(np.int64) if largest * 2 * max(1, book.shape[1]) < 2 ** 31 else book


def train(df, parts=4, entries=256, rounds=4, scale=1024, id_col="vec_id", vector_col="embedding"):
    """Codebooks after ``rounds`` rounds over all vectors; None without vectors."""
    books = start(df, parts, entries, scale, id_col, vector_col)
    for _ in range(rounds if books else 0):
        books = improve(df, books, id_col, vector_col)
    return books


def encode(df, books, id_col="vec_id", vector_col="embedding", label_col="label"):
    """``vec_id``, ``label``, ``code`` (hex, two digits a part for up to 256 entries) and ``error`` of every whole vector."""
    rows = _kept(df, id_col, vector_col, label_col)
    fields = rows.select("vec_id", "label").schema
    digits = 2 if max(len(b) for b in books.books) <= 256 else 8
    schema = pa.schema([*to_arrow_schema(fields), pa.field("code", pa.string()), pa.field("error", pa.int64())])

    def work(batches):
        for batch in _chunks(batches, len(books.books)):
            _, codes, distances = _assigned(batch.column(2), books)
            text = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
            errors = [int(e) for e in distances.sum(axis=1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(schema.field(0).type), batch.column(1).cast(schema.field(1).type),
                pa.array(text, pa.string()), pa.array(errors, pa.int64())], schema=schema)

    return rows.mapInArrow(work, fields.add("code", StringType()).add("error", LongType()))


def decode(coded, books, code_col="code"):
    """``coded`` with ``approximation``: the middle of the integer cell of every component, as doubles; null stays null."""
    digits = 2 if max(len(b) for b in books.books) <= 256 else 8
    middles = [(np.asarray(book, np.float64) + 0.5) / books.scale for book in books.books]

    @F.pandas_udf("array<double>")
    def rebuilt(codes: pd.Series) -> pd.Series:
        at = lambda c, p: int(c[p * digits:(p + 1) * digits], 16)
        return pd.Series([None if c is None else np.concatenate([m[at(c, p)] for p, m in enumerate(middles)]).tolist() for c in codes])

    return coded.withColumn("approximation", rebuilt(F.col(f"`{code_col}`")))


def compress(df, parts=4, entries=256, rounds=4, scale=1024, id_col="vec_id", vector_col="embedding", label_col="label"):
    """Train and encode: ``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every whole vector.

    ``label_error`` is the error summed over the rows of the same label. Labels are folded before they are joined
    back, and the join is a broadcast only for a counted number of labels, so that a hot label is no hot task.
    """
    books = train(df, parts, entries, rounds, scale, id_col, vector_col)
    if books is None:
        coded = _kept(df, id_col, vector_col, label_col).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        coded = stage(encode(df, books, id_col, vector_col, label_col), "codes")
    by_label = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    return attach(coded, by_label, ["label"], rows=by_label.count()).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256 if books else "").alias("codebooks_sha256"))
