"""Arrow batches of texts, cut into chunks of bounded size."""

import ctypes
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

#: Bytes of text that a task works on at once; one longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20


#: What the running task of this worker process holds: tokenizers, matchers.
_held = {}


def held(key, build):
    """``build()``, once per task: kept under ``key`` until the task ends."""
    if key not in _held:
        _held[key] = build()
    return _held[key]


def release():
    """Let go of what a task held and give the memory back: Spark uses a worker process for many tasks."""
    if _held:
        _held.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only some C libraries have it
        pass


def per_task(run):
    """``run``, a function over Arrow batches, that releases what it held when it ends, fails or is no longer wanted."""
    def ending(batches):
        try:
            yield from run(batches)
        finally:
            release()
    return ending


def pick(df, id_col="doc_id", text_col="text", **more):
    """Only the columns that an operator reads, under fixed names: ``doc_id``, ``text`` and ``more``.

    Whatever else the table has, clashing names included, is left behind.
    """
    columns = {"doc_id": id_col, "text": text_col, **more}
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


def chunks(batches, size=CHUNK_BYTES, text="text"):
    """Slices of the Arrow batches with about ``size`` bytes of text each, in order."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        groups = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64) + 32) // size
        cuts = np.flatnonzero(np.diff(groups)) + 1
        for start, end in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def texts_of(batch, text="text"):
    """The texts of a batch as a list; null counts as empty."""
    return ["" if t is None else t for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def emit(schema, **columns):
    """A record batch with the columns in the order of ``schema``, a ``pa.schema``."""
    return pa.RecordBatch.from_arrays([
        c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
        for f, c in ((f, columns[f.name]) for f in schema)], schema=schema)


def id_field(df):
    """The Arrow field of ``doc_id`` with the type that the table has."""
    from pyspark.sql.pandas.types import to_arrow_type
    return pa.field("doc_id", to_arrow_type(df.schema["doc_id"].dataType))


def map_texts(df, work, fields, size=CHUNK_BYTES):
    """Apply ``work(chunk) -> dict of columns`` to chunks of a table from :func:`pick`; one row out per row in.

    ``doc_id`` is carried over with its type; ``fields`` are the Arrow fields of the other columns.
    """
    from pyspark.sql.pandas.types import from_arrow_schema
    schema = pa.schema([id_field(df), *fields])

    def run(batches):
        for batch in chunks(batches, size):
            yield emit(schema, doc_id=batch.column(batch.schema.get_field_index("doc_id")).cast(schema.field("doc_id").type), **work(batch))

    return df.mapInArrow(per_task(run), from_arrow_schema(schema))
