"""Files as rows: size, checksum, date-partitioned key."""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kerbside.functions.ordered import BROADCAST_ROWS, attach
from kerbside.session import stage
from kerbside.sources.logs import split_size

#: Bytes under one leaf of a file's tree of checksums, and checksums under one node. They are part of the checksum.
LEAF_BYTES, FANOUT = 1024, 1024

#: Bytes that one task of a scan in small splits takes, and what opening a split counts for among them.
TASK_BYTES, OPEN_BYTES = 128 << 20, 1 << 20

_MARK = b"\xef\xbb\xbf"


def _listing(spark, folder, glob):
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)


def _described(files, bucket, stage_name, as_of, etag):
    day = F.lit(as_of).cast("timestamp") if as_of else F.col("modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    key = F.concat_ws("/", F.lit(stage_name), F.date_format(day, "yyyy/MM/dd"), name)
    return files.select(
        F.lit(bucket).alias("bucket"),
        key.alias("key"),
        F.col("length").alias("size_bytes"),
        etag.alias("etag"),
        F.concat(F.lit(f"s3://{bucket}/"), key).alias("uri"),
        day.alias("uploaded_at"),
    )


def file_manifest(spark: SparkSession, folder, bucket, stage="raw", as_of=None, glob="*", checksum=True) -> DataFrame:
    """(bucket, key, size_bytes, etag, uri, uploaded_at) of each file.

    The checksum reads each file as one value, so use it for files that fit
    into one (2 GB); :func:`large_manifest` has no such limit. Without it only
    the listing is read. ``as_of`` dates the keys; by default each file's own
    date does.
    """
    files = _listing(spark, folder, glob)
    return _described(files, bucket, stage, as_of, F.md5("content") if checksum else F.lit(None).cast("string"))


def large_manifest(spark: SparkSession, folder, bucket, stage="raw", as_of=None, glob="*", split_bytes=None) -> DataFrame:
    """The manifest of files of any size; ``etag`` is the root of :func:`tree_checksums`."""
    files = _listing(spark, folder, glob).select("path", "modificationTime", "length")
    sums = tree_checksums(spark, folder, glob, split_bytes).withColumnRenamed("path", "__path")
    return _described(files.join(sums, F.col("path") == F.col("__path"), "left"), bucket, stage, as_of, F.col("checksum"))


def tree_checksums(spark: SparkSession, folder, glob="*", split_bytes=None, leaf_bytes=LEAF_BYTES, fanout=FANOUT) -> DataFrame:
    """(path, size_bytes, checksum): the root of a tree of md5 sums over ``leaf_bytes`` of a file each.

    A leaf is the md5 of its bytes, a node the md5 of up to ``fanout`` sums
    below it in order; the root is the single sum left. Files are read in
    splits of ``split_bytes`` (None: the session's), a piece at a time; a task
    takes as many given splits, one after the other, as count for
    ``TASK_BYTES``. A split hands on its whole leaves as sums and only the odd
    bytes at its two ends as they are, so the result does not depend on the
    splits, and a task holds no more than a leaf and the lines of an Arrow
    batch. Spark's listings leave out empty files, so those have no row.
    """
    files = stage(_listing(spark, folder, glob).select("path", F.col("length").alias("size_bytes")), "files")
    # Line by line, because only line readers open a file part by part; bytes are kept as they are.
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).option("lineSep", "\n")
    parts = reader.text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("value"))
    if split_bytes:  # Spark gives each a task of its own
        count = files.agg(F.sum(F.col("size_bytes") + F.ceil(F.col("size_bytes") / split_bytes) * OPEN_BYTES)).first()[0] or 0
        parts = parts.coalesce(max(spark.sparkContext.defaultParallelism, -(-count // TASK_BYTES)))
    with split_size(spark, split_bytes):
        # A split's first byte follows from the bytes of the lines before it.
        sizes = stage(parts.groupBy("path", "size", "split").agg(F.sum(F.octet_length("value") + 1).alias("n")), "split-sizes")
        file = Window.partitionBy("path")
        earlier = file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
        # The reader leaves out a byte order mark, and with it three bytes of the file.
        mark = F.sum("n").over(file) < F.col("size")
        starts = stage(sizes.select("path", "split", mark.alias("mark"), (F.coalesce(F.sum("n").over(earlier), F.lit(0)) + F.when(
            mark & (F.col("split") > 0), len(_MARK)).otherwise(0)).alias("start")), "split-starts")
        few = starts.count()
        placed = attach(parts, starts, ["path", "split"], rows=few)
        if few > BROADCAST_ROWS:  # a shuffle has taken the lines out of order
            placed = placed.repartition("path", "split").sortWithinPartitions("path", "split", "at")
        pieces = stage(placed.select("path", "size", "split", "start", "mark", "value").mapInArrow(
            _leaves(leaf_bytes), "path string, leaf long, at int, bytes binary, whole boolean"), "leaves")
    whole = pieces.where("whole").select("path", "leaf", F.col("bytes").alias("sum"))
    # Pieces of one leaf, so no more than its bytes.
    torn = pieces.where("NOT whole").groupBy("path", "leaf").agg(F.array_sort(F.collect_list(F.struct("at", "bytes"))).alias("held"))
    chained = lambda name: F.aggregate("held", F.lit(b""), lambda a, p: F.concat(a, p[name]))
    level = stage(whole.unionByName(torn.select("path", "leaf", F.unhex(F.md5(chained("bytes"))).alias("sum"))), "sums")
    while level.where("leaf > 0").head(1):
        grouped = level.groupBy("path", F.expr(f"leaf div {fanout}").alias("node")).agg(
            F.array_sort(F.collect_list(F.struct("leaf", "sum"))).alias("held"))
        # A file of which one sum is left has its root already.
        root = (F.size("held") == 1) & (F.col("held")[0]["leaf"] == 0)
        level = stage(grouped.select("path", F.col("node").alias("leaf"), F.when(root, F.col("held")[0]["sum"]).otherwise(
            F.unhex(F.md5(chained("sum")))).alias("sum")), "sums")
    found = level.select(F.col("path").alias("__path"), F.lower(F.hex("sum")).alias("sum"))
    # No line is read from a file that is nothing but a mark.
    bare = F.lit(hashlib.md5(_MARK).hexdigest())
    return files.join(found, _plain("path") == _plain("__path"), "left").select("path", "size_bytes", F.coalesce("sum", bare).alias("checksum"))


def _leaves(leaf_bytes):
    """Whole leaves of the splits in a task as sums, the bytes at both ends of a split as they are."""
    schema = pa.schema([("path", pa.string()), ("leaf", pa.int64()), ("at", pa.int32()), ("bytes", pa.binary()), ("whole", pa.bool_())])

    def pieces(path, size, at, held, end):
        """Takes from ``held``, the bytes from ``at`` on, what fills a leaf, and with ``end`` all; where it now begins."""
        out = []
        while held:
            inside = at % leaf_bytes
            take = min(leaf_bytes - inside, len(held))
            if not end and inside + take < leaf_bytes:
                break
            piece = bytes(held[:take])
            whole = inside == 0 and (take == leaf_bytes or at + take == size)
            out.append((path, at // leaf_bytes, inside, hashlib.md5(piece).digest() if whole else piece, whole))
            del held[:take]
            at += take
        return at, out

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        split, at, held = None, 0, bytearray()
        for batch in batches:
            out = []
            for path, size, begin, start, mark, value in zip(*(c.to_pylist() for c in batch.columns)):
                if split is None or (path, begin) != split[:2]:
                    if split:
                        out += pieces(split[0], split[2], at, held, True)[1]
                    split, at, held = (path, begin, size), start, bytearray(_MARK if mark and begin == 0 else b"")
                held += value
                if at + len(held) < size:  # every line but a last one without an end
                    held += b"\n"
                at, more = pieces(path, size, at, held, False)
                out += more
            if out:
                yield batch_of(out)
        rest = pieces(split[0], split[2], at, held, True)[1] if split else []
        if rest:
            yield batch_of(rest)

    return run


def _plain(path):
    """A path without its scheme, which listings and rows may spell differently."""
    return F.regexp_replace(path, "^[a-z0-9]+:/*", "/")


def list_keys(manifest: DataFrame, prefix="") -> DataFrame:
    return manifest.filter(F.col("key").startswith(prefix)).select("key")
