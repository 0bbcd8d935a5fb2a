"""What each of several filters removes, in every order, when others have run before it.

The audit stores one table of failing rows per filter, bucketed by the row's number so that joins of these tables move
nothing. For each set of filters that may have run before (a prefix in any order), a left-anti join with the ids that
they removed leaves what the other filters remove now, and a left-semi join what they would have removed but find gone
already. All orders are read off the counts of these sets: orders that differ only within a prefix share its joins.

Rows get a number when their flags are written, so null and repeated ids count row by row. Part and labels are stored
beside the number. A document with any label of quality 1 is good, with any toxic of 1 toxic. Parts are the values of a
column, null with the empty text; every part has a row for each order and step, zeros included, and without documents
there is no row. Other columns are not read.
"""

import itertools
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from kerbside.functions.ordered import BROADCAST_ROWS
from kerbside.session import shared_path, stage

#: Failing rows per bucket, and the size from which a group of equal texts is joined by broadcast, not by shuffle.
BUCKET_ROWS, HOT_ROWS = 1_000_000, 100_000

#: Prefixes that one job counts: plans of all of them at once are too much for a driver of a few hundred MB.
JOB_PREFIXES = 4


def text_filters(text):
    """Fixed rules on whole texts, true where a text fails: ``A`` short, ``B`` repetitive, ``C`` shouting, ``D`` symbols."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return {
        "A": F.size(words) < 50,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 65,
        "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * 5,
        "D": text.rlike(r"[#$%&*|]"),
    }


def flagged(docs, filters, id_col="doc_id", text_col="text", part_col="source"):
    """One written row per document: ``row``, ``doc_id``, ``part``, ``digest`` of the text and a flag per filter.

    ``filters`` turns the text (null: empty) into named conditions under which it fails. The text itself is not written.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    flags = [F.coalesce(c, F.lit(False)).alias(name) for name, c in filters(F.col("text")).items()]
    # The write fixes the number of every row.
    return stage(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *flags), "flags")


def later_copies(rows, hot_rows=HOT_ROWS):
    """The rows of a table from :func:`flagged` whose text a smaller ``doc_id`` has as well.

    Ids are folded per text first. Texts of more than ``hot_rows`` rows are few, whatever the table, and are joined by
    broadcast, so no shuffled group is larger than that. A row without id is no later copy.
    """
    groups = stage(rows.groupBy("digest").agg(F.min("doc_id").alias("__first"), F.max("doc_id").alias("__last"), F.count("*").alias("__n"))
                   .where("__first < __last").drop("__last"), "copies")
    # At most one in hot_rows of the table; a table for which these are too many to send is shuffled.
    many = groups.where(F.col("__n") > hot_rows)
    hot = F.broadcast(many) if many.count() <= BROADCAST_ROWS else many
    rest = rows.join(hot.select("digest"), "digest", "left_anti").join(groups.where(F.col("__n") <= hot_rows).hint("merge"), "digest")
    found = rows.join(hot, "digest").unionByName(rest)
    return found.where("doc_id > __first").select(*rows.columns)


def failing(rows, names, copies=None, labels=None):
    """``filter``, ``row``, ``part``, ``good``, ``toxic``: one row per document and filter that it fails.

    ``copies`` maps the name of a filter to the rows that fail it, for filters that are no flags.
    """
    keys = ["row", "doc_id", "part"]
    own = rows.select(*keys, F.explode(F.array_compact(F.array(*[F.when(F.col(n), F.lit(n)) for n in names]))).alias("filter"))
    for name, more in (copies or {}).items():
        own = own.unionByName(more.select(*keys, F.lit(name).alias("filter")))
    if labels is None:
        return own.select("filter", "row", "part", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    found = own.join(known, "doc_id", "left")
    return found.select("filter", "row", "part", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


class FailingIds:
    """The stored relations: one folder of failing rows per filter, each bucketed and sorted by the row's number."""

    def __init__(self, relation: DataFrame, names, bucket_rows=BUCKET_ROWS):
        self.spark, self.names = relation.sparkSession, list(names)
        self.table = f"failing_{uuid.uuid4().hex}"
        held = stage(relation, "failing")
        buckets = max(4, -(-held.count() // bucket_rows))
        # Every join opens the files of a bucket anew, one per task that wrote it. A session may deal a key to more partitions than asked for;
        # as these need not line up with the buckets, no more tasks than buckets write.
        held.repartition(buckets, "row").coalesce(buckets).write.partitionBy("filter").bucketBy(buckets, "row").sortBy("row").option(
            "path", shared_path(self.spark, "failing-ids")).format("parquet").saveAsTable(self.table)

    def of(self, names) -> DataFrame:
        """The rows that fail any of ``names``, once for each."""
        return self.spark.table(self.table).where(F.col("filter").isin(*names))

    def removed(self, before) -> DataFrame:
        """What every other filter removes after the filters ``before``: ``filter``, ``row``, ``part``, ``good``, ``toxic``."""
        others = self.of([n for n in self.names if n not in before])
        return others.join(self.of(before).select("row").hint("merge"), "row", "left_anti") if before else others

    def redundant(self, before) -> DataFrame:
        """What every other filter would remove but for the filters ``before``, which have removed it."""
        return self.of([n for n in self.names if n not in before]).join(self.of(before).select("row").hint("merge"), "row", "left_semi")

    def survivors(self, rows, before) -> DataFrame:
        """The rows of a table from :func:`flagged` that are left after the filters ``before``."""
        return rows.join(self.of(before).select("row"), "row", "left_anti") if before else rows

    def counts(self) -> DataFrame:
        """Per prefix (the bits of its filters), filter and part: removed, good and toxic among them, redundant."""
        prefixes = [p for size in range(len(self.names)) for p in itertools.combinations(self.names, size)]
        jobs = [prefixes[i:i + JOB_PREFIXES] for i in range(0, len(prefixes), JOB_PREFIXES)]
        return reduce(DataFrame.unionByName, [stage(self._counted(job), "prefix-counts") for job in jobs])

    def _counted(self, prefixes):
        """The counts of some prefixes; what a prefix leaves and what it has made redundant are rows until they are summed."""
        rows = []
        for before in prefixes:
            rows.append(self.removed(before).withColumns({"gone": F.lit(False), "prefix": F.lit(self.bits(before))}))
            if before:
                rows.append(self.redundant(before).withColumns({"gone": F.lit(True), "prefix": F.lit(self.bits(before))}))
        now = ~F.col("gone")
        return reduce(DataFrame.unionByName, rows).groupBy("prefix", "part", "filter").agg(
            F.count_if(now).alias("removed"), F.count_if(F.col("good") & now).alias("good_lost"), F.count_if(F.col("toxic") & now).alias("toxic_lost"),
            F.count_if(F.col("gone")).alias("redundant"))

    def bits(self, names) -> int:
        return sum(1 << self.names.index(n) for n in names)

    def drop(self):
        """Forget the table; its files go with the application's stages."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def audit(rows, relation, names, bucket_rows=BUCKET_ROWS):
    """Per part, order of all filters and step: ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``,
    ``toxic_lost`` and ``shapley``, the filter's removals summed over all orders."""
    spark, names = rows.sparkSession, list(names)
    ids = FailingIds(relation, names, bucket_rows)
    try:
        counts = ids.counts()
    finally:
        ids.drop()
    steps = [(i, "".join(order), step + 1, order[step], ids.bits(order[:step]), ids.bits(names) - ids.bits(order[step]))
             for i, (order, step) in enumerate(itertools.product(itertools.permutations(names), range(len(names))))]
    plan = stage(spark.createDataFrame(steps, "__at int, filter_order string, step int, filter string, prefix int, __others int"), "steps")
    parts = rows.groupBy("part").agg(F.count("*").alias("__total"))
    grid = parts.select("part", "__total", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))).alias("__at")).join(F.broadcast(plan), "__at")
    found = grid.join(counts, ["part", "prefix", "filter"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    known = found.select("part", "filter_order", "step", "filter", "prefix", "__others", "__total",
                         *[zero(c).alias(c) for c in ("removed", "redundant", "good_lost", "toxic_lost")])
    # All orders of one part and filter: as many rows as there are orders.
    whole = Window.partitionBy("part", "filter")
    run = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return known.select(
        "part", "filter_order", "step", (F.col("__total") - F.sum("removed").over(run)).alias("kept"), "removed", "redundant",
        F.max(F.when(F.col("prefix") == F.col("__others"), F.col("removed"))).over(whole).alias("unique_fails"),
        "good_lost", "toxic_lost", F.sum("removed").over(whole).alias("shapley"))


def audit_texts(docs, labels, id_col="doc_id", text_col="text", part_col="source", bucket_rows=BUCKET_ROWS, hot_rows=HOT_ROWS):
    """The audit of :func:`text_filters` and of ``E``, later copies of a text, over whole texts."""
    rows = flagged(docs, text_filters, id_col, text_col, part_col)
    relation = failing(rows, "ABCD", {"E": later_copies(rows, hot_rows)}, labels)
    return audit(rows, relation, "ABCDE", bucket_rows)
