"""Records of several lines, checksums of files in parts, table loads, tables in buckets."""

import hashlib
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kerbside.functions import columns as X
from kerbside.operators import analytics, layout, windows
from kerbside.sinks import tables
from kerbside.sources import logs, manifest

HEAD = "2024-01-01 00:00:%02d,500 [INFO] job: message %d"


def plain_records(text):
    """[(first line number, message, lines)] of one file."""
    out = []
    for no, line in enumerate(text.split("\n")[:-1] if text.endswith("\n") else text.split("\n"), 1):
        m = re.match(logs.LINE, line)
        if m or not out or not out[-1][3]:
            out.append([no, m[4] if m else line, 1, bool(m)])
        else:
            out[-1][1] += "\n" + line
            out[-1][2] += 1
    return [tuple(r[:3]) for r in out]


@pytest.mark.parametrize("split", [None, 64, 300])
def test_log_records_across_splits(spark, tmp_path, split):
    files = {
        "a.log": "".join(HEAD % (i, i) + "\n" + "".join(f"  at {k} of {i}\n" for k in range(i % 7)) for i in range(40)),
        "b.log": "no header\nnor here\n" + HEAD % (1, 1) + "\n" + "\n".join(f"line {k}" for k in range(60)),
        "c.log": "never\na\nheader\n", "d.log": "", "e.log": HEAD % (2, 2), "f.txt": "not a log\n"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    found = logs.read_records(spark, str(tmp_path), split).collect()
    want = {(n, *r) for n, t in files.items() if n.endswith(".log") and t for r in plain_records(t)}
    assert {(r.source_file, r.line_no, r.message, r.n_lines) for r in found} == want and len(found) == len(want)
    heads = [r for r in found if r.source_file == "a.log"]
    assert all(r.level == "INFO" and r.logger == "job" and str(r.ts).startswith("2024-01-01 00:00:") for r in heads)
    assert all(r.ts is None and r.level is None for r in found if r.source_file == "c.log")
    if split:
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(split)


def plain_tree(data, leaf, fanout):
    sums = [hashlib.md5(data[i:i + leaf]).digest() for i in range(0, len(data), leaf)] or [hashlib.md5(b"").digest()]
    while len(sums) > 1:
        sums = [hashlib.md5(b"".join(sums[i:i + fanout])).digest() for i in range(0, len(sums), fanout)]
    return sums[0].hex()


def test_checksums_do_not_depend_on_splits(spark, tmp_path):
    import random
    draw = random.Random(5)
    files = {
        "random": bytes(draw.randrange(256) for _ in range(20_000)), "lines": b"some text\r\n" * 900, "zeros": bytes(7000),
        "mark": b"\xef\xbb\xbfmarked\n" * 300, "mark_only": b"\xef\xbb\xbf", "unended": b"\n\n\nx", "end": b"\n" * 130, "exact": b"y" * 64, "one": b"z"}
    for name, data in [*files.items(), ("none", b"")]:  # an empty file is not listed
        (tmp_path / name).write_bytes(data)
    want = {n: (len(d), plain_tree(d, 64, 5)) for n, d in files.items()}
    for split in (1 << 10, 1 << 20, 37):
        found = manifest.tree_checksums(spark, str(tmp_path), split_bytes=split, leaf_bytes=64, fanout=5).collect()
        assert {r.path.rsplit("/", 1)[1]: (r.size_bytes, r.checksum) for r in found} == want, split


def test_tree_checksums_of_many_splits_take_few_tasks(spark, tmp_path):
    """Tasks follow the bytes, not the splits."""
    data = b"".join(b"line %d\n" % i for i in range(6000))
    for name in "abc":
        (tmp_path / name).write_bytes(data)
    spark.sparkContext.setJobGroup("tree", "tree")
    try:
        found = manifest.tree_checksums(spark, str(tmp_path), split_bytes=256).collect()
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("tree") for s in status.getJobInfo(j).stageIds]
    splits = 3 * (len(data) // 256)
    assert splits > 600 and 0 < max(s.numTasks for s in stages if s) < splits // 10
    assert {r.checksum for r in found} == {plain_tree(data, manifest.LEAF_BYTES, manifest.FANOUT)} and len(found) == 3


def test_large_manifest(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x" * 5000)
    row = manifest.large_manifest(spark, str(tmp_path), "b", as_of="2024-02-03").first()
    assert (row.key, row.size_bytes, row.etag) == ("raw/2024/02/03/a.csv", 5000, plain_tree(b"x" * 5000, manifest.LEAF_BYTES, manifest.FANOUT))
    assert row.uri == "s3://b/raw/2024/02/03/a.csv"


def test_table_loads(spark, tmp_path):
    first = spark.createDataFrame([(1, "a")], "id int, name string")
    load = lambda df, mode, evolve=True: tables.load_table(df, "evolving", mode, str(tmp_path / "t"), evolve)
    assert load(first, "fail") == 1
    with pytest.raises(AnalysisException):
        load(first, "fail")
    assert load(spark.createDataFrame([(True, 2), (None, 3)], "flag boolean, ID long"), "append") == 2
    assert load(spark.createDataFrame([], "id int"), "append") == 0
    rows = {(r.id, r.name, r.flag) for r in spark.table("evolving").collect()}
    assert rows == {(1, "a", None), (2, None, 1), (3, None, None)} and dict(spark.table("evolving").dtypes)["id"] == "int"
    assert load(spark.createDataFrame([(9,)], "other int"), "replace") == 1 and spark.table("evolving").columns == ["other"]
    spark.sql("DROP TABLE evolving")


def test_bucketed_tables_need_no_exchange(spark, tmp_path):
    left = layout.bucketed(spark.range(1000).select((F.col("id") % 37).alias("k"), (F.col("id") % 5).alias("j"), "id"), "left_t", ["k"], 4, str(tmp_path / "l"))
    right = layout.bucketed(spark.range(37).select(F.col("id").alias("k"), F.lit("x").alias("name")), "right_t", ["k"], 4, str(tmp_path / "r"))
    both = left.join(right.hint("merge"), "k").groupBy("k", "j").agg(F.count("*").alias("n"))
    assert sum(r.n for r in both.collect()) == 1000
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    for name in ("left_t", "right_t"):
        spark.sql(f"DROP TABLE {name}")


def test_query_over_buckets_has_no_exchange(spark, folder):
    from kerbside.plans import roundtrips
    found = roundtrips.bucketed_orders(spark, folder)
    found.collect()
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_money_does_not_depend_on_partitions(spark):
    rows = spark.range(200_000).select(
        F.concat(F.lit("V"), F.col("id").cast("string")).alias("violation_id"), F.element_at(F.array(F.lit("Downtown"), F.lit("Highway")), (F.col("id") % 2 + 1).cast("int")).alias("zone"),
        F.lit("DUI").alias("violation_type"), F.lit("High").alias("severity"), (F.col("id") % 24).cast("int").alias("hour"), F.lit("OFF-001").alias("officer_id"),
        (F.lit(5e9) + F.col("id") * 0.37).alias("fine_amount"), (F.col("id") * 0.001).alias("speed_kmh"), F.lit("2024-01-15").cast("timestamp").alias("timestamp"))
    reports = [analytics.zone_revenue, analytics.zone_type_report, analytics.kpi_cards, analytics.officer_top, windows.running_revenue,
               lambda df: analytics.zone_revenue_recent(df, "2024-01-31")]
    found = [[sorted(map(str, report(rows.repartition(n)).collect())) for report in reports] for n in (1, 7, 64)]
    assert found[0] == found[1] == found[2]
    exact = sum(5 * 10**9 * 100 + i * 37 for i in range(200_000)) / 100
    assert rows.agg(X.total("fine_amount").alias("t")).first().t == exact


def test_totals_of_odd_values(spark):
    total = lambda *v: spark.createDataFrame([(x,) for x in v], "v double").agg(X.total("v").alias("t"), X.mean("v").alias("m")).first()
    assert total(None, None).t is None and total(None).m is None
    assert total(0.1, 0.2, None).t == 0.3 and total(-0.25, -1.5).t == -1.75 and total(1e300, 1.0).t == 1e300
    assert str(total(float("nan"), 1.0).t) == "nan" and total(float("inf"), 1.0).t == float("inf") and total(1.0, 2.0).m == 1.5
