"""Files in and out: CSV quirks, exports, manifests, logs, versions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from kerbside.operators import layout
from kerbside.plans import batch
from kerbside.plans.catalogue import clean_table, enriched_table
from kerbside.sinks import files, tables
from kerbside.sources.csv_files import ingest, read_csv_folder
from kerbside.sources.logs import read_logs
from kerbside.sources.manifest import file_manifest, list_keys
from kerbside.sources.synthetic import synthetic_records
from kerbside.sources.tables import read_first, read_records, rejected_records


@pytest.fixture
def csv_folder(tmp_path):
    base = tmp_path / "in"
    base.mkdir()
    (base / "a.csv").write_text(
        "violation_id,timestamp,violation_type,zone,speed_kmh,fine_amount\n"
        'TRF-1,2024-01-01 08:00:00,Speeding,"Down, town",40,100\n'
        "TRF-2,2024-01-01 09:00:00,DUI,Highway,abc,500\n"
        ",,,,,\n"
        "TRF-3,2024-01-01 09:00:00,DUI,Highway,1,2,3,4\n"
        "TRF-4,2024-01-01\n")
    (base / "b.csv").write_bytes("id,timestamp,Type,zone,speed,lat\nTRF-5,2024-01-02,Réckless,School,10,28.5\n".encode("latin-1"))
    (base / "c.csv").write_text("id,timestamp,Type,zone,speed,lat\nTRF-6,2024-01-02,Reckless,School,12,28.6\n")
    (base / "empty.csv").write_text("")
    (base / "notes.txt").write_text("not,a,csv,file\n1,2,3,4\n")
    return str(base)


def test_csv_folder(spark, csv_folder):
    good, rejected = read_csv_folder(spark, csv_folder)
    rows = {r.violation_id: r for r in good.collect()}
    assert set(rows) == {"TRF-1", "TRF-2", "TRF-4", "TRF-5", "TRF-6"}
    assert rows["TRF-1"].zone == "Down, town"
    assert rows["TRF-4"].zone is None
    assert rows["TRF-5"].violation_type == "Réckless" and rows["TRF-5"].latitude == "28.5"
    assert rows["TRF-6"].source_file == "c.csv"
    assert [(r.source_file, r.line[:5]) for r in rejected.collect()] == [("a.csv", "TRF-3")]
    assert good.count() == 5 and rejected.count() == 1 and good.select("zone").count() == 5
    order = [r.violation_id for r in good.orderBy("row_seq").collect()]
    assert order == ["TRF-1", "TRF-2", "TRF-4", "TRF-5", "TRF-6"]


def test_ingest(spark, csv_folder):
    good, _ = ingest(spark, csv_folder, "2024-01-31T00:00:00")
    rows = {r.violation_id: r for r in good.collect()}
    assert rows["TRF-2"].speed_kmh is None and rows["TRF-1"].speed_kmh == 40.0
    assert rows["TRF-1"].officer_id is None
    assert {r.pipeline_run for r in rows.values()} == {hashlib.md5(b"2024-01-31T00:00:00").hexdigest()[:8]}


def test_ingest_needs_files(spark, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        read_csv_folder(spark, str(tmp_path))


def test_synthetic_is_repeatable(spark):
    a, b = synthetic_records(spark, 2000, partitions=1), synthetic_records(spark, 2000, partitions=5)
    assert a.exceptAll(b).isEmpty()
    row = a.agg(F.count("*").alias("n"), F.avg(F.col("fine_amount").isNull().cast("int")).alias("gap"),
                F.count_distinct("violation_id").alias("ids"), F.max("timestamp").alias("last"),
                F.min("latitude").alias("lat"), F.count_distinct("zone", "violation_type").alias("pairs")).first()
    assert row.n == row.ids == 2000 and 0.03 < row.gap < 0.07 and row.pairs == 35
    far = synthetic_records(spark, 1_000_002).filter("row_seq > 999998")
    assert sorted(r.violation_id for r in far.collect())[:2] == ["TRF-1000000", "TRF-1000001"]
    assert row.last == "2024-01-07 22:35:00" and row.lat >= 28.4


def test_round_trips(spark, folder, tmp_path):
    df = clean_table(spark, folder)
    files.export_parquet(df, str(tmp_path / "p"), ["zone", "absent"])
    assert spark.read.parquet(str(tmp_path / "p")).exceptAll(df).isEmpty()
    files.export_parquet(df, str(tmp_path / "q"), ["zone"])
    assert (tmp_path / "q" / "zone=Highway").exists()
    files.export_csv(df.select("violation_id", "zone"), str(tmp_path / "c"), chunk_rows=10)
    assert len(list((tmp_path / "c").glob("*.csv"))) >= df.count() / 10
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == df.count()
    files.export_zone_summary(df, str(tmp_path / "s"))
    assert len(list((tmp_path / "s").glob("*.csv"))) == 1


def test_read_records_by_format(spark, folder, tmp_path):
    df = enriched_table(spark, folder)
    files.export_parquet(df, str(tmp_path / "r.parquet"))
    assert read_records(spark, str(tmp_path / "r.parquet")).count() == df.count()
    (tmp_path / "r.csv").write_text("violation_id,zone,speed_kmh\nTRF-1,Highway,12\nTRF-2,Highway,\n")
    schema = "violation_id string, zone string, speed_kmh double"
    got = read_records(spark, str(tmp_path / "r.csv"), schema=schema).collect()
    assert [(r.violation_id, r.speed_kmh) for r in got] == [("TRF-1", 12.0), ("TRF-2", None)]


def test_malformed_rows_are_rejected_not_lost(spark, tmp_path):
    (tmp_path / "r.csv").write_text("violation_id,zone,speed_kmh\nTRF-1,Highway,12\nTRF-2,Highway,fast\nTRF-3,School,1,2,3\nTRF-4,,\n")
    schema = "violation_id string, zone string, speed_kmh double"
    good = read_records(spark, str(tmp_path / "r.csv"), schema=schema)
    bad = rejected_records(spark, str(tmp_path / "r.csv"), schema=schema)
    assert sorted(r.violation_id for r in good.collect()) == ["TRF-1", "TRF-4"] and good.columns == ["violation_id", "zone", "speed_kmh"]
    assert sorted(r.text for r in bad.collect()) == ["TRF-2,Highway,fast", "TRF-3,School,1,2,3"]


def test_read_first_takes_what_is_there_and_nothing_else(spark, folder, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_first(spark, "no_such_table", str(tmp_path / "none"))
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        read_first(spark, "no_such_table")
    spark.range(120_000).write.mode("overwrite").saveAsTable("preview_source")
    assert read_first(spark, "preview_source").count() == 120_000
    assert read_first(spark, "preview_source", rows=7).count() == 7
    spark.range(3).limit(0).write.parquet(str(tmp_path / "empty.parquet"))
    assert read_first(spark, "no_such_table", str(tmp_path / "empty.parquet")).count() == 0


def test_load_table_modes(spark, folder):
    df = clean_table(spark, folder)
    n = df.count()
    assert tables.load_table(df, "loaded") == n
    assert tables.load_table(df, "loaded", "append") == n
    assert spark.table("loaded").count() == 2 * n
    kinds = dict(spark.table("loaded").dtypes)
    assert kinds["is_peak"] == "int" and kinds["timestamp"] == "string"
    with pytest.raises(Exception):
        tables.load_table(df, "loaded", "fail")
    assert tables.load_table(df, "loaded", "replace") == n


def test_logs(spark, tmp_path):
    (tmp_path / "a.log").write_text("2024-01-01 08:00:00,123 [INFO] etl: ready: go\nplain text\n")
    rows = read_logs(spark, str(tmp_path)).collect()
    assert (rows[0].level, rows[0].logger, rows[0].message) == ("INFO", "etl", "ready: go")
    assert str(rows[0].ts) == "2024-01-01 08:00:00.123000"
    assert (rows[1].level, rows[1].message) == (None, "plain text")


def test_manifest(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"hello")
    (tmp_path / "b.txt").write_bytes(b"other")
    m = file_manifest(spark, str(tmp_path), "lake", "raw", "2024-01-05", "*.csv")
    row = m.first()
    assert m.count() == 1
    assert (row.key, row.size_bytes, row.etag) == ("raw/2024/01/05/a.csv", 5, hashlib.md5(b"hello").hexdigest())
    assert row.uri == "s3://lake/raw/2024/01/05/a.csv"
    assert list_keys(m, "raw/2023").count() == 0 and list_keys(m, "raw/2024").count() == 1
    assert file_manifest(spark, str(tmp_path), "lake", checksum=False).filter("etag IS NULL").count() == 2


def test_blocks_cover_files(spark):
    sizes = spark.createDataFrame([("e", 0), ("s", 10), ("x", 128), ("l", 300)], "path string, size_bytes long")
    got = layout.block_layout(sizes, 128)
    assert sorted((r.path, r.block_no, r.block_bytes) for r in got.collect()) == [
        ("e", 0, 0), ("l", 0, 128), ("l", 1, 128), ("l", 2, 44), ("s", 0, 10), ("x", 0, 128)]
    assert layout.block_report(sizes, 128).first().asDict() == {"files": 4, "total_bytes": 438, "blocks": 6}


def test_batch_run(spark, tmp_path, csv_folder):
    out = batch.run(spark, None, str(tmp_path / "gen"), "2024-01-05T00:00:00", table_prefix="gen_", synthetic_rows=1000)
    assert out["passed"] and out["score"] == 100.0
    assert out["tables"]["violations"] == 1000 and out["tables"]["fact_violation"] == 1000
    assert spark.table("gen_fact_violation").count() == 1000
    lines = [r.value for r in spark.read.text(out["paths"]["dq_report"]).collect()]
    assert lines[0] == "# Data Quality Report" and "✓ PASS" in "".join(lines)
    bad = batch.run(spark, csv_folder, str(tmp_path / "csv"), "2024-03-05T00:00:00", table_prefix="bad_")
    assert bad["score"] < 100
    run = spark.read.json(bad["paths"]["log"] + "/runs").first()
    assert run.raw_rows == 5
    assert spark.read.option("header", True).csv(bad["paths"]["rejected"]).count() == 1
