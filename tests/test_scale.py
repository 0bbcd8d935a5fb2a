"""The large-data paths, forced on small inputs, give the same results; and
plans have the shape that scale needs."""

import contextlib
import io

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from kerbside import contract as C
from kerbside.functions.ordered import (
    Spread, cumulate, number_rows, previous_value, quantiles, spreads, value_counts)
from kerbside.operators import conform, features, impute, messages, star, windows
from kerbside.plans import cleaning
from kerbside.plans.catalogue import clean_table, enriched_table
from kerbside.sources.incidents import raw_incidents, read_table


ONE = Spread(0, 0)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def hot(spark, folder):
    """Events of which a third share one value."""
    return read_table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", F.when(F.col("event_id") % 3 == 0, 7.0).otherwise(F.col("value")).alias("value"))


def test_spread_cuts_balance(spark, folder):
    spread = spreads(hot(spark, folder), ["value"], slab_rows=20)["value"]
    distinct = hot(spark, folder).select("value").distinct().count()
    assert len(spread.cuts) > 3 and list(spread.cuts) == sorted(set(spread.cuts))
    assert spread.distinct >= distinct


def test_slabs_hold_distinct_values_however_hot_one_is(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 1000 > 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    spread = spreads(df, ["v"], slab_rows=10)["v"]
    from kerbside.functions.ordered import _with_slab
    sizes = [r["count"] for r in _with_slab(df.select("v").distinct(), "v", spread.cuts).groupBy("__slab").count().collect()]
    assert max(sizes) <= 20 and len(sizes) >= 3


def test_both_paths_agree_on_odd_numbers(spark):
    import math
    import numpy as np
    odd = [math.inf, -math.inf, math.nan, None, 0.0, -3.5]
    values = odd * 3 + [float(i % 37) for i in range(300)]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "v double, g int")
    for some in (df, df.where("NOT isnan(v) OR v IS NULL")):
        probs = {"a": 0.05, "b": 0.5, "c": 0.99}
        for by in ([], ["g"]):
            small, large = (quantiles(some, "v", probs, by, slab_rows=n) for n in (10**6, 7))
            assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    finite = sorted(v for v in values if v is not None and math.isfinite(v))
    row = quantiles(df.where("abs(v) < double('inf')"), "v", {"q": 0.37}, slab_rows=7).first()
    assert math.isclose(row.q, np.quantile(finite, 0.37))


def test_text_numbers_on_both_paths(spark, folder):
    raw = raw_incidents(spark, folder)
    text = raw.withColumn("fine_amount", F.when(F.col("row_seq") % 13 == 0, "n/a").otherwise(F.col("fine_amount").cast("string")))
    from kerbside.functions import ordered
    want = cleaning.clean(text)
    rows = cleaning.deduplicate(text)
    forced = cleaning.clean(text, slab_spreads=spreads(rows, ["fine_amount", "speed_kmh", "latitude", "longitude"], slab_rows=50))
    assert same(want, forced) and ordered.SLAB_ROWS == 1_000_000
    assert same(quantiles(text, "fine_amount", {"q": 0.5}, slab_rows=50), quantiles(text, "fine_amount", {"q": 0.5}))


def test_cumulate_in_slabs(spark, folder):
    df = hot(spark, folder).withColumn("value", F.when(F.col("event_id") % 5 > 0, F.col("value")))
    spread = spreads(df, ["value"], slab_rows=20)["value"]
    for by in ([], ["event_type"]):
        counts = value_counts(df, "value", by)
        assert same(cumulate(counts, "value", by, spread), cumulate(counts, "value", by, ONE))
        probs = {"a": 0.05, "b": 0.5, "c": 0.99}
        built_in = quantiles(df, "value", probs, by)
        for how in (spread, Spread(10**9, 10**9)):
            assert same(quantiles(df, "value", probs, by, how), built_in)
            assert same(quantiles(counts, "value", probs, by, how, "n"), built_in)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=40),
       cuts=st.lists(st.integers(-6, 6), max_size=4, unique=True))
def test_any_cuts_give_the_same_ranks(spark, data, cuts):
    df = spark.createDataFrame([(v,) for v in data], "v int")
    counts = value_counts(df, "v")
    spread = Spread(len(data), len(data), tuple(float(c) for c in sorted(cuts)))
    assert same(cumulate(counts, "v", [], spread), cumulate(counts, "v", [], ONE))


def test_numbering_in_slabs(spark, folder):
    df = hot(spark, folder)
    for by in ([], ["event_type"]):
        big = number_rows(df, ["value", "event_id"], "n", by, start=0, slab_rows=17)
        assert same(big, number_rows(df, ["value", "event_id"], "n", by, start=0))
    numbers = sorted(r.n for r in number_rows(df, ["value", "event_id"], "n", slab_rows=17).collect())
    assert numbers == list(range(1, df.count() + 1))


def test_lag_in_slabs(spark, folder):
    df = hot(spark, folder).withColumn("value", F.when(F.col("event_id") % 5 > 0, F.col("value")))
    for by in ([], ["event_type"]):
        big = previous_value(df, "value", ["user_id", "event_id"], "p", by, slab_rows=17)
        assert same(big, previous_value(df, "value", ["user_id", "event_id"], "p", by))


def test_zone_windows_in_slabs(spark, folder):
    df = clean_table(spark, folder)
    small = windows.zone_windows(df)
    assert same(windows.zone_windows(df, slab_rows=13), small)
    assert same(windows.top_per_zone(df, slab_rows=13), small.filter("rank_in_zone <= 5"))


def test_clean_in_slabs(spark, folder):
    raw = raw_incidents(spark, folder)
    cut = spreads(raw, ["fine_amount", "speed_kmh", "latitude", "longitude"], slab_rows=11)
    assert all(s.cuts for s in cut.values())
    assert same(cleaning.clean(raw, cut), cleaning.clean(raw))


def test_risk_in_slabs(spark, folder):
    df = clean_table(spark, folder).select("violation_id", "severity", "speed_kmh", "fine_amount")
    cut = spreads(df, ["fine_amount"], slab_rows=5)["fine_amount"]
    assert same(features.add_risk_score(df, cut), features.add_risk_score(df))


def test_star_and_offsets_in_slabs(spark, folder):
    df = enriched_table(spark, folder)
    assert same(star.dimension(df, "dim_location", slab_rows=19)[0], star.dimension(df, "dim_location")[0])
    log = messages.with_partition(clean_table(spark, folder).select("row_seq", "violation_id", "zone"))
    assert same(messages.with_offset(log, ["row_seq"], slab_rows=19), messages.with_offset(log, ["row_seq"]))


def test_keep_first_limits_groups_before_the_shuffle(spark, folder):
    text = plan(conform.keep_first(raw_incidents(spark, folder)))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_no_python_in_plans(spark, folder):
    raw = raw_incidents(spark, folder)
    for df in (cleaning.clean(raw), windows.zone_windows(clean_table(spark, folder)),
               features.add_risk_score(clean_table(spark, folder))):
        text = plan(df)
        assert "Python" not in text and "BatchEval" not in text


def test_statistics_are_broadcast_not_windowed(spark, folder):
    text = plan(features.normalise(clean_table(spark, folder), "speed_kmh"))
    assert "Broadcast" in text and "Window" not in text


def test_filters_and_columns_reach_the_scan(spark, folder):
    from kerbside.operators import analytics
    text = plan(analytics.zone_revenue_recent(clean_table(spark, folder), "2024-01-31"))
    assert "GreaterThanOrEqual(timestamp" in text
    assert "vehicle_type" not in text
    text = plan(analytics.explore(clean_table(spark, folder), zone="Downtown"))
    assert "EqualTo(zone,Downtown)" in text and "TakeOrderedAndProject" in text


def test_partition_pruning(spark, folder, tmp_path):
    from kerbside.sinks.files import export_partitioned
    df = clean_table(spark, folder)
    path = str(tmp_path / "by_zone")
    export_partitioned(df, path)
    back = spark.read.parquet(path)
    assert back.count() == df.count()
    one = back.filter("zone = 'Highway' AND severity = 'High'")
    assert "PartitionFilters: [isnotnull(zone" in plan(one)
    assert one.count() == df.filter("zone = 'Highway' AND severity = 'High'").count()
    # On request only the partitions that are written are replaced; else an export replaces the last one whole.
    export_partitioned(df.filter("zone = 'Highway'"), path, only_written=True)
    assert spark.read.parquet(path).count() == df.count()
    export_partitioned(df.filter("zone = 'Highway'"), path)
    assert spark.read.parquet(path).count() == df.filter("zone = 'Highway'").count()


def test_unsized_tables_are_not_broadcast(spark, folder):
    from kerbside.functions.ordered import attach
    a = spark.range(10).withColumnRenamed("id", "k")
    hinted = attach(a, a.withColumn("x", F.lit(1)), ["k"], rows=10)._jdf.queryExecution().analyzed().toString()
    unhinted = attach(a, a.withColumn("x", F.lit(1)), ["k"], rows=10**9)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in unhinted.lower()


def test_unbounded_categories_take_the_shuffle_join(spark, folder):
    df = clean_table(spark, folder)
    assert same(windows.zone_windows(df), windows.zone_windows(df, zones=windows.ZONE_BOUND))
    assert same(windows.zone_share(df), windows.zone_share(df, zones=windows.ZONE_BOUND))
    raw = cleaning.prepare(raw_incidents(spark, folder))
    assert same(impute.impute(raw), impute.impute(raw, pairs=C.MAX_ZONE_TYPE_GROUPS))


def test_stages_of_an_application_can_be_dropped(spark, folder):
    import os
    from kerbside import session as S
    path = S.write_stage(spark.range(3), "drop-me")
    assert spark.sparkContext.applicationId in path and S.exists(spark, path)
    before = clean_table(spark, folder).count()
    assert S.drop_stages(spark) and not os.path.exists(path)
    # The catalogue builds its tables again.
    assert clean_table(spark, folder).count() == before


def test_cluster_without_shared_folder_is_an_error():
    import pytest
    from kerbside import session as S

    class Conf:
        def get(self, *a):
            return None

    class Spark:
        conf = Conf()

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getConf():
                return Conf()

    with pytest.raises(RuntimeError):
        S.shared_dir(Spark())
