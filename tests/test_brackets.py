"""Order statistics from brackets, and duplicate rows by hashes, against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.functions.brackets import Wanted, bracketed
from kerbside.functions.ordered import quantiles
from kerbside.operators import quality


@pytest.mark.parametrize("kind", ["spread", "tied", "few"])
def test_brackets_keep_order_statistics(spark, kind):
    draw = random.Random(kind)
    n = 7 if kind == "few" else 4000
    value = {"spread": lambda: draw.gauss(0, 100), "tied": lambda: float(draw.choice([1, 1, 1, 2, 9])), "few": lambda: draw.random()}[kind]
    rows = [(draw.choice(["a", "a", "b", None]), None if draw.random() < 0.1 else value(), draw.choice(["x", "y", None])) for _ in range(n)] + [("only null", None, "x")] * 3
    df = spark.createDataFrame(rows, "g string, v double, t string").repartition(5)
    wanted = [Wanted("by_group", "v", 0.5, ("g",)), Wanted("all", "v", 0.25)]
    counts = bracketed(df, wanted, ["t"], groups=10)
    own = lambda name: counts.where(F.col("stat") == name)
    found = {r.g: r.q for r in quantiles(own("by_group"), "value", {"q": 0.5}, ["g"], weight="n").collect()}
    for g in {r[0] for r in rows}:
        known = [v for h, v, _ in rows if h == g and v is not None]
        assert found[g] == (pytest.approx(np.percentile(known, 50)) if known else None)
    every = [v for _, v, _ in rows if v is not None]
    assert quantiles(own("all"), "value", {"q": 0.25}, weight="n").first().q == pytest.approx(np.percentile(every, 25))
    assert own("all").agg(F.sum("n")).first()[0] == len(rows)
    assert {r.text: r.n for r in own("t").collect()} == Counter(t for _, _, t in rows)
    if kind == "spread":  # most values are folded away
        assert own("all").count() < 0.1 * len(every)


def test_filled_brackets_allow_for_any_fill(spark):
    """The median of the column lies in its bracket whether the nulls are filled low or high."""
    rows = [(float(i),) for i in range(1000)] + [(None,)] * 150
    counts = bracketed(spark.createDataFrame(rows, "v double"), [Wanted("half", "v", 0.5, filled=True)])
    kept = counts.where("value IS NOT NULL").select("value", "n")
    for fill in (-5.0, 2000.0, 500.0):
        filled = kept.unionByName(spark.createDataFrame([(fill, 150)], "value double, n long"))
        assert quantiles(filled, "value", {"q": 0.5}, weight="n").first().q == np.percentile([*range(1000), *[fill] * 150], 50)


ROWS = [(1, "a", None), (1, "a", None), (None, "a", 1.0), (None, 'a', 1.0), (None, "a", 1.0), (1, None, 1.0), (2, "a", float("nan")), (2, "a", float("nan")), (3, "b", 0.0), (3, "b", -0.0), (4, "", None), (4, None, None)]


@pytest.mark.parametrize("first,second,want", [(None, None, 5), ("7L", None, 5), ("coalesce(a, 0) % 2", None, 5), ("1L", "monotonically_increasing_id()", 5), ("1L", "1L", 11)])
def test_duplicate_rows_with_forced_collisions(spark, first, second, want):
    """Where rows of one first hash differ in the second, they are compared as they are; only rows equal in both are taken for equal."""
    df = spark.createDataFrame(ROWS, "a long, b string, c double").repartition(3)
    own = quality.row_hashes(df.columns)
    pair = (F.expr(first) if first else own[0], F.expr(second) if second else own[1])
    assert quality.duplicate_rows(df, "n", pair).first().n == want
    assert quality.duplicate_count(df, df.columns, "n").first().n == 5
