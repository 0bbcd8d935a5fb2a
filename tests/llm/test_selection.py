"""Vector codes, the source mix and the filter audit against plain versions."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import curriculum, filter_audit, vector_codes

# --- vector codes -----------------------------------------------------------


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """``(id, code, error, label error)`` of every row, and the digest of the codebooks."""
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    cut = []
    for i, v, l in kept:
        whole = [math.floor(Fraction(x) * scale) for x in v] + [0] * (parts * width - len(v))
        cut.append((i, l, [whole[p * width:(p + 1) * width] for p in range(parts)], v))
    least = {}
    for i, _, ps, v in cut:
        if i not in least or list(v) < least[i][0]:
            least[i] = (list(v), ps)
    first = sorted(least, key=lambda i: (i is None, i or 0))[:entries]
    books = [[least[i][1][p] for i in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((gap(x, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            came = defaultdict(list)
            for _, _, ps, _ in cut:
                came[near(ps[p], books[p])[1]].append(ps[p])
            for e, members in came.items():
                books[p][e] = [sum(m[k] for m in members) // len(members) for k in range(width)]
    out, by_label = [], Counter()
    for i, l, ps, _ in cut:
        found = [near(x, book) for x, book in zip(ps, books)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), l))
        by_label[l] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, c, e, by_label[l]) for i, c, e, l in out], digest


def test_nearest_like_brute_force():
    draw = np.random.default_rng(3)
    for width, spread, kind in ((1, 3, int), (4, 3, int), (16, 900, int), (7, 2 ** 40, object), (0, 1, int)):
        points = draw.integers(-spread, spread + 1, (300, width)).astype(kind)
        entries = draw.integers(-spread, spread + 1, (40, width)).astype(kind)
        entries[7] = entries[31]  # equal entries: the lower index
        index, best = vector_codes.nearest(points, entries)
        for k, p in enumerate(points.tolist()):
            want = min((sum((a - b) ** 2 for a, b in zip(p, c)), e) for e, c in enumerate(entries.tolist()))
            assert (int(best[k]), int(index[k])) == want


def test_search_ends_early():
    """Entries of far sums are never compared."""
    points, entries = np.zeros((1, 2), np.int64), np.array([[k * 100, 0] for k in range(50)])
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if self.ndim == 2 and isinstance(at, np.ndarray):
                seen.extend(np.ravel(at).tolist())
            return np.asarray(self)[at]

    assert vector_codes.nearest(points, entries.view(Watched))[0].tolist() == [0] and len(seen) <= 2


def test_vector_codes_like_brute_force(spark):
    draw = np.random.default_rng(11)
    rows = [(i, np.round(draw.normal(size=8), 2).tolist(), i % 3) for i in range(400)]
    rows += [(None, [0.5] * 8, 1), (3, rows[3][1], 0), (4, [0.0] * 8, None), (900, [], None), (901, [1.0, -2.0, 0.3], 2),
             (902, None, 1), (903, [1.0, None] + [0.0] * 6, 1), (904, [math.nan] * 8, 1), (905, [math.inf] + [0.0] * 7, 1), (906, [-0.0001] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    df = df.withColumns({"vector": F.lit("x"), "code": F.lit(1), "error": F.lit(2), "part": F.lit(3), "n": F.lit(4)})
    want, digest = plain_codes(rows)
    found = vector_codes.compress(df).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in found) == Counter(want)
    assert {r.codebooks_sha256 for r in found} == {digest}


def test_vector_codes_of_few_and_large_and_no_vectors(spark):
    schema = "vec_id long, embedding array<double>, label string"
    rows = [(1, [2.0 ** 21, -2.0 ** 20, 3.0], "a"), (2, [2.0 ** 21, 2.0 ** 20, 3.5], "b"), (2, [0.5, 0.5, 0.5], "a")]
    found = vector_codes.compress(spark.createDataFrame(rows, schema)).collect()
    want, digest = plain_codes(rows)
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in found) == Counter(want) and found[0].codebooks_sha256 == digest
    for none in ([], [(1, None, "a"), (2, [None], "b")]):
        empty = vector_codes.compress(spark.createDataFrame(none, schema))
        assert empty.collect() == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_codes_are_decoded_to_near_vectors(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    books = vector_codes.train(df)
    coded = vector_codes.encode(df, books)
    back = vector_codes.decode(coded.join(df.select("vec_id", "embedding"), "vec_id"), books).collect()
    loss = np.mean([np.sum((np.array(r.embedding) - r.approximation) ** 2) for r in back])
    assert len(back) == df.count() and loss < 0.25 * np.mean([np.sum(np.square(r.embedding)) for r in back])
    assert vector_codes.decode(spark.createDataFrame([(None,)], "code string"), books).first().approximation is None


# --- source mix -------------------------------------------------------------


def plain_targets(sizes, weights, repeats=3):
    """Share by weight, stop what is above, share the excess anew, until nothing is."""
    total, stopped, target = sum(sizes), set(), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in stopped]
        left = total - sum(repeats * sizes[i] for i in stopped)
        target = {i: Fraction(repeats * sizes[i]) for i in stopped} | {i: Fraction(left) * Fraction(weights[i]) / sum(Fraction(weights[j]) for j in free) for i in free}
        over = {i for i in free if target[i] > repeats * sizes[i]}
        if not over:
            return [target[i] for i in range(len(sizes))]
        stopped |= over


@pytest.mark.parametrize("sizes,weights", [
    ([100, 1, 1, 1000, 0], [1, 2, 3, 1, 2]), ([5, 5, 5], [1, 2, 3]), ([0, 0], [1, 2]), ([7], [1]), ([1, 10, 100, 1000, 10000], [3, 3, 2, 1, 0.25])])
def test_targets_like_plain_rounds(spark, sizes, weights):
    df = spark.createDataFrame([(i, s, float(w)) for i, (s, w) in enumerate(zip(sizes, weights))], "i int, source_size long, weight double").repartition(3)
    found = {r.i: r.target for r in curriculum.targets(df).collect()}
    assert [pytest.approx(float(t), abs=1e-9) for t in plain_targets(sizes, weights)] == [found[i] for i in range(len(sizes))]


def documents(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    return df.withColumns({"size": F.lit("x"), "place": F.lit(1), "target": F.lit(2), "taken": F.lit(3), "knots": F.lit(4)})


ROWS = [(i, " ".join(["w"] * (1 + i * 7 % 40)), f"s{i % 3}") for i in range(90)] + [
    (200, None, "s0"), (201, "", "s1"), (202, " \t\n ", None), (203, "a\x0bb\xa0c", None), (None, "no id at all", ""), (7, "twice", "t"), (7, "twice", "t"),
    (300, "long " * 50_000, "s1"), (301, None, "empty")]


def test_mix_takes_each_source_to_its_target(spark):
    found = curriculum.mix(documents(spark, ROWS), run_rows=10).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, len(re.findall("[^\x20\x09-\x0d]+", t or ""))) for i, t, _ in ROWS)
    sources = sorted({r.source for r in found}, key=lambda s: (s is None, s or ""))
    sizes = [sum(r.size for r in found if r.source == s) for s in sources]
    want = plain_targets(sizes, [1 + k % 3 for k in range(len(sources))])
    for s, size, target in zip(sources, sizes, want):
        own = [r for r in found if r.source == s]
        assert {r.source_size for r in own} == {size} and all(r.target == pytest.approx(float(target)) for r in own)
        assert sum(r.taken for r in own) == math.floor(float(target) + 0.5)
    assert all(0 <= r.taken <= 3 * r.size and r.taken == sum(c.words for c in r.copies) for r in found)
    again = curriculum.mix(documents(spark, ROWS).repartition(7), run_rows=1000).collect()
    assert Counter(map(str, again)) == Counter(map(str, found))


def test_position_is_the_inverse_of_the_demand(spark):
    """With a schedule of four knots, flat and zero stretches among them, a copy is due when its words are asked for."""
    knots = [(0.0, 0.0), (0.25, 0.0), (0.5, 4.0), (1.0, 1.0)]

    def schedules(sources):
        return sources.withColumn("knots", F.array(*[F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in knots]))

    def integral(t):
        grid = [(min(t, b[0]) - a[0], a[1], a[1] + (b[1] - a[1]) / (b[0] - a[0]) * (min(t, b[0]) - a[0])) for a, b in zip(knots, knots[1:]) if t > a[0]]
        return sum(d * (u + v) / 2 for d, u, v in grid)

    mixed = curriculum.mix(documents(spark, ROWS), schedules, run_rows=10)
    for r in mixed.collect():
        budget = math.floor(r.target + 0.5)
        assert all(0 <= c.position <= 1 and c.words > 0 for c in r.copies)
        assert [c.position for c in r.copies] == sorted(c.position for c in r.copies)
    order = curriculum.training_order(mixed, run_rows=16).orderBy("slot").collect()
    assert [r.slot for r in order] == list(range(len(order))) and [r.position for r in order] == sorted(r.position for r in order)
    budgets = {r.source: math.floor(r.target + 0.5) for r in mixed.collect()}
    for s, budget in budgets.items():
        given = 0
        for r in (r for r in order if r.source == s):
            assert integral(r.position) / integral(1.0) * budget == pytest.approx(given, abs=1e-6 * budget)
            given += r.words
        assert given == budget


def test_mix_of_nothing(spark):
    for rows in ([], [(1, None, "a"), (2, "", None)]):
        mixed = curriculum.mix(documents(spark, rows))
        assert [r.taken for r in mixed.collect()] == [0] * len(rows)
        assert curriculum.ordered_by_due(mixed).count() == len(rows) and curriculum.training_order(mixed).collect() == []


def test_mix_ranges_follow_training(spark, folder):
    """The rows come range-sorted, and a running sum is never one task's for a whole source."""
    mixed = curriculum.ordered_by_due(curriculum.mix(spark.read.parquet(f"{folder}/documents.parquet")))
    found = [r.first_position for r in mixed.collect()]
    taken = [p for p in found if p is not None]
    assert found[:len(taken)] == taken == sorted(taken)
    assert "rangepartitioning" in mixed._jdf.queryExecution().toString()


# --- filter audit -----------------------------------------------------------


def plain_audit(rows, labels):
    letters = "ABCDE"
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = []
    for i, t, s in rows:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        tests = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 bool(re.search("[#$%&*|]", t)), i is not None and first[t] < i]
        docs.append((s or "", {f for f, x in zip(letters, tests) if x}, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in itertools.permutations(letters):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                failing = [d for d in docs if d[0] == part and f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(d[1] == {f} for d in failing), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


AUDITED = [(i, " ".join(f"w{(i * 31 + k * k) % (60 + i % 3 * 40)}" for k in range(40 + i % 30)) + ["", " #", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 2][i % 3], f"s{i % 4}") for i in range(60)]
AUDITED += [(100 + i, AUDITED[i % 5][1], "s9") for i in range(40)] + [
    (300, None, None), (301, "", ""), (None, None, "s0"), (302, "é" * 30, "s1"), (303, "W" * 200_000, "s1"), (303, "W" * 200_000, "s1"), (304, " \t ", None)]
LABELS = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 120, 3)] + [(3, None, None), (None, 1, 1), (3, 1, 1), (300, 1, 1)]


def audited(spark, rows=AUDITED):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    docs = docs.withColumns({"row": F.lit("x"), "part": F.lit(1), "digest": F.lit(2), "A": F.lit(3), "filter": F.lit(4), "good": F.lit(5)})
    return docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("hot", [100_000, 3])
def test_audit_like_brute_force(spark, hot):
    docs, labels = audited(spark)
    found = filter_audit.audit_texts(docs, labels, bucket_rows=40, hot_rows=hot).collect()
    want = plain_audit(AUDITED, LABELS)
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found} == want
    assert len(found) == len(want)


def test_audit_of_nothing(spark):
    docs, labels = audited(spark)
    assert filter_audit.audit_texts(docs.limit(0), labels).collect() == []
    clean = " ".join(f"w{k}" for k in range(60))
    found = filter_audit.audit_texts(audited(spark, [(1, clean, "s")])[0], labels.limit(0)).collect()
    assert len(found) == 600 and {(r.kept, r.removed, r.redundant, r.shapley) for r in found} == {(1, 0, 0, 0)}


def test_audit_joins_move_nothing(spark):
    """The stored relations are bucketed by row: no exchange on either side of a join, whatever the prefix."""
    docs, labels = audited(spark)
    rows = filter_audit.flagged(docs, filter_audit.text_filters)
    ids = filter_audit.FailingIds(filter_audit.failing(rows, "ABCD", {"E": filter_audit.later_copies(rows)}, labels), "ABCDE")
    try:
        for joined in (ids.removed("AC"), ids.redundant("BDE")):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
        left = ids.survivors(rows, "ABE").count()
        want = {(order[:3], kept) for (part, order, step), (kept, *_) in plain_audit([(i, t, "") for i, t, _ in AUDITED], LABELS).items() if step == 3}
        assert {kept for order, kept in want if set(order) == set("ABE")} == {left}
    finally:
        ids.drop()


def test_audit_files_follow_the_buckets(spark, monkeypatch):
    """Where a session deals keys to more partitions than asked for, the stored relations have no more files for it, and the counts are the same."""
    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "repartition", lambda self, n, *cols, f=frame.repartition: f(self, max(n, 61) if cols else n, *cols))
    made = [(i, "W#", f"s{i % 3}") for i in range(400)]
    docs, labels = audited(spark, made)
    rows = filter_audit.flagged(docs, filter_audit.text_filters)
    ids = filter_audit.FailingIds(filter_audit.failing(rows, "ABCD", {"E": filter_audit.later_copies(rows)}, labels), "ABCDE")
    try:
        assert 0 < len(spark.table(ids.table).inputFiles()) <= 4 * 4 * 5
    finally:
        ids.drop()
    found = filter_audit.audit_texts(docs, labels).collect()
    want = plain_audit(made, LABELS)
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found} == want
