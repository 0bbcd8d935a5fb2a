"""Operators that compare rows with each other, and the pipeline, against brute force."""

import random
import re

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbside.llm import bpe, cotraining, cover_tree, decontaminate, graph, jaccard_join, langid, pii, sharding
from kerbside.llm.oracles import ORACLES
from kerbside.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return compare.duck(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, folder, con, name):
    assert compare.difference(QUERIES[name](spark, folder), con, ORACLES[name]) is None


def classes(links, nodes):
    """Least node of each node's component."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


# --- components -------------------------------------------------------------


def test_components(spark):
    draw = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(draw.randrange(200, 260), draw.randrange(200, 260)) for _ in range(40)] + [(7, 7), (1, 2), (2, 1)]
    df = spark.createDataFrame([*edges, (None, 3), (500, None)], "a long, b long")
    found = {r.node: r.root for r in graph.components(df).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    want = classes(edges, {n for e in edges for n in e})
    assert set(found) == nodes
    assert len({(found[n], want[n]) for n in nodes}) == len({found[n] for n in nodes}) == len({want[n] for n in nodes})
    assert graph.components(df.limit(0)).collect() == []


# --- shingles ---------------------------------------------------------------


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def corpus(seed, groups=12, copies=9):
    """Groups of near copies at all distances around the threshold, with shared passages and repeated rows."""
    draw = random.Random(seed)
    word = lambda: draw.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(draw.randrange(40))
    passage, texts = [word() for _ in range(40)], []
    for _ in range(groups):
        base = [word() for _ in range(draw.choice([3, 8, 30, 80]))] + (passage if draw.random() < 0.5 else [])
        for _ in range(copies):
            own = list(base)
            for _ in range(draw.randrange(4)):
                own[draw.randrange(len(own))] = word()
            texts.append(draw.choice([" ", "\n", "\t "]).join(w.upper() if draw.random() < 0.1 else w for w in own))
    return [*texts, None, "", " \n", "one two", "ONE  two", "É é", texts[0], texts[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_like_brute_force(spark, monkeypatch, seed):
    texts = corpus(seed)
    sets = [shingle_set(t) for t in texts]
    n = len(texts)
    links = [(i, j) for i in range(n) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = classes(links, range(n))
    df = spark.createDataFrame([(i, t, 5, i) for i, t in enumerate(texts)], "doc_id long, text string, n int, cid long").repartition(5)
    if seed == 2:  # small clusters, and every list dealt out by blocks
        monkeypatch.setattr(jaccard_join, "CLUSTER_SHINGLES", 60)
        monkeypatch.setattr(jaccard_join, "LIST_ROWS", 3)
        monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(df).collect()}
    assert found == {i: (len(s), want[i]) for i, s in enumerate(sets)}
    kept = [r.doc_id for r in jaccard_join.keep_one(df).collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_jaccard_odd_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, None), (None, "x"), (None, "x"), (9, "w " * 60_000)], "doc_id long, text string")
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.similar_components(df).collect())
    assert found == sorted([("None", 2, "5"), ("5", 2, "5"), ("5", 2, "5"), ("None", 0, "None"), ("None", 1, "None"), ("None", 1, "None"), ("9", 1, "9")])
    kept = sorted(((str(r.doc_id), (r.text or "")[:5]) for r in jaccard_join.keep_one(df).collect()))
    assert kept == [("5", "a b c"), ("9", "w w w"), ("None", ""), ("None", "x")]
    assert jaccard_join.similar_components(df.limit(0)).collect() == [] and jaccard_join.keep_one(df.limit(0)).collect() == []


def test_bounds_of_very_long_texts():
    """Sets whose hundredfold does not fit in 32 bits."""
    for n in (13_000_000, 15_000_000, 22_000_000, 30_000_000):
        size = np.array([n], np.int32)
        assert jaccard_join.possible(size - 1, size, size, size - 1, size, size, 75).all()
        assert not jaccard_join.possible(size // 2, size, size, size // 2, size, size, 75).any()
        assert jaccard_join.at_least(size, 75).tolist() == [n * 3 // 4]


def test_member_links_from_pivots():
    draw = random.Random(3)
    for _ in range(300):
        universe = range(60)
        p = set(draw.sample(universe, 30))
        q = set(draw.sample(sorted(p), 22)) | set(draw.sample(universe, 8))
        near = lambda s: (set(draw.sample(sorted(s), len(s) - 2)) | {draw.choice(universe)})
        left, right = [p, *(near(p) for _ in range(3))], [q, *(near(q) for _ in range(3))]
        blob = lambda s: np.array(sorted(s), np.uint64).tobytes()
        row = {"a_pivot": blob(p), "b_pivot": blob(q), "b_n": len(q), "gap": 1 - len(p & q) / len(p | q)}
        for s, pivot, members in (("a", p, left), ("b", q, right)):
            row |= {f"{s}_ns": [len(m) for m in members], f"{s}_gaps": [1 - len(m & pivot) / len(m | pivot) for m in members],
                    f"{s}_minus": [blob(pivot - m) for m in members], f"{s}_plus": [blob(m - pivot) for m in members]}
        assert jaccard_join.member_link(row, 75) == any(100 * len(a & b) >= 75 * len(a | b) for a in left for b in right)


# --- embeddings -------------------------------------------------------------


def test_cover_tree_like_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * rng.choice([0.02, 0.3, 1.0])).astype(np.float32).tolist(), int(i % 3)) for i in range(400)]
    rows += [(400 + i, rows[0][1], 0) for i in range(30)] + [(500, [2 * x for x in rows[0][1]], 0), (501, [0.0] * 16, 0), (502, None, 1), (503, [1.0, None] * 8, 1),
             (504, [float("nan")] * 16, 1), (505, rows[0][1], None), (506, [1.0, 2.0], 0), (507, [1.0, 2.0], 0), (508, [], 0), (509, [float("inf")] * 16, 2), (510, [-x for x in rows[0][1]], 0)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, n int, v string")
    unit = {}
    for i, v, label in rows:
        if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.asarray(np.asarray(v, np.float32), np.float64)
            unit[i] = (label, x / np.sqrt(x @ x))
    links = [(i, j) for i in unit for j in unit if i != j and unit[i][0] == unit[j][0] and len(unit[i][1]) == len(unit[j][1]) and unit[i][1] @ unit[j][1] >= 0.93]
    least, degree = classes(links, [r[0] for r in rows]), {}
    for i, _ in links:
        degree[i] = degree.get(i, 0) + 1
    for leaf in (1024, 20):
        found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_duplicates(df, leaf=leaf).collect()}
        assert found == {i: (degree.get(i, 0), least[i], least[i] == i) for i, *_ in rows}
    assert cover_tree.near_duplicates(df.limit(0)).collect() == []


def test_cover_tree_of_rescaled_copies(spark):
    """More copies of a direction than a leaf holds, by powers of two and by other factors, beside a few other vectors."""
    rows = [(k, [float(k + 1) * x for x in (0.3, -1.7, 2.9, 0.1)], 0) for k in range(150)] + [(300 + k, [2.0**k * x for x in (1.1, 0.2, -0.4, 5.0)], 0) for k in range(-60, 60)]
    rows += [(400 + k, [1.0, 0.3 * k, -1.0, 0.0], 0) for k in range(5)]
    unit = {i: np.asarray(v) / np.linalg.norm(v) for i, v, _ in rows}
    links = [(i, j) for i in unit for j in unit if i != j and unit[i] @ unit[j] >= 0.93]
    least = classes(links, list(unit))
    found = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), leaf=20).collect()}
    assert found == {i: (sum(a == i for a, _ in links), least[i]) for i in unit}


def test_net_of_equal_directions_ends():
    points = np.random.default_rng(3).normal(size=(1, 64)) * np.arange(1, 400)[:, None]
    points = points / np.linalg.norm(points, axis=1, keepdims=True)
    chosen = cover_tree.net(points, 0.0)
    assert len(chosen) == len(set(chosen))
    assert cover_tree.links(points, points, 0.1, 0.995).all()


def test_dual_traversal_is_exact():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(size=(1, 8)) + rng.normal(size=(60, 8)) * s for s in (0.01, 0.2, 1.0)])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    for cosine in (0.5, 0.93, 0.999):
        assert (cover_tree.links(points, points[::2], np.sqrt(2 - 2 * cosine), cosine) == (points @ points[::2].T >= cosine)).all()


# --- shards -----------------------------------------------------------------


def test_hilbert_neighbours(spark):
    import itertools
    for n, bits in ((2, 3), (3, 2), (1, 3), (4, 1)):
        cells = list(itertools.product(range(1 << bits), repeat=n))
        df = spark.createDataFrame([(list(c),) for c in cells], "x array<int>").select("x", sharding.hilbert_index("x", bits).alias("i"))
        path = sorted((r.i, tuple(r.x)) for r in df.collect())
        assert [i for i, _ in path] == list(range(len(cells)))
        assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for (_, p), (_, q) in zip(path, path[1:]))


def test_shards(spark, tmp_path):
    rows = [(i, f"t{i % 7}", None if i % 5 == 0 else i % 3, i * i % 97) for i in range(300)] + [(7, "t0", 1, 1)] * 90 + [(None, None, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, shard string, b int, curve int").withColumnRenamed("shard", "a").withColumnRenamed("curve", "c")
    for run_rows in (1_000_000, 25):
        placed = sharding.place(df, 8, ["a", "b", "c"], keep=["doc_id"], run_rows=run_rows).toPandas()
        sizes = placed.groupby("shard").size()
        assert len(placed) == len(rows) and list(sizes.index) == list(range(8)) and sizes.max() - sizes.min() <= 1
        for _, own in placed.groupby("shard"):
            assert sorted(own["slot"]) == list(range(len(own)))
        ordered = placed.sort_values(["shard", "slot"])
        assert ordered["curve"].is_monotonic_increasing
    few = sharding.place(df.limit(3), 8, ["a"], keep=["doc_id"])
    assert few.count() == 3 and few.select("shard").distinct().count() == 3 and sharding.place(df.limit(0), 8, ["a"]).collect() == []
    assert sharding.ranges(sharding.place(df, 4, ["a", "c"]), ["c"]).count() == 4
    # Whatever the columns are called: nothing is lost, and the folders' column is none of them.
    for i, names in enumerate((["doc_id", "a", "b", "c"], ["doc_id", "shard", "slot", "curve"], ["_shard", "Shard", "key0", "first"])):
        named = df.toDF(*names)
        out = sharding.write(named, str(tmp_path / f"out{i}"), 4, names[1:], names[:1])
        back = spark.read.parquet(str(tmp_path / f"out{i}"))
        assert set(back.columns) - set(names) == {out} and back.select(out).distinct().count() == 4
        assert compare.rows_of(names, back.select(names).collect()) == compare.rows_of(names, named.collect())


def test_filters_skip_shards(spark, tmp_path):
    """A narrow range of any one dimension lies in a part of the shards, and of the files, only."""
    rows = [(i, i * 7919 % 1024, i * 104729 % 1024, f"s{i * 31 % 16:02d}") for i in range(4096)]
    df = spark.createDataFrame(rows, "id int, x int, y int, s string")
    sharding.write(df, str(tmp_path / "out"), 16, ["x", "y", "s"], ["id"])
    back = spark.read.parquet(str(tmp_path / "out"))
    for column, low, high in (("x", 100, 130), ("y", 900, 930), ("s", "s03", "s03")):
        files = back.groupBy(F.col("_metadata.file_path")).agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.first("shard").alias("shard"))
        hit = [r for r in files.collect() if r.lo <= high and low <= r.hi]
        assert len({r.shard for r in hit}) <= 10 and len(hit) <= 0.65 * files.count()
        inside = back.where(F.col(column).between(low, high))
        assert {r.shard for r in inside.select("shard").distinct().collect()} <= {r.shard for r in hit}
        assert inside.count() == df.where(F.col(column).between(low, high)).count()


def test_cut_points_count_all_rows(spark):
    """Exact positions of every type, whatever the slabs; values that a sample of a few thousand rows would miss."""
    draw = random.Random(7)
    rows = [(i * 7919 % 9001, f"s{min(draw.randrange(3000), 400):04d}", [None, float("nan"), -0.0, 0.0, draw.random()][i % 5], None) for i in range(9001)]
    df = spark.createDataFrame(rows, "n int, s string, x double, none date").repartition(5)
    for slab_rows in (500, 20_000):
        found = sharding.cut_points(df, df.columns, 32, slab_rows)
        for at, c in enumerate(("n", "s")):
            values = sorted(r[at] for r in rows)
            assert found[c] == sorted({values[9001 * k // 32] for k in range(1, 32)}), c
        known = sorted((r[2] for r in rows if r[2] is not None), key=lambda v: (v != v, v))
        want = list(dict.fromkeys(repr(known[len(known) * k // 32] + 0.0) for k in range(1, 32)))
        assert [repr(v) for v in found["x"]] == want and found["none"] == []
        assert sharding.cut_points(df.limit(0), ["s"], 32, slab_rows) == {"s": []}


def test_shard_query_is_complete(spark, folder, con):
    found = QUERIES["op7_hilbert_shards"](spark, folder).toPandas()
    sizes = found.groupby("shard").size()
    assert len(found) == con.execute("select count(*) from documents").fetchone()[0] and sizes.max() - sizes.min() <= 1
    want = dict(con.execute("select doc_id, octet_length(encode(coalesce(text, ''))) + 1 from documents").fetchall())
    assert dict(zip(found["doc_id"], found["size"])) == want and found["slot"].max() == sizes.max() - 1


# --- quality ----------------------------------------------------------------


def test_cotraining_held_out(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = QUERIES["op3_quality_cotraining"](spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    assert ((found["score"] >= 0.5) == (found["quality"] == 1)).mean() > 0.9
    model = cotraining.train(docs, labels.limit(0))
    assert {r.score for r in cotraining.score(docs, model).collect()} == {0.5}


def random_bags(rng, y, size, per, kinds):
    """Features of which a class has a half of its own, each document ``per`` of them."""
    at = np.array([rng.choice(kinds // 2, per, replace=False) + (kinds // 2) * (rng.random(per) < (0.2 if c else 0.8)) for c in y])
    return cotraining.Bags(np.repeat(np.arange(len(y)), per), at.ravel(), len(y), size)


def test_cotraining_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 3000)
    text, meta = random_bags(rng, y, cotraining.TEXT, 12, 400), random_bags(rng, y, cotraining.VALUES, 9, 60)
    some = lambda a, b: ((np.arange(3000) >= a) & (np.arange(3000) < b))
    free = [v.of(some(80, 2000)) for v in (text, meta)]
    gather = lambda views, sure: cotraining.summed(views, free, sure)
    model = cotraining.co_train(text.of(some(0, 80)), meta.of(some(0, 80)), y[:80], gather, sure=0.9)
    alone = cotraining.co_train(text.of(some(0, 80)), meta.of(some(0, 80)), y[:80], lambda views, sure: [(np.zeros((2, cotraining.TEXT)), 0), (np.zeros((2, cotraining.VALUES)), 0)])
    right = lambda m: ((m.score(text.of(some(2000, 3000)), meta.of(some(2000, 3000))) > 0.5) == y[2000:]).mean()
    assert all(min(n) > 100 for n in model.given) and len(model.given) == 3 and right(model) > 0.95 and right(model) >= right(alone)
    # Sums over parts are the sums of the whole.
    views, parts = (model.text, model.meta), [[v.of(some(a, b)) for v in (text, meta)] for a, b in ((80, 700), (700, 2000))]
    whole, added = cotraining.summed(views, free, 0.9), [cotraining.summed(views, p, 0.9) for p in parts]
    for k in range(2):
        assert np.array_equal(whole[k][0], added[0][k][0] + added[1][k][0]) and whole[k][1] == added[0][k][1] + added[1][k][1]


def test_cotraining_learns_what_no_label_shows(spark):
    """Junk of a kind that no labelled document has, one document in 4,500, is known by its source alone; its words are learned from that."""
    draw = random.Random(4)
    good, bad = [f"word{i}" for i in range(60)], [f"spam{i}" for i in range(60)]
    text = lambda words: " ".join(draw.choice(words) for _ in range(30))
    rows = [(i, text(good if i % 2 else bad), f"{'clean' if i % 2 else 'dirty'}{i % 5}", "en", 150) for i in range(8994)]
    odd = [f"odd{i}" for i in range(8)]
    rows += [(9000 + i, " ".join(odd), f"dirty{2 * i}", "en", 150) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    model = cotraining.train(docs, labels)
    assert model.given and all(min(n) > 8000 for n in model.given)
    asked = spark.createDataFrame([(1, " ".join(odd), "new", "en", 150), (2, text(good), "new", "en", 150)], docs.schema)
    found = {r.doc_id: r.score for r in cotraining.score(asked, model).collect()}
    unlearned = {r.doc_id: r.score for r in cotraining.score(asked, cotraining.train(docs.where("doc_id < 9000"), labels)).collect()}
    assert found[1] < 0.45 and found[1] < unlearned[1] - 0.05 and found[2] > 0.8, (found, unlearned)
    again = cotraining.train(docs.repartition(7), labels)
    assert again.given == model.given and np.allclose(again.join, model.join)


def test_cotraining_tables(spark):
    rows = [(i, "plain words and more" if i % 2 else "!!! ### $$$", None if i % 7 == 0 else "s", "en", i, 1) for i in range(80)] + [(None, None, None, None, None, None), (200, "", "s", "en", 0, 0), (200, "", "s", "en", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, score int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(61, None), (None, 1), (62, 9), (3, 1)], "doc_id long, quality int")
    found = cotraining.score(docs, cotraining.train(docs, labels)).collect()
    assert len(found) == 83 and all(0 <= r.score <= 1 for r in found)
    assert all(r.keep == bool(r.doc_id % 2) for r in found if r.doc_id is not None and 60 <= r.doc_id < 80)
    assert cotraining.score(docs.limit(0), cotraining.train(docs, labels)).collect() == []


# --- pipeline ---------------------------------------------------------------


def test_pipeline_like_brute_force(spark, folder, con):
    """Every stage's decision again, by plain means."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = con.execute("select doc_id, text from documents order by doc_id").fetchall()
    model = langid.train(docs)
    rejected = model.predict([t for _, t in rows])[2]
    left = [r for r, bad in zip(rows, rejected) if not bad]
    assert len(left) > 0.95 * len(rows)
    sets = {i: shingle_set(t) for i, t in left}
    by_shingle, pairs = {}, {}
    for i, own in sets.items():
        for s in own:
            by_shingle.setdefault(s, []).append(i)
    for ids in by_shingle.values():
        for x, a in enumerate(ids):
            for b in ids[:x]:
                pairs[a, b] = pairs.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in pairs.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    least = classes(links, list(sets))
    left = [(i, t) for i, t in left if least[i] == i]
    items = [decontaminate.fold_one(t) for (t,) in con.execute("select text from benchmark").fetchall()]
    masks = [decontaminate.character_masks(t) for t in items]
    folded = {i: decontaminate.fold_one(t) for i, t in left}

    def leaks(i):
        # Whole texts against whole items; the fold alone decides for items that are there unchanged.
        return any(t in folded[i] for t in items) or any(decontaminate.best_stretch(t, folded[i], int(len(t) * 0.05), m) for t, m in zip(items, masks) if any(
            folded[i].find(t[a:a + 12]) >= 0 for a in range(0, len(t) - 12, 6)))

    left = [(i, t) for i, t in left if not leaks(i)]
    kept = spark.createDataFrame(left, "doc_id long, text string")
    field = pii.train(kept)
    own = bpe.encoder(bpe.default_path())
    want = {i: [len(ids), own.decode(ids)] for (i, _), ids in zip(left, own.encode([pii.mask(t, s) for (_, t), (_, s) in zip(left, pii.find([t for _, t in left], field))]))}
    import hashlib
    found = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(found) == set(want)
    assert found == {i: (n, hashlib.sha256(t.encode()).hexdigest()) for i, (n, t) in want.items()}


def test_pipeline_stages_keep_columns(spark, folder):
    docs = spark.createDataFrame([(1, None, "en", None, None), (2, "", None, "s", 0), (3, "the thing is that it is so", "en", "s", 26), (3, "the thing is that it is so", "en", "s", 26),
                                  (None, "mail a.b@c.de the thing is here", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, folder)
            assert out.columns == docs.columns and out.count() <= table.count()
    assert corpus_pipeline.near_duplicates(spark, docs, folder).count() == 4
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "decontamination", "pii", "bpe_encoding"]


def test_every_operator_has_its_query():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 11))
    assert len(QUERIES) == 10
