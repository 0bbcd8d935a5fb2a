"""Exact Jaccard join of word-shingle sets, by the relations between sets.

1. Each chunk of texts sends its distinct shingles to the part of the hash range that they fall in; the part answers
   with those that occur more than once in the corpus, and how often. A shingle of one text can match nothing, so
   only the shared ones go on, and a set with too few of them has no partner.
2. Equal sets fold to a class. Classes with the same two smallest hash images form clusters of bounded size around a
   pivot; members are kept as their difference from it.
3. Index: each cluster posts the rarest shingles of its members, each once, with positions and sizes. Lists are cut
   into blocks by position, and pairs of blocks whose bounds rule out a link are skipped.
4. Pairs of clusters are decided on their pivots. Jaccard distance is a metric, so a pair further apart than the
   threshold and both radii has no link. For the few that remain undecided and are not yet connected, the overlaps of
   the members are derived from those of the pivots and the differences.

Every step is exact; a cluster is connected through its pivot, so components need no pair of one group written out.
"""

import gc

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from kerbside.llm.batches import chunks, per_task, pick, texts_of
from kerbside.llm.graph import components
from kerbside.llm.shingles import shingles
from kerbside.llm.wordcache import mix
from kerbside.session import stage

#: Bytes of shingles that one part of the hash range answers for, shingles of a cluster, postings of one list in a task.
PART_BYTES, CLUSTER_SHINGLES, LIST_ROWS = 16_000_000, 250_000, 20_000
BLOCK = 64
MANY = 0xFFFF
ASK = np.dtype([("hash", "<u8"), ("slot", "<u2")])
ANSWER = np.dtype([("hash", "<u8"), ("slot", "<u2"), ("rank", "u1")])
SLOT = np.dtype([("n", "<i4"), ("k1", "<i8"), ("k2", "<i8")])
POST = np.dtype([("hash", "<i8"), ("rest", "<i4")])


def at_least(sizes, percent):
    """The least overlap of a set with any partner."""
    return -(-np.asarray(sizes, np.int64) * percent // 100)


def linked(overlap, n, m, percent):
    return 100 * overlap >= percent * (n + m - overlap)


# --- 1: shared shingles -----------------------------------------------------


def _asker(parts, id_type):
    schema = _row_schema(id_type)

    def run(batches):
        base, number = TaskContext.get().partitionId() << 32, -1
        for batch in chunks(batches, size=1 << 20):
            for at in range(0, batch.num_rows, MANY - 1):
                number += 1
                yield from _ask(batch.slice(at, MANY - 1), base + number, parts, schema)

    return run, from_arrow_schema(schema)


def _row_schema(id_type):
    return pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("ids", pa.list_(pa.list_(id_type))), ("slots", pa.binary()), ("body", pa.binary())])


def _ask(batch, chunk, parts, schema):
    owner, hashes = shingles(texts_of(batch))
    sizes = np.bincount(owner, minlength=batch.num_rows)
    first = np.cumsum(sizes) - sizes
    keys = np.zeros((2, batch.num_rows), np.uint64)
    some = sizes > 0
    if some.any():
        for i, salt in enumerate((0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)):
            keys[i, some] = np.add.reduceat(mix(hashes ^ np.uint64(salt)), first[some])
    # Texts with equal sets share a slot.
    slots = np.empty(batch.num_rows, np.dtype([("n", "<i4"), ("k1", "<i8"), ("k2", "<i8")]))
    slots["n"], slots["k1"], slots["k2"] = sizes, keys[0].view(np.int64), keys[1].view(np.int64)
    unique, lead, slot = np.unique(slots, return_index=True, return_inverse=True)
    ids = batch.column(batch.schema.get_field_index("doc_id"))
    groups = [[] for _ in unique]
    for i, s in zip(ids.to_pylist(), slot.tolist()):
        groups[s].append(i)
    mine = np.zeros(batch.num_rows, bool)
    mine[lead] = True
    mine = mine[owner]
    owner, hashes = slot[owner[mine]], hashes[mine]
    order = np.argsort(hashes, kind="stable")
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    at = np.flatnonzero(new)
    counts = np.diff(np.r_[at, len(hashes)])
    asks = np.empty(len(at), ASK)
    asks["hash"], asks["slot"] = hashes[at], np.where(counts > 1, MANY, owner[at])
    several = np.repeat(counts > 1, counts)
    local = np.empty(int(several.sum()), ASK)
    local["hash"], local["slot"] = hashes[several], owner[several]
    id_type = schema.field("ids").type
    home = int(chunk * 2654435761 % parts)
    yield pa.RecordBatch.from_arrays([pa.array([home], pa.int32()), pa.array([chunk], pa.int64()), pa.array([1], pa.int32()), pa.array([groups], id_type),
                                      pa.array([unique.astype(SLOT).tobytes()]), pa.array([local.tobytes()])], schema=schema)
    # The upper 32 bits of a hash give its part.
    part = ((asks["hash"] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(part, np.arange(parts + 1))
    used = np.flatnonzero(np.diff(cuts))
    yield pa.RecordBatch.from_arrays([
        pa.array(used, pa.int32()), pa.array([chunk] * len(used), pa.int64()), pa.array([0] * len(used), pa.int32()), pa.array([None] * len(used), id_type),
        pa.array([None] * len(used), pa.binary()), pa.array([asks[cuts[p]:cuts[p + 1]].tobytes() for p in used], pa.binary())], schema=schema)


def _groups(batches, column):
    """Rows of consecutive equal ``column``, as lists of dicts."""
    held, key = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[column] != key:
                yield held
                held = []
            key = row[column]
            held.append(row)
    if held:
        yield held


def _answerer(id_type):
    schema = _row_schema(id_type)

    def row(part, chunk, kind, ids, slots, body):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([chunk], pa.int64()), pa.array([kind], pa.int32()),
                                           pa.array([ids], schema.field("ids").type), pa.array([slots], pa.binary()), pa.array([body], pa.binary())], schema=schema)

    def run(batches):
        for rows in _groups(batches, "part"):
            asks = [r for r in rows if r["kind"] == 0]
            for r in rows:
                if r["kind"] == 1:
                    yield row(r["part"], r["chunk"], 1, r["ids"], r["slots"], r["body"])
            if not asks:
                continue
            every = np.frombuffer(b"".join(r["body"] for r in asks), ASK)
            source = np.repeat(np.arange(len(asks)), [len(r["body"]) // ASK.itemsize for r in asks])
            order = np.argsort(every["hash"], kind="stable")
            hashes = every["hash"][order]
            new = np.ones(len(hashes), bool)
            new[1:] = hashes[1:] != hashes[:-1]
            run_of = np.cumsum(new) - 1
            total = np.bincount(run_of, weights=np.where(every["slot"][order] == MANY, 2, 1))
            shared = total[run_of] > 1
            order, frequency = order[shared], total[run_of][shared]
            back = np.argsort(source[order], kind="stable")
            order, frequency = order[back], frequency[back]
            answers = np.empty(len(order), ANSWER)
            answers["hash"], answers["slot"] = every["hash"][order], every["slot"][order]
            answers["rank"] = np.minimum(255, 4 * np.log2(frequency))
            cuts = np.searchsorted(source[order], np.arange(len(asks) + 1))
            for i, r in enumerate(asks):
                if cuts[i] < cuts[i + 1]:
                    yield row(r["part"], r["chunk"], 2, None, None, answers[cuts[i]:cuts[i + 1]].tobytes())

    return run, from_arrow_schema(schema)


def _gatherer(id_type, percent):
    schema = pa.schema([("ids", pa.list_(id_type)), ("n", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("shared", pa.binary()), ("s1", pa.int64()), ("s2", pa.int64())])

    def run(batches):
        for rows in _groups(batches, "chunk"):
            home = next(r for r in rows if r["kind"] == 1)
            slots, local = np.frombuffer(home["slots"], SLOT), np.frombuffer(home["body"], ASK)
            answers = np.frombuffer(b"".join(r["body"] for r in rows if r["kind"] == 2), ANSWER)
            single = answers[answers["slot"] != MANY]
            many = answers[answers["slot"] == MANY]
            many = many[np.argsort(many["hash"])]
            rank = many["rank"][np.searchsorted(many["hash"], local["hash"])] if len(local) else np.zeros(0, np.uint8)
            slot = np.concatenate([single["slot"], local["slot"]])
            rank = np.concatenate([single["rank"], rank])
            hashes = np.concatenate([single["hash"], local["hash"]])
            counts = np.bincount(slot, minlength=len(slots))
            enough = (counts >= at_least(slots["n"], percent)) & (slots["n"] > 0)
            use = enough[slot]
            slot, rank, hashes = slot[use], rank[use], hashes[use]
            order = np.lexsort((hashes, rank, slot))
            slot, hashes = slot[order], hashes[order]
            cuts = np.searchsorted(slot, np.arange(len(slots) + 1))
            shared, s1, s2 = [], [], []
            for k in range(len(slots)):
                own = hashes[cuts[k]:cuts[k + 1]] if enough[k] else None
                shared.append(None if own is None else own.tobytes())
                s1.append(None if own is None else int(mix(own ^ np.uint64(0x243F6A8885A308D3)).min().view(np.int64)))
                s2.append(None if own is None else int(mix(own ^ np.uint64(0x13198A2E03707344)).min().view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(home["ids"], schema.field("ids").type), pa.array(slots["n"]), pa.array(slots["k1"]), pa.array(slots["k2"]),
                                              pa.array(shared, pa.binary()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64())], schema=schema)

    return run, from_arrow_schema(schema)


def shared_sets(docs, percent):
    """One row per chunk and distinct set: ``ids, n, k1, k2`` and, if it may have a partner, its shared shingles, rarest first."""
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(16, int(size * 1.5 // PART_BYTES))
    ask, row = _asker(parts, id_type)
    answer, _ = _answerer(id_type)
    gather, out = _gatherer(id_type, percent)
    # As many tasks as parts, so that what a task holds at once stays near PART_BYTES.
    asked = docs.mapInArrow(per_task(ask), row).repartition(parts, "part").sortWithinPartitions("part")
    answered = asked.mapInArrow(per_task(answer), row).repartition(parts, "chunk").sortWithinPartitions("chunk")
    return answered.mapInArrow(per_task(gather), out)


# --- 2: clusters ------------------------------------------------------------

CLUSTER = pa.schema([
    ("cluster", pa.int64()), ("n", pa.int32()), ("pivot", pa.binary()), ("radius", pa.float64()), ("least", pa.int32()), ("most", pa.int32()),
    ("cids", pa.list_(pa.int64())), ("ns", pa.list_(pa.int32())), ("gaps", pa.list_(pa.float64())),
    ("minus", pa.list_(pa.binary())), ("plus", pa.list_(pa.binary())), ("posts", pa.binary())])


def _posts(hashes, n, percent):
    """The postings of a set: its first shingles in the common order that have to hold one of every partner's."""
    lonely = n - len(hashes)
    upto = n - int(at_least(n, percent)) + 1 - lonely
    own = np.empty(max(0, min(upto, len(hashes))), POST)
    own["hash"] = hashes[:len(own)].view(np.int64)
    own["rest"] = n - lonely - np.arange(len(own)) - 1
    return own


def _clusterer(percent):
    def run(keys, table):
        rows = sorted(table.to_pylist(), key=lambda r: (-r["n"], r["cid"]))
        sets = [np.frombuffer(r["shared"], np.uint64) for r in rows]
        sorts = [np.sort(s) for s in sets]
        left, out = list(range(len(rows))), []
        while left:
            lead, inside, rest = left[0], [], []
            for k in left:
                overlap = len(np.intersect1d(sorts[lead], sorts[k], assume_unique=True)) if k != lead else rows[k]["n"]
                n, m = rows[lead]["n"], rows[k]["n"]
                if k == lead or linked(overlap, n, m, percent):
                    inside.append((k, 1 - overlap / (n + m - overlap)))
                else:
                    rest.append(k)
            posts = np.concatenate([_posts(sets[k], rows[k]["n"], percent) for k, _ in inside])
            order = np.lexsort((-posts["rest"], posts["hash"]))
            posts = posts[order]
            fresh = np.ones(len(posts), bool)
            fresh[1:] = posts["hash"][1:] != posts["hash"][:-1]
            ns = [rows[k]["n"] for k, _ in inside]
            out.append({
                "cluster": rows[lead]["cid"], "n": rows[lead]["n"], "pivot": sorts[lead].tobytes(), "radius": max(g for _, g in inside),
                "least": min(ns), "most": max(ns), "cids": [rows[k]["cid"] for k, _ in inside], "ns": ns, "gaps": [g for _, g in inside],
                "minus": [np.setdiff1d(sorts[lead], sorts[k], assume_unique=True).tobytes() for k, _ in inside],
                "plus": [np.setdiff1d(sorts[k], sorts[lead], assume_unique=True).tobytes() for k, _ in inside],
                "posts": posts[fresh].tobytes()})
            left = rest
        return pa.Table.from_pylist(out, CLUSTER)

    return run, from_arrow_schema(CLUSTER)


# --- 3: index ---------------------------------------------------------------

POSTED = pa.schema([("hash", pa.int64()), ("cluster", pa.int64()), ("rest", pa.int32()), ("least", pa.int32()), ("most", pa.int32())])


def _post_rows(batches):
    for batch in batches:
        for row in batch.to_pylist():
            posts = np.frombuffer(row["posts"], POST)
            if len(posts):
                same = lambda v, kind: pa.array(np.full(len(posts), v), kind)
                yield pa.RecordBatch.from_arrays([pa.array(posts["hash"]), same(row["cluster"], pa.int64()), pa.array(posts["rest"]),
                                                  same(row["least"], pa.int32()), same(row["most"], pa.int32())], schema=POSTED)


def possible(rest_a, least_a, most_a, rest_b, least_b, most_b, percent):
    """Whether a first common shingle at these positions, and these sizes, leave room for a link (vectorised bounds)."""
    # Sizes are stored in 32 bits; their hundredfold is not.
    rest_a, least_a, most_a, rest_b, least_b, most_b = (np.asarray(x, np.int64) for x in (rest_a, least_a, most_a, rest_b, least_b, most_b))
    overlap = 1 + np.minimum(rest_a, rest_b)
    return ((100 + percent) * overlap >= percent * (least_a + least_b)) & (100 * most_a >= percent * least_b) & (100 * most_b >= percent * least_a)


def list_pairs(cluster, rest, least, most, side_a, side_b, percent):
    """Candidate pairs of one list between the rows ``side_a`` and ``side_b`` (the same array: within it).

    Rows are sorted by what is left behind their position and cut into blocks; blocks that cannot match are skipped.
    """
    within = side_a is side_b
    blocks = []
    for side in (side_a, side_b):
        side = side[np.argsort(-rest[side], kind="stable")]
        starts = np.arange(0, len(side), BLOCK)
        blocks.append((side, starts, np.maximum.reduceat(rest[side], starts), np.minimum.reduceat(least[side], starts), np.maximum.reduceat(most[side], starts)))
        if within:
            blocks.append(blocks[0])
            break
    (a, a_at, a_rest, a_least, a_most), (b, b_at, b_rest, b_least, b_most) = blocks
    for i in range(len(a_at)):
        fits = possible(a_rest[i], a_least[i], a_most[i], b_rest, b_least, b_most, percent)
        for j in np.flatnonzero(fits):
            if within and j < i:
                continue
            left, right = a[a_at[i]:a_at[i] + BLOCK], b[b_at[j]:b_at[j] + BLOCK]
            ok = possible(rest[left][:, None], least[left][:, None], most[left][:, None], rest[right], least[right], most[right], percent)
            ok &= cluster[left][:, None] != cluster[right]
            p, q = np.nonzero(ok)
            yield cluster[left[p]], cluster[right[q]]


def _pairer(percent):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        held, size = [], 0

        def flush():
            if held:
                a, b = (np.concatenate(x) for x in zip(*held))
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                held.clear()
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=schema)

        carry = None
        for batch in _with_end(batches):
            table = carry if batch is None else pa.Table.from_batches([batch]) if carry is None else pa.concat_tables([carry, pa.Table.from_batches([batch])])
            if table is None or not table.num_rows:
                continue
            hashes, lo, hi, block, cluster, rest, least, most = (table.column(c).to_numpy() for c in ("hash", "lo", "hi", "block", "cluster", "rest", "least", "most"))
            new = np.flatnonzero((np.diff(hashes) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)) + 1
            cuts = np.r_[0, new, len(hashes)]
            # The last list may go on in the next batch.
            carry = None if batch is None else table.slice(int(cuts[-2]))
            stop = len(cuts) - 1 if batch is None else len(cuts) - 2
            widths = np.diff(cuts)[:stop]
            two = cuts[:stop][widths == 2]
            if len(two):
                x, y = two, two + 1
                ok = possible(rest[x], least[x], most[x], rest[y], least[y], most[y], percent) & ((lo[x] == hi[x]) | (block[x] != block[y])) & (cluster[x] != cluster[y])
                held.append((cluster[x[ok]], cluster[y[ok]]))
                size += int(ok.sum())
            for k in np.flatnonzero(widths > 2):
                rows = np.arange(cuts[k], cuts[k + 1])
                if lo[rows[0]] == hi[rows[0]]:
                    sides = (rows, rows)
                else:
                    own = block[rows] == lo[rows[0]]
                    sides = (rows[own], rows[~own])
                if len(sides[0]) and len(sides[1]):
                    for pair in list_pairs(cluster, rest, least, most, *sides, percent):
                        held.append(pair)
                        size += len(pair[0])
                        if size > 1_000_000:
                            yield from flush()
                            size = 0
            if size > 1_000_000:
                yield from flush()
                size = 0
        yield from flush()

    return run, from_arrow_schema(schema)


def _with_end(batches):
    yield from batches
    yield None


def candidate_pairs(clusters, percent):
    """Distinct pairs of clusters that share a posting with room for a link. Long lists are dealt to tasks by pairs of blocks."""
    posts = stage(clusters.select("cluster", "least", "most", "posts").mapInArrow(per_task(_post_rows), from_arrow_schema(POSTED)), "posts")
    counts = posts.groupBy("hash").agg(F.count("*").alias("rows")).where("rows > 1")
    ways = F.ceil(F.col("rows") / F.lit(LIST_ROWS)).cast("int")
    wide = posts.join(counts, "hash").withColumn("block", F.pmod(F.xxhash64("cluster"), ways).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), ways - 1))) \
        .select("hash", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "cluster", "rest", "least", "most")
    run, schema = _pairer(percent)
    return wide.repartition("hash", "lo", "hi").sortWithinPartitions("hash", "lo", "hi").mapInArrow(per_task(run), schema).distinct()


# --- 4: decisions -----------------------------------------------------------


def _pivot_decider(percent):
    """Rows of pairs with both pivots to ``a, b, linked``; pairs that can hold no link are left out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_()), ("gap", pa.float64())])
    reach = 1 - percent / 100

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                overlap = len(np.intersect1d(np.frombuffer(r["a_pivot"], np.uint64), np.frombuffer(r["b_pivot"], np.uint64), assume_unique=True))
                gap = 1 - overlap / (r["a_n"] + r["b_n"] - overlap)
                if linked(overlap, r["a_n"], r["b_n"], percent):
                    out.append((r["a"], r["b"], True, gap))
                elif gap <= reach + r["a_radius"] + r["b_radius"] + 1e-9:
                    out.append((r["a"], r["b"], False, gap))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run, from_arrow_schema(schema)


def _size(a, b):
    return len(np.intersect1d(a, b, assume_unique=True))


def member_link(r, percent):
    """Whether any two members of a pair of clusters are linked; overlaps are derived from the pivots' and the differences."""
    reach = 1 - percent / 100
    p, q = np.frombuffer(r["a_pivot"], np.uint64), np.frombuffer(r["b_pivot"], np.uint64)
    overlap = _size(p, q)
    parts = lambda s: [(n, g, np.frombuffer(m, np.uint64), np.frombuffer(x, np.uint64)) for n, g, m, x in zip(r[f"{s}_ns"], r[f"{s}_gaps"], r[f"{s}_minus"], r[f"{s}_plus"])]
    left, right = parts("a"), parts("b")
    widest = max(g for _, g, _, _ in right)
    for n, gap, minus, plus in left:
        if gap + widest + reach + 1e-9 < r["gap"]:
            continue
        # Of this member with the other pivot, from that of the pivots.
        with_pivot = overlap - _size(minus, q) + _size(plus, q)
        nearer = 1 - with_pivot / (n + r["b_n"] - with_pivot)
        for m, other, less, more in right:
            if nearer > reach + other + 1e-9:
                continue
            own = lambda x: _size(x, p) - _size(x, minus) + _size(x, plus)  # noqa: E731  overlap of x with the member
            if linked(with_pivot - own(less) + own(more), n, m, percent):
                return True
    return False


def _member_decider(percent):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            found = [(r["a"], r["b"]) for r in batch.to_pylist() if member_link(r, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], schema=schema)

    return run, from_arrow_schema(schema)


def _release(spark):
    """Let go of the shuffle files of finished steps: Spark deletes them once the driver has forgotten their plans."""
    for _ in range(2):  # Python's references to plans reach the JVM with the call after
        gc.collect()
        spark._jvm.System.gc()


def _beside(pairs, clusters, columns):
    for side in ("a", "b"):
        pairs = pairs.join(clusters.select(F.col("cluster").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return pairs


def similar_components(df, percent=75, id_col="doc_id", text_col="text"):
    """Components of the links of word-shingle sets with a Jaccard similarity of at least ``percent`` / 100; one row per row.

    ``doc_id``, ``n_shingles`` and ``component_id``, the least id of the component. Null texts and texts without words
    have no shingles and are components of their own; texts of fewer than five words have one shingle; equal
    texts and repeated rows are linked; null ids take part but are never the least. Other columns are not read.
    """
    docs = pick(df, id_col, text_col)
    sets = stage(shared_sets(docs, percent), "sets")
    _release(df.sparkSession)
    classes = sets.where("shared IS NOT NULL").groupBy("k1", "k2").agg(F.first("n").alias("n"), F.first("shared").alias("shared"), F.first("s1").alias("s1"), F.first("s2").alias("s2"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    heavy = classes.groupBy("s1", "s2").agg(F.sum("n").alias("total"))
    parts = F.ceil(F.col("total") / F.lit(CLUSTER_SHINGLES)).cast("int")
    dealt = classes.join(heavy, ["s1", "s2"]).withColumn("part", F.pmod(F.xxhash64("cid"), parts))
    cluster, schema = _clusterer(percent)
    # Dealt by the part as well, so that a signature that many classes share does not meet in one task.
    dealt = dealt.select("s1", "s2", "part", "cid", "n", "shared").repartition("s1", "s2", "part")
    clusters = stage(dealt.groupBy("s1", "s2", "part").applyInArrow(cluster, schema), "clusters")
    del dealt
    _release(df.sparkSession)
    pairs = candidate_pairs(clusters, percent)
    decide, schema = _pivot_decider(percent)
    decided = stage(_beside(pairs, clusters, ["n", "pivot", "radius"]).mapInArrow(decide, schema), "decided")
    edges = decided.where("linked").select("a", "b")
    open_pairs = decided.where("NOT linked").select("a", "b", "gap")
    if not open_pairs.isEmpty():
        roots = components(edges)
        to = lambda s: roots.select(F.col("node").alias(s), F.col("root").alias(f"{s}_root"))
        apart = open_pairs.join(to("a"), "a", "left").join(to("b"), "b", "left") \
            .where("coalesce(a_root, a) <> coalesce(b_root, b)").select("a", "b", "gap")
        decide, schema = _member_decider(percent)
        more = _beside(apart, clusters, ["n", "pivot", "ns", "gaps", "minus", "plus"]).mapInArrow(decide, schema)
        edges = stage(edges.unionByName(more), "edges")
    inside = clusters.select(F.explode("cids").alias("cid"), "cluster")
    roots = components(edges)
    class_roots = inside.join(roots.withColumnRenamed("node", "cluster"), "cluster", "left").select("cid", F.coalesce("root", "cluster").alias("root"))
    named = classes.select("k1", "k2", "cid").join(class_roots, "cid").select("k1", "k2", F.col("root"))
    # Sets without a partner keep their own key as the name of their component.
    keyed = sets.where("n > 0").groupBy("k1", "k2").agg(F.min(F.array_min("ids")).alias("least")) \
        .join(named, ["k1", "k2"], "left").withColumn("name", F.when(F.col("root").isNull(), F.struct("k1", "k2")).otherwise(F.struct(F.col("root").alias("k1"), F.lit(None).cast("long").alias("k2"))))
    keyed = stage(keyed, "keyed")
    least = keyed.groupBy("name").agg(F.min("least").alias("component_id"))
    component = keyed.join(least, keyed["name"].eqNullSafe(least["name"])).select("k1", "k2", "component_id")
    out = sets.select("ids", "n", "k1", "k2")
    some = out.where("n > 0").join(component, ["k1", "k2"]).select(F.explode("ids").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id")
    none = out.where("n = 0").select(F.explode("ids").alias("doc_id")).select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none)


def keep_one(df, percent=75, id_col="doc_id", text_col="text"):
    """All columns of one row of each component: that with the least id, rows without an id last.

    Rows with equal id and text count as one. Texts without words stay, each on its own id.
    """
    own = {"x": F.col(f"`{id_col}`").isNull(), "d": F.col(f"`{id_col}`"), "h": F.xxhash64(F.col(f"`{text_col}`"))}
    keyed = df.select(F.struct(*[c.alias(n) for n, c in own.items()]).alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = similar_components(keyed, percent)
    chosen = stage(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows")).select("doc_id.*", "rows"), "chosen")

    def rows(which):
        some = chosen.where(which).select(F.col("d").alias("__d"), F.col("h").alias("__h"))
        return df.join(some, own["d"].eqNullSafe(F.col("__d")) & own["h"].eqNullSafe(F.col("__h")), "left_semi")

    once = rows("rows = 1")
    if chosen.where("rows > 1").isEmpty():
        return once
    return once.unionByName(rows("rows > 1").dropDuplicates([id_col, text_col]))
