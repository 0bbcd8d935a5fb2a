"""Exact near-duplicate embeddings by a dual traversal of cover trees.

Vectors of one label form a tree: a node covers its points within its radius, its children have at most half of the
reach that split it, and every point hangs below its nearest child. A pair of nodes further apart than both covering
radii and the threshold together holds no link and is dropped with all below it. The upper levels are Spark tables,
split until a leaf is small; pairs of leaves that remain are tasks of their own, in which the traversal goes on in numpy.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from kerbside.llm.graph import components
from kerbside.llm.wordcache import mix
from kerbside.session import stage

#: Points of a leaf, points of the sample that a larger node is split by, and children of a split at least.
LEAF, SAMPLE, CHILDREN = 1024, 256, 32
#: Nodes of at most this radius are not split by distance: what :func:`distances` gives for equal directions is up to some 1e-7.
NOISE = 1e-6


def distances(a, b):
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def net(points, radius, most=None):
    """Indices of a greedy net: no two within ``radius``, every point within ``radius`` of one; None beyond ``most``."""
    chosen, nearest = [], np.full(len(points), np.inf)
    while True:
        far = int(nearest.argmax())
        if nearest[far] <= radius:
            return chosen
        if most is not None and len(chosen) >= most:
            return None
        chosen.append(far)
        nearest = np.minimum(nearest, distances(points[far:far + 1], points)[0])
        nearest[far] = -1.0  # never again, whatever its computed distance to itself


class Node:
    """A node of the tree within a leaf of the upper levels."""

    __slots__ = ("at", "centre", "radius", "children")

    def __init__(self, points, at, small=32):
        self.at, self.centre, self.children = at, points[at[0]], []
        gap = distances(self.centre[None], points[at])[0]
        self.radius = float(gap.max())
        if len(at) > small and self.radius > NOISE:
            own = points[at]
            chosen = net(own, self.radius / 2, most=len(at) // 4)
            if chosen and len(chosen) > 1:
                nearest = distances(own, own[chosen]).argmin(axis=1)
                parts = [at[nearest == k] for k in range(len(chosen))]
                parts = [part for part in parts if len(part)]
                self.children = [Node(points, part, small) for part in parts] if len(parts) > 1 else []


def links(p, q, reach, cosine):
    """The boolean matrix of links between the unit vectors of two leaves."""
    out = np.zeros((len(p), len(q)), bool)
    slack = 1e-7
    stack = [(Node(p, np.arange(len(p))), Node(q, np.arange(len(q))))]
    while stack:
        a, b = stack.pop()
        gap = float(distances(a.centre[None], b.centre[None])[0, 0])
        if gap > a.radius + b.radius + reach + slack:
            continue
        if a.children and (not b.children or a.radius >= b.radius):
            stack += [(c, b) for c in a.children]
        elif b.children:
            stack += [(a, c) for c in b.children]
        else:
            out[np.ix_(a.at, b.at)] = p[a.at] @ q[b.at].T >= cosine
    return out


def labels_of(matrix, same):
    """Component numbers of the rows and columns of a link matrix; ``same``: rows and columns are the same points."""
    n, m = matrix.shape
    row, col = np.arange(n), np.arange(m) if same else np.arange(n, n + m)
    while True:
        new_row = np.minimum(row, np.where(matrix, col[None, :], n + m).min(axis=1, initial=n + m))
        if same:
            new_row = new_col = np.minimum(new_row, np.where(matrix, new_row[:, None], n + m).min(axis=0, initial=n + m))
        else:
            new_col = np.minimum(col, np.where(matrix, new_row[:, None], n + m).min(axis=0, initial=n + m))
        if (new_row == row).all() and (new_col == col).all():
            return row, col
        row, col = new_row, new_col


def _vectors(batches):
    """Valid vectors as bytes, single precision if the column is, with the width of a number first; the others as null.

    Vectors are scaled by a power of two, where no digit is lost, so that copies scaled like that are equal bytes; the
    unit vectors that are compared are the same.
    """
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("v", pa.binary())])
    for batch in batches:
        out, kind = [], np.float32 if batch.schema.field(2).type.value_type == pa.float32() else np.float64
        for values, label in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
            found = None
            if values and label is not None and None not in values:
                v = np.asarray(values, np.float64)
                top = np.abs(v).max()
                if np.isfinite(top) and top > 0:
                    power = int(np.frexp(top)[1])
                    with np.errstate(all="ignore"):
                        scaled = np.ldexp(v, -power).astype(kind)
                        if (np.ldexp(scaled.astype(np.float64), power) == v).all():
                            v = scaled
                    found = bytes([np.dtype(kind).itemsize]) + v.astype(kind).tobytes()
            out.append(found)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(out, pa.binary())], schema=schema)


def _matrix(blobs):
    """The unit vectors, in double precision, of vectors as bytes."""
    if not blobs:
        return np.zeros((0, 0))
    kind = np.float32 if blobs[0][0] == 4 else np.float64
    rows = np.frombuffer(b"".join(b[1:] for b in blobs), kind).reshape(len(blobs), -1).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _split(keys, table):
    """Child centres of one node from a sample of its points: a net of half its reach, or of as small a part of it as gives some children.

    A single centre says that the sample has one direction, up to noise.
    """
    blobs = table.column("v").to_pylist()
    points = _matrix(blobs)
    radius, chosen = float(distances(points[:1], points).max()) / 2, [0]
    while len(points) > 1 and radius > NOISE:
        chosen = net(points, radius)
        if len(chosen) >= min(CHILDREN, len(points)):
            break
        radius /= 2
    return pa.table({"node": pa.array([keys[0].as_py()] * len(chosen)), "child": pa.array(range(len(chosen)), pa.int32()),
                     "centre": pa.array([blobs[k] for k in chosen], pa.binary())})


def _descend(keys, left, right):
    """Points of a part of a node go below the nearest centre; of a node with a single one they are dealt to leaves by hash."""
    if not left.num_rows:
        return pa.table({"cid": pa.array([], pa.int64()), "node": pa.array([], pa.string()), "v": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
    right = right.sort_by("child")
    node = keys[0].as_py()
    if right.num_rows == 1:
        depth = np.uint64(node.count("/") + 1)  # another deal on every level
        nearest = (mix(mix(left.column("cid").to_numpy().astype(np.uint64)) + depth) % np.uint64(right.column("deal")[0].as_py())).astype(np.int64)
    else:
        nearest = distances(_matrix(left.column("v").to_pylist()), _matrix(right.column("centre").to_pylist())).argmin(axis=1)
    return pa.table({"cid": left.column("cid"), "node": pa.array([f"{node}/{k}" for k in nearest.tolist()]), "v": left.column("v"), "n": left.column("n")})


def _grow(points, leaf):
    """Split nodes of more than ``leaf`` points, level by level, until there are none."""
    while True:
        sizes = points.groupBy("node").agg(F.count("*").alias("size")).where(F.col("size") > leaf)
        sizes = stage(sizes, "nodes")
        if sizes.isEmpty():
            return points
        large = points.join(sizes, "node")
        share = F.lit(float(SAMPLE)) / F.col("size")
        drawn = F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) < share * F.lit(float(1 << 30))
        # Two different points of every node are in its sample; with one direction only, the node is dealt out by hash.
        least = large.groupBy("node").agg(F.min(F.struct(F.xxhash64("cid").alias("r"), "v")).alias("m"), F.max(F.struct(F.xxhash64("cid").alias("r"), "v")).alias("x"))
        ends = least.select("node", F.explode(F.array("m.v", "x.v")).alias("v"))
        sample = large.where(drawn).select("node", "v").unionByName(ends)
        centres = stage(sample.groupBy("node").applyInArrow(_split, "node string, child int, centre binary"), "centres")
        parts = F.ceil(F.col("size") / F.lit(4 * leaf)).cast("int")
        moving = large.select("cid", "node", "v", "n", F.pmod(F.xxhash64("cid", F.lit(1)), parts).cast("int").alias("part"))
        copies = centres.join(sizes, "node").select("node", "child", "centre", F.ceil(F.col("size") * 2 / F.lit(leaf)).cast("long").alias("deal"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        moved = moving.groupBy("node", "part").cogroup(copies.groupBy("node", "part")).applyInArrow(_descend, "cid long, node string, v binary, n long")
        points = stage(points.join(sizes, "node", "left_anti").select("cid", "node", "v", "n").unionByName(moved), "points")


def _together(points, leaf):
    """Small leaves below one node become one, as long as they fit; the bounds are worked out afterwards."""
    sizes = points.groupBy("node").agg(F.count("*").alias("size"))
    above = F.regexp_replace("node", "/[^/]*$", "")
    siblings = Window.partitionBy(above).orderBy("size", "node").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = sizes.where(F.col("node").contains("/")).select("node", F.concat(above, F.lit("/g"), F.floor((F.sum("size").over(siblings) - 1) / F.lit(leaf)).cast("string")).alias("to"))
    return points.join(names, "node", "left").select("cid", F.coalesce("to", "node").alias("node"), "v", "n")


def _bounds(keys, table):
    """The centre of a leaf and its covering radius."""
    points = _matrix(table.column("v").to_pylist())
    centre = points[int((points @ points.mean(axis=0)).argmax())]
    return pa.table({"node": [keys[0].as_py()], "centre": pa.array([b"\x08" + centre.tobytes()], pa.binary()), "radius": [float(distances(centre[None], points).max())]})


def _parents(keys, table):
    """Centre and covering radius of a node from those of its children: it covers whatever they cover."""
    centres, radii = _matrix(table.column("centre").to_pylist()), np.array(table.column("radius").to_pylist())
    gaps = (distances(centres, centres) + radii[None, :]).max(axis=1) if len(centres) <= 4096 else distances(centres[:1], centres)[0].max() + radii.max() * np.ones(len(centres))
    best = int(gaps.argmin())
    return pa.table({"node": [keys[0].as_py()], "centre": pa.array([b"\x08" + centres[best].tobytes()], pa.binary()), "radius": [float(gaps[best])]})


def _near(reach):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda n: batch.column(batch.schema.get_field_index(n))
            centres = [get(n).to_pylist() for n in ("a_centre", "b_centre")]
            sizes, gaps = np.array([len(c) for c in centres[0]]), np.zeros(batch.num_rows)
            for size in np.unique(sizes):  # vectors of one length at a time
                at = np.flatnonzero(sizes == size)
                apart = _matrix([centres[0][i] for i in at]) - _matrix([centres[1][i] for i in at])
                gaps[at] = np.sqrt((apart * apart).sum(axis=1))
            keep = gaps <= get("a_radius").to_numpy() + get("b_radius").to_numpy() + reach + 1e-7
            yield pa.RecordBatch.from_arrays([get("a"), get("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _traverse(leaves, reach):
    """Pairs of leaves that may hold links, from the roots down, level by level."""
    depth = F.size(F.split("node", "/"))
    nodes = stage(leaves.select("node", "centre", "radius").withColumn("depth", depth), "tree")
    deepest = nodes.agg(F.max("depth")).first()[0]
    if deepest is None:
        return None
    levels = {deepest: nodes.where(F.col("depth") == deepest)}
    for d in range(deepest - 1, 0, -1):
        above = levels[d + 1].withColumn("node", F.regexp_replace("node", "/[^/]*$", "")) \
            .select("node", "centre", "radius").groupBy("node").applyInArrow(_parents, "node string, centre binary, radius double")
        levels[d] = stage(above.withColumn("depth", F.lit(d)).unionByName(nodes.where(F.col("depth") == d)), "tree")
    pairs = levels[1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for d in range(2, deepest + 1):
        # Leaves of upper levels stay as they are; the others are replaced by their children.
        down = levels[d].select(F.regexp_replace("node", "/[^/]*$", "").alias("up"), "node", "centre", "radius") \
            .unionByName(nodes.where(F.col("depth") < d).select(F.col("node").alias("up"), "node", "centre", "radius"))
        side = lambda s: down.select(F.col("up").alias(s), F.col("node").alias(f"{s}_node"), F.col("centre").alias(f"{s}_centre"), F.col("radius").alias(f"{s}_radius"))
        wide = pairs.join(side("a"), "a").join(side("b"), "b").where("a_node <= b_node OR a <> b")
        wide = wide.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"), "a_centre", "b_centre", "a_radius", "b_radius")
        pairs = stage(wide.mapInArrow(_near(reach), "a string, b string"), "pairs")
    return pairs


LINKS = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _join_leaves(reach, cosine):
    """The links of one pair of leaves, as counts and spanning edges."""
    def run(keys, table):
        same = keys[0].as_py() == keys[1].as_py()
        side = table.column("side").to_numpy()
        cids, ns, vs = table.column("cid").to_numpy(), table.column("n").to_numpy(), table.column("v")
        at = [np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))]
        p = _matrix(vs.take(pa.array(at[0])).to_pylist())
        q = p if same else _matrix(vs.take(pa.array(at[1])).to_pylist())
        found = links(p, q, reach, cosine)
        if same:
            np.fill_diagonal(found, False)
        rows, cols = labels_of(found, same)
        ids = cids[at[0]] if same else np.concatenate([cids[at[0]], cids[at[1]]])
        sides = [(cids[at[0]], found @ ns[at[1]], rows, found.any(axis=1))]
        if not same:
            sides.append((cids[at[1]], ns[at[0]] @ found, cols, found.any(axis=0)))
        return pa.table([np.concatenate([x[s] for x, s in parts]) for parts in (
            [(c, s) for c, _, _, s in sides], [(n, s) for _, n, _, s in sides], [(ids[label], s) for _, _, label, s in sides])], schema=LINKS)

    return run, from_arrow_schema(LINKS)


def near_duplicates(df, cosine=0.93, id_col="vec_id", vector_col="embedding", label_col="label", leaf=LEAF):
    """Links of cosine at least ``cosine`` (above 0) between vectors of equal label, in double precision; one row per row.

    ``vec_id``, ``n_links`` (other rows linked directly), ``component_id`` (least id reachable), ``kept``. A null label
    and a vector that is null, empty, zero or holds null or non-finite components link with nothing and stay; vectors of
    other lengths are never compared; rows that repeat a vector link with each other, and a null id counts but never
    names a component unless the row stands alone. Equal vectors fold to one point first, links leave a task as counts and spanning edges, so no
    group is ever written out pair by pair. Tasks hold two leaves of ``leaf`` points.
    """
    reach = math.sqrt(2 - 2 * cosine)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"), F.col(f"`{vector_col}`").alias("embedding"))
    rows = stage(rows.mapInArrow(_vectors, "vec_id long, label string, v binary"), "vectors")
    points = rows.where("v IS NOT NULL").groupBy("label", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    points = stage(points.withColumn("cid", F.monotonically_increasing_id()), "points")
    root = F.concat_ws(":", F.hex("label"), F.octet_length("v"))
    tree = _grow(points.select("cid", root.alias("node"), "v", "n"), leaf)
    tree = stage(_together(tree, leaf), "leaves")
    pairs = _traverse(tree.select("node", "v").groupBy("node").applyInArrow(_bounds, "node string, centre binary, radius double"), reach)
    alone = F.col("vec_id").alias("component_id")
    loners = rows.where("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), alone)
    if pairs is None:
        return loners.withColumn("kept", F.lit(True))
    side = lambda at, end: pairs.join(tree.withColumnRenamed("node", end), end).select("a", "b", F.lit(at).alias("side"), "cid", "v", "n")
    run, schema = _join_leaves(reach, cosine)
    found = stage(side(0, "a").unionByName(side(1, "b").where("a <> b")).groupBy("a", "b").applyInArrow(run, schema), "links")
    roots = components(found, "cid", "root")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = points.select("cid", "label", "v", "n", "first").join(counts, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left") \
        .select("cid", "label", "v", "n", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cid").alias("root"))
    joined = stage(joined, "classes")
    least = joined.groupBy("root").agg(F.min("first").alias("component"))
    classes = joined.join(least, "root").select("label", "v", (F.col("links") + F.col("n") - 1).alias("n_links"), F.col("component").alias("component_id"))
    out = rows.where("v IS NOT NULL").join(classes, ["label", "v"]).select("vec_id", "n_links", "component_id").unionByName(loners)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
