"""Exact threshold pairs of embeddings by dual traversal of a cover tree.

Levels of centres with halving radii are fitted on a bounded sample; a child list begins with its parent's
centre, so levels are nested. Every vector goes to the leaf with the nearest centre. What
prunes is not the nominal radius but the covering angle over all vectors below a node, so the
pairs are exact whatever the sample was. Node pairs are followed from the root down; two
nodes are apart if the angle between their centres exceeds both covering angles and that of the
threshold. Vectors are laid out once, leaf after leaf, in strips of bounded size, and blocks of
them get an axis and their angles to it. Cells of two strips with leaf pairs that remain are
compared in tasks, in rounds: what a round shuffles is bounded by the size of the strips, however
many cells there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from kilnmark.llm.common import components, discard, durable, freed_shuffles, released, table

COSINE = 0.9
#: Bound of the sample that shapes the tree, of children per node, of rows per leaf that is not split further, and of the levels.
SAMPLE, FANOUT, BLOCK, LEVELS = 2048, 16, 4096, 6
#: Bytes of the vectors of a strip, at least so many strips if they hold a block each, and rows and bytes that are packed into one row.
STRIP_BYTES, STRIPS, PACKED, PACKED_BYTES = 32 << 20, 16, 1024, 1 << 20
#: Bytes that a round of cells may shuffle, if all strips together have less.
ROUND_BYTES = 128 << 20
#: Edges that a task holds before it joins them; rows of counts and edges that rounds may leave before they are summed, if there are fewer vectors.
EDGES, LINKS = 1 << 20, 1 << 20
_SLACK = 1e-6


@dataclass
class Node:
    center: np.ndarray
    level: int
    index: int
    children: list[Node] = field(default_factory=list)
    radius: float = 0.0


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled by their largest part first, as squares of tiny or huge parts vanish or overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def _angle(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1, 1))


def fit_tree(sample: np.ndarray, rows: int, block: int = BLOCK, fanout: int = FANOUT, levels: int = LEVELS) -> list[Node]:
    """Nodes of a tree over unit vectors, the root first; ``rows`` is how many vectors the sample stands for."""
    nodes = [Node(sample[0], 0, 0)]
    todo = [(nodes[0], sample)]
    while todo:
        node, own = todo.pop()
        if len(own) < 2 or node.level == levels or len(own) * rows / len(sample) <= block:
            continue
        radius = 2.0 / 2 ** (node.level + 1)
        centers = [node.center]  # nested: a centre stays one on the next level
        gap = _distance(own, node.center[None])[:, 0]
        while len(centers) < fanout and gap.max() > radius:
            centers.append(own[int(gap.argmax())])
            gap = np.minimum(gap, _distance(own, centers[-1][None])[:, 0])
        near = _distance(own, np.stack(centers)).argmin(axis=1)
        for k, center in enumerate(centers):
            child = Node(center, node.level + 1, len(nodes))
            nodes.append(child)
            node.children.append(child)
            todo.append((child, own[near == k]))
    return nodes


def nearest_leaf(nodes: list[Node]):
    """A function that gives the leaf of every vector. Nothing hangs on ties, which sums of another order may settle otherwise."""
    leaves = np.array([n.index for n in nodes if not n.children])
    centers = np.stack([nodes[k].center for k in leaves]).astype(np.float32)
    return lambda vectors: leaves[(vectors.astype(np.float32) @ centers.T).argmax(axis=1)]


def cover(nodes: list[Node], radius: dict[int, float]) -> set[int]:
    """Sets the covering angles of all nodes by those of the filled leaves; the nodes with vectors below them."""
    filled, above = set(radius), {c.index: n.index for n in nodes for c in n.children}
    for leaf, d in radius.items():
        at = nodes[leaf]
        at.radius = max(at.radius, d)
        while at.index in above:
            at = nodes[above[at.index]]
            at.radius = max(at.radius, float(_angle(at.center, nodes[leaf].center)) + d)
            filled.add(at.index)
    return filled


def leaf_pairs(nodes: list[Node], filled: set[int], reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of filled leaves that may hold vectors within the angle ``reach`` of each other, each once, the lesser leaf first."""
    center, radius = np.stack([n.center for n in nodes]), np.array([n.radius for n in nodes])
    full = np.zeros(len(nodes), bool)
    full[list(filled)] = True
    many = np.array([len(n.children) for n in nodes])
    first = np.cumsum(many) - many
    below = np.array([c.index for n in nodes for c in n.children] or [0])
    out, todo = [], [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        a, b = todo.pop()
        if len(a) > 1 << 16:  # the stack stays short, as pieces are followed to their leaves one by one
            todo += [(a[:len(a) // 2], b[:len(b) // 2]), (a[len(a) // 2:], b[len(b) // 2:])]
            continue
        apart = np.arccos(np.clip((center[a] * center[b]).sum(axis=1), -1, 1)) > radius[a] + radius[b] + reach + _SLACK
        near = full[a] & full[b] & ((a == b) | ~apart)
        a, b = a[near], b[near]
        leaves = (many[a] == 0) & (many[b] == 0)
        out.append((np.minimum(a[leaves], b[leaves]), np.maximum(a[leaves], b[leaves])))
        a, b = a[~leaves], b[~leaves]
        for n in np.unique(a[a == b]):
            own = below[first[n]:first[n] + many[n]]
            i, j = np.triu_indices(len(own))
            todo.append((own[i], own[j]))
        a, b = a[a != b], b[a != b]
        left = (many[b] == 0) | ((many[a] > 0) & (radius[a] >= radius[b]))
        split, other = np.where(left, a, b), np.where(left, b, a)
        if len(split):
            step = np.arange(many[split].sum()) - np.repeat(np.cumsum(many[split]) - many[split], many[split])
            todo.append((below[np.repeat(first[split], many[split]) + step], np.repeat(other, many[split])))
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def lay_out(nodes: list[Node], count: dict[int, int]) -> np.ndarray:
    """The number of rows before each leaf: leaves in the order of the tree, so that near ones share a strip."""
    start, at, todo = np.zeros(len(nodes), np.int64), 0, [nodes[0]]
    while todo:
        node = todo.pop()
        todo += node.children[::-1]
        if not node.children:
            start[node.index], at = at, at + count.get(node.index, 0)
    return start


def cut(units: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of at most ``most`` near rows: the axis, the rows, and their angles to the axis."""
    todo = [np.arange(len(units))]
    while todo:
        rows = todo.pop()
        own = units[rows]
        middle = own.mean(axis=0)
        if len(rows) > 2 * most:  # in halves along the line between two far ones
            one = own[(own @ middle).argmin()]
            along = own @ (one - own[(own @ one).argmin()])
            order = np.argpartition(along, len(rows) // 2)
            todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
            continue
        size = np.linalg.norm(middle)
        axis = middle / size if size > 1e-6 else own[0]
        angle = _angle(own, axis)
        for piece in np.array_split(angle.argsort(), -(-len(rows) // most)):
            yield axis, rows[piece], angle[piece]


def rounds(slots: list[tuple[int, int, int]], pairs: tuple[np.ndarray, np.ndarray], row_bytes: int, budget: int) -> Iterator[list[tuple[int, int, int]]]:
    """(strip, leaf, cell) of the rows that meet in cells, in rounds of at most ``budget`` bytes or one cell.

    ``slots`` are (leaf, strip, rows), in the order of the leaves: a large leaf reaches into
    several strips. A cell of strips i <= j has the number i * strips + j and gets the leaves of
    either that have a partner in the other.
    """
    own = np.array([s for _, s, _ in slots])
    strips = int(own.max()) + 1
    leaves, first, many = np.unique([leaf for leaf, _, _ in slots], return_index=True, return_counts=True)
    at = np.zeros(int(leaves.max()) + 1, np.int64)
    at[leaves] = np.arange(len(leaves))
    first, many = first[at], many[at]
    meets = np.zeros((len(slots), strips), bool)
    for p in range(0, len(pairs[0]), 1 << 16):
        a, b = (x[p:p + (1 << 16)] for x in pairs)
        for k in range(int(many[a].max())):  # the k-th strip of a with the l-th of b
            for l in range(int(many[b].max())):
                some = (many[a] > k) & (many[b] > l)
                x, y = first[a[some]] + k, first[b[some]] + l
                meets[x, own[y]] = True
                meets[y, own[x]] = True
    cells: dict[tuple[int, int], list[int]] = {}
    for k, s in zip(*(x.tolist() for x in np.nonzero(meets))):
        cells.setdefault((min(int(own[k]), s), max(int(own[k]), s)), []).append(k)
    side = max(1, int((budget * strips / (2 * sum(n for _, _, n in slots) * row_bytes)) ** 0.5))  # squares of cells: a round reads few strips
    held, out = 0, []
    for i, j in sorted(cells, key=lambda c: (c[0] // side, c[1] // side, c)):
        more = sum(slots[k][2] for k in cells[i, j]) * row_bytes
        if out and held + more > budget:
            yield out
            held, out = 0, []
        held += more
        out += [(slots[k][1], slots[k][0], i * strips + j) for k in cells[i, j]]
    if out:
        yield out


def _star_edges(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every linked row or column to the least id of its component within ``mask``."""
    rows, cols = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    few, x, y = mask[np.ix_(rows, cols)], left[rows].copy(), right[cols].copy()
    top = np.iinfo(np.int64).max
    while True:
        before = x.copy(), y.copy()
        x = np.minimum(x, np.where(few, y[None, :], top).min(axis=1, initial=top))
        y = np.minimum(y, np.where(few, x[:, None], top).min(axis=0, initial=top))
        if (x == before[0]).all() and (y == before[1]).all():
            break
    return np.concatenate([left[rows], right[cols]]), np.concatenate([x, y])


def _joined(child: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One edge for every id: to the least id of its component within the edges."""
    ids, at = np.unique(np.concatenate([child, top]), return_inverse=True)
    a, b = at[:len(child)], at[len(child):]
    label = np.arange(len(ids))
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        for x in (label[a], label[b], a, b):
            np.minimum.at(label, x, least)
        label = label[label]
        if (label == before).all():
            return ids, ids[label]


class _Side:
    """The vectors of a strip that stand in a cell, block by block."""

    def __init__(self, rows: list[dict], item: str):
        self.raw = [np.frombuffer(r["v"], item).reshape(r["n"], -1) for r in rows]
        self.ids = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in rows])
        self.many = np.concatenate([np.frombuffer(r["ms"], "<i8") for r in rows])
        self.cuts = np.cumsum([0] + [r["n"] for r in rows])
        self.lo, self.hi = np.array([r["lo"] for r in rows]), np.array([r["hi"] for r in rows])
        self.axes = np.stack([np.frombuffer(r["axis"], "<f8") for r in rows])
        self.short = np.empty((len(self.ids), self.axes.shape[1]), np.float32)
        for k, x in enumerate(self.raw):
            self.short[self.cuts[k]:self.cuts[k + 1]] = unit(x.astype(np.float64))
        self.n = np.zeros(len(self.ids), np.int64)

    def exact(self, block: int, rows: np.ndarray) -> np.ndarray:
        return unit(self.raw[block][rows].astype(np.float64))


def _compare(width: int, cosine: float, reach: float, strips: int, item: str):
    """Counts and edges of a cell. Products in single precision only leave out what is below the threshold by more than their error."""
    slack = _SLACK + (width + 8) * 1.2e-7

    def run(table_: pa.Table) -> pa.Table:
        i, j = divmod(table_.column("cell")[0].as_py(), strips)
        rows = table_.drop_columns(["cell"]).to_pylist()
        del table_
        a = _Side([r for r in rows if r["strip"] == i], item)
        b = a if i == j else _Side([r for r in rows if r["strip"] == j], item)
        # What may hold a partner of a block: not farther from its axis than its farthest vector and the reach, nor nearer than its nearest one less the reach.
        least, most = ([np.where(s.hi + reach < np.pi, np.cos(np.minimum(s.hi + reach, np.pi)), -2) - slack for s in (a, b)],
                       [np.where(s.lo - reach > 0, np.cos(np.maximum(s.lo - reach, 0)), 2) + slack for s in (a, b)])
        edges, held = [], 0
        for p in range(len(a.raw)):
            mine = a.short[a.cuts[p]:a.cuts[p + 1]]
            near = np.flatnonzero(_angle(b.axes, a.axes[p]) <= a.hi[p] + b.hi + reach + _SLACK)
            if b is a:
                near = near[near >= p]
            if not len(near):
                continue
            to_one, to_two = b.short @ a.axes[p].astype(np.float32), mine @ b.axes[near].astype(np.float32).T
            to_one, to_two = (to_one >= least[0][p]) & (to_one <= most[0][p]), (to_two >= least[1][near]) & (to_two <= most[1][near])
            for q, some in zip(near.tolist(), to_two.T):
                itself = b is a and q == p
                xs, ys = np.flatnonzero(some), np.flatnonzero(to_one[b.cuts[q]:b.cuts[q + 1]])
                if not len(xs) or not len(ys):
                    continue
                like = mine[xs] @ b.short[b.cuts[q] + ys].T
                if like.max() < cosine - slack:
                    continue
                like = like >= cosine - slack
                xs, ys = xs[like.any(axis=1)], ys[like.any(axis=0)]
                mask = a.exact(p, xs) @ b.exact(q, ys).T >= cosine
                if itself:
                    mask[xs[:, None] == ys[None, :]] = False
                if not mask.any():
                    continue
                xs, ys = a.cuts[p] + xs, b.cuts[q] + ys
                a.n[xs] += mask @ b.many[ys]
                if not itself:
                    b.n[ys] += a.many[xs] @ mask
                edges.append(_star_edges(mask, a.ids[xs], b.ids[ys]))
                held += len(edges[-1][0])
                if held > EDGES:
                    edges = [_joined(*(np.concatenate(x) for x in zip(*edges)))]
                    held = len(edges[0][0]) // 2  # may not fall below that many
        out = [(s.ids[s.n > 0], s.n[s.n > 0], s.ids[s.n > 0]) for s in ((a,) if b is a else (a, b))]
        if edges:
            child, top = _joined(*(np.concatenate(x) for x in zip(*edges)))
            out.append((child[child != top], np.zeros((child != top).sum(), np.int64), top[child != top]))
        return pa.table({c: pa.array(np.concatenate([x[k] for x in out])) for k, c in enumerate(("id", "n", "up"))})

    return run


def _keyed(rows: DataFrame, item: str, whole: bool) -> DataFrame:
    """vec_id and a digest of every vector that can be compared; if ``whole``, its length and its bytes instead of the vec_id."""
    def run(batches):
        for batch in batches:
            ids, lists = batch.column("vec_id"), batch.column("v")
            long = np.diff(lists.offsets.to_numpy())
            start = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            usable = ids.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False) & (long > 0)
            for width in np.unique(long[usable]).tolist():
                at = np.flatnonzero(usable & (long == width))
                v = flat[start[at][:, None] + np.arange(width)]
                good = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
                at, v = at[good], (v[good] + 0.0).astype(item)
                data = [x.tobytes() for x in v]
                keys = pa.array([hashlib.sha256(x).digest() for x in data], pa.binary())
                if whole:
                    yield pa.RecordBatch.from_arrays([keys, pa.array(np.full(len(at), width), pa.int32()), pa.array(data, pa.binary())], ["key", "d", "v"])
                else:
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), keys], ["vec_id", "key"])

    return rows.mapInArrow(released(run), "key binary, d int, v binary" if whole else "vec_id long, key binary")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding).

    Null, empty and zero vectors, and those with null or non-finite parts, link with nothing; so do
    vectors of different lengths with each other, and rows without a vec_id (component null, not
    kept). Equal vectors are compared once and counted as often as they stand there; rows that
    repeat both id and vector are one vector, and rows that repeat an id share their links. Extra
    columns are dropped. A leaf that holds many rows is dealt out over strips of bounded size.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    kind = vectors.schema["embedding"].dataType
    item = "<f4" if isinstance(getattr(kind, "elementType", None), FloatType) else "<f8"
    # Vectors are shuffled once to their classes and once to their strips, in the width they came in; all else goes by digests and ids.
    named = durable(_keyed(rows, item, False).distinct(), "vector-ids")
    sizes = named.groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("m"))
    of = durable(named.join(sizes, "key").select("vec_id", "id", "m"), "vector-members")
    whole = _keyed(rows, item, True).groupBy("key").agg(F.first("d").alias("d"), F.first("v").alias("v"))
    classes = durable(sizes.join(whole, "key").select("id", "m", "d", "v"), "vector-classes")
    discard(named)
    found = [x for width in sorted(r.d for r in classes.select("d").distinct().collect())
             for x in _links(spark, classes.where(F.col("d") == width), cosine, sample, block, width, item)]
    discard(classes)
    links = _all(found) if found else spark.createDataFrame([], "id long, n long, up long")
    linked = links.groupBy("id").agg(F.sum("n").alias("n"))
    # Members of a class hang below its least id; an id with several vectors joins their classes.
    edges = links.where("id <> up").select(F.col("id").alias("a"), F.col("up").alias("b"))
    label = components(edges.union(of.where("vec_id <> id").select("vec_id", "id")))
    direct = (of.join(linked, "id", "left").groupBy("vec_id")
              .agg(F.sum(F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links")))
    return (rows.select("vec_id").join(direct, "vec_id", "left").join(label.withColumnRenamed("id", "vec_id"), "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def _matrix(column: pa.Array, width: int, item: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), item).reshape(len(column), width).astype(np.float64)


def _all(tables: list[DataFrame]) -> DataFrame:
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*(x.stored_in for x in tables))


def _summed(links: DataFrame) -> DataFrame:
    """The same counts and components in fewer rows: one count and one edge for each id, and what its other edges say of their ends."""
    edges = links.where("id <> up").select("id", "up")
    least = edges.groupBy("id").agg(F.min("up").alias("top"))
    ends = edges.join(least, "id").where("up <> top").select("up", "top").distinct()
    return (links.groupBy("id").agg(F.sum("n").alias("n")).where("n > 0").select("id", "n", F.col("id").alias("up"))
            .union(least.select("id", F.lit(0).cast("long"), "top")).union(ends.select("up", F.lit(0).cast("long"), "top")))


def _links(spark: SparkSession, classes: DataFrame, cosine: float, sample: int, block: int, width: int, item: str) -> list[DataFrame]:
    """Tables (id, n, up) with partial counts of linked vectors, and edges to smaller ids, from each cell."""
    rows, row_bytes = classes.count(), width * np.dtype(item).itemsize
    first = F.xxhash64("id")
    # About four times as many as needed by their hash, so that few vectors are sorted.
    some = classes if rows <= 8 * sample else classes.where(first < F.lit(-(1 << 63) + (4 * sample << 64) // rows))
    with freed_shuffles(spark):
        few = some.orderBy(first, "id").select("v").limit(sample).collect() or classes.select("v").limit(sample).collect()
    nodes = fit_tree(unit(np.array([np.frombuffer(r.v, item) for r in few], np.float64)), rows, block)
    reach, leaf_of = float(np.arccos(np.clip(cosine, -1.0, 1.0))), nearest_leaf(nodes)

    def survey(batches):
        count = np.zeros(len(nodes), np.int64)
        for batch in batches:
            if batch.num_rows:
                count += np.bincount(leaf_of(unit(_matrix(batch.column("v"), width, item))), minlength=len(nodes))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], ["leaf", "n"])

    # Both lists are bounded by the number of nodes, which the sample bounds, and of strips.
    with freed_shuffles(spark):
        count = {r.leaf: r.n for r in classes.select("v").mapInArrow(released(survey), "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect()}
    start, size = lay_out(nodes, count), min(max(1, STRIP_BYTES // row_bytes), max(block, -(-rows // STRIPS)))
    share_of, most = np.array([count.get(k, 0) for k in range(len(nodes))]), max(1, min(PACKED, block, PACKED_BYTES // row_bytes))
    center = {n.index: n.center for n in nodes if not n.children}

    def assign(batches):
        for batch in batches:
            leaf = leaf_of(unit(_matrix(batch.column("v"), width, item))) if batch.num_rows else np.zeros(0, np.int64)
            share = (batch.column("h").to_numpy().view(np.uint64) >> np.uint64(11)).astype(np.float64) / (1 << 53)
            strip = np.minimum(start[leaf] + (share * share_of[leaf]).astype(np.int64), rows - 1) // size
            yield pa.RecordBatch.from_arrays([pa.array(strip, pa.int32()), pa.array(leaf), batch.column("id"), batch.column("m"), batch.column("v")],
                                             ["strip", "leaf", "id", "m", "v"])

    def pack(batches):
        held, parts = None, []

        def packed():
            ids, many, v = (np.concatenate([x[k] for x in parts]) for k in range(3))
            units = unit(v.astype(np.float64))
            far = float(_angle(units, center[held[1]]).max())
            for axis, at, angle in cut(units, most):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([held[0]], pa.int32()), pa.array([held[1]], pa.int64()), pa.array([far]), pa.array([axis.tobytes()], pa.binary()),
                     pa.array([angle.min()]), pa.array([angle.max()]), pa.array([len(at)], pa.int32()),
                     *(pa.array([x[at].tobytes()], pa.binary()) for x in (ids, many, v))], ["strip", "leaf", "far", "axis", "lo", "hi", "n", "ids", "ms", "v"])

        for batch in batches:
            strip, leaf = batch.column("strip").to_numpy(), batch.column("leaf").to_numpy()
            columns = [batch.column(c).to_numpy() for c in ("id", "m")]
            columns.append(np.frombuffer(b"".join(batch.column("v").to_pylist()), item).reshape(batch.num_rows, width))
            cuts = np.flatnonzero((np.diff(strip, prepend=-1) != 0) | (np.diff(leaf, prepend=-1) != 0)).tolist()
            for begin, end in zip(cuts, [*cuts[1:], batch.num_rows]):
                if held != (strip[begin], leaf[begin]) and parts:
                    yield from packed()
                    parts = []
                held = int(strip[begin]), int(leaf[begin])
                parts.append([x[begin:end] for x in columns])
        if parts:
            yield from packed()

    blocks = durable(
        classes.select("id", "m", "v", F.xxhash64("id", "v").alias("h"))
        .mapInArrow(released(assign), "strip int, leaf long, id long, m long, v binary")
        .repartition(-(-rows // size), "strip").sortWithinPartitions("strip", "leaf")
        .mapInArrow(released(pack), "strip int, leaf long, far double, axis binary, lo double, hi double, n int, ids binary, ms binary, v binary"), "vector-strips")
    with freed_shuffles(spark):
        there = blocks.groupBy("leaf", "strip").agg(F.sum("n").alias("n"), F.max("far").alias("far")).collect()
    slots = sorted((r.leaf, r.strip, r.n) for r in there)
    radius: dict[int, float] = {}
    for r in there:
        radius[r.leaf] = max(radius.get(r.leaf, 0.0), r.far)
    compare = _compare(width, cosine, reach, max(s for _, s, _ in slots) + 1, item)
    found, left, most_left = [], 0, max(LINKS, rows)
    for cells in rounds(slots, leaf_pairs(nodes, cover(nodes, radius), reach), row_bytes + 16, max(ROUND_BYTES, rows * (row_bytes + 16))):
        lookup = spark.createDataFrame(cells, "strip int, leaf long, cell long")
        met = blocks.where(F.col("strip").isin(sorted({s for s, _, _ in cells}))).join(F.broadcast(lookup), ["strip", "leaf"])
        found.append(durable(met.select("cell", "strip", "axis", "lo", "hi", "n", "ids", "ms", "v").groupBy("cell")
                             .applyInArrow(compare, "id long, n long, up long"), "vector-links"))
        left += found[-1].count()
        if left > most_left:  # else they would grow with the cells of a large component
            summed = durable(_summed(_all(found)), "vector-links")
            discard(*found)
            found, left = [summed], summed.count()
            most_left = max(most_left, 2 * left)
    discard(blocks)
    return found


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
