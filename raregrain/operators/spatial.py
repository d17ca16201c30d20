"""Exact neighbour search on a balanced space partition, without pairing all points.

Equal points are first merged into one weighted point.  A binary tree of
boxes is then grown level by level (every level is one aggregation over all
points) until a leaf holds at most ``leaf_size`` distinct points.  Box pairs
are refined from the root: a pair too far apart is dropped, a pair entirely
within a radius is accepted as a whole, and only leaf pairs that can still
matter reach the points, as bounded blocks.  A dense spot thus becomes many
small leaves instead of one hot group.

Nearest neighbours meet without an exchange: the leaves lie in files of the
shared folder, and each task reads them past its own leaves, one leaf at a time.
Matrix products tell which pairs can matter; only these get their distance.

Node ids are heap numbers (root 1, children 2i and 2i+1), so the parent of a
node is ``id div 2``.  ``cats`` are integer category codes; two different
codes add ``penalty``**2 to the squared distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import default_buckets, id_rank
from ..functions.scratch import materialise

MAX_DEPTH = 60
GROUP = 8192  # points of a task that other leaves are read past at a time


@dataclass
class Space:
    """Dimensions and metric of a point set."""

    dims: list[str]
    cats: list[str] = field(default_factory=list)
    penalty: float = 0.0

    @property
    def all(self) -> list[str]:
        return [*self.dims, *self.cats]

    def _spread(self, c: str, prefix: str = "") -> Column:
        lo, hi = F.col(f"{prefix}lo_{c}"), F.col(f"{prefix}hi_{c}")
        if c in self.cats:
            return F.when(hi > lo, F.lit(self.penalty)).otherwise(F.lit(0.0))
        return hi - lo

    def min_sq(self, a: str, b: str) -> Column:
        """Smallest possible squared distance between boxes a and b (column prefixes)."""
        total = F.lit(0.0)
        for c in self.all:
            gap = F.greatest(F.col(f"{a}lo_{c}") - F.col(f"{b}hi_{c}"),
                             F.col(f"{b}lo_{c}") - F.col(f"{a}hi_{c}"), F.lit(0.0))
            total = total + (F.when(gap > 0, F.lit(self.penalty ** 2)).otherwise(F.lit(0.0))
                             if c in self.cats else gap * gap)
        return total

    def max_sq(self, a: str, b: str) -> Column:
        total = F.lit(0.0)
        for c in self.all:
            far = F.greatest(F.col(f"{a}hi_{c}") - F.col(f"{b}lo_{c}"),
                             F.col(f"{b}hi_{c}") - F.col(f"{a}lo_{c}"))
            total = total + (F.when(far > 0, F.lit(self.penalty ** 2)).otherwise(F.lit(0.0))
                             if c in self.cats else far * far)
        return total


@dataclass
class Tree:
    """points: pid, coordinates, weight, leaf.  rows: id, pid.  nodes: node, box, n_points, weight, is_leaf."""

    space: Space
    points: DataFrame
    rows: DataFrame
    nodes: DataFrame
    depth: int
    leaf_size: int


def build_tree(df: DataFrame, id_col: str, space: Space, leaf_size: int = 256) -> Tree:
    src = df.select(F.col(id_col).cast("long").alias("id"),
                    *[F.col(c).cast("double").alias(c) for c in space.all])
    # the smallest id names a group of equal points
    pts = src.groupBy(*space.all).agg(F.min("id").alias("pid"), F.count(F.lit(1)).alias("weight"))
    pts = materialise(pts)
    rows = src.join(pts.select(*space.all, "pid"), space.all).select("id", "pid")
    cur = pts.withColumn("node", F.lit(1).cast("long"))
    levels = []
    depth = 0
    while True:
        box = [f(c).alias(f"{n}_{c}") for c in space.all for n, f in (("lo", F.min), ("hi", F.max))]
        mid = [F.percentile_approx(c, 0.5).alias(f"md_{c}") for c in space.all]
        stats = cur.groupBy("node").agg(*box, *mid, F.count(F.lit(1)).alias("n_points"),
                                        F.sum("weight").alias("weight"))
        split = (F.col("n_points") > leaf_size) & F.lit(depth < MAX_DEPTH)
        # arrays keep the plan linear in the number of dimensions
        spreads = F.array(*[space._spread(c) for c in space.all])
        dim = (F.array_position(spreads, F.array_max(spreads)) - 1).cast("int")
        cut = F.get(F.array(*[F.when(F.col(f"md_{c}") < F.col(f"hi_{c}"), F.col(f"md_{c}"))
                              .otherwise((F.col(f"lo_{c}") + F.col(f"hi_{c}")) / 2) for c in space.all]), dim)
        stats = materialise(stats.select(
            "node", *[f"{n}_{c}" for c in space.all for n in ("lo", "hi")], "n_points", "weight",
            (~split).alias("is_leaf"), F.when(split, dim).alias("dim"), F.when(split, cut).alias("cut")))
        levels.append(stats.drop("dim", "cut"))
        if stats.where("NOT is_leaf").isEmpty():
            break
        cuts = stats.where("NOT is_leaf").select("node", "dim", "cut")
        x = F.get(F.array(*[F.col(c) for c in space.all]), F.col("dim"))
        moved = cur.join(cuts, "node", "left").withColumn("child", F.when(
            F.col("dim").isNotNull(), F.col("node") * 2 + (x > F.col("cut")).cast("long")))
        moved = moved.withColumn("leaf", F.when(F.col("child").isNull(), F.col("node")))
        moved = materialise(moved.drop("dim", "cut"))
        done = moved.where("leaf IS NOT NULL").drop("child", "leaf")
        finished = done if depth == 0 else finished.unionByName(done)  # noqa: F821
        cur = moved.where("child IS NOT NULL").drop("node", "leaf").withColumnRenamed("child", "node")
        depth += 1
    finished = cur if depth == 0 else finished.unionByName(cur)
    nodes = levels[0]
    for lv in levels[1:]:
        nodes = nodes.unionByName(lv)
    return Tree(space, finished.withColumnRenamed("node", "leaf"), rows, nodes, depth, leaf_size)


def _prefixed(nodes: DataFrame, p: str) -> DataFrame:
    return nodes.select(*[F.col(c).alias(f"{p}{c}") for c in nodes.columns])


def _children(node: str, leaf: str) -> Column:
    """A leaf stays, an inner node becomes its two children."""
    return F.explode(F.when(F.col(leaf), F.array(F.col(node))).otherwise(
        F.array(F.col(node) * 2, F.col(node) * 2 + 1)))


def _refine(tree: Tree, decide) -> tuple[list[DataFrame], DataFrame | None]:
    """Walk box pairs from (root, root).  ``decide`` adds boolean ``drop`` and ``accept`` columns.

    Returns accepted pairs per step and the leaf pairs left undecided.
    """
    spark = tree.nodes.sparkSession
    a, b = _prefixed(tree.nodes, "q_"), _prefixed(tree.nodes, "c_")
    front = spark.range(1, 2).select(F.col("id").alias("q_node"), F.col("id").alias("c_node"))
    accepted, tiles = [], []
    for _ in range(tree.depth + 1):
        pairs = decide(front.join(a, "q_node").join(b, "c_node")).where("NOT drop")
        pairs = materialise(pairs.select("q_node", "c_node", "q_is_leaf", "c_is_leaf", "accept"))
        accepted.append(pairs.where("accept").select("q_node", "c_node"))
        rest = pairs.where("NOT accept")
        tiles.append(rest.where("q_is_leaf AND c_is_leaf").select("q_node", "c_node"))
        front = (rest.where("NOT (q_is_leaf AND c_is_leaf)")
                 .withColumn("q2", _children("q_node", "q_is_leaf"))
                 .withColumn("c2", _children("c_node", "c_is_leaf"))
                 .select(F.col("q2").alias("q_node"), F.col("c2").alias("c_node")))
        if front.isEmpty():
            break
    out = tiles[0]
    for t in tiles[1:]:
        out = out.unionByName(t)
    return accepted, out


def _blocks(tree: Tree, prefix: str, extra: tuple = (), where: str | None = None) -> DataFrame:
    """One row per leaf with its points packed in arrays (at most leaf_size of them)."""
    p = tree.points if where is None else tree.points.where(where)
    cols = list(dict.fromkeys(["pid", *tree.space.all, *extra]))
    packed = p.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("pts"))
    return packed.select(F.col("leaf").alias(f"{prefix}node"),
                         *[F.col(f"pts.{c}").alias(f"{prefix}{c}") for c in cols])


def _distances(space: Space):
    """Self-contained numpy helper: squared distances between two packed blocks."""
    dims, cats, pen = list(space.dims), list(space.cats), float(space.penalty)

    def sq(row):
        import numpy as np
        out = None
        for c in dims + cats:
            q = np.asarray(row[f"q_{c}"], dtype=float)[:, None]
            t = np.asarray(row[f"c_{c}"], dtype=float)[None, :]
            part = (q != t) * (pen * pen) if c in cats else (q - t) ** 2
            out = part if out is None else out + part
        return out
    return sq


def _tile_rows(tiles: DataFrame, q: DataFrame, c: DataFrame) -> DataFrame:
    return tiles.join(q, "q_node").join(c, "c_node")


# --------------------------------------------------------------------------- leaves in files
def stored_leaves(tree: Tree, points: DataFrame, extra: tuple = ()) -> DataFrame:
    """(node, pid, x, further columns): a row per leaf in files of the shared folder; x has the points one after the other.

    Points without all coordinates have no distance and are left out.
    """
    cols = ["pid", F.array(*tree.space.all).alias("x"), *extra]
    whole = points.dropna(subset=tree.space.all)
    packed = whole.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("pts"))
    return materialise(packed.select(F.col("leaf").alias("node"), F.col("pts.pid").alias("pid"),
                                     F.flatten("pts.x").alias("x"), *[F.col(f"pts.{c}").alias(c) for c in extra]))


def dealt(tree: Tree, leaves: DataFrame) -> DataFrame:
    """Leaves in as many tasks as their points ask for, neighbours in the tree together."""
    n = leaves.agg(F.sum(F.size("pid"))).first()[0] or 0
    level = F.length(F.bin("node")) - 1
    order = F.col("node") * F.pow(F.lit(2.0), F.lit(tree.depth) - level)
    return leaves.repartitionByRange(max(default_buckets(leaves), -(-n // GROUP)), order)


class Leaf:
    """Points of a leaf: ids, raw coordinates, and what the matrix products need; ``mid`` is any point near all."""

    def __init__(self, space: Space, mid: np.ndarray, node: int, pid: np.ndarray, x: np.ndarray, **more):
        self.node, self.pid, self.space, self.more = node, pid, space, more
        self.x = x.reshape(len(pid), -1)
        self.lo, self.hi = self.x.min(axis=0), self.x.max(axis=0)
        own = self.x[:, :len(space.dims)] - mid
        self.norm = (own * own).sum(axis=1)
        self.left = np.concatenate([-2 * own, np.ones((len(pid), 1))], axis=1)
        self.right = np.concatenate([own, self.norm[:, None]], axis=1)

    def apart(self, other: Leaf) -> float:
        """Smallest possible squared distance of two leaves."""
        gap = np.maximum(np.maximum(self.lo - other.hi, other.lo - self.hi), 0)
        d = len(self.space.dims)
        return float((gap[:d] ** 2).sum() + (gap[d:] > 0).sum() * self.space.penalty ** 2) * (1 - 1e-12)

    def roughly(self, other: Leaf) -> tuple[np.ndarray, np.ndarray]:
        """(squared distances less ``norm``, by how much they may be off), for each point here and there."""
        out = self.left @ other.right.T
        for j in range(len(self.space.dims), self.x.shape[1]):
            out += (self.x[:, j, None] != other.x[None, :, j]) * self.space.penalty ** 2
        off = 16 * (self.x.shape[1] + 10) * np.finfo(float).eps * (self.norm + other.norm.max() + len(self.space.cats) * self.space.penalty ** 2)
        return out, off

    def distances(self, i: np.ndarray, other: Leaf, j: np.ndarray) -> np.ndarray:
        """Of single pairs, summed column by column as everywhere."""
        out = np.zeros(len(i))
        for c in range(self.x.shape[1]):
            a, b = self.x[i, c], other.x[j, c]
            out += (a - b) ** 2 if c < len(self.space.dims) else (a != b) * (self.space.penalty * self.space.penalty)
        return np.sqrt(out)


def read_leaves(space: Space, mid: np.ndarray, batches, extra: tuple = ()) -> Iterator[Leaf]:
    for b in batches:
        for row in range(b.num_rows):
            col = lambda c: b.column(c)[row].values  # noqa: E731, B023
            yield Leaf(space, mid, b.column("node")[row].as_py(), col("pid").to_numpy(), col("x").to_numpy(zero_copy_only=False),
                       **{c: col(c) for c in extra})


def leaf_files(files: list[str], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """All leaves, a few at a time."""
    for uri in files:
        fs, path = pafs.FileSystem.from_uri(uri)
        with fs.open_input_file(path) as f:
            yield from pq.ParquetFile(f).iter_batches(batch_size=4, columns=columns)


def middle(tree: Tree) -> np.ndarray:
    """A point in the middle of all; products lose no digits to a far origin."""
    box = tree.nodes.where("node = 1").first()
    mid = [((box[f"lo_{c}"] or 0.0) + (box[f"hi_{c}"] or 0.0)) / 2 if box else 0.0 for c in tree.space.dims]
    return np.asarray(mid, dtype=float)


# --------------------------------------------------------------------------- nearest neighbours
def nearest(tree: Tree, k: int, coordinates: bool = True) -> DataFrame:
    """(pid, neighbours): the k nearest rows of each distinct point, itself included.

    ``neighbours`` is ordered by (distance, id) and carries the coordinates ``xs`` where they are asked for.  Of a
    group of equal points only the k smallest ids can appear in any answer, so no more are carried.
    """
    space, mid = tree.space, middle(tree)
    small = Window.partitionBy("pid").orderBy("id")
    kept = (tree.rows.withColumn("r", F.row_number().over(small)).where(F.col("r") <= k)
            .groupBy("pid").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    leaves = stored_leaves(tree, tree.points.join(kept, "pid"), ("ids",))
    files, columns = leaves.inputFiles(), leaves.columns

    def merged(q: Leaf, best: list, c: Leaf) -> None:
        """Take what is near in ``c`` into the k nearest points of each point of ``q``."""
        dist, pid, rank = best[0], best[1], min(k, len(c.pid)) - 1
        if q.apart(c) > (dist[:, -1].max() ** 2) * (1 + 1e-12):
            return
        rough, off = q.roughly(c)
        limit = dist[:, -1] ** 2 * (1 + 1e-12) - q.norm + off
        open_ = np.flatnonzero(np.isinf(dist[:, -1]))
        if len(open_) and rank == k - 1:
            limit[open_] = np.partition(rough[open_], rank, axis=1)[:, rank] + 2 * off[open_]
        i, j = np.nonzero(rough <= limit[:, None])
        if not len(i):
            return
        rows = np.unique(i)
        row = np.concatenate([i, np.repeat(rows, k)])
        d = np.concatenate([q.distances(i, c, j), dist[rows].ravel()])
        p = np.concatenate([c.pid[j], pid[rows].ravel()])
        at = np.concatenate([np.arange(len(i)), np.full(len(rows) * k, -1)])
        order = np.lexsort((p, d, row))
        starts = np.searchsorted(row[order], rows)
        order = order[(starts[:, None] + np.arange(k))].ravel()  # each row has its k old ones at least
        dist[rows], pid[rows] = d[order].reshape(-1, k), p[order].reshape(-1, k)
        for x in np.unique(at[order][at[order] >= 0]):
            ids = c.more["ids"][int(j[x])].values
            if len(ids) > 1 or coordinates:
                best[2][int(c.pid[j[x]])] = (ids.to_numpy(), c.x[j[x]])

    def answers(q: Leaf, dist: np.ndarray, pid: np.ndarray, known: dict) -> pa.RecordBatch:
        sizes, of_d, of_id, xs = [], [], [], []
        several = any(len(ids) > 1 for ids, _ in known.values())
        for d, p in zip(dist, pid):
            there = np.isfinite(d)
            d, p = d[there], p[there]
            if several:
                each = [known[int(v)][0] if int(v) in known else np.array([v]) for v in p]
                from_ = np.repeat(np.arange(len(p)), [len(v) for v in each])
                ids = np.concatenate(each) if each else p
                order = np.lexsort((ids, d[from_]))[:k]
                d, ids, p = d[from_][order], ids[order], p[from_][order]
            else:
                ids = p
            sizes.append(len(d))
            of_d.append(d)
            of_id.append(ids)
            if coordinates:
                xs += [known[int(v)][1] for v in p]
        n = sum(sizes)
        fields = [pa.array(np.concatenate(of_d)), pa.array(np.concatenate(of_id), pa.int64())]
        if coordinates:
            flat = np.concatenate(xs) if xs else np.zeros(0)
            fields.append(pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(space.all), pa.int32()), pa.array(flat)))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()),
                                         pa.StructArray.from_arrays(fields, ["dist", "id", "xs"][:len(fields)]))
        return pa.RecordBatch.from_arrays([pa.array(q.pid, pa.int64()), lists], names=["pid", "neighbours"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(group: list[Leaf]) -> Iterator[pa.RecordBatch]:
            found = [[np.full((len(q.pid), k), np.inf), np.full((len(q.pid), k), np.iinfo(np.int64).max), {}] for q in group]
            for q, best in zip(group, found):
                merged(q, best, q)
            for c in read_leaves(space, mid, leaf_files(files, columns), ("ids",)):
                for q, best in zip(group, found):
                    if q.node != c.node:
                        merged(q, best, c)
            for q, best in zip(group, found):
                yield answers(q, *best)
        group: list[Leaf] = []
        for q in read_leaves(space, mid, batches, ("ids",)):
            group.append(q)
            if sum(len(v.pid) for v in group) >= GROUP:
                yield from out(group)
                group = []
        if group:
            yield from out(group)
    kind = "dist:double,id:bigint" + ",xs:array<double>" * coordinates
    return dealt(tree, leaves).mapInArrow(work, f"pid long, neighbours array<struct<{kind}>>")


def knn(tree: Tree, k: int, coordinates: bool = True) -> DataFrame:
    """(id, rank, neighbour, dist, xs): the k nearest other rows of every row, exact, ties by id; xs if asked for."""
    near = tree.rows.join(nearest(tree, k + 1, coordinates), "pid")
    others = F.slice(F.filter("neighbours", lambda n: n["id"] != F.col("id")), 1, k)
    return (near.select("id", F.posexplode(others).alias("pos", "n"))
            .select("id", (F.col("pos") + 1).alias("rank"), F.col("n.id").alias("neighbour"),
                    F.col("n.dist").alias("dist"), *[F.col("n.xs").alias("xs")] * coordinates))


def k_distance(tree: Tree, k: int = 7) -> DataFrame:
    """(id, dist): distance to the k-th nearest row, the row itself counted as the first."""
    near = nearest(tree, k, False).select("pid", F.get("neighbours", F.lit(k - 1))["dist"].alias("dist"))
    return tree.rows.join(near, "pid").select("id", "dist")


# --------------------------------------------------------------------------- radius work
@dataclass
class RadiusPairs:
    """Box pairs within a radius: whole pairs (accepted) and leaf blocks to check point by point."""

    tree: Tree
    eps: float
    accepted: DataFrame
    tiles: DataFrame


def radius_pairs(tree: Tree, eps: float) -> RadiusPairs:
    lim = float(eps) * float(eps)

    def decide(d):
        return d.withColumns({"drop": tree.space.min_sq("q_", "c_") > lim,
                              "accept": tree.space.max_sq("q_", "c_") <= lim})
    accepted, tiles = _refine(tree, decide)
    acc = accepted[0]
    for a in accepted[1:]:
        acc = acc.unionByName(a)
    return RadiusPairs(tree, eps, acc, tiles)


def _ancestors(tree: Tree, nodes: DataFrame, col: str) -> DataFrame:
    """(col, up): a node and everything above it; at most depth + 1 rows per node."""
    return nodes.select(col).distinct().withColumn("up", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(tree.depth)),
        lambda s: F.call_function("shiftright", F.col(col), s.cast("int"))))).where("up > 0")


def _tile_reduce(rp: RadiusPairs, points: DataFrame, value: str, how: str) -> DataFrame:
    """Per point: sum or min of ``value`` over the points of its undecided blocks within eps."""
    t = Tree(rp.tree.space, points, rp.tree.rows, rp.tree.nodes, rp.tree.depth, rp.tree.leaf_size)
    q, c = _blocks(rp.tree, "q_"), _blocks(t, "c_", (value,))
    sq, lim = _distances(rp.tree.space), float(rp.eps) ** 2

    def reduce_tile(batches):
        import numpy as np
        import pandas as pd
        for pdf in batches:
            for row in pdf.to_dict("records"):
                near = sq(row) <= lim
                v = np.asarray(row[f"c_{value}"], dtype=np.int64)
                if how == "sum":
                    out = near @ v
                else:
                    out = np.where(near, v[None, :], np.iinfo(np.int64).max).min(axis=1)
                hit = near.any(axis=1)
                yield pd.DataFrame({"pid": np.asarray(row["q_pid"])[hit], "v": out[hit]})
    got = _tile_rows(rp.tiles, q, c).mapInPandas(reduce_tile, "pid long, v long")
    return got.groupBy("pid").agg((F.sum if how == "sum" else F.min)("v").alias("v"))


def _reduce_in_radius(rp: RadiusPairs, points: DataFrame, value: str, how: str) -> DataFrame:
    """(pid, v): sum or min of an integer value over all points within eps of each point."""
    tree = rp.tree
    f = F.sum if how == "sum" else F.min
    per_leaf = points.groupBy("leaf").agg(f(value).alias("v"))
    up = _ancestors(tree, per_leaf, "leaf")
    per_node = up.join(per_leaf, "leaf").groupBy(F.col("up").alias("c_node")).agg(f("v").alias("v"))
    whole = rp.accepted.join(per_node, "c_node").groupBy(F.col("q_node").alias("up")).agg(f("v").alias("v"))
    leaf_all = _ancestors(tree, tree.points, "leaf").join(whole, "up").groupBy("leaf").agg(f("v").alias("v"))
    a = tree.points.select("pid", "leaf").join(leaf_all, "leaf").select("pid", "v")
    return a.unionByName(_tile_reduce(rp, points, value, how)).groupBy("pid").agg(f("v").alias("v"))


def radius_counts(rp: RadiusPairs) -> DataFrame:
    """(id, n): rows within eps of every row, itself included."""
    per_point = _reduce_in_radius(rp, rp.tree.points, "weight", "sum")
    return rp.tree.rows.join(per_point, "pid").select("id", F.col("v").alias("n"))


def connected_components(edges: DataFrame, vertices: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(v, comp): smallest vertex of each component by alternating star contractions.

    ``edges`` (a, b) must connect vertices of bounded degree.  Every round
    shortens paths by about half and is written to the scratch folder.
    """
    e = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low2.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        e = materialise(small)
        # settled: every vertex points once, and only at vertices that point nowhere
        twice = e.groupBy("a").count().where("count > 1").select("a")
        chained = e.select("a").join(e.select(F.col("b").alias("a")), "a", "left_semi")
        if twice.unionByName(chained).isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return vertices.join(e.withColumnRenamed("a", "v"), "v", "left").select("v", F.coalesce("b", "v").alias("comp"))


def density_clusters(tree: Tree, eps: float, min_samples: int = 7) -> DataFrame:
    """(id, is_core, cluster): density clustering; noise is -1.

    A core row has ``min_samples`` rows within eps, itself included.  Clusters
    are numbered by their smallest core id; a border row joins the lowest
    numbered cluster that has a core row within eps.
    """
    rp = radius_pairs(tree, eps)
    counts = _reduce_in_radius(rp, tree.points, "weight", "sum")
    pts = materialise(tree.points.join(counts.withColumnRenamed("v", "n"), "pid")
                      .withColumn("is_core", F.col("n") >= min_samples))
    core = pts.where("is_core")
    # vertices: boxes are -node, core points are pid; a box inside an accepted pair is one piece
    live = _ancestors(tree, core, "leaf").select(F.col("up").alias("node")).distinct()
    acc = (rp.accepted.join(live.withColumnRenamed("node", "q_node"), "q_node")
           .join(live.withColumnRenamed("node", "c_node"), "c_node"))
    whole = acc.select(F.col("q_node").alias("top")).union(acc.select("c_node")).distinct()
    inherited = (live.select("node").withColumn("top", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(tree.depth)),
        lambda s: F.call_function("shiftright", F.col("node"), s.cast("int"))))).where("top > 0")
        .join(whole, "top", "left_semi").select("node").distinct())
    inherited = materialise(inherited)
    parent = (inherited.select("node", F.expr("node div 2").alias("p"))
              .join(inherited.select(F.col("node").alias("p")), "p", "left_semi"))
    box_edges = acc.select((-F.col("q_node")).alias("a"), (-F.col("c_node")).alias("b")).unionByName(
        parent.select((-F.col("node")).alias("a"), (-F.col("p")).alias("b")))
    # a core point stands for itself unless its whole leaf is one piece
    solid = inherited.select(F.col("node").alias("leaf")).withColumn("solid", F.lit(True))
    corep = materialise(core.join(solid, "leaf", "left").withColumn(
        "vertex", F.when(F.col("solid"), -F.col("leaf")).otherwise(F.col("pid"))).drop("solid"))
    t = Tree(tree.space, corep, tree.rows, tree.nodes, tree.depth, tree.leaf_size)
    q, c = _blocks(t, "q_", ("vertex",)), _blocks(t, "c_", ("vertex",))
    sq, lim = _distances(tree.space), float(eps) ** 2

    def tile_edges(batches):
        import numpy as np
        import pandas as pd
        for pdf in batches:
            for row in pdf.to_dict("records"):
                near = sq(row) <= lim
                qv, cv = np.asarray(row["q_vertex"]), np.asarray(row["c_vertex"])
                # a spanning forest of the block says as much as all its close pairs
                root = {}

                def find(x):
                    while root.setdefault(x, x) != x:
                        root[x] = root[root[x]]
                        x = root[x]
                    return x
                out = []
                for i, j in zip(*np.nonzero(near)):
                    a, b = int(qv[i]), int(cv[j])
                    ra, rb = find(a), find(b)
                    if ra != rb:
                        root[ra] = rb
                        out.append((a, b))
                yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    point_edges = _tile_rows(rp.tiles.where("q_node <= c_node"), q, c).mapInPandas(tile_edges, "a long, b long")
    vertices = (corep.select(F.col("vertex").alias("v")).unionByName(
        inherited.select((-F.col("node")).alias("v"))).distinct())
    comp = connected_components(box_edges.unionByName(point_edges), vertices)
    labelled = corep.join(comp.withColumnRenamed("v", "vertex"), "vertex")
    first = labelled.groupBy("comp").agg(F.min("pid").alias("first_core"))
    labelled = materialise(labelled.join(first, "comp").select("pid", *tree.space.all, "weight", "leaf", "first_core"))
    border = _reduce_in_radius(rp, labelled, "first_core", "min")
    per_point = (pts.select("pid", "is_core").join(labelled.select("pid", "first_core"), "pid", "left")
                 .join(border.withColumnRenamed("v", "near_core"), "pid", "left")
                 .select("pid", "is_core", F.coalesce("first_core", "near_core").alias("anchor")))
    number = id_rank(first.select("first_core"), "first_core", "cluster").select(
        F.col("first_core").alias("anchor"), (F.col("cluster") - 1).alias("cluster"))
    per_point = per_point.join(number, "anchor", "left").select(
        "pid", "is_core", F.coalesce("cluster", F.lit(-1)).cast("long").alias("cluster"))
    return tree.rows.join(per_point, "pid").select("id", "is_core", "cluster")


def single_link_cut(tree: Tree, height: float) -> DataFrame:
    """(id, cluster): components of the graph that joins rows at most ``height`` apart."""
    return density_clusters(tree, height, min_samples=1).select("id", "cluster")
