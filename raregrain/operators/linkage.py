"""Single linkage: the whole merge tree as a minimum spanning tree, by Boruvka rounds.

In a round every component takes its shortest edge to another one; ties go to the smaller ids, so no cycle arises.
While lists of nearest neighbours decide that edge (it is shorter than all that any list of the component leaves out)
a round is a few joins on the lists. What is left, but for the largest component, then looks for its nearest foreign point
among the leaves of the box tree: leaf pairs inside one component, or farther apart than the best edge known, are passed
over. A round with a search halves the components at least.

The edges in the order of their length are the merges, and the components over the edges up to a height are the
clusters cut there.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import value_rank
from ..functions.scratch import materialise
from .spatial import GROUP, Leaf, Tree, connected_components, dealt, leaf_files, middle, nearest, read_leaves, stored_leaves

EDGE = ["dist", "a", "b"]
SLACK = 1 + 1e-9  # against rounding of bounds
FAR = float("inf")


def _shortest(found: DataFrame) -> DataFrame:
    """(comp, dist, a, b, to): the least edge of each component."""
    return (found.groupBy("comp").agg(F.min(F.struct(*EDGE, "to")).alias("e")).select("comp", "e.*"))


def _labelled(edges: DataFrame, comp: DataFrame) -> DataFrame:
    """Edges (pid, other, dist) between components, with both of them."""
    a = comp.select("pid", "comp")
    b = comp.select(F.col("pid").alias("other"), F.col("comp").alias("to"))
    return edges.join(a, "pid").join(b, "other").where("comp <> to")


def _merged(comp: DataFrame, chosen: DataFrame) -> DataFrame:
    new = connected_components(chosen.select(F.col("comp").alias("a"), F.col("to").alias("b")),
                               comp.select(F.col("comp").alias("v")).distinct())
    return materialise(comp.join(new.select(F.col("v").alias("comp"), F.col("comp").alias("into")), "comp")
                       .select("pid", F.col("into").alias("comp")))


def _reach(tree: Tree, points: DataFrame, lists: DataFrame) -> DataFrame:
    """(comp, reach): a length that the shortest edge of a component does not exceed.

    From the lists, and from each component's first point to that of the next one in the order of the boxes.
    """
    dims = tree.space.dims
    first = points.groupBy("comp").agg(F.min(F.struct("leaf", "pid", *dims)).alias("p")).select("comp", "p.*")
    ranked = materialise(value_rank(first, "leaf", "pid", out="r"))
    after = ranked.select((F.col("r") - 1).alias("r"), F.col("comp").alias("next"), *[F.col(c).alias(f"n_{c}") for c in dims])
    gap = sum([(F.col(c) - F.col(f"n_{c}")) * (F.col(c) - F.col(f"n_{c}")) for c in dims], F.lit(0.0))
    steps = ranked.join(after, "r").select("comp", "next", F.sqrt(gap).alias("dist"))
    known = (steps.select("comp", "dist").unionByName(steps.select(F.col("next").alias("comp"), "dist"))
             .unionByName(lists.select("comp", "dist")))
    return known.groupBy("comp").agg(F.min("dist").alias("reach"))


def _searched(tree: Tree, comp: DataFrame, lists: DataFrame, seen: DataFrame) -> DataFrame:
    """The least edge of each component but the largest, whose edges the others find.

    Points that have ``seen`` farther than a length known for their component have nothing nearer outside their list; the
    others look through the leaves, which each task reads past its own.
    """
    points = materialise(tree.points.join(comp, "pid"))
    large = comp.groupBy("comp").count().orderBy(F.desc("count"), "comp").first()["comp"]
    reach = materialise(_reach(tree, points, lists).where(F.col("comp") != large))
    look = points.join(reach, "comp").join(seen, "pid").where(F.col("seen") <= F.col("reach") * SLACK)
    space, mid = tree.space, middle(tree)
    leaves, mine = stored_leaves(tree, points, ("comp",)), stored_leaves(tree, look, ("comp", "reach"))
    files, columns = leaves.inputFiles(), leaves.columns

    def closer(q: Leaf, best: dict, c: Leaf) -> None:
        """Take shorter edges between ``q`` and ``c`` into ``best``: {component: (dist, a, b, other component)}."""
        own, other = q.more["comp"], c.more["comp"]
        if len(q.more["names"]) == 1 and (other == own[0]).all():
            return
        known = np.array([best[v][0] if v in best else np.inf for v in q.more["names"]])[q.more["at"]]
        limit = (np.minimum(known, q.more["reach"]) * SLACK) ** 2
        if q.apart(c) > limit.max():
            return
        rough, off = q.roughly(c)
        rough[own[:, None] == other[None, :]] = np.inf
        near = np.full(len(q.more["names"]), np.inf)
        np.minimum.at(near, q.more["at"], rough.min(axis=1) + q.norm + off)
        limit = np.minimum(limit, near[q.more["at"]])
        i, j = np.nonzero(rough <= (limit - q.norm + off)[:, None])
        d, p, o = q.distances(i, c, j), q.pid[i], c.pid[j]
        low, high = np.minimum(p, o), np.maximum(p, o)
        order = np.lexsort((high, low, d, q.more["at"][i]))
        for x in order[np.unique(q.more["at"][i][order], return_index=True)[1]]:
            name, edge = int(own[i[x]]), (float(d[x]), int(low[x]), int(high[x]), int(other[j[x]]))
            best[name] = min(best.get(name, edge), edge)

    def work(batches):
        def out(group: list[Leaf]):
            best: dict = {}
            for q in group:
                q.more["names"], q.more["at"] = np.unique(q.more["comp"], return_inverse=True)
            for c in read_leaves(space, mid, leaf_files(files, columns), ("comp",)):
                c.more["comp"] = c.more["comp"].to_numpy()
                for q in group:
                    closer(q, best, c)
            if best:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(best), pa.int64()), *[pa.array(v, t) for v, t in zip(zip(*best.values()), (
                        pa.float64(), pa.int64(), pa.int64(), pa.int64()))]], names=["comp", *EDGE, "to"])
        group: list[Leaf] = []
        for q in read_leaves(space, mid, batches, ("comp", "reach")):
            q.more = {n: v.to_numpy(zero_copy_only=False) for n, v in q.more.items()}
            group.append(q)
            if sum(len(v.pid) for v in group) >= GROUP:
                yield from out(group)
                group = []
        if group:
            yield from out(group)
    found = dealt(tree, mine).mapInArrow(work, "comp long, dist double, a long, b long, to long")
    listed = lists.where(F.col("comp") != large).select("comp", *EDGE, "to")
    return _shortest(found.unionByName(listed))


def spanning_tree(tree: Tree, k: int = 8) -> DataFrame:
    """(a, b, dist): a minimum spanning tree of the rows; copies of a point hang on its smallest id at 0.

    Missing coordinates must be gone. Of equal lengths the edge with the smaller ids is taken.
    """
    points = tree.points.withColumn("weight", F.lit(1).cast("long"))
    alone = replace(tree, points=points, rows=points.select(F.col("pid").alias("id"), "pid"),
                    nodes=tree.nodes.withColumn("weight", F.col("n_points")))
    near = materialise(nearest(alone, k + 1, False).select("pid", "neighbours.id", "neighbours.dist"))
    lists = materialise(near.select("pid", F.explode(F.arrays_zip("id", "dist")).alias("n"))
                        .select("pid", F.col("n.id").alias("other"), F.col("n.dist").alias("dist")).where("pid <> other"))
    seen = near.select("pid", F.when(F.size("id") > k, F.array_max("dist")).otherwise(F.lit(FAR)).alias("seen"))
    comp = materialise(points.select("pid", F.col("pid").alias("comp")))
    edges = tree.rows.where("id <> pid").select(F.col("pid").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("dist"))
    ends = {"a": F.least("pid", "other"), "b": F.greatest("pid", "other")}
    by_lists = True
    while comp.select("comp").distinct().limit(2).count() > 1:
        labelled = materialise(_labelled(lists, comp).withColumns(ends))
        if by_lists:
            sure = comp.join(seen, "pid").groupBy("comp").agg(F.min("seen").alias("seen"))
            chosen = materialise(_shortest(labelled).join(sure, "comp").where("dist < seen").drop("seen"))
            by_lists = not chosen.isEmpty()
        if not by_lists:
            chosen = materialise(_searched(alone, comp, labelled, seen))
        edges = edges.unionByName(chosen.select("a", "b", "dist").distinct())
        comp = _merged(comp, chosen)
        lists = labelled.select("pid", "other", "dist")
    return materialise(edges)


def merges(edges: DataFrame) -> DataFrame:
    """(merge, height, a, b): the merges of single linkage in their order, from 1; a and b are the closest rows."""
    key = F.xxhash64("a", "b")
    return (value_rank(edges.withColumn("key", key), "dist", "key", out="merge")
            .select("merge", F.col("dist").alias("height"), "a", "b"))


def cut(tree: Tree, edges: DataFrame, height: float) -> DataFrame:
    """(id, cluster): the clusters that are whole at ``height``, named by their smallest id."""
    got = connected_components(edges.where(F.col("dist") <= height), tree.rows.select(F.col("id").alias("v")))
    return got.select(F.col("v").alias("id"), F.col("comp").alias("cluster"))
